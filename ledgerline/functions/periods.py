"""Periods as text: `YYYY-MM`, `YYYY-Qn` and `YYYY`. The shape is told by the text alone. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(period: Column | str) -> Column:
    return F.col(period) if isinstance(period, str) else period


def period_shape(period: Column | str) -> Column:
    """M, Q or A; null for anything else."""
    p = _c(period)
    return F.when(p.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), "M").when(p.rlike(r"^\d{4}-Q[1-4]$"), "Q").when(p.rlike(r"^\d{4}$"), "A")


def period_shape_loose(period: Column | str) -> Column:
    """As period_shape, but what is neither a quarter nor a year counts as a month."""
    p = _c(period)
    return F.when(p.contains("Q"), "Q").when(F.length(p) == 4, "A").otherwise("M")


def year(period: Column | str) -> Column:
    return F.substring(_c(period), 1, 4).try_cast("int")


def month_num(period: Column | str) -> Column:
    """The month of a monthly period, else null."""
    p = _c(period)
    return F.when(period_shape(p) == "M", F.substring(p, 6, 2).try_cast("int"))


def to_month(period: Column | str) -> Column:
    """The last month that a period covers."""
    p = _c(period)
    shape = period_shape(p)
    return F.when(shape == "M", F.substring(p, 6, 2).try_cast("int")).when(shape == "Q", F.substring(p, 7, 1).try_cast("int") * 3).when(shape == "A", F.lit(12))


def to_year_month(period: Column | str) -> Column:
    return F.format_string("%s-%02d", F.substring(_c(period), 1, 4), to_month(period))


def period_ordinal(period: Column | str) -> Column:
    """Months since year 0 at the period's last month."""
    return year(period) * 12 + to_month(period)


def months_between(earlier: Column | str, later: Column | str) -> Column:
    return period_ordinal(later) - period_ordinal(earlier)


def period_rank(period: Column | str) -> Column:
    """Place within the year for sorting: a year stands before its first quarter, a quarter with its first month."""
    p = _c(period)
    shape = period_shape(p)
    return F.when(shape == "A", F.lit(0)).when(shape == "Q", F.substring(p, 7, 1).try_cast("int") * 3 - 2).otherwise(F.substring(p, 6, 2).try_cast("int"))


def period_sort_key(period: Column | str) -> Column:
    return year(period) * 100 + period_rank(period)


def period_end_date(period: Column | str) -> Column:
    return F.last_day(F.make_date(year(period), to_month(period), F.lit(1)))


def _monthly(ordinal: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor((ordinal - 1) / 12).try_cast("int"), ((ordinal - 1) % 12 + 1).try_cast("int"))


def shift(period: Column | str, steps: int) -> Column:
    """The period so many steps of its own shape on."""
    p = _c(period)
    shape = period_shape(p)
    quarter = year(p) * 4 + F.substring(p, 7, 1).try_cast("int") + steps
    return (
        F.when(shape == "M", _monthly(period_ordinal(p) + steps))
        .when(shape == "Q", F.format_string("%04d-Q%d", F.floor((quarter - 1) / 4).try_cast("int"), ((quarter - 1) % 4 + 1).try_cast("int")))
        .when(shape == "A", F.format_string("%04d", year(p) + steps))
    )


def next_period(period: Column | str) -> Column:
    return shift(period, 1)


def year_ago_period(period: Column | str) -> Column:
    """The same place one year earlier, for every shape."""
    p = _c(period)
    return F.concat(F.lpad((year(p) - 1).cast("string"), 4, "0"), F.substring(p, 5, 10))


def prev_ytd_period(period: Column | str) -> Column:
    """The period before, within the same year; null for the first of a year and for years."""
    p = _c(period)
    first = F.substring(p, 6, 2).isin("01", "Q1") | (F.length(p) == 4)
    return F.when(~first, shift(p, -1))


def steps_between(a: Column | str, b: Column | str) -> Column:
    """Steps of the shape that both share from a to b, else null."""
    unit = F.when(period_shape(a) == "M", 1).when(period_shape(a) == "Q", 3).when(period_shape(a) == "A", 12)
    return F.when(period_shape(a) == period_shape(b), ((period_ordinal(b) - period_ordinal(a)) / unit).try_cast("int"))


def decode_code(code: Column | str) -> Column:
    """202605MM, 202602SS and 2026AA (or 202600YY) as periods: months, quarters and years by the suffix."""
    c = _c(code)
    kind, y, n = F.upper(F.right(c, F.lit(2))), F.substring(c, 1, 4), F.substring(c, 5, 2)
    return F.when(kind == "MM", F.concat_ws("-", y, n)).when(kind == "SS", F.concat(y, F.lit("-Q"), n.try_cast("int").cast("string"))).when(kind.isin("AA", "YY"), y)


def encode_code(period: Column | str) -> Column:
    p = _c(period)
    shape = period_shape(p)
    y = F.substring(p, 1, 4)
    return F.when(shape == "M", F.concat(y, F.substring(p, 6, 2), F.lit("MM"))).when(shape == "Q", F.concat(y, F.lit("0"), F.substring(p, 7, 1), F.lit("SS"))).when(shape == "A", F.concat(y, F.lit("AA")))


def period_label(period: Column | str, ytd: Column, span: Column) -> Column:
    """What a sentence calls a period: 2026 年 5 月, 2026 年 1-5 月 for cumulative and merged prints, 二季度, 全年."""
    p = _c(period)
    shape, y = period_shape_loose(p), F.concat(F.substring(p, 1, 4), F.lit(" 年"))
    quarter = F.element_at(F.array(*map(F.lit, ("一", "二", "三", "四"))), F.substring(p, 7, 1).try_cast("int"))
    month = F.substring(p, 6, 2).try_cast("int").cast("string")
    months = F.when((span > 1) | ytd, F.concat(F.lit(" 1-"), month)).otherwise(F.concat(F.lit(" "), month))
    return F.when(shape == "A", F.concat(y, F.lit("全年"))).when(shape == "Q", F.concat(y, quarter, F.lit("季度"))).otherwise(F.concat(y, months, F.lit(" 月")))


def cohort_key(period: Column | str, span: Column) -> Column:
    """Which periods of other years compare: the same month or quarter, merged prints apart."""
    p = _c(period)
    return F.when(span == 2, "jan_feb").otherwise(F.when(F.length(p) > 4, F.substring(p, 6, 2)).otherwise("A"))


def period_format(period: Column | str) -> Column:
    p = _c(period)
    return F.when(p.rlike(r"^\d{4}-\d{2}$"), "YYYY-MM").when(p.rlike(r"^\d{4}-Q\d$"), "YYYY-Qn").when(p.rlike(r"^\d{4}$"), "YYYY").when(p.rlike(r"^\d{4}-\d{2}-\d{2}$"), "YYYY-MM-DD").otherwise("other")
