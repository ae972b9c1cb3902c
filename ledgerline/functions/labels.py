"""Labels, titles and provenance of series, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions import periods as P

#: Fixed: the publishing agency by the first part of a series id.
AGENCIES = {
    "nbs": "国家统计局", "pbc": "中国人民银行", "mof": "财政部", "mohurd": "住房和城乡建设部", "customs": "海关总署",
    "caam": "中国汽车工业协会", "safe": "国家外汇管理局", "cflp": "中国物流与采购联合会",
}


def _ym(year: Column, month: Column) -> Column:
    return F.when((year != "") & month.isNotNull(), F.format_string("%s-%02d", year, month))


def _int(text: Column, pattern: str) -> Column:
    """The first number that a pattern's group 1 finds, or null."""
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def _covered(title: Column) -> Column:
    """The last month of the part of a year that a title names in words; null if it names none."""
    return F.when(title.contains("前三季度"), 9).when(title.contains("上半年"), 6).when(title.contains("一季度"), 3)


def title_period_release(title: Column) -> Column:
    """2026年5月份…, 2026年1-5月…"""
    return _ym(F.regexp_extract(title, r"(\d{4})年", 1), _int(title, r"年(?:1[-—－])?(\d{1,2})月"))


def title_period_bulletin(title: Column) -> Column:
    """A year alone stands for all of it."""
    return _ym(F.regexp_extract(title, r"(\d{4})年", 1), F.coalesce(_int(title, r"年(?:1[-—－])?(\d{1,2})月"), _covered(title), F.lit(12)))


def title_period_income(title: Column) -> Column:
    bare = F.regexp_replace(title, r"\s", "")
    fits = bare.rlike(r"^\d{4}年(一季度|上半年|前三季度)?居民收入和消费支出情况$")
    return F.when(fits, _ym(F.substring(bare, 1, 4), F.coalesce(_covered(bare), F.lit(12))))


def title_period_inferred(title: Column, published: Column) -> Column:
    """As title_period_income, with the year of publication if the title has none."""
    bare = F.regexp_replace(title, r"\s", "")
    without = bare.rlike(r"^(一季度|上半年|前三季度)居民收入和消费支出情况$")
    return F.coalesce(title_period_income(title), F.when(without, _ym(F.regexp_extract(published, r"^(\d{4})", 1), _covered(bare))))


def title_period_fiscal(title: Column) -> Column:
    whole = F.when(title.rlike(r"\d{4}年财政收支情况"), 12)
    return _ym(F.regexp_extract(title, r"^(\d{4})年", 1), F.coalesce(_covered(title), whole, _int(title, r"(?:1[-—－])?(\d{1,2})月财政收支情况")))


def published_at(text: Column) -> Column:
    """A timestamp from ISO and slashed dates, or null."""
    t = F.regexp_replace(F.trim(text), "/", "-")
    day = F.regexp_extract(t, r"^(\d{4}-\d{1,2}-\d{1,2})", 1)
    time = F.regexp_extract(t, r"^\d{4}-\d{1,2}-\d{1,2}[T ](\d{2}:\d{2}(?::\d{2})?)", 1)
    return F.coalesce(F.concat_ws(" ", day, F.when(time != "", time)).try_cast("timestamp"), day.try_cast("timestamp"))


def window_start(name: Column) -> Column:
    return F.coalesce(_int(name, r"\((\d{4})?-(?:\d{4})?\)\s*$"), F.lit(1990))


def window_end(name: Column) -> Column:
    return F.coalesce(_int(name, r"\((?:\d{4})?-(\d{4})?\)\s*$"), F.lit(2100))


def add_months(period: Column | str, delta: Column) -> Column:
    """The month so many months on, for a monthly period."""
    o = P.period_ordinal(period) + delta
    return F.format_string("%04d-%02d", F.floor((o - 1) / 12).cast("int"), ((o - 1) % 12 + 1).cast("int"))


def rule_window(period: Column | str, months: Column, first: Column, last: Column, grace: int = 3) -> Column:
    """(opens, closes) of a release window; a last day of 28 or more is the month's end."""
    start = F.to_date(F.concat(add_months(period, months), F.lit("-01")))
    end = F.last_day(start)
    closes = F.when(last >= 28, end).otherwise(F.least(F.date_add(start, last - 1), end))
    return F.struct(F.least(F.date_add(start, first - 1), end).alias("opens"), F.date_add(closes, grace).alias("closes"))


def growth_pair(text: Column) -> Column:
    """(nominal, real) of texts such as 5.3%（4.1%）; words of decline are minus signs."""
    t = F.regexp_replace(text, "下降", "-")
    n = F.transform(F.regexp_extract_all(t, F.lit(r"(-?[0-9]+(?:\.[0-9]+)?)"), F.lit(1)), lambda v: v.try_cast("double"))
    return F.struct(F.get(n, F.lit(0)).alias("nominal"), F.when(t.contains("（"), F.get(n, F.lit(1))).alias("real"))


def signed_yoy(direction: Column, value: Column) -> Column:
    return F.when(direction.isin("下降", "减少"), -value).otherwise(value)


def make_src(published: Column, source: Column, period: Column) -> Column:
    day = F.regexp_replace(F.split_part(published, F.lit(" "), F.lit(1)), "/", "")
    return (
        F.when(F.coalesce(published, F.lit("")) != "", F.concat(F.lit("rel:"), day)).when(source.contains("国家数据") | (source == "nbs_data"), "natdata:monthly")
        .when(source.contains("历史补充"), "legacy-annual-bulletin").otherwise(F.concat(F.lit("legacy:"), F.coalesce(period, F.lit(""))))
    )


def src_indicator_id(src: Column) -> Column:
    """The indicator of a provenance such as dg:abc123, else null."""
    return F.nullif(F.regexp_extract(F.trim(src), r"^dg:([0-9A-Za-z]+)", 1), F.lit(""))


def level_to_tier(level: Column) -> Column:
    return F.when(level == 1, 1).when(level.between(2, 4), 2).otherwise(3)


def metric_from_id(series: Column) -> Column:
    return F.when(series.contains("newhome"), "new_home").when(series.contains("resale"), "resale_home")


def label_candidates(label: Column, others: Column, no_source_text: Column) -> Column:
    found = F.concat(F.array(F.nullif(label, F.lit(""))), F.coalesce(others, F.array().cast("array<string>")))
    return F.when(F.coalesce(no_source_text, F.lit(False)), F.array().cast("array<string>")).otherwise(F.array_compact(found))


def file_year(name: Column) -> Column:
    return _int(name, r"^(\d{4})-\d{2}")


def headline_name(short: Column, full: Column) -> Column:
    return F.coalesce(F.nullif(short, F.lit("")), full)


def level_measure(calibers: Column) -> Column:
    return F.when(F.array_contains(calibers, "single"), "m").when(F.array_contains(calibers, "ytd"), "ytd")


def resolve_caliber(calibers: Column) -> Column:
    return F.when(F.array_contains(calibers, "single"), "single").otherwise("ytd")


def severity_for_mismatch(agency: Column, tier: Column) -> Column:
    return F.when((F.coalesce(agency, F.lit("")) == "cflp") | (tier == 3), "warn").otherwise("block")


def agency_from_id(series: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in AGENCIES.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.substring_index(series, "-", 1)), F.lit("官方数据"))


def normalize_city(city: Column) -> Column:
    return F.regexp_replace(city, r"\s+", "")


# --- charts and cards ---------------------------------------------------------------------------------------------------


def natural_decimals(v: Column) -> Column:
    a = F.abs(F.round(v, 6))
    return F.when(F.round(a, 1) != a, 2).otherwise(1)


def format_number(v: Column) -> Column:
    """With thousands commas and the decimals that it needs; a dash for none."""
    return F.when(v.isNull() | F.isnan(v), "—").when(natural_decimals(v) == 2, F.format_number(v, 2)).otherwise(F.format_number(v, 1))


def _fixed(v: Column) -> Column:
    return F.when(natural_decimals(v) == 2, F.format_string("%.2f", v)).otherwise(F.format_string("%.1f", v))


def format_percent(v: Column, sign: bool = False) -> Column:
    plus = F.when(v > 0, "+").otherwise("") if sign else F.lit("")
    return F.when(v.isNull() | F.isnan(v), "—").otherwise(F.concat(plus, _fixed(v), F.lit("%")))


def format_pp(v: Column) -> Column:
    return F.when(v.isNull() | F.isnan(v), "—").otherwise(F.concat(_fixed(F.abs(v)), F.lit(" 个百分点")))


def format_date(at: Column) -> Column:
    text = F.format_string("%d 年 %d 月 %d 日", F.year(at), F.month(at), F.dayofmonth(at))
    return F.when(at.isNotNull(), text).otherwise("—")


def circled_numeral(n: Column) -> Column:
    return F.when(n.between(1, 20), F.substr(F.lit("①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"), n.cast("int"), F.lit(1))).otherwise(F.concat(F.lit("("), n.cast("string"), F.lit(")")))


def decimals_for_step(step: Column) -> Column:
    return F.when((step > 0) & (step < 1), F.greatest(F.lit(1), F.ceil(-F.log10(step)).cast("int"))).otherwise(0)


def plotted_unit_label(kind: Column, unit: Column) -> Column:
    return F.when(kind == "yoy", "同比 %").when(kind == "mom", "环比 %").otherwise(unit)


def tooltip_period(period: Column | str, cumulative: Column) -> Column:
    p = F.col(period) if isinstance(period, str) else period
    shape, y, month = P.period_shape_loose(p), F.concat(F.substring(p, 1, 4), F.lit(" 年")), F.substring(p, 6, 2).try_cast("int")
    upto = F.when(cumulative & (month > 1), F.concat(F.lit(" 1-"), month.cast("string"))).otherwise(F.concat(F.lit(" "), month.cast("string")))
    return F.when(shape == "A", y).when(shape == "Q", F.concat(y, F.lit(" "), F.substring(p, 7, 1), F.lit(" 季度"))).otherwise(F.concat(y, upto, F.lit(" 月")))


def tooltip_value(v: Column, percent: Column, unit: Column) -> Column:
    number = F.when(F.coalesce(unit, F.lit("")) != "", F.concat(format_number(v), F.lit(" "), unit)).otherwise(format_number(v))
    return F.when(v.isNull(), "—").when(percent, format_percent(v)).otherwise(number)


def headline_and_dek(takeaway: Column, name: Column, unit: Column) -> Column:
    """(headline, dek): the sentence over name and unit, or the name over the unit if there is no sentence."""
    has = F.coalesce((takeaway != "") & (takeaway != name), F.lit(False))
    return F.struct(F.when(has, takeaway).otherwise(name).alias("headline"), F.when(has, F.concat(name, F.lit(" · "), unit)).otherwise(unit).alias("dek"))


def source_line(agency: Column, label: Column, ytd: Column, revised: Column) -> Column:
    base = F.concat(F.lit("资料来源："), agency, F.lit(" · 截至 "), label, F.lit(" · "), F.when(ytd, "累计口径").otherwise("当月口径"))
    return F.when(revised, F.concat(base, F.lit(" ※ 历史数据已修订"))).otherwise(base)
