"""Numbers and their text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_number(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v)


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def rel_diff(a: Column, b: Column) -> Column:
    """|a - b| over the greater size; 0 if both are 0."""
    most = F.greatest(F.abs(a), F.abs(b))
    return F.when(most == 0, 0.0).otherwise(F.abs(a - b) / most)


def robust_z(v: Column, median: Column, mad: Column) -> Column:
    """Distance from the median in scaled median deviations; at no deviation 0 or infinite."""
    gap = v - median
    endless = F.when(gap > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(mad == 0, F.when(gap == 0, 0.0).otherwise(endless)).otherwise(gap / (mad * 1.4826))


def display_tolerance(decimals: Column) -> Column:
    """Half a unit of the last shown digit."""
    return F.lit(0.5) * F.pow(F.lit(10.0), -decimals)


def tolerance_for(v: Column) -> Column:
    """How far a found number may lie from a stored one, by its size."""
    a = F.abs(v)
    return F.when(a < 10, 0.06).when(a < 100, 0.1).when(a < 10000, 1.0).otherwise(a * 0.001)


def close_enough(expected: Column, observed: Column, tolerance: Column) -> Column:
    return expected.isNotNull() & observed.isNotNull() & (F.abs(expected - observed) <= tolerance + 1e-9)


def values_equal(a: Column, b: Column) -> Column:
    """Equal as numbers, signed zeros and nulls included."""
    return (a + 0.0).eqNullSafe(b + 0.0)


def norm_signed_zero(v: Column) -> Column:
    return v + 0.0


def decimal_places(v: Column, most: int = 4) -> Column:
    """The fewest decimals, up to `most`, that give the value back."""
    out = F.lit(most)
    for n in range(most - 1, -1, -1):
        out = F.when(F.abs(F.round(v, n) - v) < 1e-9, n).otherwise(out)
    return F.when(v.isNotNull(), out)


def numeric(text: Column) -> Column:
    """A number from text with thousands commas; blanks and dashes are null."""
    t = F.trim(text)
    return F.when(~t.isin("", "-", "--", "—"), F.regexp_replace(t, ",", "").try_cast("double"))


def to_number(text: Column) -> Column:
    """As numeric, but of text that is no number the first number in it."""
    t = F.trim(text)
    bare = F.regexp_replace(t, ",", "")
    return F.when(~t.isin("", "-", "--", "—"), F.coalesce(bare.try_cast("double"), F.regexp_extract(bare, r"-?[0-9]+(?:\.[0-9]+)?", 0).try_cast("double")))


def sign_from_word(word: Column) -> Column:
    """1 for growth words, -1 for words of decline, null for others."""
    return F.when(word.isin("增长", "上涨", "上升", "提高", "增加"), 1).when(word.isin("下降", "下跌", "减少", "回落", "降低"), -1)


def yi_yuan(amount: Column, unit: Column) -> Column:
    """Hundreds of millions from an amount in 亿元 or 万亿元."""
    return amount * F.when(unit.startswith("万亿"), 10000.0).otherwise(1.0)


def fmt_magnitude(v: Column) -> Column:
    """The size of a value with one decimal, or two if it has them; the sign is left to the words around it."""
    a = F.abs(F.round(v, 6))
    return F.when(F.round(a, 1) == a, F.format_string("%.1f", a)).when(a.isNotNull(), F.format_string("%.2f", a))


def fmt_pct(v: Column) -> Column:
    return F.concat(fmt_magnitude(v), F.lit("%"))


def fmt_pp(v: Column) -> Column:
    return F.concat(fmt_magnitude(v), F.lit(" 个百分点"))


def fmt_points(v: Column) -> Column:
    return F.concat(fmt_magnitude(v), F.lit(" 个点"))


def up_down_class(v: Column) -> Column:
    return F.when(v > 0, "up").when(v < 0, "down").otherwise("flat")


def nice_step(low: Column, high: Column, ticks: int = 4) -> Column:
    """The distance of round axis marks: 1, 2, 5 or 10 times a power of ten."""
    raw = F.greatest((high - low) / ticks, F.lit(1e-9))
    power = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    part = raw / power
    return power * F.when(part <= 1, 1.0).when(part <= 2, 2.0).when(part <= 5, 5.0).otherwise(10.0)


def _nice(span: Column) -> Column:
    power = F.pow(F.lit(10.0), F.floor(F.log10(span)))
    part = span / power
    return power * F.when(part < 1.5, 1.0).when(part < 3, 2.0).when(part < 7, 5.0).otherwise(10.0)


def nice_ticks(low: Column, high: Column, most: int = 4) -> Column:
    """Three to five round axis marks around a range, as an array."""
    a, b = F.when(low == high, low - 1).otherwise(low), F.when(low == high, high + 1).otherwise(high)

    def marks(x: Column, step: Column) -> tuple[Column, Column]:
        return F.floor(x["a"] / step), F.ceil(x["b"] / step)

    def ticks(x: Column) -> Column:
        coarser = lambda step, _: F.when(marks(x, step)[1] - marks(x, step)[0] > 4, _nice(step * 1.5)).otherwise(step)
        step = F.aggregate(F.sequence(F.lit(1), F.lit(10)), _nice((x["b"] - x["a"]) / (most - 1)), coarser)
        return F.transform(F.array(step), lambda s: F.transform(F.sequence(*marks(x, s)), lambda k: F.round(k * s, 9)))[0]

    return F.transform(F.array(F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"))), ticks)[0]


def linear_scale(v: Column, d0: Column, d1: Column, r0: float, r1: float) -> Column:
    return F.when(d1 == d0, (F.lit(r0) + r1) / 2).otherwise(F.lit(r0) + (v - d0) / (d1 - d0) * (r1 - r0))
