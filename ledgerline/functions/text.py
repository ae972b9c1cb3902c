"""Text of releases and pages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_html(raw: Column) -> Column:
    """Readable text: no scripts, styles and tags, common entities decoded, white space single."""
    t = F.regexp_replace(raw, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for name, mark in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(mark))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def compact_text(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def normalize_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def strip_row_label(label: Column) -> Column:
    """A row label without leading numbering, marks and spaces."""
    return F.regexp_replace(compact_text(label), r"^(其中[:：]|[一二三四五六七八九十]+、|[0-9]+[.、])", "")


def slugify(text: Column, longest: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", ""), 1, longest)


def pangu_join(text: Column) -> Column:
    """A space wherever Chinese meets Latin letters or digits."""
    t = F.regexp_replace(text, r"([一-鿿])([A-Za-z0-9])", "$1 $2")
    return F.regexp_replace(t, r"([A-Za-z0-9%])([一-鿿])", "$1 $2")


def infer_source_kind(tag: Column) -> Column:
    return F.when(tag.startswith("dg:"), "dg").when(tag.startswith("rel:") | tag.startswith("natdata:") | tag.startswith("legacy"), "press").otherwise("other")


def number_renderings(v: Column) -> Column:
    """The ways in which text may print a value."""
    a = F.abs(v)
    return F.array_distinct(F.array(F.format_string("%.2f", a), F.format_string("%.1f", a), F.format_string("%d", F.round(a).cast("long")), F.format_number(a, 1), F.format_number(a, 0)))


#: Fixed: words before a number that say that it is negative or positive, and the marks that end a clause.
NEGATIVE = ("负增长", "下降", "下跌", "下滑", "降至", "回落", "减少", "亏损", "负", "-", "－", "−")
POSITIVE = ("增长", "增加", "上涨", "上升", "提高", "攀升", "回升")
CLAUSE_ENDS = "，。；！？、\n"


def direction_before(text: Column, at: Column, back: int = 12) -> Column:
    """-1 or 1 by the words of the clause in the few characters before a place; negative words go first, as 负增长 holds 增长; else null."""
    window = F.substr(text, F.greatest(at - back, F.lit(1)), F.least(at - 1, F.lit(back)))
    clause = F.regexp_replace(window, f"(?s)^.*[{CLAUSE_ENDS}]", "")
    return F.when(clause.rlike("|".join(NEGATIVE)), -1).when(clause.rlike("|".join(POSITIVE)), 1)


def direction_consistent(value: Column, candidate: Column, text: Column, at: Column) -> Column:
    """Whether a value may be what text prints as `candidate` at a place, by its sign and the words before it."""
    signed = candidate.rlike("^(-|－|−|下降|负)")
    said = F.coalesce(direction_before(text, at), F.lit(0))
    return F.when(signed, value < 0).when(value < 0, said < 1).when(value > 0, said > -1).otherwise(True)
