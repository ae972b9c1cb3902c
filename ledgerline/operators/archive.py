"""Published values looked up in archived pages: which pages may hold one, where they name it, and whether they print it.

A page is (page_id, name, html); its name starts with the day or month it was filed. Labels are found through an inverted
index of character grams that holds only grams some label has, and are confirmed at the places of their rarest gram. Pages are
matched to values by equal release days, or by years in an equi-join on each year around them, never each page with each value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import CLAUSE_ENDS, NEGATIVE, strip_html

#: Fixed: how far before and after a label a value is looked for first, how far before a value for words of direction, what is shown
#: around it, years between a page and a period, and the units that pages may print: as stored, and in ten thousands.
BEFORE, AFTER, BACK, SHOWN, YEARS = 220, 320, 12, 50, 1
SCALES = (("1x", 1.0), ("wan_yi_1e4", 10000.0))
#: Characters of a gram.
GRAM = 3
#: Rows up to which a side of a join is sent to every task; pairs of facts and pages that a task looks up, about.
SENT, PAIRS = 200_000, 100_000
#: Text that a task takes, about.
PART_BYTES = 16 << 20


def compact(text: Column) -> Column:
    """Text without white space and the commas of numbers."""
    return F.regexp_replace(text, "[\\s 　,]+", "")


def page_dates(pages: DataFrame) -> DataFrame:
    """Pages (name, ...) with filed, the day that a name starts with, if any, and year, its year."""
    filed = F.regexp_extract("name", r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    year = F.regexp_extract("name", r"^([0-9]{4})-[0-9]{2}(?:-[0-9]{2})?(?:[_.-]|$)", 1)
    return pages.select("*", F.nullif(filed, F.lit("")).alias("filed"), year.try_cast("int").alias("year"))


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, name, filed, year, text)"""
    return page_dates(pages).select("page_id", "name", "filed", "year", compact(strip_html(F.col("html"))).alias("text"))


def parts_of(text: DataFrame, column: str) -> int:
    """Tasks for some texts by their text and not by its compressed size, of which the work is many times more."""
    size = text.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(-(-size // PART_BYTES), text.sparkSession.sparkContext.defaultParallelism)


def gram_index(texts: DataFrame, labels: DataFrame, held: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(gram, page_id, place): where pages have a gram that some label (label) has; a label shorter than a gram is one itself."""
    wanted = held(labels.select(F.explode(_grams(F.col("label"))).alias("g")).select("g.gram").distinct())
    sizes = {r["size"]: r["count"] for r in wanted.groupBy(F.char_length("gram").alias("size")).count().collect()}  # at most GRAM sizes
    rows = texts.select("page_id", F.explode(F.concat(*(_all_grams(F.col("text"), n) for n in sizes))).alias("g")) if sizes else texts.select("page_id", F.struct(F.lit("").alias("gram"), F.lit(1).alias("place")).alias("g"))
    # The grams of texts are many times the texts, so they are thinned where they are made.
    return rows.select("g.gram", "page_id", "g.place").join(F.broadcast(wanted) if sum(sizes.values()) <= SENT else wanted, "gram", "left_semi")


def _grams(text: Column) -> Column:
    """(gram, place) of a label, at least one."""
    n = F.greatest(F.least(F.char_length(text), F.lit(GRAM)), F.lit(1))
    last = F.char_length(text) - n + 1
    return F.transform(F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.substr(text, i, n).alias("gram"), i.alias("place")))


def _all_grams(text: Column, size: int) -> Column:
    """(gram, place) of every place of a text, from its characters, as a place in a long string is found by walking there."""

    def of(c: Column) -> Column:
        last = F.when(text != "", F.size(c) - size + 1).otherwise(0)
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(F.concat(*(F.get(c, i + (k - 1)) for k in range(size))).alias("gram"), i.alias("place")))

    return F.transform(F.array(F.split(text, "")), of)[0]


def mentions(texts: DataFrame, labels: DataFrame, held: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(label, page_id, place): the first place of each label in each page that has it. `held` may keep the index, which is read twice."""
    labels = labels.select(compact(F.col("label")).alias("label")).where("label <> ''").distinct()
    index = held(gram_index(texts, labels, held))
    known = index.groupBy("gram").agg(F.count("*").alias("n"))
    grams = labels.select("label", F.explode(_grams(F.col("label"))).alias("g")).select("label", "g.gram", F.col("g.place").alias("offset"))
    rarest = grams.join(known, "gram", "left").groupBy("label").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "offset", "gram")).alias("r"))
    found = rarest.select("label", F.col("r.gram").alias("gram"), F.col("r.offset").alias("offset")).join(index, "gram").select("label", "page_id", (F.col("place") - F.col("offset") + 1).alias("place")).where("place > 0")
    here = found.groupBy("page_id").agg(F.collect_list(F.struct("label", "place")).alias("spots")).join(texts.select("page_id", "text").repartition(parts_of(texts, "text"), "page_id"), "page_id")
    rows = here.select("page_id", F.explode(F.filter("spots", lambda s: F.substr("text", s["place"], F.char_length(s["label"])) == s["label"])).alias("s"))
    return rows.groupBy(F.col("s.label").alias("label"), "page_id").agg(F.min("s.place").alias("place"))


def pages_of(facts: DataFrame, pages: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Facts (fact, src, period, ...) with each page (page_id, filed, year) that may hold them, and `near`, the days between page and period's end.

    A tag rel:YYYYMMDD names the day that its page was filed; without such a page there is none. Any other fact takes pages filed
    within YEARS of its period's year, and pages without a date; a fact whose period starts with no year takes every page. Both
    sides have the columns `by`, which have to be equal.
    """
    tag = F.regexp_extract(F.trim("src"), r"^rel:([0-9]{8})$", 1)
    keyed = facts.withColumn("_day", F.when(tag != "", F.concat_ws("-", F.substring(tag, 1, 4), F.substring(tag, 5, 2), F.substring(tag, 7, 2))))
    keyed = keyed.withColumn("_year", F.coalesce(F.regexp_extract("period", "^([0-9]{4})", 1).try_cast("int"), F.lit(-1)))
    loose = keyed.where("_day IS NULL")
    years = [r[0] for r in loose.select("_year").distinct().where("_year >= 0").collect()]  # some hundreds at most
    around = F.when(F.col("year").isNull(), F.array(*map(F.lit, [*years, -1]))).otherwise(F.concat(F.sequence(F.col("year") - YEARS, F.col("year") + YEARS), F.array(F.lit(-1))))
    columns = [*facts.columns, *(c for c in pages.columns if c not in facts.columns)]
    dated = keyed.join(pages.where("filed IS NOT NULL").withColumn("_day", F.col("filed")), [*by, "_day"]).select(*columns)
    every = dated.union(loose.join(pages.withColumn("_year", F.explode(around)), [*by, "_year"]).select(*columns))
    end = F.last_day(F.concat(F.substring("period", 1, 7), F.lit("-01")).try_cast("date"))
    return every.withColumn("near", F.abs(F.date_diff(F.col("filed").try_cast("date"), end)))


def renderings(value: Column) -> Column:
    """(scale, text) of every way in which a page may print a value: of each unit the longest first; negative values only with their sign or a word for it."""

    def general(v: Column) -> Column:
        # Six significant digits, without zeros at the end; sizes beyond are printed in full only.
        size, text = F.abs(v), F.lit(None).cast("string")
        for digits, least in ((0, 1e5), (1, 1e4), (2, 1e3), (3, 1e2), (4, 10.0), (5, 1.0), (6, 0.1), (7, 0.01), (8, 1e-3), (9, 1e-4)):
            text = F.coalesce(text, F.when(size >= least, _fixed(v, digits)))
        return F.when(v == 0, "0").when(size < 1e6, _bare(text))

    def some(v: Column) -> Column:
        size, whole = F.abs(v), _fixed(v, 0)
        fixed = [F.when(t.isin("", "0", "-0", "-"), None).otherwise(t) for t in (_bare(_fixed(v, 1)), _bare(_fixed(v, 2)))]
        short = _bare(_fixed(size, 1))
        below = [F.concat(F.lit("下降"), general(size)), F.concat(F.lit("负"), general(size)), F.when(short != "0", F.concat(F.lit("下降"), short))]
        texts = F.array(general(v), *fixed, F.when((F.abs(v - F.rint(v)) < 1e-6) | (size >= 1000), whole), *(F.when(v < 0, x) for x in below))
        texts = F.array_distinct(F.array_compact(texts))
        return F.array_sort(texts, lambda a, b: F.char_length(b) * 2 + (b < a).cast("int") - F.char_length(a) * 2 - (a < b).cast("int"))

    def of_scale(name: str, factor: float) -> Column:
        return F.transform(some(value / factor), lambda t: F.struct(F.lit(name).alias("scale"), t.alias("text")))

    return F.when(value.isNotNull(), F.concat(*(of_scale(*s) for s in SCALES)))


def _fixed(v: Column, digits: int) -> Column:
    """A number with so many decimals, rounded as it is in binary, halves to even."""
    return F.replace(F.format_number(v, digits), F.lit(","), F.lit(""))


def _bare(text: Column) -> Column:
    """A fixed-point number without zeros at its end."""
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


#: A place that no word for a fall stands before, in the same clause and within BACK characters.
_NOT_BELOW = "(?<!" + "|".join(f"(?:{w}[^{CLAUSE_ENDS}]{{0,{BACK - len(w)}}})" for w in NEGATIVE) + ")"


def found_in(window: Column, value: Column, ways: Column) -> Column:
    """(at, scale, text) of the first way of printing a value that a window has without contradicting its sign; null if none has.

    A rendering with a sign or a word for a fall speaks for itself; a bare one of a positive value may not follow such a word.
    """
    there = F.filter(ways, lambda w: F.contains(window, w["text"]))
    behind = lambda w: F.regexp_instr(window, F.concat(F.lit("(?=\\Q"), w["text"], F.lit("\\E)" + _NOT_BELOW)))
    place = lambda w: F.when(value > 0, behind(w)).otherwise(F.call_function("locate", w["text"], window))
    hits = F.transform(there, lambda w: F.struct(place(w).alias("at"), w["scale"].alias("scale"), w["text"].alias("text")))
    return F.try_element_at(F.filter(hits, lambda h: h["at"] > 0), F.lit(1))


def look_up(facts: DataFrame, labels: DataFrame, pages: DataFrame, held: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Facts (fact, series_id, period, value, src) against pages: adds state, page_id, scale and evidence.

    `labels` is (series_id, nth, label). unverifiable: the series has no label; gap: no page that may hold the fact names the series;
    verified: one of those that do prints the value, near the label if it can be, else anywhere; mismatch: none does. Of several pages the
    one nearest in time counts, of those the first. A page that doesn't name the series proves nothing.
    """
    texts = held(page_texts(pages))
    labels = labels.select("series_id", "nth", compact(F.col("label")).alias("label")).where("label <> ''")
    named = labels.join(mentions(texts, labels, held), "label").join(texts.select("page_id", "filed", "year"), "page_id")
    least = parts_of(texts, "text")
    near = held(pages_of(facts.select("fact", "series_id", "src", "period"), named.repartition(least, "page_id"), ("series_id",)).select("fact", "page_id", "near", "nth", "label", "place"))
    ways, of_page = held(facts.select("fact", "value", renderings(F.col("value")).alias("ways"))), texts.select("page_id", "text")
    ways = F.broadcast(ways) if ways.count() <= SENT else ways

    def read(pairs: DataFrame) -> DataFrame:
        # Their work goes with their number and not with their bytes, by which adaptive execution would join parts.
        parts = max(pairs.count() // PAIRS, least)
        return pairs.repartition(parts, "page_id").join(of_page, "page_id").join(ways, "fact")


    window = F.substr("text", F.greatest(F.col("place") - BEFORE, F.lit(1)), F.least(F.col("place") - 1, F.lit(BEFORE)) + F.char_length("label") + AFTER)
    close = held(_hits(read(near), window))
    rest = held(near.join(close.select("fact"), "fact", "left_anti").groupBy("fact", "page_id").agg(F.min("near").alias("near"), F.min("nth").alias("nth")))
    hits = close.union(_hits(read(rest), F.col("text")))

    out = facts.join(hits, "fact", "left").join(near.select("fact", F.lit(True).alias("_named")).distinct(), "fact", "left")
    out = out.join(labels.select("series_id", F.lit(True).alias("_label")).distinct(), "series_id", "left")
    state = F.when(F.col("_label").isNull(), "unverifiable").when(F.col("_named").isNull(), "gap").when(F.col("scale").isNotNull(), "verified").otherwise("mismatch")
    return out.withColumn("state", state).drop("_named", "_label")


def _hits(rows: DataFrame, window: Column) -> DataFrame:
    """(fact, page_id, scale, evidence): the best page of each fact that has its value in the window."""
    # The window is bound, as each way of printing would cut it anew, and taken out by a generator, as a condition would look twice.
    found = F.transform(F.array(window), lambda w: found_in(w, F.col("value"), F.col("ways")))
    rows = rows.withColumn("_h", F.explode(F.array_compact(found)))
    start = F.greatest(F.col("_h.at") - SHOWN, F.lit(1))
    shown = F.substr(window, start, F.col("_h.at") - start + F.char_length("_h.text") + SHOWN)
    best = F.min_by(F.struct("page_id", F.col("_h.scale").alias("scale"), shown.alias("evidence")), F.struct(F.coalesce("near", F.lit(1 << 30)), "page_id", "nth"))
    return rows.groupBy("fact").agg(best.alias("b")).select("fact", "b.page_id", "b.scale", "b.evidence")


def severity(state: Column, tier: Column, agency: Column) -> Column:
    """pass, warn or block: a mismatch blocks, but for third-tier series and those of the industry association."""
    soft = (tier == 3) | F.coalesce(agency == "cflp", F.lit(False))
    return F.when(state == "verified", "pass").when((state == "mismatch") & ~soft, "block").otherwise("warn")
