"""Merging releases into what is on file, with a log of revisions, and joins of series with each other.

Observations are long here: (series_id, period, measure, value), a row a cell that was ever printed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Changes below this are no revisions.
SAME = 1e-9
CELL = ["series_id", "period", "measure"]


def map_fields(staged: DataFrame, fields: DataFrame, known: DataFrame) -> DataFrame:
    """Adds series_id and state: mapped, unmapped (no such field) or missing (its series is not on file)."""
    there = known.select("series_id", F.lit(True).alias("_known"))
    out = staged.join(fields, ["source", "field"], "left").join(there, "series_id", "left")
    return out.withColumn("state", F.when(F.col("series_id").isNull(), "unmapped").when(F.col("_known"), "mapped").otherwise("missing")).drop("_known")


def classify(old: DataFrame, new: DataFrame) -> DataFrame:
    """(cell, old, new, class): insert (new period), first_print (new measure), noop or revise, for every cell of `new`.

    `new` has one row a cell; see in_order for several.
    """
    before = old.select(*CELL, F.col("value").alias("old"))
    periods = old.select("series_id", "period", F.lit(True).alias("_there")).distinct()
    rows = new.select(*CELL, F.col("value").alias("new")).join(before, CELL, "left").join(periods, ["series_id", "period"], "left")
    kind = F.when(F.col("_there").isNull(), "insert").when(F.col("old").isNull(), "first_print").when(F.abs(F.col("new") - F.col("old")) < SAME, "noop").otherwise("revise")
    return rows.select(*CELL, "old", "new", kind.alias("class"))


def allowed(new: DataFrame, breaks: DataFrame) -> DataFrame:
    """Without rates that fall into a window in which none may be published."""
    from ledgerline.operators.breaks import blocked

    return blocked(new, breaks).where(~(F.col("blocked") & F.col("measure").like("%yoy"))).drop("blocked")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """All cells after the merge: the new value where there is one, unless it is the same."""
    a, b = old.select(*CELL, F.col("value").alias("old")), new.select(*CELL, F.col("value").alias("new"))
    both = a.join(b, CELL, "full_outer")
    keep = F.col("new").isNull() | (F.abs(F.col("new") - F.col("old")) < SAME)
    return both.select(*CELL, F.when(keep, F.col("old")).otherwise(F.col("new")).alias("value"))


def in_order(old: DataFrame, rows: DataFrame) -> DataFrame:
    """Revisions of several rows a cell, applied in the order of row_no: (cell, row_no, old, new) for every change."""
    stored = old.select(*CELL, F.lit(0).alias("row_no"), "value")
    # Rows that belong to no cell of the release play no part.
    stored = stored.join(rows.select(*CELL).distinct(), CELL, "left_semi")
    w = Window.partitionBy(*CELL).orderBy("row_no")
    steps = stored.union(rows.select(*CELL, "row_no", "value")).withColumn("old", F.lag("value").over(w))
    return steps.where((F.col("row_no") > 0) & (F.abs(F.col("value") - F.col("old")) >= SAME)).select(*CELL, "row_no", "old", F.col("value").alias("new"))


def as_published(current: DataFrame, revisions: DataFrame, as_of: str) -> DataFrame:
    """(cell, value) as it stood on a date: the old value of the first revision after it, else the current one."""
    later = revisions.where(F.col("revised_on") > as_of).groupBy(*CELL).agg(F.min_by("old", F.struct("revised_on", "seq")).alias("_old"), F.lit(True).alias("_was"))
    return current.join(later, CELL, "left").select(*CELL, F.when(F.col("_was"), F.col("_old")).otherwise(F.col("value")).alias("value"))


def twin_revisions(published: DataFrame, latest: DataFrame) -> DataFrame:
    """Cells whose published and latest values differ, signed zeros aside."""
    other = latest.select(*CELL, F.col("value").alias("new"))
    both = published.select(*CELL, F.col("value").alias("old")).join(other, CELL)
    return both.where(~(F.col("old") + 0.0).eqNullSafe(F.col("new") + 0.0))


def integrity(revisions: DataFrame, stored: DataFrame, staged: DataFrame, today: str) -> DataFrame:
    """Revisions that don't fit: old is not what was stored, new is not what is staged, or the date is not today."""
    a, b = stored.select(*CELL, F.col("value").alias("_stored")), staged.select(*CELL, F.col("value").alias("_staged"))
    rows = revisions.join(a, CELL, "left").join(b, CELL, "left")
    off = lambda x, y: ~F.coalesce(F.abs(F.col(x) - F.col(y)) < SAME, F.lit(False))
    problem = F.when(off("old", "_stored"), "old").when(off("new", "_staged"), "new").when(~F.col("revised_on").eqNullSafe(F.lit(today)), "date")
    return rows.withColumn("problem", problem).where("problem IS NOT NULL").select(*CELL, "old", "new", "problem")


def lost_revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of the old log that the new one no longer holds as often."""
    return before.exceptAll(after.select(before.columns))


def flood(revisions: DataFrame, rows: DataFrame, most: int = 6, share: float = 0.1) -> DataFrame:
    """Series with more revisions than `most`, or than a share of their observations."""
    n = revisions.groupBy("series_id").agg(F.count("*").alias("revised"))
    total = rows.groupBy("series_id").agg(F.count("*").alias("observations"))
    return n.join(total, "series_id").where((F.col("revised") > most) | (F.col("revised") > F.col("observations") * share))


def fragment_merge(catalog: DataFrame, fragment: DataFrame, key: str = "series_id") -> DataFrame:
    """Catalog and fragment together, with `state`: kept, same, inserted or conflict (same key, other content)."""
    cols = [c for c in catalog.columns if c != key]
    a = catalog.select(key, F.struct(*cols).alias("a"))
    b = fragment.select(key, F.struct(*cols).alias("b"))
    both = a.join(b, key, "full_outer")
    state = F.when(F.col("b").isNull(), "kept").when(F.col("a").isNull(), "inserted").when(F.to_json("a") == F.to_json("b"), "same").otherwise("conflict")
    return both.select(key, F.coalesce("a", "b").alias("_row"), state.alias("state")).select(key, "_row.*", "state")


def jan_feb_problems(rows: DataFrame, flagged: Column) -> DataFrame:
    """Merged prints that aren't at February with span 2, and a January of its own in a year with a merged print."""
    years = rows.where(flagged).select("series_id", F.substring("period", 1, 4).alias("_y")).distinct().withColumn("_merged", F.lit(True))
    rows = rows.withColumn("_f", flagged).withColumn("_y", F.substring("period", 1, 4)).join(years, ["series_id", "_y"], "left")
    problem = F.when(F.col("_f") & (~F.col("period").endswith("-02") | (F.col("span") != 2)), "flag").when(F.col("_merged") & F.col("period").endswith("-01"), "january")
    return rows.withColumn("problem", problem).where("problem IS NOT NULL").select("series_id", "period", "span", "problem")


# --- series against series -------------------------------------------------------------------------------------------


def sum_parts(rows: DataFrame, parts: DataFrame, value: str = "m") -> DataFrame:
    """(total, period, summed, n) for periods in which every part has a value; parts are (total, series_id)."""
    need = parts.groupBy("total").agg(F.count("*").alias("_need"))
    sums = rows.where(F.col(value).isNotNull()).join(parts, "series_id").groupBy("total", "period").agg(F.sum(F.col(value).cast("decimal(28,2)")).cast("double").alias("summed"), F.count("*").alias("n"))
    return sums.join(need, "total").where("n = _need").drop("_need")


def ratio(numerator: DataFrame, denominator: DataFrame, value: str) -> DataFrame:
    other = denominator.select("period", F.col(value).alias("_d"))
    return numerator.join(other, "period").withColumn("ratio", F.try_divide(F.col(value), F.col("_d"))).drop("_d")


def consistency(declared: DataFrame, published: DataFrame) -> DataFrame:
    """Series published without being declared, declared without being published, or published in another section."""
    a, b = declared.select("series_id", F.col("section").alias("_a")), published.select("series_id", F.col("section").alias("_b"))
    problem = F.when(F.col("_a").isNull(), "stray").when(F.col("_b").isNull(), "unpublished").when(F.col("_a") != F.col("_b"), "wrong section")
    return a.join(b, "series_id", "full_outer").select("series_id", problem.alias("problem")).where("problem IS NOT NULL")


def disagreements(first: DataFrame, second: DataFrame, tolerance: Column) -> DataFrame:
    """Cells of two sources that lie further apart than the tolerance."""
    b = second.select(*CELL, F.col("value").alias("b"))
    return first.select(*CELL, F.col("value").alias("a")).join(b, CELL).where(F.abs(F.col("a") - F.col("b")) > tolerance + 1e-9)


def republications(rows: DataFrame, pairs: DataFrame, value: str) -> DataFrame:
    """Periods in which two series that print the same figure differ by more than the pair's tolerance."""
    side = lambda name, out: rows.select(F.col("series_id").alias(name), "period", F.col(value).alias(out))
    met = pairs.join(side("first_id", "first_value"), "first_id").join(side("second_id", "second_value"), ["second_id", "period"])
    return met.where("abs(first_value - second_value) > tol").select("first_id", "second_id", "period", "first_value", "second_value")


def merge_vintages(new: DataFrame, old: DataFrame, value: str) -> DataFrame:
    """(series_id, period, value, state): both histories, the new value first; state is same, mismatch, new or old."""
    a, b = (x.select("series_id", "period", F.col(value).alias(n)) for x, n in ((new, "_a"), (old, "_b")))
    state = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "old").when(F.col("_a") == F.col("_b"), "same").otherwise("mismatch")
    return a.join(b, ["series_id", "period"], "full_outer").select("series_id", "period", F.coalesce("_a", "_b").alias("value"), state.alias("state"))


def stitch(windows: DataFrame, value: str, start: str) -> DataFrame:
    """One value a period from windows that overlap: the latest window that has one."""
    there = windows.where(F.col(value).isNotNull())
    return there.groupBy("series_id", "period").agg(F.max_by(value, start).alias(value), F.max(start).alias(start))


def known_exceptions(findings: DataFrame, known: tuple[tuple, ...]) -> DataFrame:
    """Adds `known`: a configured exception (series, period, check, note) fits; null stands for any."""
    fits = F.lit(False)
    for series, period, check, _note in known:
        own = F.lit(True)
        for name, v in (("series_id", series), ("period", period), ("check_id", check)):
            own = own if v is None else own & (F.col(name) == v)
        fits = fits | own
    return findings.withColumn("known", fits)


def resolve_parameter(rows: DataFrame, own: DataFrame, kinds: DataFrame, kind_keys: list[str], default: float) -> DataFrame:
    """Adds `value`: the series' own setting, else its kind's, else the default."""
    return rows.join(own, "series_id", "left").join(kinds, kind_keys, "left").withColumn("value", F.coalesce("own", "kind", F.lit(default))).drop("own", "kind")


def label_hits(labels: DataFrame, names: DataFrame, name: str, width: int = 4) -> DataFrame:
    """Labels anywhere within names: an equi-join on the label's first `width` characters (all, if it has fewer), then the whole label; empty labels meet nothing.

    Equal names are looked through once. The names' stretches are many times their size, which the optimiser doesn't know, so they are merged and never sent whole.
    """
    text = F.col(name)
    grams = lambda k: F.when(F.length(text) >= k, F.transform(F.sequence(F.lit(1), F.length(text) - (k - 1)), lambda i: F.substring(text, i, F.lit(k))))
    keys = F.array_distinct(F.concat(*(F.coalesce(grams(k), F.array().cast("array<string>")) for k in range(1, width + 1))))
    keyed = labels.where("label <> ''").withColumn("_w", F.substring("label", 1, width))
    met = names.select(name).distinct().withColumn("_w", F.explode(keys)).join(keyed.hint("merge"), "_w").where(F.contains(text, F.col("label"))).drop("_w")
    return names.join(met, name)


def by_source(series: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """(series_id, key, by, extra): the source that each series' own source id names, where it is on file."""
    return series.join(names.select(F.col(key).alias("source_id"), F.col(key)), "source_id").select("series_id", key, F.lit("id").alias("by"), F.lit(0).alias("extra"))


def candidates(series: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """(series_id, key, by, extra): for each series (series_id, source_id, label) what may be its source among names.

    The one that its own source id names, where it is on file; else all whose name holds its label, with how much longer they are.
    """
    known, direct = names.select(F.col(key), F.col(name)), by_source(series, names, key)
    rest = series.join(direct.select("series_id"), "series_id", "left_anti").select("series_id", "label")
    hits = label_hits(rest, known, name)
    return direct.union(hits.select("series_id", key, F.lit("label").alias("by"), (F.length(name) - F.length("label")).alias("extra")))
