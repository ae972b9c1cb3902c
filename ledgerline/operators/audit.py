"""Checks of what is published, against the data and the raw captures.

Independent on purpose: nothing here uses the modules that merge, derive or publish, so a fault there can't hide itself.
Findings are (check_id, status, series_id, period).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _found(rows: DataFrame, check: str, status: Column | str, condition: Column) -> DataFrame:
    return rows.where(condition).select(F.lit(check).alias("check_id"), (F.lit(status) if isinstance(status, str) else status).alias("status"), "series_id", "period")


def sources(index: DataFrame, bundles: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every catalog id is published once, in its section, and stands in the index; nothing else is published."""
    published = bundles.groupBy("series_id").agg(F.count("*").alias("_n"), F.min("section").alias("_s"))
    listed = index.select("series_id", F.lit(True).alias("_i")).distinct()
    both = catalog.select("series_id", "section").join(published, "series_id", "full_outer").join(listed, "series_id", "left")
    problem = (
        F.when(F.col("section").isNull(), "stray").when(F.col("_n").isNull(), "unpublished").when(F.col("_n") > 1, "twice")
        .when(F.col("_s") != F.col("section"), "section").when(F.col("_i").isNull(), "index")
    )
    return both.select("series_id", problem.alias("problem")).where("problem IS NOT NULL")


def latest_anchor(tails: DataFrame, rows: DataFrame) -> DataFrame:
    """What is published as last (series_id, field, period: latest, the arrays' ends, the index) is the last period with any measure: `latest_anchor.<field>`."""
    true = rows.where(F.coalesce("m", "ytd", "m_yoy", "ytd_yoy").isNotNull()).groupBy("series_id").agg(F.max("period").alias("_true"))
    both = tails.select("series_id", "field", "period").join(true, "series_id", "left").where(~F.col("period").eqNullSafe(F.col("_true")))
    return both.select(F.concat(F.lit("latest_anchor."), "field").alias("check_id"), F.lit("block").alias("status"), "series_id", "period")


def yoy_break_nulls(points: DataFrame, breaks: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """No published rate (series_id, period, yoy) lies in a window without rates.

    Nor does that of a latest or previous block, and no break lies between the two: `blocks` has (series_id, period, yoy, prev, prev_yoy).
    """
    walls = breaks.where("no_yoy_across").select("series_id", "effective", "yoy_valid_from")
    inside = lambda c: (F.col(c) >= F.col("effective")) & (F.col("yoy_valid_from").isNull() | (F.col(c) < F.col("yoy_valid_from")))
    found = _found(points.where("yoy IS NOT NULL").join(walls, "series_id"), "yoy_break_nulls", "block", inside("period"))
    if blocks is not None:
        near = blocks.join(walls, "series_id")
        across = (F.col("prev") < F.col("effective")) & (F.col("effective") <= F.col("period"))
        found = found.union(_found(near, "yoy_break_nulls.latest", "block", inside("period") & F.col("yoy").isNotNull()))
        found = found.union(_found(near, "yoy_break_nulls.prev", "block", inside("prev") & F.col("prev_yoy").isNotNull())).union(_found(near, "yoy_break_nulls.seam", "block", across))
    return found.distinct()


def previous(bundles: DataFrame, rows: DataFrame, breaks: DataFrame) -> DataFrame:
    """The published previous period, found again: last year's for merged prints, the month before for cumulative ones, else the row before."""
    last = F.lag("period").over(Window.partitionBy("series_id").orderBy("period"))
    order = rows.select("series_id", "period", last.alias("_last"))
    month = F.date_format(F.add_months(F.to_date(F.concat("period", F.lit("-01"))), -1), "yyyy-MM")
    year = F.date_format(F.add_months(F.to_date(F.concat("period", F.lit("-01"))), -12), "yyyy-MM")
    want = F.when(F.col("merged"), year).when(F.col("headline") == "ytd", F.when(F.substring("period", 6, 2) != "01", month)).otherwise(F.col("_last"))
    both = bundles.join(order, ["series_id", "period"], "left").withColumn("_want", want)
    there = rows.select("series_id", F.col("period").alias("_want"), F.col("span").alias("_span"))
    both = both.join(there, ["series_id", "_want"], "left").withColumn("_want", F.when(F.col("_span").isNotNull() & (~F.col("merged") | (F.col("_span") == 2)), F.col("_want")))
    walls = breaks.where("no_yoy_across").groupBy("series_id").agg(F.collect_list("effective").alias("_walls"))
    both = both.join(walls, "series_id", "left")
    wall = F.coalesce(F.exists("_walls", lambda w: (F.col("_want") < w) & (w <= F.col("period"))), F.lit(False))
    both = both.withColumn("_want", F.when(~wall, F.col("_want")))
    return _found(both, "previous", "block", ~F.col("prev").eqNullSafe(F.col("_want")))


def headline_numbers(sentences: DataFrame, slack: float = 0.06) -> DataFrame:
    """Numbers of a sentence that aren't the size of its rate, of the change or of the real rate, and runs of months that it states wrongly.

    Rows (series_id, period, sentence, y, yp, and where there are: name, real, kind, run). Labels, names, notes and runs are left
    out of the numbers. A run of months differs: block, up to 24 as published; it isn't stated: warn.
    """
    has = set(sentences.columns)
    run = F.regexp_extract("sentence", "连续 ?([0-9]+)", 1).try_cast("int")
    bare = F.replace(F.col("sentence"), F.col("name"), F.lit("")) if "name" in has else F.col("sentence")
    bare = F.regexp_replace(bare, r"[0-9]{4} 年 ?(1-)?[0-9]+ 月|1-[0-9]+ 月|（[^）]*）|连续 ?[0-9]+ 个月", "")
    numbers = F.transform(F.regexp_extract_all(bare, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1)), lambda n: n.cast("double"))
    known = F.array_compact(F.array(F.abs("y"), F.abs(F.col("y") - F.col("yp")), *([F.abs("real")] if "real" in has else [])))
    lost = F.exists(numbers, lambda n: ~F.exists(known, lambda k: F.abs(k - n) <= slack))
    found = _found(sentences, "headline_numbers", "block", lost)
    if "run" in has:
        due = (F.col("run") >= 2) & (F.col("kind") != "none")
        wrong = run.isNotNull() & (~due | (run != F.least("run", F.lit(24))))
        found = found.union(_found(sentences, "headline_streak", "block", wrong)).union(_found(sentences, "headline_streak", "warn", due & run.isNull()))
    return found


def derived(published: DataFrame, again: DataFrame, tolerance: Column) -> DataFrame:
    """Derived values (series_id, period, value) against the same computed anew; periods on one side only count too."""
    both = published.select("series_id", "period", F.col("value").alias("_a")).join(again.select("series_id", "period", F.col("value").alias("_b")), ["series_id", "period"], "full_outer")
    off = F.col("_a").isNull() | F.col("_b").isNull() | (F.abs(F.col("_a") - F.col("_b")) > tolerance)
    return _found(both, "derived", "block", off)


#: Fixed: how far a derived value may lie from the same computed anew, by rule: at least, and as a share.
TOLERANCES = {"sum": (1.0, 0.002), "single_from_ytd": (1.0, 0.002), "ratio": (0.05, 0.01), "mean": (0.01, 0.0), "count": (0.0, 0.0)}


def derived_rules(published: DataFrame, again: DataFrame, known: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Derived values (rule, series_id, period, value) against the same computed anew, within their rule's tolerance: `derived.<rule>`.

    Periods on one side only count too; what is known (series_id, period) warns.
    """
    keys = ["rule", "series_id", "period"]
    both = published.select(*keys, F.col("value").alias("_a")).join(again.select(*keys, F.col("value").alias("_b")), keys, "full_outer")
    slack = F.lit(0.0)
    for rule, (least, share) in TOLERANCES.items():
        slack = F.when(F.col("rule") == rule, F.greatest(F.lit(least), F.abs("_b") * share)).otherwise(slack)
    sure = F.lit(False)
    for series, period in known:
        sure = sure | ((F.col("series_id") == series) & (F.col("period") == period))
    off = F.col("_a").isNull() | F.col("_b").isNull() | (F.abs(F.col("_a") - F.col("_b")) > slack)
    return both.where(off).select(F.concat(F.lit("derived."), "rule").alias("check_id"), F.when(sure, "warn").otherwise("block").alias("status"), "series_id", "period")


def freshness(bundles: DataFrame, budgets: DataFrame, as_of: str) -> DataFrame:
    """First-tier entries whose period ended longer ago than a period, the expected lag and the grace allow."""
    rows = bundles.where("tier = 1").join(budgets, "series_id")
    ended = F.last_day(F.to_date(F.concat("period", F.lit("-01"))))
    return _found(rows, "freshness", "warn", F.date_diff(F.lit(as_of).cast("date"), ended) > F.col("days"))


def advanced(before: DataFrame, now: DataFrame) -> DataFrame:
    """Indices (series_id: a section, generated_at) that weren't generated later than in the run before, or carry no time that can be read."""
    both = now.select("series_id", F.col("generated_at").alias("_now")).join(before.select("series_id", F.col("generated_at").alias("_was")), "series_id")
    a, b = (F.col(c).try_cast("timestamp") for c in ("_now", "_was"))
    return _found(both.withColumn("period", F.col("_now")), "freshness.generated_at", "warn", a.isNull() | (a <= b))


def determinism(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that one of two builds has and the other has not: (series_id, period, side)."""
    cols = ["series_id", "period", "m", "ytd"]
    a, b = first.select(*cols), second.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("missing")).union(b.exceptAll(a).withColumn("side", F.lit("extra"))).select("series_id", "period", "side")
