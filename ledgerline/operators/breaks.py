"""Breaks of method: windows in which no rate on a year before may be published, and seams that no comparison may cross.

A window is [effective, yoy_valid_from), open-ended without the second; periods compare as text across shapes. Where breaks are a
dimension of a few rows a series they are gathered by series; where a series has many, rows and breaks are swept together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _marked(rows: DataFrame, breaks: DataFrame, inside: Column, name: str) -> DataFrame:
    """Adds a boolean: some no_yoy_across break of the row's series fulfils `inside`; breaks are gathered by series first."""
    per_series = breaks.where("no_yoy_across").groupBy("series_id").agg(F.collect_list(F.struct("effective", "yoy_valid_from")).alias("_breaks"))
    return rows.join(per_series, "series_id", "left").withColumn(name, F.coalesce(inside, F.lit(False))).drop("_breaks")


def blocked(rows: DataFrame, breaks: DataFrame, period: str = "period", name: str = "blocked") -> DataFrame:
    p = F.col(period)
    inside = F.exists("_breaks", lambda b: (p >= b["effective"]) & (b["yoy_valid_from"].isNull() | (p < b["yoy_valid_from"])))
    return _marked(rows, breaks, inside, name)


def seam_between(rows: DataFrame, breaks: DataFrame, prior: str, period: str = "period", name: str = "seam") -> DataFrame:
    """prior < effective <= period; false without a prior period."""
    q, p = F.col(prior), F.col(period)
    return _marked(rows, breaks, F.exists("_breaks", lambda b: (q < b["effective"]) & (b["effective"] <= p)), name)


def _swept(rows: DataFrame, breaks: DataFrame, at: str) -> DataFrame:
    """Rows with `_start` and `_end`: the latest start of a break of their series at or before them, and the latest end of such a window.

    Breaks and rows are sorted together once by series and period and gone through with running maxima: with many breaks a series
    that is a sort, where a join would pair every row with every break. Open windows end after all periods.
    """
    marks = breaks.where("no_yoy_across").select("series_id", F.col("effective").alias("_at"), F.lit(0).alias("_kind"), F.col("effective").alias("_start"), F.coalesce("yoy_valid_from", F.lit("~")).alias("_end"))
    both = rows.withColumns({"_at": F.col(at), "_kind": F.lit(1)}).unionByName(marks, allowMissingColumns=True)
    so_far = Window.partitionBy("series_id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumns({"_start": F.max("_start").over(so_far), "_end": F.max("_end").over(so_far)}).where("_kind = 1").drop("_at", "_kind")


def blocked_by_sweep(rows: DataFrame, breaks: DataFrame, period: str = "period", name: str = "blocked") -> DataFrame:
    """What `blocked` gives, for series with many breaks: a window that opened before ends after the row."""
    return _swept(rows, breaks, period).withColumn(name, F.coalesce(F.col("_end") > F.col(period), F.lit(False))).drop("_start", "_end")


def seam_by_sweep(rows: DataFrame, breaks: DataFrame, prior: str, period: str = "period", name: str = "seam") -> DataFrame:
    """What `seam_between` gives, for series with many breaks: the last break up to the row lies after the prior period."""
    return _swept(rows, breaks, period).withColumn(name, F.coalesce(F.col("_start") > F.col(prior), F.lit(False))).drop("_start", "_end")


def rows_within(windows: DataFrame, rows: DataFrame, first: str, until: str, name: str) -> DataFrame:
    """Adds how many rows (series_id, period) of its series each window holds, from `first` on and before `until`; by running counts over one sort."""
    keys = ["series_id", first, until]
    each = windows.select(*keys).distinct()
    ends = each.select(*keys, F.explode(F.array(F.struct(F.col(first).alias("at"), F.lit(-1).alias("sign")), F.struct(F.col(until).alias("at"), F.lit(1).alias("sign")))).alias("e"))
    both = ends.select(*keys, F.col("e.at").alias("_at"), F.col("e.sign").alias("_sign")).unionByName(rows.select("series_id", F.col("period").alias("_at")), allowMissingColumns=True)
    before = Window.partitionBy("series_id").orderBy("_at", F.col("_sign").isNull()).rowsBetween(Window.unboundedPreceding, -1)
    n = both.withColumn("_n", F.sum(F.when(F.col("_sign").isNull(), 1).otherwise(0)).over(before)).where("_sign IS NOT NULL")
    return windows.join(n.groupBy(*keys).agg(F.sum(F.col("_sign") * F.coalesce("_n", F.lit(0))).alias(name)), keys)


def link_findings(breaks: DataFrame) -> DataFrame:
    """Links that have no counterpart: superseded_by without supersedes, and the other way round."""
    ahead = breaks.where("superseded_by IS NOT NULL").select("series_id", F.col("superseded_by").alias("other"))
    back = breaks.where("supersedes IS NOT NULL").select("series_id", F.col("supersedes").alias("other"))
    turned = lambda x: x.select(F.col("other").alias("series_id"), F.col("series_id").alias("other"))
    lost = ahead.join(turned(back), ["series_id", "other"], "left_anti").withColumn("side", F.lit("superseded_by"))
    return lost.union(back.join(turned(ahead), ["series_id", "other"], "left_anti").withColumn("side", F.lit("supersedes")))


def link_problems(breaks: DataFrame, series: DataFrame) -> DataFrame:
    """(series_id, other, problem, severity): links between series (series_id, ended) that aren't frozen, answered or on file."""
    known = series.select(F.col("series_id").alias("other"), F.col("ended").alias("other_ended"))
    own = series.select("series_id", "ended")
    ahead = breaks.where("superseded_by IS NOT NULL").select("series_id", F.col("superseded_by").alias("other"), F.lit("new").alias("side"))
    back = breaks.where("supersedes IS NOT NULL").select("series_id", F.col("supersedes").alias("other"), F.lit("old").alias("side"))
    answers = ahead.union(back).select(F.col("other").alias("series_id"), F.col("series_id").alias("other"), F.when(F.col("side") == "new", "old").otherwise("new").alias("side"), F.lit(True).alias("answered"))
    links = ahead.union(back).join(own, "series_id", "left").join(known, "other", "left").join(answers.distinct(), ["series_id", "other", "side"], "left")
    frozen = F.when(F.col("side") == "new", F.col("ended")).otherwise(F.col("other_ended"))
    there = F.col("other_ended").isNotNull()
    problem = F.array_compact(F.array(
        F.when(~there, "not found"), F.when(there & F.col("answered").isNull(), "no way back"),
        F.when((there | (F.col("side") == "new")) & ~F.coalesce(frozen, F.lit(False)), "not frozen"),
    ))
    out = links.select("series_id", "other", F.explode(problem).alias("problem"))
    return out.withColumn("severity", F.when(F.col("problem") == "not found", "WARN").otherwise("BLOCK"))


def seam_neighbours(rows: DataFrame, breaks: DataFrame) -> DataFrame:
    """For every break the last period before it and the first at or after it."""
    near = breaks.select("series_id", "effective").join(rows.select("series_id", "period"), "series_id")
    before, after = F.col("period") < F.col("effective"), F.col("period") >= F.col("effective")
    return near.groupBy("series_id", "effective").agg(F.max(F.when(before, F.col("period"))).alias("before"), F.min(F.when(after, F.col("period"))).alias("after"))
