"""Derivations along a series: other periods of the same series, sums within a year, runs, medians.

Other periods are found by their names in an equi-join, never by the neighbour in an array, so gaps give null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P
from ledgerline.operators import breaks as B


def with_other(rows: DataFrame, target: Column, columns: dict[str, str], keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """Adds columns (old name -> new name) of the row of the same keys at period `target`; null where there is none."""
    other = rows.select(*keys, F.col("period").alias("_at"), *(F.col(a).alias(b) for a, b in columns.items()))
    return rows.withColumn("_at", target).join(other, [*keys, "_at"], "left").drop("_at")


def prior_period(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The period before, of the same year."""
    return with_other(rows, P.prev_ytd_period("period"), columns)


def year_ago(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The same period a year before, where it covers as many months."""
    return with_other(rows, P.year_ago_period("period"), columns, ("series_id", "span"))


def single_from_ytd(rows: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Adds `single`: ytd less the ytd of the period before; a merged print is its own; null in January and after gaps.

    With `missing_as_zero`, January and periods after gaps take ytd itself.
    """
    rows = prior_period(rows, {"ytd": "_before"})
    before = F.coalesce("_before", F.lit(0.0)) if missing_as_zero else F.col("_before")
    return rows.withColumn("single", F.when((F.col("span") == 2) & F.col("period").endswith("-02"), F.col("ytd")).otherwise(F.col("ytd") - before)).drop("_before")


def ytd_cumulate(rows: DataFrame, value: str = "m") -> DataFrame:
    """Adds `cumulated`: the running sum within the year, in decimals."""
    w = Window.partitionBy("series_id", F.substring("period", 1, 4)).orderBy("period")
    return rows.withColumn("cumulated", F.sum(F.col(value).cast("decimal(28,2)")).over(w).cast("double"))


def computed_yoy(rows: DataFrame, value: str = "m") -> DataFrame:
    """Adds `yoy` in percent, one decimal; null without a base or with a base of 0."""
    rows = year_ago(rows, {value: "_base"})
    return rows.withColumn("yoy", F.round((N.safe_div(F.col(value), F.col("_base")) - 1) * 100, 1)).drop("_base")


def resolve_latest(rows: DataFrame, value: str, rate: str) -> DataFrame:
    """The last row of every series that carries the value or the rate."""
    w = Window.partitionBy("series_id").orderBy(P.period_end_date("period").desc(), F.col("period"))
    return rows.where(F.col(value).isNotNull() | F.col(rate).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def resolve_prev(rows: DataFrame, breaks: DataFrame, cumulative: Column) -> DataFrame:
    """Adds `prev`, the period that a row compares to.

    A merged print compares to last year's; a cumulative month or quarter to the one before in its year; any other
    row to the one of its shape before it. Null if the period isn't on file or a break without rates lies between.
    """
    shape = P.period_shape_loose("period")
    w = Window.partitionBy("series_id", shape).orderBy("period")
    rows = rows.withColumn("_last", F.lag("period").over(w)).withColumn("_cum", cumulative)
    target = F.when(F.col("span") == 2, P.year_ago_period("period")).when(F.col("_cum") & (shape != "A"), P.prev_ytd_period("period")).otherwise(F.col("_last"))
    other = rows.select("series_id", F.col("period").alias("_at"), F.col("span").alias("_span"))
    rows = rows.withColumn("_at", target).join(other, ["series_id", "_at"], "left")
    there = F.col("_span").isNotNull() & ((F.col("span") != 2) | (F.col("_span") == 2))
    rows = rows.withColumn("_prev", F.when(there, F.col("_at")))
    rows = B.seam_between(rows, breaks, "_prev", name="_seam")
    return rows.withColumn("prev", F.when(~F.col("_seam"), F.col("_prev"))).drop("_last", "_cum", "_at", "_span", "_prev", "_seam")


def trailing_run(rows: DataFrame, state: Column, least: int, order: str = "period") -> DataFrame:
    """(series_id, run, state): how many last rows of a series are in the state of the very last; null states end runs.

    A run shorter than `least` counts 0.
    """
    w = Window.partitionBy("series_id").orderBy(F.col(order).desc())
    rows = rows.select("series_id", order, state.alias("_s"))
    rows = rows.withColumn("_first", F.first("_s").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    off = F.when(F.col("_s").eqNullSafe(F.col("_first")) & F.col("_s").isNotNull(), 0).otherwise(1)
    rows = rows.withColumn("_off", F.sum(off).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = rows.groupBy("series_id").agg(F.sum(F.when(F.col("_off") == 0, 1).otherwise(0)).alias("run"), F.max(F.when(F.col("_off") == 0, F.col("_s"))).alias("state"))
    return runs.select("series_id", F.when(F.col("run") >= least, F.col("run")).otherwise(0).cast("long").alias("run"), F.when(F.col("run") >= least, F.col("state")).alias("state"))


def rate_streaks(rows: DataFrame, breaks: DataFrame, rate: str = "m_yoy") -> DataFrame:
    """(series_id, kind, run): falling rates, else rates that rise or sink while positive, at least two rows long."""
    rows = B.blocked(rows, breaks).withColumn("_y", F.when(~F.col("blocked"), F.col(rate)))
    w = Window.partitionBy("series_id").orderBy("period")
    rows = rows.withColumn("_d", F.round(F.col("_y") - F.lag("_y").over(w), 6)).withColumn("_both", (F.col("_y") > 0) & (F.lag("_y").over(w) > 0))
    down = trailing_run(rows, F.when(F.col("_y") < 0, "negative"), 2)
    move = trailing_run(rows, F.when(F.col("_both") & (F.col("_d") > 0), "accel").when(F.col("_both") & (F.col("_d") < 0), "decel"), 2)
    both = down.join(move.select("series_id", F.col("run").alias("_run"), F.col("state").alias("_state")), "series_id")
    return both.select("series_id", F.coalesce("state", "_state", F.lit("none")).alias("kind"), F.when(F.col("run") > 0, F.col("run")).otherwise(F.col("_run")).alias("run"))


def level_streaks(rows: DataFrame, value: str = "m", least: int = 3) -> DataFrame:
    """(series_id, run, state): levels that rise or sink, at least three steps long."""
    step = F.round(F.col(value) - F.lag(value).over(Window.partitionBy("series_id").orderBy("period")), 6)
    rows = rows.withColumn("_d", step)
    return trailing_run(rows, F.when(F.col("_d") > 0, "up").when(F.col("_d") < 0, "down"), least)


def cohort_change(rows: DataFrame, value: str = "m") -> DataFrame:
    """Adds `change`: the difference of logarithms to the row of the same season before, for positive levels."""
    w = Window.partitionBy("series_id", P.cohort_key("period", F.col("span"))).orderBy("period")
    last = F.lag(value).over(w)
    return rows.withColumn("change", F.when((F.col(value) > 0) & (last > 0), F.log(F.col(value)) - F.log(last)))


def trailing_median(rows: DataFrame, value: str = "m", many: int = 12, least: int = 3) -> DataFrame:
    """Adds `median`: of the sizes of the `many` single-month rows before; null with fewer than `least`."""
    w = Window.partitionBy("series_id").orderBy("period").rowsBetween(-many, -1)
    rows = rows.where("span = 1").withColumn("_v", F.abs(F.col(value)))
    return rows.withColumn("median", F.when(F.count("_v").over(w) >= least, F.percentile("_v", F.lit(0.5)).over(w))).drop("_v")


def stale(rows: DataFrame, measures: tuple[str, ...] = ("m", "ytd", "m_yoy", "ytd_yoy")) -> DataFrame:
    """Rows that repeat the row before in all measures that both have, two or more."""
    w = Window.partitionBy("series_id").orderBy("period")
    pairs = [(F.col(x), F.lag(x).over(w)) for x in measures]
    shared = sum((F.when(a.isNotNull() & b.isNotNull(), 1).otherwise(0) for a, b in pairs), F.lit(0))
    same = sum((F.when(a == b, 1).otherwise(0) for a, b in pairs), F.lit(0))
    return rows.withColumn("shared", shared).withColumn("_same", same).where("shared >= 2 AND shared = _same").drop("_same")
