"""Aggregations over observations, panels and findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P

SEVERITY = ("pass", "skip", "warn", "block")


def panel_mean(panel: DataFrame, value: str = "m") -> DataFrame:
    """The mean over entities, nulls left out, at four decimals; from decimals, so that order plays no part."""
    total, n = F.sum(F.col(value).cast("decimal(20,4)")).cast("double"), F.count(value)
    return panel.groupBy("metric", "period").agg(F.round(total / n, 4).alias("mean"), n.alias("n")).where("n > 0")


def panel_counts(panel: DataFrame, value: str = "m") -> DataFrame:
    n = lambda c: F.count(F.when(c, 1))
    return panel.groupBy("metric", "period").agg(n(F.col(value) > 0).alias("up"), n(F.col(value) == 0).alias("flat"), n(F.col(value) < 0).alias("down"))


def panel_latest(panel: DataFrame, value: str = "m") -> DataFrame:
    """The cell of the last period of each entity and metric, which may be null."""
    return panel.groupBy("entity", "metric").agg(F.max("period").alias("period"), F.max_by(value, "period").alias(value))


def group_mean(panel: DataFrame, groups: DataFrame, value: str = "m") -> DataFrame:
    """The mean over named groups of entities; entities of no group are the group `other`."""
    rows = panel.join(groups, "entity", "left").withColumn("group", F.coalesce("group", F.lit("other")))
    total, n = F.sum(F.col(value).cast("decimal(20,4)")).cast("double"), F.count(value)
    return rows.groupBy("group", "metric", "period").agg(F.round(total / n, 4).alias("mean"), n.alias("n")).where("n > 0")


def true_latest(rows: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """The period of each series that ends last and has any measure; of those that end together the first by sort key."""
    there = rows.where(F.coalesce(*measures).isNotNull())
    return there.groupBy("series_id").agg(F.max_by("period", F.struct(P.period_end_date("period"), -P.period_sort_key("period"))).alias("period"))


def status_rollup(findings: DataFrame, by: str = "check_id") -> DataFrame:
    """The worst status of each check; exit_code 2 if any blocks."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITY)), F.lower("status")).cast("int")
    out = findings.groupBy(by).agg(F.max(rank).alias("_r"), F.count("*").alias("n"))
    return out.select(by, F.element_at(F.array(*map(F.lit, SEVERITY)), F.col("_r")).alias("status"), "n", F.when(F.col("_r") == len(SEVERITY), 2).otherwise(0).alias("exit_code"))


def coverage(rows: DataFrame, by: list[str], state: str = "state", of: str = "verified") -> DataFrame:
    """Counts by state and the share that is verified in percent."""
    states = ("verified", "mismatch", "gap")
    counts = [F.count(F.when(F.col(state) == s, 1)).alias(s) for s in states]
    return rows.groupBy(*by).agg(*counts, F.count("*").alias("n")).withColumn("share", F.round(F.col(of).cast("double") / F.col("n") * 100, 1))


def profile(rows: DataFrame) -> DataFrame:
    """Observations, first and last period, formats and measures of each series."""
    measures = ("m", "ytd", "m_yoy", "ytd_yoy")
    kinds = F.concat_ws(",", F.array_sort(F.collect_set(P.period_format("period"))))
    signature = F.concat_ws("+", *(F.when(F.col(c).isNotNull(), c) for c in measures))
    return rows.groupBy("series_id").agg(
        F.count("*").alias("n"), F.min("period").alias("first"), F.max("period").alias("last"), kinds.alias("formats"),
        F.countDistinct(signature).alias("signatures"), *(F.count(c).alias(f"n_{c}") for c in measures),
    )


def infer_frequency(rows: DataFrame) -> DataFrame:
    """The most common distance of neighbouring periods in months, and what it is called; the smaller of equals."""
    gap = F.col("_o") - F.lag("_o").over(Window.partitionBy("series_id").orderBy("_o"))
    gaps = rows.select("series_id", P.period_ordinal("period").alias("_o")).select("series_id", gap.alias("gap")).where("gap IS NOT NULL")
    counts = gaps.groupBy("series_id", "gap").agg(F.count("*").alias("n"))
    best = counts.groupBy("series_id").agg(F.max_by("gap", F.struct("n", -F.col("gap"))).alias("gap"), F.count("*").alias("kinds"))
    name = F.when(F.col("gap") == 1, "monthly").when(F.col("gap") == 3, "quarterly").when(F.col("gap") == 12, "annual").otherwise("irregular")
    return best.select("series_id", "gap", F.concat(name, F.when(F.col("kinds") > 1, " (with gaps)").otherwise("")).alias("frequency"))


def missing_months(rows: DataFrame) -> DataFrame:
    """Months between a series' first and last that it has no row for."""
    ends = rows.groupBy("series_id").agg(F.min(P.period_ordinal("period")).alias("a"), F.max(P.period_ordinal("period")).alias("b"))
    all_ = ends.select("series_id", F.explode(F.sequence("a", "b")).alias("o"))
    period = F.format_string("%04d-%02d", F.floor((F.col("o") - 1) / 12).cast("int"), ((F.col("o") - 1) % 12 + 1).cast("int"))
    return all_.select("series_id", period.alias("period")).join(rows.select("series_id", "period"), ["series_id", "period"], "left_anti")


def infer_decimals(rows: DataFrame, value: str) -> DataFrame:
    """The most decimals that a series uses, up to four; 1 where it has no value."""
    return rows.groupBy("series_id").agg(F.coalesce(F.max(N.decimal_places(F.col(value))), F.lit(1)).alias("decimals"))


def level_jumps(rows: DataFrame, breaks: DataFrame, times: float = 5.0, least: float = 0.03, many: int = 12) -> DataFrame:
    """What the first row at or after each break did: redefined if it moved far more than the rows before it."""
    w = Window.partitionBy("series_id").orderBy("period")
    change = F.abs(F.col("m") / F.lag("m").over(w) - 1)
    moved = rows.withColumn("_c", change).withColumn("_usual", F.avg("_c").over(w.rowsBetween(-many, -1)))
    first = breaks.select("series_id", "effective").join(rows.select("series_id", "period"), "series_id").where("period >= effective").groupBy("series_id", "effective").agg(F.min("period").alias("period"))
    verdict = F.when(F.col("_c") > F.greatest(F.col("_usual") * times, F.lit(least)), "redefined").otherwise("restated")
    return first.join(moved, ["series_id", "period"]).select("series_id", "period", F.round(F.col("_c") * 100, 1).alias("jump_pct"), verdict.alias("verdict"))


def fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(series_id, hash): the same whenever the rows are the same, in any order, signed zeros aside."""
    text = F.concat_ws("|", *(F.coalesce((F.col(c) + 0.0 if t == "double" else F.col(c)).cast("string"), F.lit("~")) for c, t in rows.select(*columns).dtypes))
    return rows.groupBy("series_id").agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(F.sha2(text, 256)))), 256).alias("hash"))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))
