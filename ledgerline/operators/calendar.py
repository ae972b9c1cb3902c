"""Release calendars: which sources are due, and how a release is taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import periods as P


def due(rules: DataFrame, latest: DataFrame, today: str, grace: int = 3) -> DataFrame:
    """Sources (source, low, high, lag) in their window today whose latest period is before the expected one.

    A window's last day is cut to the month's; months with fewer days than `high` end it.
    """
    day = F.lit(today).cast("date")
    first = F.trunc(day, "month")
    opens = F.date_add(first, F.col("low") - 1)
    closes = F.date_add(F.least(F.date_add(first, F.col("high") - 1), F.last_day(day)), grace)
    expected = F.date_format(F.add_months(first, -F.col("lag")), "yyyy-MM")
    rows = rules.join(latest, "source", "left").withColumn("expected", expected).where((day >= opens) & (day <= closes))
    return rows.where(F.col("latest").isNull() | (F.col("latest") < F.col("expected"))).select("source", "expected", "latest")


def lookback(rows: DataFrame, last: str, many: int = 3) -> DataFrame:
    """Rows of the last `many` periods up to one."""
    return rows.where(P.steps_between("period", F.lit(last)).between(0, many - 1))


def frozen(rows: DataFrame, catalog: DataFrame, ended: DataFrame) -> DataFrame:
    """Adds `taken`: rows of series that are in the catalog and haven't ended before the row."""
    known = catalog.select("series_id", F.lit(True).alias("_k"))
    rows = rows.join(known, "series_id", "left").join(ended.select("series_id", F.col("effective").alias("_e")), "series_id", "left")
    return rows.withColumn("taken", F.col("_k").isNotNull() & (F.col("_e").isNull() | (F.col("period") < F.col("_e")))).drop("_k", "_e")


def split_at(rows: DataFrame, old: str, new: str, effective: str) -> DataFrame:
    """One source's rows as two series by date; the first row of the new one is flagged break_first."""
    later = F.col("period") >= effective
    rows = rows.withColumn("series_id", F.when(later, new).otherwise(old))
    first = F.min(F.when(F.col("period") >= effective, F.col("period"))).over(Window.partitionBy("series_id"))
    return rows.withColumn("break_first", F.coalesce(F.col("period") == first, F.lit(False)))


def manifests(manifest: DataFrame, captures: DataFrame) -> DataFrame:
    """(release, listed, missing, satisfied): all captures that a release lists are there, and it lists one at least."""
    listed = manifest.select("release", F.explode_outer("captures").alias("capture"))
    there = captures.select("capture", F.lit(1).alias("_t")).distinct()
    out = listed.join(there, "capture", "left").groupBy("release").agg(F.count("capture").alias("listed"), F.count(F.when(F.col("capture").isNotNull() & F.col("_t").isNull(), 1)).alias("missing"))
    return out.withColumn("satisfied", (F.col("listed") > 0) & (F.col("missing") == 0))
