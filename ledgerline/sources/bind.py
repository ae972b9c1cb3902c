"""The star-schema tables as official statistics: monthly order totals by market segment and by nation.

`Model` gives the tables that the operators take. Amounts are summed as decimals, so sums don't depend on order.
From 1998 on, January and February are one print at February with span 2, as official series have it.

The cells, and what is published from them, are computed once for each query and written to the shared folder: every
use reads a small table, whose size the optimiser knows, instead of the orders.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import periods as P

#: The breaks of method of the bound series.
BREAKS = (
    ("mkt-BUILDING", "1998-01", "rebase", True, "1999-01", None, None),
    ("mkt-MACHINERY", "1997-06", "method", True, "1997-06", None, None),
    ("mkt-HOUSEHOLD", "2001-01", "scope", True, None, None, None),
    ("mkt-FURNITURE", "1999-03", "note", False, None, None, None),
    ("nat-3", "1998-04", "newid", True, None, None, "nat-4"),
    ("nat-4", "1998-04", "newid", True, "1999-04", "nat-3", None),
    ("nat-5", "1999-02", "newid", True, None, None, "nat-6"),
)
BREAK_SCHEMA = "series_id string, effective string, kind string, no_yoy_across boolean, yoy_valid_from string, supersedes string, superseded_by string"
MEASURES = ("m", "ytd", "m_yoy", "ytd_yoy")


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self) -> str:
        """A folder of its own under the one that driver and executors share."""
        held = self.spark.conf.get("spark.checkpoint.dir", None) or self.spark.sparkContext.getCheckpointDir()
        if held is None:
            if not self.spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            held = tempfile.mkdtemp(prefix="spark-shared-")
        return f"{held}/{uuid.uuid4().hex}"

    def held(self, df: DataFrame) -> DataFrame:
        """The same rows, written once and read by every use."""
        path = self.scratch()
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def rows(self, values: list[tuple] | tuple, schema: str) -> DataFrame:
        return self.spark.createDataFrame(list(values), schema)

    @cached_property
    def cells(self) -> DataFrame:
        """(seg, nat, pri, period, v, va, n): totals; va leaves out every 97th order, as an older vintage would."""
        amount, day = F.col("o_totalprice").cast("decimal(18,2)"), F.date_format("o_orderdate", "yyyy-MM")
        orders = self.table("orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("pri"), day.alias("period"), amount.alias("v"))
        customer = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"))
        kept = F.when(F.col("o_orderkey") % 97 != 0, F.col("v"))
        return self.held(orders.join(customer, "o_custkey").groupBy("seg", "nat", "pri", "period").agg(F.sum("v").alias("v"), F.sum(kept).alias("va"), F.count("*").alias("n")))

    @cached_property
    def raw(self) -> DataFrame:
        """(series_id, period, v, va): every calendar month by itself."""
        ids = F.explode(F.array(F.concat(F.lit("mkt-"), "seg"), F.concat(F.lit("nat-"), "nat"))).alias("series_id")
        return self.cells.select(ids, "period", "v", "va").groupBy("series_id", "period").agg(F.sum("v").alias("v"), F.sum("va").alias("va"))

    def _levels(self, column: str) -> DataFrame:
        joint = (F.col("period") >= "1998") & F.substring("period", 6, 2).isin("01", "02")
        rows = self.raw.where(F.col(column).isNotNull()).withColumn("span", F.when(joint, 2).otherwise(1))
        rows = rows.withColumn("period", F.when(joint, F.concat(F.substring("period", 1, 4), F.lit("-02"))).otherwise(F.col("period")))
        rows = rows.groupBy("series_id", "period", "span").agg(F.sum(column).alias("v"))
        ytd = F.expr("sum(v) OVER (PARTITION BY series_id, substr(period, 1, 4) ORDER BY period)")
        return rows.select("series_id", "period", "span", F.col("v").cast("double").alias("m"), ytd.cast("double").alias("ytd"))

    def _with_yoy(self, levels: DataFrame) -> DataFrame:
        before = levels.select("series_id", "span", F.concat((P.year("period") + 1).cast("string"), F.substring("period", 5, 3)).alias("period"), F.col("m").alias("bm"), F.col("ytd").alias("by"))
        rate = lambda a, b: F.round((F.col(a) / F.col(b) - 1) * 100, 1)
        return levels.join(before, ["series_id", "span", "period"], "left").select("series_id", "period", "span", "m", "ytd", rate("m", "bm").alias("m_yoy"), rate("ytd", "by").alias("ytd_yoy"))

    @cached_property
    def obs(self) -> DataFrame:
        """(series_id, period, span, m, ytd, m_yoy, ytd_yoy): what is published."""
        return self.held(self._with_yoy(self._levels("v")))

    @cached_property
    def old(self) -> DataFrame:
        """The older vintage, up to 2001-03."""
        return self.held(self._with_yoy(self._levels("va")).where("period <= '2001-03'"))

    @cached_property
    def release(self) -> DataFrame:
        """What a release brings, long: values of 2000-06 and later."""
        return self.long(self.obs.where("period >= '2000-06'"))

    def long(self, obs: DataFrame) -> DataFrame:
        """(series_id, period, span, measure, value), nulls left out."""
        return obs.unpivot(["series_id", "period", "span"], list(MEASURES), "measure", "value").where("value IS NOT NULL")

    @cached_property
    def mixed(self) -> DataFrame:
        """(series_id, period, m): months, quarters and years of the segments in one table."""
        months = self.raw.where("series_id LIKE 'mkt-%'")
        quarter = F.concat(F.substring("period", 1, 4), F.lit("-Q"), F.ceil(F.substring("period", 6, 2).cast("int") / 3).cast("string"))
        out = [months.groupBy("series_id", p.alias("period")).agg(F.sum("v").alias("v")) for p in (F.col("period"), quarter, F.substring("period", 1, 4))]
        return out[0].union(out[1]).union(out[2]).select("series_id", "period", F.col("v").cast("double").alias("m"))

    @cached_property
    def breaks(self) -> DataFrame:
        return self.rows(BREAKS, BREAK_SCHEMA)

    @cached_property
    def catalog(self) -> DataFrame:
        """(series_id, section, section_order, tier, name, value_type, headline): every series that is on file."""
        nations = self.table("nation").select(F.concat(F.lit("nat-"), "n_nationkey").alias("series_id"), F.lit("nation").alias("section"), F.lit(2).alias("section_order"), F.when(F.col("n_regionkey") < 3, 2).otherwise(3).alias("tier"), F.col("n_name").alias("name"))
        segments = self.table("customer").select("c_mktsegment").distinct().select(F.concat(F.lit("mkt-"), "c_mktsegment"), F.lit("market"), F.lit(1), F.lit(1), F.col("c_mktsegment"))
        return segments.union(nations).toDF("series_id", "section", "section_order", "tier", "name").withColumn("value_type", F.lit("level")).withColumn("headline", F.when(F.col("tier") == 3, "ytd").otherwise("single"))

    @cached_property
    def panel(self) -> DataFrame:
        """(entity, metric, period, m): nations by order priority, change on the month before in percent."""
        totals = self.cells.groupBy(F.col("nat").alias("entity"), F.col("pri").alias("metric"), "period").agg(F.sum("v").cast("double").alias("v"))
        before = totals.select("entity", "metric", P.next_period("period").alias("period"), F.col("v").alias("b"))
        return totals.join(before, ["entity", "metric", "period"], "left").select("entity", "metric", "period", F.round((F.col("v") / F.col("b") - 1) * 100, 1).alias("m"))

    @cached_property
    def captures(self) -> DataFrame:
        """(indicator, code, v, fetched): line items by ship month as an API would give them, twice for some months."""
        ship = self.table("lineitem").select("l_returnflag", F.date_format("l_shipdate", "yyyyMM").alias("ym"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v"))
        sums = ship.groupBy(F.concat(F.lit("ind-"), "l_returnflag").alias("indicator"), F.concat("ym", F.lit("MM")).alias("code")).agg(F.sum("v").alias("v"))
        first = sums.select("indicator", "code", F.col("v").cast("string").alias("v"), F.lit("2002-01-01").alias("fetched"))
        later = sums.where("substr(code, 5, 2) IN ('03', '06')").select("indicator", "code", F.when(F.substring("code", 5, 2) == "03", "").otherwise((F.col("v") + 1).cast("decimal(28,2)").cast("string")).alias("v"), F.lit("2002-02-01").alias("fetched"))
        return self.held(first.union(later))
