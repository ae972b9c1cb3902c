"""What of the published cells is checked again: strata of a stratified sample, and their check against API captures.

Points are (series_id, section, period, caliber), one for each published value. The random stratum takes the smallest hashes of
each section: counts of hashes by their first digits give a bound that leaves few more than are wanted, and only those are put
in order, so that no section is sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.breaks import seam_neighbours

#: Names of the strata, in the order in which a point belongs to the first.
STRATA = ("a_latest", "b_last_commit", "c_break_seam", "d_jan_feb", "e_derived_latest", "f_random")
POINT = ["series_id", "period", "caliber"]


def hash_of(seed: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), *POINT), 256)


def smallest(points: DataFrame, by: str, many: int, seed: str, digits: int = 3) -> DataFrame:
    """`many` points of each group by the order of a hash; the same for a seed, whatever the partitions."""
    hashed = points.withColumn("_h", hash_of(seed))
    head = F.substring("_h", 1, digits)
    counts = hashed.groupBy(by, head.alias("_head")).agg(F.count("*").alias("_n"))
    # One row for each first digits: the counts so far, of which there are 4096 a group.
    upto = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(by).orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bound = upto.where(F.col("_before") < many).groupBy(by).agg(F.max("_head").alias("_bound"))
    few = hashed.join(F.broadcast(bound), by).where(head <= F.col("_bound"))
    nth = F.row_number().over(Window.partitionBy(by).orderBy("_h", *POINT))
    return few.withColumn("_nth", nth).where(F.col("_nth") <= many).select(points.columns)


def strata(points: DataFrame, touched: DataFrame, breaks: DataFrame, derived: DataFrame, many: int, seed: str) -> DataFrame:
    """(series_id, section, period, caliber, stratum): every point of a stratum, in the first that it belongs to.

    a: the latest of a series; b: what the last commit touched (series_id, period); c: the periods next to a break on each side; d: Februaries of
    the last year and the one before; e: the latest of derived series (series_id), if it isn't in a; f: `many` others of each section, drawn.
    """
    last = points.groupBy("series_id").agg(F.max("period").alias("_last"))
    newest = points.agg(F.max(F.substring("period", 1, 4).cast("int")).alias("_newest"))
    seams = seam_neighbours(points.select("series_id", "period").distinct(), breaks)
    seams = seams.select("series_id", F.explode(F.array_distinct(F.array_compact(F.array("before", "after")))).alias("period")).distinct().withColumn("_seam", F.lit(True))
    rows = points.join(last, "series_id").join(F.broadcast(newest)).join(touched.select("series_id", "period", F.lit(True).alias("_touched")).distinct(), ["series_id", "period"], "left")
    rows = rows.join(seams, ["series_id", "period"], "left").join(derived.select("series_id", F.lit(True).alias("_derived")).distinct(), "series_id", "left")
    recent = F.col("period").endswith("-02") & (F.substring("period", 1, 4).cast("int") >= F.col("_newest") - 1)
    latest = F.col("period") == F.col("_last")
    tests = [latest & F.col("_derived").isNull(), F.col("_touched"), F.col("_seam"), recent, latest & F.col("_derived")]
    stratum = F.coalesce(*(F.when(t, name) for t, name in zip(tests, STRATA, strict=False)))
    rows = rows.select(*points.columns, stratum.alias("stratum"))
    drawn = smallest(rows.drop("stratum"), "section", many, seed).withColumn("_drawn", F.lit(True))
    rows = rows.join(drawn.select(*POINT, "_drawn"), POINT, "left")
    return rows.withColumn("stratum", F.coalesce("stratum", F.when(F.col("_drawn"), STRATA[-1]))).where("stratum IS NOT NULL").drop("_drawn")


#: The cells of a caliber that are checked.
FIELDS = {"single": ("m", "m_yoy"), "ytd": ("ytd", "ytd_yoy")}


def api_check(points: DataFrame, cells: DataFrame, captures: DataFrame, labels: DataFrame, slack: float = 0.06) -> DataFrame:
    """Each point's cells against API captures: (series_id, period, caliber, field, state, by).

    `cells` are (series_id, period, src, m, m_yoy, ytd, ytd_yoy), `captures` (indicator, name, period, value), `labels` (series_id, label). A source tag dg:<indicator>
    names the indicator; where there is none, those whose name holds a label of the series. A capture verifies a
    value that it equals as it is or less 100, within the display's slack. Each cell counts for itself: verified, mismatch, or gap where no capture has the period.
    """
    of_caliber = F.create_map(*(F.lit(x) for k, v in FIELDS.items() for x in (k, ",".join(v))))
    met = points.select(*POINT).join(cells, ["series_id", "period"]).withColumn("_fields", F.split(of_caliber[F.col("caliber")], ","))
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for fs in FIELDS.values() for f in fs))
    rows = met.select(*POINT, "src", "_fields", F.inline(each)).where("value IS NOT NULL AND array_contains(_fields, field)").drop("_fields")
    tag = F.regexp_extract("src", "^dg:(.+)$", 1)
    rows = rows.withColumn("indicator", F.when(tag != "", tag))
    from ledgerline.operators.merge import label_hits

    names = label_hits(labels.select("series_id", "label"), captures.select("indicator", "name").distinct(), "name").select("series_id", "indicator").distinct()
    tagged = rows.where("indicator IS NOT NULL").withColumn("by", F.lit("tag"))
    loose = rows.where("indicator IS NULL").drop("indicator").join(names, "series_id", "left").withColumn("by", F.when(F.col("indicator").isNotNull(), "label").otherwise("none"))
    both = tagged.unionByName(loose).join(captures.select("indicator", "period", F.col("value").alias("_raw")), ["indicator", "period"], "left")
    near = F.exists(F.array(F.col("_raw"), F.col("_raw") - 100), lambda r: F.abs(r - F.col("value")) <= slack + 1e-9)
    state = F.when(F.max(F.coalesce(near, F.lit(False))), "verified").when(F.max(F.col("_raw").isNotNull()), "mismatch").otherwise("gap")
    return both.groupBy(*POINT, "field").agg(state.alias("state"), F.min("by").alias("by"))
