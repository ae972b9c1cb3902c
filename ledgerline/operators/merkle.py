"""Two builds compared by trees of digests over key ranges: equal ranges are never read.

A row belongs to the range of the first digits of its key's SHA-256; a range's digest is taken over its rows in order of their keys,
a parent's over its children's. Rows are written sorted by range, so that a reader of some ranges skips the rest of the files.
Ranges hold LEAF rows on average, whatever the table's size; a key that repeats keeps its rows together.

    nodes/   (depth, node, digest, n): all ranges, the root is ''
    rows/    the rows with their range
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a range, on average, and digits of the longest range's name.
LEAF, DEEPEST = 64, 12


def depth_for(n: int) -> int:
    """Digits that make ranges of about LEAF rows."""
    depth = 0
    while n > LEAF * 16**depth and depth < DEEPEST:
        depth += 1
    return depth


def _text(columns: list[str]) -> Column:
    """Columns as one text in which none can run into another."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def range_of(keys: list[str], depth: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)), 256), 1, depth)


def nodes(rows: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """(depth, node, digest, n) of all ranges of rows, from the leaves up; rows may have their range in `_range` already."""
    columns = sorted(c for c in rows.columns if c != "_range")
    rows = rows if "_range" in rows.columns else rows.withColumn("_range", range_of(keys, depth))
    leaf = rows.groupBy(F.col("_range").alias("node")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(_text(columns))), "\n"), 256).alias("digest"), F.count("*").alias("n"))
    level = leaf.select(F.lit(depth).alias("depth"), "node", "digest", "n")
    out = level
    for d in range(depth - 1, -1, -1):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat(c["node"], F.lit(":"), c["digest"])), "\n")
        level = level.groupBy(F.substring("node", 1, d).alias("node")).agg(F.sha2(children, 256).alias("digest"), F.sum("n").alias("n")).select(F.lit(d).alias("depth"), "node", "digest", "n")
        out = out.union(level)
    return out


def write(rows: DataFrame, keys: list[str], path: str, depth: int | None = None) -> int:
    """Writes rows and their tree; returns the depth. Trees that are compared need the same."""
    depth = depth_for(rows.count()) if depth is None else depth
    ranged = rows.withColumn("_range", range_of(keys, depth))
    ranged.repartitionByRange("_range").sortWithinPartitions("_range", *keys).write.mode("overwrite").parquet(f"{path}/rows")
    nodes(rows.sparkSession.read.parquet(f"{path}/rows"), keys, depth).write.mode("overwrite").parquet(f"{path}/nodes")
    return depth


def differing(spark: SparkSession, first: str, second: str) -> DataFrame:
    """(_range): the leaf ranges that differ between two trees, found from the root: only children of differing ranges are compared."""
    a, b = (spark.read.parquet(f"{p}/nodes").select("depth", "node", "digest") for p in (first, second))
    deepest = a.union(b).agg(F.max("depth")).first()[0] or 0
    found = None
    for depth in range(deepest + 1):
        x, y = (t.where(F.col("depth") == depth).select("node", F.col("digest").alias(k)) for t, k in ((a, "x"), (b, "y")))
        if depth:
            x, y = (t.withColumn("_up", F.substring("node", 1, depth - 1)).join(found, "_up", "left_semi").drop("_up") for t in (x, y))
        found = x.join(y, "node", "full_outer").where("NOT x <=> y").select(F.col("node").alias("_up"))
    return found.withColumnRenamed("_up", "_range")


#: Differing ranges up to which readers name them to the files, which skip the others by their statistics.
NAMED = 5000


def diff(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Rows of the first build that the second has not (side missing), and the other way round (extra), counting repeats; only differing ranges are compared."""
    a, b = rows_of(spark, first, second)
    b = b.select(a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("missing")).union(b.exceptAll(a).withColumn("side", F.lit("extra")))


def rows_of(spark: SparkSession, first: str, second: str) -> list[DataFrame]:
    """The rows of both builds in the ranges that differ."""
    ranges = differing(spark, first, second)
    few = [r[0] for r in ranges.limit(NAMED + 1).collect()]
    both = [spark.read.parquet(f"{p}/rows") for p in (first, second)]
    near = (lambda t: t.where(F.col("_range").isin(few))) if len(few) <= NAMED else (lambda t: t.join(ranges, "_range", "left_semi"))
    return [near(t).drop("_range") for t in both]
