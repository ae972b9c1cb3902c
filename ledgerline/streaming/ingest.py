"""Taking releases in, as a batch or from a stream of files; both go through the same function.

State is kept by family of series and year of the period. A release is staged, merged into the years it touches and written
under its own name with a log of every value that it changes, so what it costs goes with the years it touches and not with all that is on
file. The checks see what was written, and each family that nothing blocks gets its commit, one file: readers take the newest
commit of each family and year, so that they see all of a family's release or nothing, whatever becomes of the others.
A release that was taken in before is merged into what stood before it, so a stream that starts anew after a fault may repeat its last batch.

    staged/<name>/family=<f>              rows as they came
    cells/<name>/part=<f>/year=<year>     cells of a year after the release
    log/release=<name>/part=<f>           (cell, row_no, old, new): every change, several for a cell that the release has several rows of
    findings/<name>                       what the checks said
    commits/<name>/<f>                    (family, year, name)
    packed/<name>                         the commits up to a name in one file
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import gates as K
from ledgerline.operators import merge as G

ROW = "series_id string, period string, measure string, value double, release_id string"
CELL = "series_id string, period string, measure string, value double"
STORED = "family string, " + CELL
LOG = "series_id string, period string, measure string, row_no int, old double, new double"
COMMIT = "family string, year string, name string"
#: The family of rows that name none.
ALL = "all"
_YEAR = "substr(period, 1, 4)"


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, which need not exist."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _commits(spark: SparkSession, root: str, before: str | None = None) -> DataFrame:
    """(family, year, name) of the families' releases taken in, or of those before a name: the last pack, and what came after it."""
    packs = children(spark, f"{root}/packed")[-1:]
    since = [n for n in children(spark, f"{root}/commits") if not packs or n > packs[0]]
    paths = [f"{root}/packed/{n}" for n in packs] + [f"{root}/commits/{n}" for n in since]
    if not paths:
        return spark.createDataFrame([], COMMIT)
    rows = spark.read.option("recursiveFileLookup", "true").schema(COMMIT).json(paths)
    return rows.where(F.col("name") < before) if before is not None else rows


def pack(spark: SparkSession, root: str) -> None:
    """Writes all commits so far as one file, so that readers open it instead of a file for each family and release."""
    names = children(spark, f"{root}/commits")
    if names and names[-1:] != children(spark, f"{root}/packed")[-1:]:
        _commits(spark, root).coalesce(1).write.mode("overwrite").json(f"{root}/packed/{names[-1]}")


def newest(spark: SparkSession, root: str, before: str | None = None, parts: list[tuple[str, str]] | None = None, families: list[str] | None = None) -> DataFrame:
    """The cells as the last release left them, or the last before a name; all, or of some (family, year) or families only."""
    return _stored(spark, root, before, parts, families).drop("family")


def _stored(spark: SparkSession, root: str, before: str | None = None, parts: list[tuple[str, str]] | None = None, families: list[str] | None = None) -> DataFrame:
    last = _commits(spark, root, before).groupBy("family", "year").agg(F.max("name").alias("name"))
    last = last if families is None else last.where(F.col("family").isin(families))
    rows = [tuple(r) for r in last.collect()]  # a path for each family's years on file
    paths = [f"{root}/cells/{name}/part={family}/year={year}" for family, year, name in rows if parts is None or (family, year) in set(parts)]
    return spark.read.schema(STORED).parquet(*paths) if paths else spark.createDataFrame([], STORED)


def revisions(spark: SparkSession, root: str) -> DataFrame:
    """(release, cell, row_no, old, new): what the releases taken in have changed, from one scan of the log."""
    if not children(spark, f"{root}/log"):
        return spark.createDataFrame([], "release string, " + LOG)
    log = spark.read.schema(LOG + ", release string, part string").parquet(f"{root}/log")
    taken = _commits(spark, root).select(F.col("name").alias("release"), F.col("family").alias("part")).distinct()
    return log.join(taken, ["release", "part"], "left_semi").select("release", "series_id", "period", "measure", "row_no", "old", "new")


def check(now: DataFrame, rows: DataFrame, before: DataFrame, log: DataFrame) -> DataFrame:
    """Findings on release rows alone: bad periods and levels below zero."""
    shaped = rows.withColumn("span", F.lit(1))
    level = rows.where("measure IN ('m', 'ytd')").withColumn("m", F.col("value")).withColumn("m_yoy", F.lit(None).cast("double"))
    return K.schema(shaped).union(K.bounds(level))


#: Cells after the release (series_id, period, measure, value) of the families it touches, its rows, the cells before, its log -> findings.
Gate = Callable[[DataFrame, DataFrame, DataFrame, DataFrame], DataFrame]


def take(spark: SparkSession, pulls: DataFrame | dict[str, Callable[[], DataFrame]], root: str, name: str, gate: Gate = check) -> dict[str, str]:
    """Takes a release in under a name and says of each family whether it was taken, blocked by the checks, or failed.

    `pulls` are rows with a family, or a function for each family that gives its rows; a family whose function or rows raise
    an error fails alone. Of several rows of a cell the last by release_id stays, and each step is logged.
    """
    state: dict[str, str] = {}
    if isinstance(pulls, dict):
        for family, pull in pulls.items():
            try:
                _numbered(pull()).write.mode("overwrite").parquet(f"{root}/staged/{name}/family={family}")
                state[family] = "taken"
            except Exception as error:  # whatever a source does, the other families go on
                state[family] = f"failed: {type(error).__name__}"
        if "taken" not in state.values():
            return state
    else:
        family = F.col("family") if "family" in pulls.columns else F.lit(ALL)
        _numbered(pulls, family.alias("family")).write.mode("overwrite").partitionBy("family").parquet(f"{root}/staged/{name}")
    rows = spark.read.schema(CELL + ", row_no int, family string").parquet(f"{root}/staged/{name}")
    rows = rows.where(F.col("family").isin([f for f, s in state.items() if s == "taken"])) if state else rows  # what an earlier attempt left plays no part
    parts = [tuple(r) for r in rows.selectExpr("family", f"{_YEAR} AS year").distinct().collect()]
    state |= {family: "taken" for family, _ in parts}
    key, families = ["family", *G.CELL], sorted({family for family, _ in parts})
    part = F.col("family").alias("part")

    old = _stored(spark, root, name, parts)
    mapped = rows.select("series_id", "family").distinct()
    G.in_order(old, rows).join(mapped, "series_id").select("series_id", "period", "measure", "row_no", "old", "new", part).write.mode("overwrite").partitionBy("part").parquet(f"{root}/log/release={name}")
    last = rows.groupBy(*key).agg(F.max_by("value", "row_no").alias("new"))
    both = old.withColumnRenamed("value", "old").join(last, key, "full_outer")
    keep = F.col("new").isNull() | (F.abs(F.col("new") - F.col("old")) < G.SAME)
    after = both.select(*key, F.when(keep, F.col("old")).otherwise(F.col("new")).alias("value"), part, F.expr(_YEAR).alias("year"))
    after.hint("rebalance", "part", "year").write.mode("overwrite").partitionBy("part", "year").parquet(f"{root}/cells/{name}")

    log = spark.read.schema(LOG + ", part string").parquet(f"{root}/log/release={name}").drop("part")
    now = spark.read.schema(STORED + ", part string, year string").parquet(f"{root}/cells/{name}").drop("part", "year")
    before = _stored(spark, root, name, families=families)
    others = before.withColumn("year", F.expr(_YEAR)).join(F.broadcast(spark.createDataFrame(parts, "family string, year string")), ["family", "year"], "left_anti").drop("year")
    now = now.union(others.select(now.columns))
    found = gate(now.drop("family"), rows, before.drop("family"), log)
    of_series = now.select("series_id", "family").union(mapped).distinct()
    # A finding on no series on file is one on the family that it names, or on all.
    found.join(of_series, "series_id", "left").withColumn("family", F.coalesce("family", F.when(F.col("period").isin(families), F.col("period")))).write.mode("overwrite").parquet(f"{root}/findings/{name}")
    blocked = {r[0] for r in spark.read.parquet(f"{root}/findings/{name}").where("severity = 'BLOCK'").select("family").distinct().collect()}
    for family in families:
        if family in blocked or None in blocked:
            state[family] = "blocked"
        else:
            years = [(family, y, name) for f, y in parts if f == family]
            spark.createDataFrame(years, COMMIT).coalesce(1).write.mode("overwrite").json(f"{root}/commits/{name}/{family}")
    return state


def _numbered(rows: DataFrame, *more) -> DataFrame:
    order = Window.partitionBy(*G.CELL).orderBy(*(["release_id"] if "release_id" in rows.columns else []), "value")
    return rows.withColumn("row_no", F.row_number().over(order)).select(*G.CELL, "value", "row_no", *more)


def ingest(spark: SparkSession, rows: DataFrame, root: str, name: str, gate: Gate = check) -> tuple[bool, DataFrame]:
    """Takes release rows in; whether all families were taken, and what the release changes."""
    state = take(spark, rows, root, name, gate)
    log = spark.read.schema(LOG).parquet(f"{root}/log/release={name}") if state else spark.createDataFrame([], LOG)
    return all(s == "taken" for s in state.values()), log


def start(spark: SparkSession, source: str, root: str, checkpoint: str) -> StreamingQuery:
    """A stream of JSON files of release rows; a batch is a release named by its number, so a repeated batch is written over."""
    rows = spark.readStream.schema(ROW).json(source)
    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, n: ingest(spark, df, root, f"snapshot-{n:09d}"))
        .trigger(availableNow=True)
        .start()
    )
