"""Published documents in a store where nothing is changed: files by the hash of their content, and one pointer to what is current.

A publication writes the documents whose content is new, then a manifest of all its documents, then its pointer. Readers take
the newest pointer, so they see one publication whole, whatever is being written or has failed; documents that didn't change are
neither written nor copied.

    objects/hash=<sha256>/     one document
    manifests/<name>/          (document, hash, bytes)
    current/<name>/            (name)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.streaming.ingest import children

MANIFEST = "document string, hash string, bytes long"


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The manifest of the newest publication."""
    names = children(spark, f"{root}/current")
    return spark.read.schema(MANIFEST).json(f"{root}/manifests/{names[-1]}") if names else None


def publish(spark: SparkSession, documents: DataFrame, root: str, name: str) -> DataFrame:
    """Publishes documents (document, body), each name once, under a name that sorts after those before; (document, hash, written)."""
    rows = documents.select("document", "body", F.sha2("body", 256).alias("hash"))
    rows.write.mode("overwrite").parquet(f"{root}/staged/{name}")
    rows = spark.read.parquet(f"{root}/staged/{name}")
    before = current(spark, root)
    known = before.select("hash").distinct() if before is not None else rows.select("hash").where("false")
    new = rows.dropDuplicates(["hash"]).join(known, "hash", "left_anti")
    # A hash that is written again after a failure holds the same bytes.
    new.select("body", "hash").repartition("hash").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hash").text(f"{root}/objects")
    manifest = rows.select("document", "hash", F.octet_length("body").cast("long").alias("bytes"))
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/manifests/{name}")
    spark.createDataFrame([(name,)], "name string").coalesce(1).write.mode("overwrite").json(f"{root}/current/{name}")
    return rows.select("document", "hash").join(known.withColumn("_known", F.lit(True)), "hash", "left").select("document", "hash", F.col("_known").isNull().alias("written"))


def read(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """(document, body) of the newest publication; of some documents only, whose files alone are opened."""
    manifest = current(spark, root)
    if manifest is None:
        return spark.createDataFrame([], "document string, body string")
    wanted = manifest.where(F.col("document").isin(*names)) if names else manifest
    paths = sorted({f"{root}/objects/hash={r['hash']}" for r in wanted.select("hash").collect()})  # a publication has some hundreds of documents
    if not paths:
        return spark.createDataFrame([], "document string, body string")
    bodies = spark.read.option("basePath", f"{root}/objects").schema("value string, hash string").text(paths, wholetext=True)
    return wanted.join(bodies, "hash").select("document", F.regexp_replace("value", "\n$", "").alias("body"))
