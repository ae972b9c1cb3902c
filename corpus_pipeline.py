"""From raw documents to token files: five stages, each written as Parquet and read again by the next.

1. quality: documents that the pairwise ranking rejects go.
2. near-dedup: of documents that meet by ball hashing of their SimHash fingerprints (op4's, here over five-word shingles) or, beyond its
   radius, by MinHash, and are found similar, the one with the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: every document is repeated as often as the mix takes it, which may be never.
5. token files: the texts as ids, packed and read back.

Stages 1 to 4 return the columns of documents, whatever others the table has beside doc_id, text and source.

Rows: null and empty texts are scored like any other, are one group of copies, hold no benchmark item, are of size 0 and give the
end id alone. Rows with a null id stand for themselves by their text: they are judged, deduplicated after all
rows with an id, and dropped if contaminated like any other. Rows that repeat an id are one document: they stay or go together as
copies, each by its own text in decontamination, and each gets copies of its own in the mix. Of groups of equal standing the
smallest id stays. Very long texts are taken whole. An empty table gives empty results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, mixing, quality, simhash, token_files
from ledgerline.llm.common import shared_dir, small_side, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below 0.3; all labelled rows but the held-out ones are learnt from."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~quality.held_out()))
    return docs.where(model.score() >= 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group at similarity 0.8 or more over five-word shingles."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops each row whose text holds an item; rows of one id and rows without an id are told apart by their texts."""
    key = F.concat_ws(":", F.col("doc_id"), F.xxhash64("text"), F.when(F.col("doc_id").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256)))
    keyed = docs.withColumn("_key", key)
    found = decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col="_key").select("_key").distinct()
    # The keys are few, so that the texts needn't be shuffled; found first, so that the Python workers have the memory for themselves.
    return keyed.join(small_side(found), "_key", "left_anti").select(*docs.columns)


#: Shares into which rows equal in id, source and size are cut by their texts.
SHARES = 64


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each row as often as the mix takes it; of rows equal in id, source and size, as many as it takes of them."""
    # Those differ by one copy at most, as a source's rows have one ratio of target to size.
    key, same = F.to_json(F.struct("doc_id", "source")).alias("_key"), ["_key", "_size"]
    least, copies = F.min("copies").alias("_least"), F.sum("copies")
    taken = mixing.mix(docs).select(key, F.col("size").alias("_size"), "copies").groupBy(*same).agg(least, (copies - F.count("*") * F.min("copies")).alias("_more"))
    size = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).cast("long").alias("_size")
    rows = docs.select("*", key, size, F.pmod(F.xxhash64("text"), F.lit(SHARES)).alias("_share"))
    before = rows.groupBy(*same, "_share").agg(F.count("*").alias("_n")).withColumn("_before", F.expr("sum(_n) OVER (PARTITION BY _key, _size ORDER BY _share) - _n")).drop("_n")
    met = rows.join(before.join(taken.where("_least > 0 OR _more > 0"), same), [*same, "_share"])
    nth = F.row_number().over(Window.partitionBy(*same, "_share").orderBy(F.xxhash64("text"), "text")) + F.col("_before")
    met = met.withColumn("_copies", F.col("_least") + (nth <= F.col("_more")).cast("long")).where("_copies > 0")
    return met.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_nth")).drop("_nth")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: No stage but the last step's arithmetic can be put in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}-{name}")
        docs = spark.read.parquet(f"{place}/{k}-{name}")
    return docs
