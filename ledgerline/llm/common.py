"""What the operators of this subpackage share: words in Arrow batches, the shared folder, components."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; where that is unset in local mode, one of this process."""
    sc = spark.sparkContext
    held = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if held is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        held = tempfile.mkdtemp(prefix="spark-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(held)
    return held


def kept(df: DataFrame) -> DataFrame:
    """The same rows, computed once and held in the shared folder, where they outlive a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A side of a join, held in the shared folder: sent to every task where it has at most `most` rows, shuffled otherwise."""
    df = kept(df)
    return F.broadcast(df) if df.count() <= most else df


def give_back() -> None:
    """Returns what this worker has freed to the system, as other workers and later stages share the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts together have about `most` bytes, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        give_back()


def coded_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of a batch, the place of each word of the batch among them, and how many each text has. A null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = lists.flatten().dictionary_encode()
    words, places = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    each = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    if "" in words:  # what stands between two white spaces is no word
        none = words.index("")
        full = places != none
        rows = np.repeat(np.arange(len(lists)), each)[full]
        places = places[full]
        places = places - (places > none)
        return words[:none] + words[none + 1 :], places, np.bincount(rows, minlength=len(lists))
    return words, places, each.astype(np.int64)


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `values`, whose lengths are `counts`; an empty run sums to 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of `edges` (a, b) the smallest node that it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014) on edges from the greater end to the lesser: the first
    leads each edge on to the least node that its lesser end points to, by a minimum by node and a join back; the second
    leads all that a node points to, and itself, to the least of them. Minima are taken before the shuffle, a hub's edges stay rows that
    adaptive execution may split over tasks, and every round is held in the shared folder. It ends when each node points to one that
    points nowhere.
    """
    pairs = lambda *ends: F.inline(F.array(*(F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends)))
    e = kept(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while not _are_stars(e):
        low = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = e.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v")).repartition("u")
        e = kept(large.withColumn("m", F.expr("min(v) OVER (PARTITION BY u)")).select(pairs(("v", "m"), ("u", "m"))).where("u <> v").distinct())
    return e.select(pairs(("u", "v"), ("v", "v"))).distinct().toDF("node", "component")


def _are_stars(e: DataFrame) -> bool:
    """Whether in `e` (u, v) each u has one v, which is no u itself."""
    ends = e.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))))
    return ends.groupBy("node").agg(F.sum("out").alias("n"), F.min("out").alias("least")).where("n > 1 OR n = 1 AND least = 0").isEmpty()
