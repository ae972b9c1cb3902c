"""Passages that repeat: seed and extend over winnowed anchors.

A window is LENGTH consecutive words of one document. Of the SEED-word runs inside a window the one with the least hash is
its anchor (the leftmost of equals), so equal windows have equal anchors at equal places, and consecutive windows of a document
share theirs: a text gives one anchor for about eight words, each with the windows that it stands for.

Anchors meet by their hash. A match is extended both ways over all words of the anchor's windows at once: occurrences that agree
on all of them form a class, whose first occurrence stands for it and whose others repeat it wholly. Where a seed has several
classes, which agree on some windows only, as at the ends of a passage, the windows of their first occurrences are compared one
by one. Windows found either way are joined into maximal passages. A group of copies costs rows in proportion to its members,
never pairs, and repeats within a batch of texts are settled before anything is shuffled.

Hashes: 64 bits of the seed and 64 of the words around it have to agree.

Rows: a null text has no words. Rows without an id come after all others. Rows of one id are ordered by their texts' hashes; rows
equal in id and text are one document, judged alike. Texts are taken whole. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import coded_words, shared_dir, slices, table

#: Words of a window, and of the seeds inside it.
LENGTH, SEED = 20, 6
_BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scattered, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Hashes of any run of words of a batch, from sums of powers."""

    def __init__(self, texts: pa.Array) -> None:
        words, codes, self.counts = coded_words(texts)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))[codes]
        self.n, self.starts = len(hashes), np.cumsum(self.counts) - self.counts
        powers = lambda base: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(self.n, base, np.uint64)]))
        self.sums, self.back = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(_BASE)[:-1])]), powers(pow(_BASE, -1, 1 << 64))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start])


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Where in each run of `width` entries the least is, the leftmost of equals."""
    at, have = np.arange(len(x)), 1
    while have < width and len(at):
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at, have = np.where(x[right] < x[left], right, left), have + step
    return at


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("id", id_type), *(T.StructField(k, T.LongType()) for k in ("tie", "seed", "span")), *(T.StructField(k, T.IntegerType()) for k in ("first", "last")), T.StructField("done", T.BooleanType())]
    )


def _settled(batch: pa.RecordBatch, doc: np.ndarray, first: np.ndarray, last: np.ndarray, seed: np.ndarray, span: np.ndarray) -> pa.RecordBatch:
    """Rows of _schema; of equal (seed, span) in the batch only the earliest go on, the others are done, joined where they adjoin.

    `first` and `last` are window starts within document `doc`, in order.
    """
    keys = pa.table({"id": batch.column(0), "tie": batch.column(1)})
    order = pc.sort_indices(keys, [("id", "ascending"), ("tie", "ascending")], null_placement="at_end").to_numpy()
    ids, ties = keys["id"].combine_chunks().take(pa.array(order)).dictionary_encode(null_encoding="encode").indices.to_numpy(), keys["tie"].to_numpy()[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], (np.diff(ids) != 0) | (np.diff(ties) != 0)])) if len(order) else 0
    by = np.lexsort((first, rank[doc], span, seed))
    opens = np.concatenate([[True], (np.diff(seed[by]) != 0) | (np.diff(span[by]) != 0)])[: len(by)]
    head = by[np.maximum.accumulate(np.where(opens, np.arange(len(by)), 0))]
    done = np.empty(len(by), bool)
    done[by] = (rank[doc[by]] != rank[doc[head]]) | (first[by] != first[head])
    new = np.ones(len(done), bool)
    new[1:] = ~(done[1:] & done[:-1] & (doc[1:] == doc[:-1]) & (first[1:] == last[:-1] + 1))
    at = np.nonzero(new)[0]
    ends = np.append(at[1:], len(new))[: len(at)] - 1
    # What is done needs no meeting: its key only scatters it.
    seed = np.where(done[at], mixed(seed[at] + mixed(first[at].astype(np.uint64))), seed[at])
    columns = [batch.column(0).take(pa.array(doc[at])), batch.column(1).take(pa.array(doc[at])), pa.array(seed.view(np.int64)), pa.array(span[at].view(np.int64))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(first[at].astype(np.int32)), pa.array(last[ends].astype(np.int32)), pa.array(done[at])], ["id", "tie", "seed", "span", "first", "last", "done"])


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (id, tie, text) as anchors with the windows `first` to `last` that they stand for."""
    for batch in slices(batches, 2):
        s = Spans(batch.column(2))
        if s.n < LENGTH:
            continue
        at = np.arange(s.n - SEED + 1)
        x = s.of(at, at + SEED)
        place = least_of(x, LENGTH - SEED + 1)
        owner = np.repeat(np.arange(len(s.counts)), s.counts)
        windows = np.nonzero(owner[: s.n - LENGTH + 1] == owner[LENGTH - 1 :])[0]
        place = place[windows]
        opens = np.nonzero(np.concatenate([[True], place[1:] != place[:-1]]))[0] if len(place) else place
        first, last = windows[opens], windows[np.append(opens[1:], len(windows))[: len(opens)] - 1]
        doc = owner[first]
        yield _settled(batch, doc, first - s.starts[doc], last - s.starts[doc], x[place[opens]], s.of(first, last + LENGTH))


def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (id, tie, text, spots of first, last, seed) as single windows."""
    for batch in slices(batches, 2):
        s, lists = Spans(batch.column(2)), batch.column(3)
        spots, many = lists.flatten(), pc.list_value_length(lists).to_numpy()
        first, last, seed = (spots.field(k).to_numpy() for k in range(3))
        doc, size = np.repeat(np.arange(len(many)), many), last - first + 1
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        doc, start = np.repeat(doc, size), np.repeat(first, size) + within
        at = s.starts[doc] + start
        yield _settled(batch, doc, start, start, np.repeat(seed, size).view(np.uint64), s.of(at, at + LENGTH))


def _earlier() -> WindowSpec:
    return Window.partitionBy("done", "seed", "span").orderBy(F.col("id").asc_nulls_last(), "tie", "first")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tie, text): the tie is 0 where ids are unique."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    again = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").limit(1).count()
    return rows.select("id", (F.xxhash64("text") if again else F.lit(0).cast("long")).alias("tie"), "text")


def _same(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """a with the columns of b, joined by id and tie; null ids are equal."""
    b = b.withColumnRenamed("id", "_id").withColumnRenamed("tie", "_tie")
    return a.join(b, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), how).drop("_id", "_tie")


def repeats(keyed: DataFrame) -> DataFrame:
    """(id, tie, first, last): starts of windows whose words also start earlier, from rows (id, tie, text)."""
    out = _schema(keyed.schema["id"].dataType)
    met = keyed.mapInArrow(anchors, out).withColumn("_nth", F.rank().over(_earlier()))
    seed = Window.partitionBy("done", "seed")
    met = met.withColumn("_one", F.min("span").over(seed) == F.max("span").over(seed))
    found = F.col("done") | (F.col("_nth") > 1)
    met = met.where(found | ~F.col("_one")).select("id", "tie", "seed", "first", "last", (~found).alias("open"))
    path = f"{shared_dir(keyed.sparkSession)}/passages-{uuid.uuid4().hex}"
    met.write.parquet(path)
    met = keyed.sparkSession.read.parquet(path)
    spots = met.where("open").groupBy("id", "tie").agg(F.collect_list(F.struct("first", "last", "seed")).alias("spots"))
    each = _same(keyed, spots, "inner").select("id", "tie", "text", "spots").mapInArrow(windows_of, out)
    each = each.withColumn("_nth", F.rank().over(_earlier())).where("done OR _nth > 1")
    columns = ["id", "tie", "first", "last"]
    return met.where("NOT open").select(*columns).union(each.select(*columns))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (id, text, spots of first, last) without the words of those windows."""
    for batch in slices(batches, 1):
        sizes, gone, kept = [], [], []
        for text, spots in zip(batch.column(1), batch.column(2), strict=True):
            words = (text.as_py() or "").encode().split()
            drop = np.zeros(len(words) + 1, np.int64)
            if spots.is_valid:
                np.add.at(drop, spots.values.field(0).to_numpy(), 1)
                np.add.at(drop, spots.values.field(1).to_numpy() + LENGTH, -1)
            stays = np.cumsum(drop)[:-1] == 0
            sizes.append(len(words))
            gone.append(len(words) - int(stays.sum()))
            kept.append(b" ".join(words if stays.all() else [words[k] for k in np.nonzero(stays)[0]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"])


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_removed, kept): every text's words but those of passages that also start earlier, joined by single spaces."""
    keyed = _keyed(df, id_col, text_col)
    spots = repeats(keyed).distinct().groupBy("id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("spots"))
    out = T.StructType([T.StructField("id", keyed.schema["id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return _same(keyed, spots, "left").select("id", "text", "spots").mapInArrow(_without, out).withColumnRenamed("id", id_col)


def op11_passages(spark, sf_dir):
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
