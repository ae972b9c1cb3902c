"""Token-id files: whole texts encoded, packed by Simple-8b and read back.

A file set is a Parquet folder. A row is a block, some 64k ids of whole documents of one shard:

    shard int            place of the shard; shards hold rising ranges of document ids
    block int            place within the shard
    shard_start long     ids of the shard before the block
    doc_ids array<..>    documents of the block, in order
    lengths array<int>   ids of each, with its end id
    offsets array<long>  place of the 64-bit word that begins with every OFFSET_EVERY-th id of the block
    packed binary        little-endian 64-bit words

Every word has a selector in its top 4 bits and 60 bits of payload: WIDTHS[s] bits for each of COUNTS[s] ids, the
first lowest. A word never reaches over an OFFSET_EVERY-th id. Selector 15 is the escape: one id of up to 60 bits, for ids that no narrower cell can hold.

Shards hold about SHARD_BYTES of text, however large the table is; rows of one id, or of none, may fill several.

Rows: null texts count as empty, and an empty text has the end id alone; rows of equal ids are in the order of a hash of their
texts, then of the texts; null ids come first; very long texts make a block of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import coded_words, kept, shared_dir, slices, table

COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
END_ID = 1
BLOCK_IDS = 1 << 16
OFFSET_EVERY = 4096
#: Bytes of text encoded at once, for which a worker needs some thirty times as much.
SLICE_BYTES = 1 << 20
#: Bytes of text of a shard, about.
SHARD_BYTES = 32 << 20
#: Shards up to which their first places, two numbers each, are sent to every task.
BROADCAST_SHARDS = 1_000_000
#: What a Python worker remembers of words and their ids, in bytes; then it starts anew.
REMEMBERED = 96 << 20


_FLOOR = np.array([max((c for c in COUNTS if c <= room), default=0) for room in range(61)], np.uint8)


def pack(ids: np.ndarray, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 64-bit words of `ids`; and of every run of OFFSET_EVERY ids, each block's counted from its start, the place of its
    first id and of its first word. `blocks` are the places where blocks begin.

    All runs advance together: a step of the loop fills one word of each.
    """
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    if int(width.max()) > 60:
        raise ValueError("an id takes more than 60 bits")
    # most[i]: the widest of the c ids from i; c grows by steps, and each window is two shorter ones.
    best, most, have = np.ones(n, np.uint8), width, 1
    for c, w in sorted(zip(COUNTS, WIDTHS, strict=True)):
        if c > n:
            break
        while have < c:
            step = min(have, c - have)
            most = np.maximum(most[: len(most) - step], most[step:])
            have += step
        fits = (most <= w).view(np.uint8) * np.uint8(c)
        np.maximum(best[: len(most)], fits, out=best[: len(most)])
    cuts = np.append(np.zeros(1, np.int64) if blocks is None else blocks, n)
    starts = np.concatenate([np.arange(a, b, OFFSET_EVERY) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    ends = np.append(starts[1:], n)
    # Fewer ids than fit leave cells that are wide enough, so the last words of a run may stop short.
    for back in range(1, min(60, OFFSET_EVERY) + 1):
        at = ends - back
        at = at[at >= starts]
        best[at] = np.minimum(best[at], _FLOOR[back])
    at, last, firsts = starts, ends, []
    while len(at):
        firsts.append(at)
        at = at + best[at]
        open_ = at < last
        if not open_.all():
            at, last = at[open_], last[open_]
    mark = np.zeros(n, bool)
    mark[np.concatenate(firsts)] = True
    firsts = np.nonzero(mark)[0]
    took, words = best[firsts], np.zeros(len(firsts), np.uint64)
    for s, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        at = np.nonzero(took == c)[0]
        if len(at):
            cells = ids[firsts[at][:, None] + np.arange(c)] << (np.uint64(w) * np.arange(c, dtype=np.uint64))
            words[at] = np.bitwise_or.reduce(cells, axis=1) | (np.uint64(ESCAPE if c == 1 else s) << np.uint64(60))
    return words, starts, np.searchsorted(firsts, starts)


def unpack(words: np.ndarray) -> np.ndarray:
    """All ids of some words."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    selector[selector == ESCAPE] = len(COUNTS) - 1
    counts = np.array(COUNTS)[selector]
    out, starts = np.zeros(counts.sum(), np.uint64), np.cumsum(counts) - counts
    for s, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        at = np.nonzero(selector == s)[0]
        if len(at):
            cells = words[at][:, None] >> (np.uint64(w) * np.arange(c, dtype=np.uint64)) & np.uint64((1 << w) - 1)
            out[starts[at][:, None] + np.arange(c)] = cells
    return out


def unpack_part(words: np.ndarray, offsets: np.ndarray, start: int, stop: int) -> np.ndarray:
    """The ids from `start` to `stop` of a block, decoded from the offset before the first to the one after the last."""
    a, b = start // OFFSET_EVERY, -(-stop // OFFSET_EVERY)
    ids = unpack(words[offsets[a] : offsets[b] if b < len(offsets) else len(words)])
    return ids[start - a * OFFSET_EVERY : stop - a * OFFSET_EVERY]


class WordEncoder:
    """Ids of white-space separated words, from a tokenizer that drops white space, so that a text's ids are its words' ids.

    Most words are letters with or without a run of marks behind. Where the tokenizer takes the two apart, their ids
    are those of the letters, in lower case if the tokenizer ignores case, and of the marks. Runs of letters are
    encoded many at once and told apart by the suffix that ends each of the tokenizer's own words; all else is
    encoded one by one. Words are remembered by a hash of 64 bits in some 30 bytes each.
    """

    LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
    #: Letters and marks of each line, or all of a line that is not of this form.
    PLAIN = re.compile(rf"^(?:([{LETTERS}]+)([!-/:-@\[-^`{{-~]*)|(.*))$", re.MULTILINE)

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        probes = [("word", ","), ("Größe", "..."), ("x", "'"), ("The", ")*")]
        self.splits = self.ends.any() and all(self._one(a + b) == self._one(a) + self._one(b) for a, b in probes)
        letters = [c for c in map(chr, range(256)) if re.match(f"[{self.LETTERS}]", c)]
        self.folds = all(self._one(f"n{c}n") == self._one(f"n{c}n".lower()) for c in letters)
        self._forget()

    def _forget(self) -> None:
        # By a 64-bit hash of the word, in rising order: the first of its ids among `flat`, and how many it has.
        self.keys, self.starts, self.counts, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def _one(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    @staticmethod
    def _hashes(words: list[str]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each word stands, or -1."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def _keep(self, hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        """Remembers new words; of equal ones the first."""
        hashes, first = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.keys, hashes)
        self.keys, self.starts, self.counts = np.insert(self.keys, at, hashes), np.insert(self.starts, at, starts[first]), np.insert(self.counts, at, counts[first])

    def _singly(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._one(w) for w in words]
        return np.array([x for own in ids for x in own], "<u4"), np.fromiter(map(len, ids), np.int64, len(ids))

    def _in_runs(self, letters: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """All ids of runs of letters one after the other, and how many each has; None if the tokenizer cuts letters after all."""
        found, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for k in range(0, len(letters), 5000):
            some = letters[k : k + 5000]
            found.append(np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4"))
            stops = np.nonzero(self.ends[found[-1]])[0] + 1
            if len(stops) != len(some):
                return None
            counts.append(np.diff(stops, prepend=0))
        return np.concatenate(found), np.concatenate(counts)

    def _learn(self, words: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each of these words begin among `flat`, and how many it has. All are remembered at once."""
        parts = self.PLAIN.findall("\n".join(words)) if self.splits else []
        plain = [k for k, p in enumerate(parts) if p[0]]
        heads, marks = [parts[k][0] for k in plain], [parts[k][1] for k in plain]
        if self.folds and heads:
            heads = "\n".join(heads).lower().split("\n")  # these letters are as many in lower case
        letters = {w: k for k, w in enumerate(dict.fromkeys(heads))}
        names, known = list(letters), self._hashes(list(letters))
        at = self._places(known)
        fresh = np.nonzero(at < 0)[0]
        found = self._in_runs([names[k] for k in fresh])
        if found is None:
            plain, heads, marks, fresh, letters, found = [], [], [], fresh[:0], {}, (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        # One behind the other: what is remembered, new letters, marks, and all other words.
        tails = {w: k for k, w in enumerate(dict.fromkeys(marks))}
        taken = np.zeros(len(words), bool)
        taken[plain] = True
        rest = np.nonzero(~taken)[0]
        tail_ids, tail_counts = self._singly(list(tails))
        rest_ids, rest_counts = self._singly([words[k] for k in rest])
        pool = np.concatenate([self.flat, found[0], tail_ids])
        begin = lambda counts, start: start + np.cumsum(counts) - counts
        starts, counts = np.zeros(len(letters), np.int64), np.zeros(len(letters), np.int64)
        if letters:
            old = np.nonzero(at >= 0)[0]
            starts[old], counts[old] = self.starts[at[old]], self.counts[at[old]]
            starts[fresh], counts[fresh] = begin(found[1], len(self.flat)), found[1]
        head = np.fromiter(map(letters.__getitem__, heads), np.int64, len(heads))
        tail = np.fromiter(map(tails.__getitem__, marks), np.int64, len(marks))
        pair_starts = np.stack([starts[head], begin(tail_counts, len(self.flat) + len(found[0]))[tail]], axis=1)
        pair_counts = np.stack([counts[head], tail_counts[tail]], axis=1)
        # A word that is its own letters has its ids among theirs already.
        whole = np.fromiter((not m for m in marks), bool, len(marks))
        joined = np.nonzero(~whole)[0]
        base = len(self.flat) + len(found[0])
        composed = ranges(pool, pair_starts[joined].ravel(), pair_counts[joined].ravel())
        sums = pair_counts.sum(axis=1)
        out_starts, out_counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain = np.array(plain, np.int64)
        out_counts[plain], out_counts[rest] = sums, rest_counts
        out_starts[plain[whole]] = pair_starts[whole, 0]
        out_starts[plain[joined]] = begin(sums[joined], base)
        out_starts[rest] = begin(rest_counts, base + len(composed))
        self.flat = np.concatenate([self.flat, found[0], composed, rest_ids])
        self._keep(np.concatenate([known[fresh], hashes]), np.concatenate([starts[fresh], out_starts]), np.concatenate([counts[fresh], out_counts]))
        return out_starts, out_counts

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after the other, and how many each has."""
        if 20 * len(self.keys) + 4 * len(self.flat) > REMEMBERED:
            self._forget()
        hashes = self._hashes(words)
        at = self._places(hashes)
        missing = np.nonzero(at < 0)[0]
        starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        held = np.nonzero(at >= 0)[0]
        starts[held], counts[held] = self.starts[at[held]], self.counts[at[held]]
        if len(missing):
            starts[missing], counts[missing] = self._learn([words[k] for k in missing], hashes[missing])
        return ranges(self.flat, starts, counts), counts


def ranges(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of `values` that begin at `starts` and have `counts` entries, one after the other."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return values[:0]
    kind = np.int32 if max(ends[-1], len(values)) < 1 << 31 else np.int64
    return values[np.arange(ends[-1], dtype=kind) + np.repeat((starts - (ends - counts)).astype(kind), counts)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for every Python worker, which serves many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts, each with its end id, and how many each text has."""
    words, places, counts = coded_words(texts)
    flat, size = encoder(path).ids(words)
    flat, size = np.concatenate([flat, np.array([END_ID], "<u4")]), np.concatenate([size, [1]])
    places = np.insert(places, np.cumsum(counts), len(words))  # the end id, after the last word of each text
    starts = np.cumsum(size) - size
    ids = ranges(flat, starts[places], size[places])
    ends = np.cumsum(size[places])[np.cumsum(counts + 1) - 1] if len(counts) else np.zeros(0, np.int64)
    return ids, np.diff(ends, prepend=0)


def _block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("shard_start", T.LongType()), T.StructField("n_ids", T.LongType())]
        + [T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(T.LongType()))]
        + [T.StructField("packed", T.BinaryType())]
    )


def write_ids(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text and writes the blocks in ascending order of ids, in shards of about SHARD_BYTES, and as many as there are cores at least."""
    held = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(-(-held // SHARD_BYTES), df.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches, most=SLICE_BYTES):
            ids, lengths = encode_texts(batch.column(1), tokenizer)
            ends = np.cumsum(lengths)
            part = (ends - lengths) // BLOCK_IDS
            cuts = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(lengths)]])
            firsts = (ends - lengths)[cuts[:-1]] if len(lengths) else ends
            packed, starts, places = pack(ids, firsts)
            runs = np.append(np.searchsorted(starts, firsts), len(starts))
            for nth, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                own, here = int(ends[b - 1] - firsts[nth]), places[runs[nth] : runs[nth + 1]]
                words = packed[here[0] : places[runs[nth + 1]] if runs[nth + 1] < len(places) else len(packed)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "shard_start": pa.array([before], pa.int64()),
                        "n_ids": pa.array([own], pa.int64()), "doc_ids": pa.array([batch.column(0)[a:b].to_pylist()], pa.list_(batch.column(0).type)),
                        "lengths": pa.array([lengths[a:b]], pa.list_(pa.int32())), "offsets": pa.array([here - here[0]], pa.list_(pa.int64())),
                        "packed": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    }
                )
                block, before = block + 1, before + own

    order = F.xxhash64(text_col)  # parts a hot id
    ordered = df.select(id_col, text_col).repartitionByRange(shards, id_col, order).sortWithinPartitions(id_col, order, text_col)
    ordered.mapInArrow(run, _block_schema(df.schema[id_col].dataType)).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files of write_ids."""
    blocks = spark.read.parquet(path)
    id_type = blocks.schema["doc_ids"].dataType.elementType
    # One row a shard: each shard's first id among all.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    first = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    starts = kept(shards.select("shard", first.alias("first")))
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_SHARDS else starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["packed"], "<u8")).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(row["first"] + row["shard_start"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    out = T.StructType([T.StructField("doc_id", id_type), *(T.StructField(k, T.LongType()) for k in ("start", "n_tokens", "ids_crc32"))])
    rows = blocks.join(starts, "shard").select("doc_ids", "lengths", "packed", "shard_start", "first")
    return rows.mapInArrow(run, out)


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(start, ids): the ids at the places start to stop of the whole stream, in pieces of one block each, decoded from the nearest offsets on."""
    blocks = spark.read.parquet(path)
    first = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.expr("sum(n) OVER (ORDER BY shard) - n").alias("first"))  # one row a shard
    own = blocks.join(first, "shard").select((F.col("first") + F.col("shard_start")).alias("at"), "n_ids", "offsets", "packed").where((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            for row in batch.to_pylist():
                a, b = max(start - row["at"], 0), min(stop - row["at"], row["n_ids"])
                ids = unpack_part(np.frombuffer(row["packed"], "<u8"), row["offsets"], a, b)
                yield pa.RecordBatch.from_arrays([pa.array([row["at"] + a]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], ["start", "ids"])

    return own.mapInArrow(run, "start long, ids array<long>")


def token_files(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files into the shared folder and returns what reading them back gives."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(df, path, tokenizer, id_col, text_col)
    return read_ids(spark, path)


def op10_token_ids(spark, sf_dir):
    import public_tokenizers

    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
