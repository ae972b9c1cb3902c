"""Benchmark decontamination: documents that hold a passage of a benchmark item.

A word is a run of anything but ASCII white space, lower-cased and without marks, in items and documents alike. Windows
as long as an item slide over each document; a document of fewer words than the item is one window as a whole. Every
window has a SimHash of LANES * 64 bits over its shingles of five words. A multi-index over the items' fingerprints, of
one block for each lane, finds the items within RADIUS bits: of so many differing bits some block has at most
RADIUS // LANES, which one unrelated pair in some thousands has. Candidates are verified by exact
weighted-shingle similarity, the sum of the lesser counts of each shingle over the sum of the greater ones.

Windows are only taken where they can matter. A window at the similarity lacks less than a fifth of an item's
shingles, so of any fifth of them, and one more, it holds one; the rarest in the benchmark are the item's anchors. Each anchor found in
a document opens the windows around it for its own items only, so that a passage that many items share opens none.

Benchmarks of any size are worked off in parts of at most ITEMS_AT_ONCE items and BYTES_AT_ONCE bytes (or one item) against all documents;
one part's index is what a task holds in memory, with the words of SLICE_BYTES of text. Windows are worked off by WINDOWS_AT_ONCE.

Rows: null or empty texts hold nothing, and items without words are in no document; items of fewer than
five words match as a whole; null ids keep their rows; repeated rows give repeated results; of windows of equal similarity
the one of fewer differing bits, then the first is given; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import WORD, coded_words, slices, table

SHINGLE = 5
SIMILARITY = 0.8
#: 64-bit words of a fingerprint, each one block of the multi-index.
LANES = 4
#: At similarity 0.8 a bit differs with probability 0.15: 39 of 256 are expected, and 67 are five deviations more.
RADIUS = 67
ITEMS_AT_ONCE, BYTES_AT_ONCE = 20_000, 16 << 20
WINDOWS_AT_ONCE = 8192
#: Bytes of text whose words are held at once, for which a worker needs some twenty times as much.
SLICE_BYTES = 1 << 20

_MARKS = re.compile(r"[\W_]+")
_LINE_MARKS = re.compile(r"(?:[^\w\n]|_)+")
_WORDS = re.compile(WORD)


def plain(word: str) -> str:
    return _MARKS.sub("", word.lower())


def all_plain(words: list[str]) -> list[str]:
    """`plain` of each of these words, none of which holds a line feed, in one go."""
    return _LINE_MARKS.sub("", "\n".join(words).lower()).split("\n") if words else []


def shingles(words: list[str], size: int = SHINGLE) -> list[str]:
    """Runs of `size` words; of all words if there are fewer; none of no words."""
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def similarity(a: Counter, b: Counter) -> float:
    common = (a & b).total()
    return common / max(1, a.total() + b.total() - common)


def hashed(shingle_list: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s) for s in shingle_list), np.uint64, len(shingle_list))


def prints(hashes: np.ndarray, span: int) -> np.ndarray:
    """[window, lane]: the fingerprints of all runs of `span` of `hashes`; each lane mixes the hashes in its own way."""
    out = np.empty((len(hashes) - span + 1, LANES), np.uint64)
    for lane in range(LANES):
        mixed = hashes * np.uint64(2 * _MIX[lane] + 1)
        mixed ^= mixed >> np.uint64(32)
        bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
        out[:, lane] = np.packbits(2 * (sums[span:] - sums[:-span]) > span, axis=1, bitorder="little").view("<u8").ravel()
    return out


_MIX = np.random.default_rng(SHINGLE).integers(0, 2**62, LANES).tolist()


def within(windows: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that the multi-index gives for an item, and their differing bits: some block within RADIUS // LANES, all within RADIUS."""
    apart = np.bitwise_count(windows ^ item)
    at = np.nonzero((apart <= RADIUS // LANES).any(axis=1))[0]
    bits = apart[at].sum(axis=1, dtype=np.int64)
    return at[bits <= RADIUS], bits[bits <= RADIUS]


def item_words(text: str | None) -> list[str]:
    return [p for p in map(plain, _WORDS.findall(text or "")) if p]


class Index:
    """Items with their bags of shingles and fingerprints, and their anchors by shingle size and key."""

    def __init__(self, items: list[tuple[object, str | None]]) -> None:
        self.items = [(i, w) for i, t in items if (w := item_words(t))]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(x for _, words in self.items for x in words))}
        self.bags = [Counter(shingles(w)) for _, w in self.items]
        spans = [shingles(w) for _, w in self.items]
        self.prints = np.array([prints(hashed(s), len(s))[0] for s in spans], np.uint64).reshape(-1, LANES)
        every = [self.keys(np.array([self.vocabulary[w] for w in words]), min(SHINGLE, len(words))) for _, words in self.items]
        holders = Counter(key for keys in every for key in np.unique(keys).tolist())
        owners: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, keys in enumerate(every):
            # The least that a window shares with the item; what is left out of the anchors is too little for it.
            need, left = math.ceil(SIMILARITY * len(keys) - 1e-9), len(keys)
            for key, n in sorted(Counter(keys.tolist()).items(), key=lambda x: (holders[x[0]], x)):
                if left < need:
                    break
                owners[min(SHINGLE, len(self.items[k][1]))][key].append(k)
                left -= n
        self.anchors = {size: (np.array(sorted(found), np.uint64), dict(found)) for size, found in owners.items()}

    def keys(self, ids: np.ndarray, size: int) -> np.ndarray:
        """A number for each run of `size` words; runs with a word of no item have key 0."""
        if len(ids) < size:
            return np.zeros(0, np.uint64)
        base, key, known = np.uint64(len(self.vocabulary) + 1), np.zeros(len(ids) - size + 1, np.uint64), np.ones(len(ids) - size + 1, bool)
        for j in range(size):
            part = ids[j : len(ids) - size + 1 + j]
            known &= part >= 0
            key = key * base + (part + 1).astype(np.uint64)
        return np.where(known, key, np.uint64(0))

    def hits(self, ids: np.ndarray) -> dict[int, list[int]]:
        """The places in the words `ids` where each item has an anchor."""
        found: dict[int, list[int]] = defaultdict(list)
        for size, (keys, owners) in self.anchors.items():
            own = self.keys(ids, size)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            for p in np.nonzero((keys[at] == own) & (own > 0))[0].tolist():
                for k in owners[int(own[p])]:
                    found[k].append(p)
        return found

    def matches(self, words: list[str], hits: dict[int, list[int]]) -> Iterator[tuple[object, float, int, int]]:
        """(item, similarity, differing bits, first word) of the best window for each item that the words hold."""
        by_length: dict[int, list[int]] = defaultdict(list)
        for k in sorted(hits):
            by_length[len(self.items[k][1])].append(k)
        best: dict[int, tuple[float, int, int]] = {}
        for n, own in by_length.items():
            size, length = min(SHINGLE, n), min(n, len(words))
            span = length - size + 1  # shingles of a window
            if span < SIMILARITY * (n - size + 1):
                continue
            windows = {}
            for k in own:
                starts = np.unique(np.array(hits[k])[:, None] - np.arange(span))
                windows[k] = starts[(starts >= 0) & (starts + length <= len(words))]
            starts = np.unique(np.concatenate(list(windows.values())))
            # Windows are worked off by stretches, so that far-apart anchors cost nothing between them.
            for stretch in np.split(starts, np.nonzero(np.diff(starts) > 1)[0] + 1):
                for c in range(0, len(stretch), WINDOWS_AT_ONCE):
                    first, last = int(stretch[c]), int(stretch[min(c + WINDOWS_AT_ONCE, len(stretch)) - 1])
                    local = shingles(words[first : last + length], size)
                    marks = prints(hashed(local), span)
                    for k in own:
                        a, b = np.searchsorted(windows[k], (first, last + 1))
                        at = windows[k][a:b] - first
                        near, bits = within(marks[at], self.prints[k])
                        for w, d in zip(at[near].tolist(), bits.tolist(), strict=True):
                            s = similarity(Counter(local[w : w + span]), self.bags[k])
                            if s >= SIMILARITY and (s, -d, -(first + w)) > best.get(k, (0.0, 0, 0)):
                                best[k] = (s, -d, -(first + w))
        for k, (s, d, w) in sorted(best.items()):
            yield self.items[k][0], s, -d, -w


def passages(batches: Iterator[pa.RecordBatch], index: Index, out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What the texts of the batches (id, text) hold of the items, as `out`: a row for every text and item."""
    for batch in slices(batches, most=SLICE_BYTES):
        distinct, codes, counts = coded_words(batch.column(1))
        bare = all_plain(distinct)
        ids = np.fromiter((index.vocabulary.get(w, -1) if w else -2 for w in bare), np.int64, len(bare))[codes]
        rows, stops = [], np.cumsum(counts)
        for k, (stop, n) in enumerate(zip(stops.tolist(), counts.tolist(), strict=True)):
            own = ids[stop - n : stop]
            full = own > -2
            hits = index.hits(own[full]) if n else {}
            if hits:
                words = [bare[c] for c in codes[stop - n : stop][full]]
                rows += [(batch.column(0)[k].as_py(), *m) for m in index.matches(words, hits)]
        columns = zip(*rows, strict=True) if rows else [[] for _ in out]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], out.names)


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, similarity, differing_bits, first_word): a row for every document and item that it holds."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    many = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-many[0] // ITEMS_AT_ONCE), -(-many[1] // BYTES_AT_ONCE))
    id_type, item_type = df.schema[id_col].dataType, benchmark.schema[item_col].dataType
    out = T.StructType(
        [T.StructField(id_col, id_type), T.StructField(item_col, item_type), T.StructField("similarity", T.DoubleType())]
        + [T.StructField("differing_bits", T.IntegerType()), T.StructField("first_word", T.LongType())]
    )
    found = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        index = df.sparkSession.sparkContext.broadcast(Index(sorted(((r["item"], r["text"]) for r in rows), key=repr)))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds = (batch.column(0).type, _arrow(item_type), pa.float64(), pa.int32(), pa.int64())
                yield from passages(iter([batch]), index.value, pa.schema(zip(out.names, kinds, strict=True)))

        found.append(df.select(id_col, text_col).mapInArrow(run, out))
    return reduce(DataFrame.union, found) if found else df.sparkSession.createDataFrame([], out)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op9_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
