"""A vocabulary over all texts, kept in prefix ranges: no task and no driver holds it whole.

`written` turns texts into slices of some megabytes: the places of their words among the slice's own sorted terms, and one request
for every prefix range that has any of them, with counts. `answered` unites the requests of each range, sums their counts, keeps the terms with
enough, and builds the range's minimal acyclic transducer from them, in sorted order; every request's terms pass through it
and are answered by their ordinals. With the terms kept in the ranges before (`bases`), ordinals count all kept terms in the order of their bytes.
A term is its language's bytes, a line feed and the word; words hold no line feed.

Ranges come from a sample of texts; that decides only how even they are. A frequent term is one entry of each slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import shared_dir, slices

#: Bytes of text in a slice, and for each range; ranges are at most MOST_RANGES.
SLICE_BYTES, RANGE_BYTES, MOST_RANGES = 4 << 20, 16 << 20, 1 << 16


class Transducer:
    """A minimal acyclic transducer from each of some sorted terms to its place among them.

    Arcs are sorted by state and byte; an arc's output is the number of terms that are passed by taking it.
    """

    def __init__(self, keys: np.ndarray, target: np.ndarray, output: np.ndarray, final: np.ndarray) -> None:
        self.keys, self.target, self.output, self.final = keys, target, output, final

    @classmethod
    def of(cls, terms: list[bytes]) -> Transducer:
        """Built one term after the other: what is below the part shared with the next term can't change any more and is looked up among the states."""
        states: dict[tuple, int] = {}
        path: list[list] = [[False, []]]
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], states.setdefault((final, tuple(arcs)), len(states))))

        for term in terms:
            shared, most = 0, min(len(last), len(term))
            while shared < most and last[shared] == term[shared]:
                shared += 1
            close(shared)
            path.extend([False, []] for _ in range(len(term) - shared))
            path[-1][0] = True
            last = term
        close(0)
        states.setdefault((path[0][0], tuple(path[0][1]), "root"), len(states))
        size, keys, target, output = [], [], [], []
        for k, state in enumerate(states):
            passed = int(state[0])
            for label, to in state[1]:
                keys.append(k << 8 | label)
                target.append(to)
                output.append(passed)
                passed += size[to]
            size.append(passed)
        return cls(np.array(keys, np.int64), np.array(target, np.int32), np.array(output, np.int32), np.array([s[0] for s in states], bool))

    def ordinals(self, terms: pa.Array) -> np.ndarray:
        """The place of each term, -1 for others; all terms go a byte further in each step."""
        terms = terms.cast(pa.large_binary())
        at = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
        data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
        begin, size = at[:-1], np.diff(at)
        out, state, going, j = np.zeros(len(terms), np.int64), np.full(len(terms), len(self.final) - 1, np.int64), np.arange(len(terms)), 0
        while True:
            going = going[size[going] > j]
            if not len(going):
                break
            key = state[going] << 8 | data[begin[going] + j]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key if len(self.keys) else np.zeros(len(going), bool)
            out[going[~there]] = -1
            going, arc = going[there], arc[there]
            out[going] += self.output[arc]
            state[going] = self.target[arc]
            j += 1
        return np.where((out >= 0) & self.final[state], out, -1)

    def term(self, ordinal: int) -> bytes:
        """The term at a place."""
        state, found = len(self.final) - 1, bytearray()
        while not (self.final[state] and ordinal == 0):
            a, b = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            arc = a + int(np.searchsorted(self.output[a:b], ordinal, side="right")) - 1
            found.append(int(self.keys[arc]) & 255)
            ordinal, state = ordinal - int(self.output[arc]), int(self.target[arc])
        return bytes(found)

    def terms(self) -> Iterator[bytes]:
        """All terms, in order."""
        starts = np.searchsorted(self.keys, np.arange(len(self.final) + 1) << 8).tolist()
        labels, target, final = (self.keys & 255).tolist(), self.target.tolist(), self.final.tolist()
        open_ = [(len(final) - 1, b"")]
        while open_:
            state, so_far = open_.pop()
            if final[state]:
                yield so_far
            open_.extend((target[k], so_far + bytes((labels[k],))) for k in range(starts[state + 1] - 1, starts[state] - 1, -1))

    def packed(self) -> bytes:
        return b"".join([np.array([len(self.keys), len(self.final)], np.int64).tobytes(), self.keys.tobytes(), self.target.tobytes(), self.output.tobytes(), self.final.tobytes()])

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        arcs, states = np.frombuffer(data, np.int64, 2)
        at = 16 + 8 * int(arcs)
        return cls(np.frombuffer(data, np.int64, arcs, 16), np.frombuffer(data, np.int32, arcs, at), np.frombuffer(data, np.int32, arcs, at + 4 * int(arcs)), np.frombuffer(data, bool, states, at + 8 * int(arcs)))


def translated(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """The texts with every byte replaced from a table of 256; null texts are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(table[data]))


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs between ASCII white space in one flat array, and the text that each comes from."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    rows = np.repeat(np.arange(len(lists), dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return flat.filter(full), rows[full.to_numpy(zero_copy_only=False)]


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches, one at a time."""
    for batch in batches:
        for k in range(len(batch)):
            yield batch.slice(k, 1).to_pylist()[0]


def terms_of(words: pa.Array, langs: list[str], lang: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The sorted distinct terms of words whose languages are `lang` (places in `langs`), and each word's place among them."""
    coded = words.dictionary_encode()
    many = max(1, len(coded.dictionary))
    both, place = np.unique(lang.astype(np.int64) * many + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    names = pa.array([x.encode() + b"\n" for x in langs], pa.large_binary()).take(pa.array(both // many))
    terms = pc.binary_join_element_wise(names, coded.dictionary.cast(pa.large_binary()).take(pa.array(both % many)), pa.scalar(b"", pa.large_binary()))
    order = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    return terms.take(pa.array(order)), rank[place]


def sizes_of(terms: pa.Array) -> np.ndarray:
    return pc.binary_length(terms).to_numpy(zero_copy_only=False).astype(np.int32)


def blob_of(terms: pa.Array) -> bytes:
    return pc.binary_join(pa.array([terms], pa.large_list(pa.large_binary())), pa.scalar(b"", pa.large_binary()))[0].as_py() if len(terms) else b""


def terms_from(blobs: list[bytes], sizes: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The terms of several requests one after the other, and how many each has."""
    each = [np.frombuffer(s, np.int32) for s in sizes]
    ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *each]).astype(np.int64))])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(blobs))]), np.array([len(x) for x in each], np.int64)


@dataclass
class Sliced:
    """What a tokeniser makes of a batch: words, each word's document, which words count towards its term, and marks of each word for later."""

    words: pa.Array
    doc: np.ndarray
    #: Counts of each word towards its term; None: one for each document that has it.
    once: bool
    marks: np.ndarray


SLICES = "slice long, range int, codes binary, marks binary, names array<string>, docs binary, terms binary, sizes binary, counts binary, n long"


def boundaries(df: DataFrame, tokenise: Callable[[pa.Array], Sliced]) -> list[bytes]:
    """Where ranges begin, from stretches of a bounded sample of texts. `df` has lang and text."""
    held, rows = df.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("text")).first()
    many = int(min(max(-(-held // RANGE_BYTES), df.sparkSession.sparkContext.defaultParallelism), MOST_RANGES))
    place = F.pmod(F.xxhash64("text"), F.greatest(F.char_length("text") - 400, F.lit(1))).cast("int") + 1
    stretches = df.where("text IS NOT NULL").select("lang", F.substring("text", place, F.lit(400)).alias("text"), F.xxhash64("text").alias("at"))
    # About four times as many by their hashes, of which the first are taken.
    share = int(min(1, 4 * max(1000, many) / max(1, rows)) * (1 << 20))
    rows = stretches.where(F.pmod("at", F.lit(1 << 20)) < share).orderBy("at").limit(max(1000, many)).collect()
    if not rows:
        return []
    langs = sorted({r["lang"] for r in rows})
    made = tokenise(pa.array([r["text"] for r in rows], pa.string()))
    terms, _ = terms_of(made.words, langs, np.array([langs.index(r["lang"]) for r in rows])[made.doc])
    at = np.unique(np.linspace(0, len(terms), many, endpoint=False).astype(int)[1:])
    return terms.take(pa.array(at)).to_pylist()


def written(df: DataFrame, tokenise: Callable[[pa.Array], Sliced], names: list[str]) -> str:
    """Writes the slices and requests of a table with lang, text and `names`, of which lang is one; returns the folder."""
    bounds = boundaries(df, tokenise)
    path = f"{shared_dir(df.sparkSession)}/vocabulary-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId() << 32
        for batch in slices(batches, 0, SLICE_BYTES):
            made = tokenise(batch.column(0))
            own = list(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True))
            kinds = {kind: k for k, kind in enumerate(sorted(set(own)))}
            code, langs = np.array([kinds[x] for x in own], np.int32), sorted({kind[0] for kind in kinds})
            of_kind = np.array([langs.index(kind[0]) for kind in kinds], np.int32)
            terms, place = terms_of(made.words, langs, of_kind[code[made.doc]])
            told = np.unique(made.doc.astype(np.int64) * max(1, len(terms)) + place) % max(1, len(terms)) if made.once else place
            counts = np.bincount(told, minlength=len(terms)).astype(np.int64)
            cuts = [0, *(_first_at(terms, b) for b in bounds), len(terms)]
            sizes, rows = sizes_of(terms), [(nth, -1, place.tobytes(), made.marks.tobytes(), [x for kind in kinds for x in kind], code.tobytes() + np.bincount(made.doc, minlength=len(code)).astype(np.int32).tobytes(), None, None, None, len(code))]
            for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b > a:
                    rows.append((nth, r, None, None, None, None, blob_of(terms[a:b]), sizes[a:b].tobytes(), counts[a:b].tobytes(), b - a))
            yield _batch(rows, SLICES)
            nth += 1
            pa.default_memory_pool().release_unused()

    df.select("text", *names).mapInArrow(run, SLICES).write.parquet(path)
    return path


def _first_at(terms: pa.Array, bound: bytes) -> int:
    """How many sorted terms come before a bound."""
    a, b = 0, len(terms)
    while a < b:
        mid = (a + b) // 2
        a, b = (mid + 1, b) if terms[mid].as_py() < bound else (a, mid)
    return a


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split(" ", 1) for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _KINDS[kind]) for k, (_, kind) in enumerate(fields)], [n for n, _ in fields])


ANSWERS = "slice long, range int, ordinals binary, befores binary, weights binary, transducer binary, langs array<string>, many array<long>, n long, weight long"


def answered(sliced: DataFrame, least: int) -> str:
    """Writes the answers to every request, and a row of each range with its transducer, its terms' weights and languages (slice -1); returns the folder.

    Terms with at least `least` counts are kept. An answer has each term's ordinal within the range, and of the kept ones where
    it lies among the range's counts and its own count.
    """

    def run(group: pa.Table) -> pa.Table:
        terms, many = terms_from(group["terms"].to_pylist(), group["sizes"].to_pylist())
        coded = terms.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in group["counts"].to_pylist()])
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, code, counts)
        kept = coded.dictionary.filter(pa.array(total >= least))
        kept = kept.take(pc.sort_indices(kept))
        machine = Transducer.of(kept.to_pylist())
        ordinal = machine.ordinals(coded.dictionary)
        weight = np.zeros(len(kept), np.int64)
        weight[ordinal[ordinal >= 0]] = total[ordinal >= 0]
        before, all_, out, ends = np.cumsum(weight) - weight, int(weight.sum()), [], np.cumsum(many)
        names = [t.rpartition(b"\n")[0] for t in kept.to_pylist()]
        langs = sorted(set(names))
        of_lang = np.array([langs.index(x) for x in names], np.int32) if len(langs) < 20 else np.searchsorted(np.array(langs, object), np.array(names, object)).astype(np.int32)
        r = group["range"][0].as_py()
        for slice_, a, b in zip(group["slice"].to_pylist(), ends - many, ends, strict=True):
            own = ordinal[code[a:b]]
            here = own[own >= 0]
            out.append((slice_, r, own.astype(np.int32).tobytes(), *placed(before[here], weight[here], all_), None, None, None, b - a, None))
        out.append((-1, r, None, of_lang.tobytes(), weight.tobytes(), machine.packed(), [x.decode() for x in langs], np.bincount(of_lang, minlength=len(langs)).tolist(), len(kept), all_))
        return pa.Table.from_batches([_batch(out, ANSWERS)])

    path = f"{shared_dir(sliced.sparkSession)}/vocabulary-{uuid.uuid4().hex}"
    requests = sliced.where("range >= 0").select("slice", "range", "terms", "sizes", "counts")
    requests.groupBy("range").applyInArrow(run, ANSWERS).write.parquet(path)
    return path


def placed(before: np.ndarray, weight: np.ndarray, all_: int) -> tuple[bytes, bytes]:
    """Counts before and own counts, in short: a share of all in 32 bits, and counts up to 2^31."""
    return (before / max(1, all_)).astype(np.float32).tobytes(), np.minimum(weight, (1 << 31) - 1).astype(np.int32).tobytes()


def unplaced(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Where the kept items of some answers lie among all counts, and their counts."""
    at = [np.frombuffer(p["befores"], np.float32).astype(np.float64) * p["range_weight"] + p["before"] for p in parts]
    return np.concatenate([np.zeros(0), *at]), np.concatenate([np.zeros(0), *(np.frombuffer(p["weights"], np.int32) for p in parts)])


def bases(answers: DataFrame) -> DataFrame:
    """(range, base, before, range_weight, weight_all): kept terms and their counts in the ranges before, the range's counts, those of all. One row a range, MOST_RANGES at most."""
    return answers.where("slice < 0").selectExpr("range", "sum(n) OVER (ORDER BY range) - n AS base", "sum(weight) OVER (ORDER BY range) - weight AS before", "weight AS range_weight", "sum(weight) OVER () AS weight_all")


def encoded(sliced: DataFrame, answers: DataFrame, *more: str) -> DataFrame:
    """Slices with their answers: parts, an array of (range, base, ordinals) and, where `more` names them, (before, range_weight, befores, weights); and weight_all."""
    own = answers.where("slice >= 0").drop("weight").join(F.broadcast(bases(answers)), "range")
    parts = own.groupBy("slice").agg(F.collect_list(F.struct("range", "base", "ordinals", *more)).alias("parts"), F.max("weight_all").alias("weight_all"))
    return sliced.where("range < 0").select("slice", "codes", "marks", "names", "docs", "n").join(parts, "slice")


def read_parts(parts: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every term of a slice, in order: its ordinal among all or -1, the counts of kept terms before it, and its own; without counts zeros."""
    parts = sorted(parts, key=lambda p: p["range"])
    none = np.zeros(0, np.int64)
    local = [np.frombuffer(p["ordinals"], np.int32).astype(np.int64) for p in parts]
    ordinal = np.concatenate([none, *(np.where(x >= 0, x + p["base"], -1) for x, p in zip(local, parts, strict=True))])
    before, weight = np.zeros(len(ordinal)), np.zeros(len(ordinal))
    if parts and "weights" in parts[0]:
        before[ordinal >= 0], weight[ordinal >= 0] = unplaced(parts)
    return ordinal, before, weight


def read_docs(docs: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each document of a slice, and how many words it has."""
    both = np.frombuffer(docs, np.int32)
    return both[:n], both[n:]
