"""Phrases whose words come together more often than apart, from weighted acyclic automata of n-grams.

An automaton of n-grams has a state for each kept phrase, an arc from it by a word to the phrase one longer, and on each arc its count.
Each slice of texts builds the arcs of its own n-grams, sorted; the arcs of all slices are united by prefix range, where
equal arcs' weights add up, and arcs below LEAST go. Words come first (vocabulary.py), then phrases of two and three words:
an n-gram is only counted where both its parts were kept, as neither can be rarer than the whole. The answer to a slice names the states
that its arcs lead to, so the next level goes on from there. Ranges hold equal weights of prefixes; within them a frequent prefix is
spread by its next word. Part counts come from composing: an arc of three words knows its state, and the state of its last two.

Rows: null texts are empty, null languages `und`. Rows that repeat count again. Texts are taken whole. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import vocabulary as V
from ledgerline.llm.common import shared_dir, table
from ledgerline.llm.passages import mixed

#: Occurrences that a phrase needs; percent of them in a longer phrase that drop it; phrases reported of a language; arcs of a range.
LEAST, COVERED, MOST, RANGE_ARCS = 10, 50, 2000, 1_500_000

_PIECES = np.arange(256, dtype=np.uint8)
_PIECES[65:91] += 32
_PIECES[list(b".,;:!?\n\x0b\x0c\r")] = 10
_PIECES[9] = 32


def pieces(texts: pa.Array) -> V.Sliced:
    """Words in lower case; marks: whether a word goes on from the one before in the same piece, in bits."""
    lists = pc.split_pattern(V.translated(texts, _PIECES), "\n")
    flat = lists.flatten()
    words, piece = V.split(flat)
    doc = np.repeat(np.arange(len(lists), dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[piece]
    return V.Sliced(words, doc, False, np.packbits(np.diff(piece, prepend=-1) == 0))


ARCS = "slice long, range int, states binary, runs binary, labels binary, suffixes binary, counts binary"


def _arcs(slice_: int, state: np.ndarray, label: np.ndarray, suffix: np.ndarray | None, count: np.ndarray, before: np.ndarray, weight: np.ndarray, all_: int, ranges: int) -> list[tuple]:
    """A slice's arcs, given by ascending state, in a row for each range; `before` and `weight` are the states'. Without suffixes the label is the suffix."""
    spread = mixed(label.astype(np.uint64)).astype(np.float64) / 2.0**64
    at = np.minimum((before + weight * spread) * (ranges / max(1, all_)), ranges - 1).astype(np.int64)
    order = np.argsort(at.astype(np.uint16) if ranges <= 1 << 16 else at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(ranges + 1)) if ranges < len(at) else np.concatenate([[0], np.nonzero(np.diff(at[order]))[0] + 1, [len(at)]])
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            own = order[a:b]
            states, runs = np.unique(state[own], return_counts=True)
            rows.append((slice_, int(at[own[0]]), states.tobytes(), runs.astype(np.int32).tobytes(), label[own].astype(np.int32).tobytes(), None if suffix is None else suffix[own].tobytes(), count[own].astype(np.int32).tobytes()))
    return rows


def _words(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A slice's words as places among its terms, and as ordinals; and where a kept word has another after it in its piece."""
    ordinal, _, _ = V.read_parts(row["parts"])
    place = np.frombuffer(row["codes"], np.int32)
    words, on = ordinal[place], np.unpackbits(np.frombuffer(row["marks"], np.uint8))[: len(place)].astype(bool)
    return place, words, np.nonzero(on[1:] & (words[1:] >= 0) & (words[:-1] >= 0))[0]


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words slices have of each language."""
    for row in V.each(batches):
        of_doc, many = V.read_docs(row["docs"], row["n"])
        totals = np.zeros(len(row["names"]), np.int64)
        np.add.at(totals, of_doc, many)
        yield pa.RecordBatch.from_arrays([pa.array(row["names"], pa.string()), pa.array(totals)], ["lang", "n"])


def _pairs(ranges: int):
    """Slices with answered words as arcs of two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in V.each(batches):
            ordinal, before, weight = V.read_parts(row["parts"])
            place, _, there = _words(row)
            many = max(1, len(ordinal))
            key, count = np.unique(place[there].astype(np.int64) * many + place[there + 1], return_counts=True)
            a, b = key // many, key % many
            yield V._batch(_arcs(row["slice"], ordinal[a], ordinal[b], None, count, before[a], weight[a], row["weight_all"], ranges), ARCS)

    return run


STATES = "slice long, range int, states binary, labels binary, suffixes binary, ordinals binary, befores binary, weights binary, n long, weight long"


def _united(group: pa.Table, answer: bool) -> pa.Table:
    """The arcs of one range, united: all kept ones (slice -1), and, for a next level, what each slice needs to know of its kept arcs."""
    read = lambda name, kind: [np.frombuffer(x, kind) for x in group[name].to_pylist()]
    states = [np.repeat(s, n) for s, n in zip(read("states", np.int64), read("runs", np.int32), strict=True)]
    labels, counts = read("labels", np.int32), read("counts", np.int32)
    suffixes = labels if group["suffixes"].null_count else read("suffixes", np.int64)
    ends = np.cumsum([len(x) for x in states])
    state, label, suffix = np.concatenate(states), np.concatenate(labels), np.concatenate(suffixes).astype(np.int64)
    order = np.lexsort((label, state))
    opens = np.concatenate([[True], (np.diff(state[order]) != 0) | (np.diff(label[order]) != 0)])
    arc = np.empty(len(order), np.int64)
    arc[order] = np.cumsum(opens) - 1
    weight = np.zeros(int(opens.sum()), np.int64)
    np.add.at(weight, arc, np.concatenate(counts))
    keep, first = weight >= LEAST, order[opens]
    ordinal = np.where(keep, np.cumsum(keep) - 1, -1)
    before, all_ = np.cumsum(np.where(keep, weight, 0)) - weight, int(weight[keep].sum())
    r, rows = group["range"][0].as_py(), []
    for slice_, a, b in zip(group["slice"].to_pylist(), ends - [len(x) for x in states], ends, strict=True):
        here = np.nonzero(keep[arc[a:b]])[0]
        if len(here) and answer:
            own = arc[a:b][here]
            told = (state[a:b][here].astype(np.int32).tobytes(), label[a:b][here].tobytes(), None, ordinal[own].astype(np.int32).tobytes(), *V.placed(before[own], weight[own], all_))
            rows.append((slice_, r, *told, len(here), None))
    own = first[keep]
    rows.append((-1, r, state[own].tobytes(), label[own].tobytes(), suffix[own].tobytes(), None, None, weight[keep].tobytes(), int(keep.sum()), all_))
    return pa.Table.from_batches([V._batch(rows, STATES)])


def _longer(ranges: int):
    """Slices with their kept states as arcs that are a word longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in V.each(batches):
            _, words, there = _words(row)
            of = lambda name: np.concatenate([np.frombuffer(p[name], np.int32) for p in row["arcs"]]).astype(np.int64)  # noqa: B023, E731
            arcs = of("states") << 32 | of("labels")
            ordinal = np.concatenate([np.frombuffer(p["ordinals"], np.int32).astype(np.int64) + p["base"] for p in row["arcs"]])
            # States stand by their ordinals, which is not the order of their words: a range's labels and runs have to go by the same.
            order = np.argsort(ordinal)
            arcs, ordinal, (before, weight) = arcs[order], ordinal[order], (x[order] for x in V.unplaced(row["arcs"]))
            by = np.argsort(arcs)
            key = words[there] << 32 | words[there + 1]
            at = by[np.minimum(np.searchsorted(arcs, key, sorter=by), len(arcs) - 1)]
            state = np.full(len(words), -1)
            hit = arcs[at] == key
            state[there[hit]] = at[hit]
            go = np.nonzero((state[:-1] >= 0) & (state[1:] >= 0))[0]
            key, count = np.unique(state[go] * len(arcs) + state[go + 1], return_counts=True)
            a, b = key // len(arcs), key % len(arcs)
            yield V._batch(_arcs(row["slice"], ordinal[a], arcs[b] & 0xFFFFFFFF, ordinal[b], count, before[a], weight[a], row["arcs_weight"], ranges), ARCS)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept states, one row each."""
    for p in V.each(batches):
        state, label, suffix, weight = (np.frombuffer(p[k], t) for k, t in (("states", np.int64), ("labels", np.int32), ("suffixes", np.int64), ("weights", np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(p["base"] + np.arange(len(state))), pa.array(state), pa.array(label.astype(np.int64)), pa.array(suffix), pa.array(weight)], ["ordinal", "state", "label", "suffix", "a"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept words, one row each."""
    for p in V.each(batches):
        terms = [t.rpartition(b"\n") for t in V.Transducer.unpacked(p["transducer"]).terms()]
        columns = [pa.array(p["base"] + np.arange(len(terms))), pa.array([t[0].decode() for t in terms], pa.string()), pa.array([t[2].decode() for t in terms], pa.string()), pa.array(np.frombuffer(p["weights"], np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["ordinal", "lang", "word", "f"])


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two and three words by how much their parts need each other."""
    spark = df.sparkSession
    docs = df.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))

    def held(rows: DataFrame) -> DataFrame:
        path = f"{shared_dir(spark)}/collocations-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return spark.read.parquet(path)

    def ranges(weight: int | None) -> int:
        return int(min(max(-(-(weight or 0) // RANGE_ARCS), spark.sparkContext.defaultParallelism), V.MOST_RANGES))

    sliced = spark.read.parquet(V.written(docs, pieces, ["lang"]))
    answers = spark.read.parquet(V.answered(sliced, LEAST))
    all_ = V.bases(answers).agg(F.max("weight_all")).first()[0]
    arcs = ["range", "slice", "states", "runs", "labels", "suffixes", "counts"]
    two = V.encoded(sliced, answers, "before", "range_weight", "befores", "weights").select("slice", "codes", "marks", "parts", "weight_all").mapInArrow(_pairs(ranges(all_)), ARCS)
    kept2 = held(two.select(*arcs).groupBy("range").applyInArrow(lambda group: _united(group, True), STATES))
    own = kept2.where("slice >= 0").drop("weight").join(F.broadcast(V.bases(kept2)), "range")
    known = own.groupBy("slice").agg(F.collect_list(F.struct("base", "before", "range_weight", "states", "labels", "ordinals", "befores", "weights")).alias("arcs"), F.max("weight_all").alias("arcs_weight"))
    three = V.encoded(sliced, answers).select("slice", "codes", "marks", "parts").join(known, "slice").mapInArrow(_longer(ranges(V.bases(kept2).agg(F.max("weight_all")).first()[0])), ARCS)
    kept3 = held(three.select(*arcs).groupBy("range").applyInArrow(lambda group: _united(group, False), STATES))

    def listed(kept: DataFrame) -> DataFrame:
        rows = kept.where("slice < 0").join(F.broadcast(V.bases(kept).select("range", "base")), "range").select("base", "states", "labels", "suffixes", "weights")
        return rows.mapInArrow(_listed, "ordinal long, state long, label long, suffix long, a long")

    machines = answers.where("slice < 0").join(F.broadcast(V.bases(answers).select("range", "base")), "range").select("base", "transducer", "weights")
    words = held(machines.mapInArrow(_named, "ordinal long, lang string, word string, f long"))
    pairs, triples = held(listed(kept2)), listed(kept3)
    word = lambda k, x=words: x.select(F.col("ordinal").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"))
    first = words.select(F.col("ordinal").alias("w1"), "lang", F.col("word").alias("word1"), F.col("f").alias("f1"))
    score = lambda l, r: F.expr(f"CAST(1000000 * CAST(a AS DECIMAL(14,0)) * CAST(a AS DECIMAL(14,0)) AS DECIMAL(38,0)) div (CAST({l} AS DECIMAL(14,0)) * CAST({r} AS DECIMAL(14,0)))")

    over = triples.select(F.col("state").alias("ordinal"), "a").union(triples.select("suffix", "a")).groupBy("ordinal").agg(F.max("a").alias("longer"))
    two = pairs.join(over, "ordinal", "left").where(f"longer IS NULL OR 100 * longer < {COVERED} * a")
    two = two.select(F.col("state").alias("w1"), F.col("label").alias("w2"), "a").join(first, "w1").join(word(2), "w2")
    two = two.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("f1", "f2").alias("score"))
    head, tail = pairs.select(F.col("ordinal").alias("state"), F.col("state").alias("w1"), F.col("label").alias("w2"), F.col("a").alias("a12")), pairs.select(F.col("ordinal").alias("suffix"), F.col("a").alias("a23"))
    three = triples.select("state", "suffix", F.col("label").alias("w3"), "a").join(head, "state").join(tail, "suffix").join(first, "w1").join(word(2), "w2").join(word(3), "w3")
    three = three.withColumn("s1", score("f1", "a23")).withColumn("s2", score("a12", "f3")).withColumn("one", F.col("s1") <= F.col("s2"))
    part = lambda a, b: F.when(F.col("one"), F.col(a)).otherwise(F.col(b))
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", part("f1", "a12").alias("l"), part("a23", "f3").alias("r"), part("s1", "s2").alias("score"))
    totals = sliced.where("range < 0").select("names", "docs", "n").mapInArrow(_totals, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = two.union(three).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= MOST)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
