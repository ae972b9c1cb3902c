"""Toxicity: a linear-chain conditional random field over words.

Labels say which documents are toxic, not which words. Word labels are therefore induced: over a bounded sample of
labelled documents, each text once, words (lower-cased, without marks) that are far more frequent in toxic documents
than in clean ones form a bounded lexicon; such a word of a toxic document is labelled toxic, every other word clean.
A two-state field with a weight for each of these features and for each transition is then fitted to the word labels by
gradient ascent on the conditional likelihood; of texts of over FIT_WORDS words a stretch is taken, which a hash places,
or in toxic ones the first word of the lexicon.

Scoring runs forward and backward over each whole text. A document's score is a logistic function, fitted on the same
sample, of its expected number of toxic words, the sum of their marginals; words whose marginal reaches SPAN_AT are
its offending spans, in code points.

Rows: null texts count as empty and score like clean ones, and so do all texts where no toxic label was learnt; repeated rows score alike;
a labelled id counts once; null labels and labels without a document are left out; an empty table gives an empty result; very
long texts are scored whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import coded_words, kept, row_sums, slices, table
from ledgerline.llm.quality import sample_rows

#: Most labelled documents of either class that the lexicon is counted on.
SAMPLE_PER_CLASS = 10_000
#: Most of those, of either class, that the field is fitted on, and the longest stretch in words.
FIT_PER_CLASS, FIT_WORDS = 800, 600
LEXICON = 2_000
#: A feature enters the lexicon if its share of toxic documents, smoothed, is so many times its share of clean ones,
#: and if the log-likelihood ratio against chance is so high, which a word of a few documents can't reach.
LIFT, EVIDENCE = 5.0, 11.0
SPAN_AT = 0.5

_MARKS = re.compile(r"[\W_]+")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def features(word: str) -> tuple[str, ...]:
    """What the field sees of a word: the word itself, if anything is left of it without marks."""
    bare = _MARKS.sub("", word.lower())
    return (bare,) if bare else ()


def forward_backward(emission: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences laid end to end, for each word: the chance of the toxic state given the words up to it, and how much
    likelier what follows is after the toxic state than after the clean one.

    `emission` is what the toxic state adds for each word, `moves` [from, to] what a transition adds; the chain starts
    in the clean state. All sequences advance together, longest first, so a step is one vector operation.
    """
    n = len(counts)
    order = np.argsort(-counts, kind="stable")
    starts, lengths = (np.cumsum(counts) - counts)[order], counts[order]
    steps = int(lengths[0]) if n else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # sequences longer than t
    t00, t01, t10, t11 = np.exp(moves).ravel()
    weight = np.exp(np.clip(emission, -50, 50))
    tox, ratio = np.zeros(n), np.ones(n)
    ahead, behind = np.zeros(len(emission)), np.ones(len(emission))
    for t in range(steps):
        k = active[t]
        at, p = starts[:k] + t, tox[:k]
        a = ((1 - p) * t01 + p * t11) * weight[at]
        ahead[at] = tox[:k] = a / ((1 - p) * t00 + p * t10 + a)
    for t in range(steps - 1, 0, -1):
        k = active[t]
        at = starts[:k] + t
        nxt = weight[at] * ratio[:k]
        behind[at - 1] = ratio[:k] = (t10 + t11 * nxt) / (t00 + t01 * nxt)
    return ahead, behind


def marginals(ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    return ahead * behind / (1 - ahead + ahead * behind)


@dataclass
class Field:
    """Weights of the lexicon's features, of any word, of the transitions [from, to], and of the document's score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -12.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 2.0
    level: float = 0.0

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def document(self, expected: np.ndarray) -> np.ndarray:
        """Scores from expected numbers of toxic words."""
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(expected + 0.05) + self.level, -50, 50)))

    def calibrate(self, expected: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
        """Newton steps on the weighted logistic loss, with a small ridge towards the slope 2 and the level 0."""
        x, theta, start = np.stack([np.log(expected + 0.05), np.ones(len(expected))], axis=1), np.array([2.0, 0.0]), np.array([2.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            grad = x.T @ (weight * (toxic - p)) - 0.1 * (theta - start)
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), grad)
            theta = theta + np.clip(step, -1, 1)
        self.slope, self.level = max(0.1, float(theta[0])), float(theta[1])

    def fit(self, sequences: list[tuple[list[tuple[int, ...]], np.ndarray]], names: list[str], rounds: int = 60, rate: float = 0.1, ridge: float = 1e-3) -> None:
        """sequences: for every word the places of its features in `names`, and its label."""
        counts = np.array([len(y) for _, y in sequences])
        y = np.concatenate([y for _, y in sequences]).astype(float)
        word = np.concatenate([np.repeat(np.arange(len(x)), [len(f) for f in x]) + s for (x, _), s in zip(sequences, np.cumsum(counts) - counts, strict=True)]).astype(int)
        feat = np.array([k for x, _ in sequences for f in x for k in f], int)
        first = np.zeros(len(y), bool)
        first[(np.cumsum(counts) - counts)] = True
        before = np.where(first, 0.0, np.concatenate([[0.0], y[:-1]]))
        w, bias, moves = np.full(len(names), 6.0), -8.0, np.zeros((2, 2))
        speed = [np.zeros(len(names)), 0.0, np.zeros((2, 2))]
        seen = np.array([[((1 - before) * (1 - y)).sum(), ((1 - before) * y).sum()], [(before * (1 - y)).sum(), (before * y).sum()]])
        often, toxic = np.maximum(1.0, np.bincount(feat, y[word], len(names))), max(1.0, y.sum())
        for step in range(rounds):
            emission = bias + np.bincount(word, w[feat], len(y))
            ahead, behind = forward_backward(emission, counts, moves)
            gap = y - marginals(ahead, behind)
            prior = np.where(first, 0.0, np.concatenate([[0.0], ahead[:-1]]))
            gives = np.stack([np.ones(len(y)), np.exp(emission) * behind])
            both = np.stack([1 - prior, prior])[:, None] * np.exp(moves)[:, :, None] * gives[None]
            expected = (both / both.sum(axis=(0, 1))).sum(axis=2)
            grad = [np.bincount(feat, gap[word], len(names)) / often - ridge * w, gap.sum() / toxic - ridge * bias, (seen - expected) / toxic - ridge * moves]
            for k, g in enumerate(grad):
                speed[k] = 0.9 * speed[k] + g
            pace = rate / (1 + step / 50)
            w, bias, moves = w + pace * np.clip(speed[0], -2, 2), bias + pace * np.clip(speed[1], -2, 2), moves + pace * np.clip(speed[2], -0.5, 0.5)
        self.weights, self.bias, self.moves = dict(zip(names, w.tolist(), strict=True)), float(bias), moves


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean): in how many documents of a batch each feature stands."""
    for batch in slices(batches, 0):
        words, codes, counts = coded_words(batch.column(0))
        own = [features(w) for w in words]
        names = {f: k for k, f in enumerate(dict.fromkeys(f for fs in own for f in fs))}
        if not names:
            continue
        many = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter((names[f] for fs in own for f in fs), np.int64)
        starts = np.cumsum(many) - many
        row = np.repeat(np.repeat(np.arange(len(counts)), counts), many[codes])
        take = np.arange(len(row)) - np.repeat(np.cumsum(many[codes]) - many[codes], many[codes]) + np.repeat(starts[codes], many[codes])
        pairs = np.unique(row * len(names) + flat[take])
        label = batch.column(1).to_numpy(zero_copy_only=False)[pairs // len(names)]
        toxic = np.bincount(pairs % len(names), label, len(names)).astype(np.int64)
        both = np.bincount(pairs % len(names), minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(list(names)), pa.array(toxic), pa.array(both - toxic)], ["feature", "toxic", "clean"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Learns from all rows of `labels` that the samples take; leave held-out rows out before."""
    sample, sizes = sample_rows(labels, label_col, SAMPLE_PER_CLASS, id_col)
    model = Field()
    if not sizes.get(1):
        return model
    # The sample has at most 2 * SAMPLE_PER_CLASS rows of two numbers, whatever the tables' sizes.
    found = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(sample.withColumnRenamed(id_col, "_id")), F.col(id_col) == F.col("_id"))
    # Copies of a text count once, as what it says.
    once = kept(found.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.max("label").alias("label")))
    totals = {r["label"]: r["count"] for r in once.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    t, c, share = F.col("toxic"), F.col("clean"), toxic / max(1, toxic + clean)
    lift = (t + 0.1) / (toxic + 0.2) / ((c + 0.1) / (clean + 0.2))
    evidence = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * max(1e-9, 1 - share)))).otherwise(0.0)
    counts = once.select("text", "label").mapInArrow(_bags, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    strong = counts.where((t > 0) & (lift >= LIFT) & (evidence >= EVIDENCE)).orderBy(F.desc(evidence), "feature").limit(LEXICON)
    names = [r["feature"] for r in strong.collect()]
    places = {f: k for k, f in enumerate(names)}
    if not names:
        return model
    chosen = [once.where(F.col("label") == c).select("h").orderBy(F.xxhash64("h"), "h").limit(FIT_PER_CLASS) for c in (0, 1)]
    some = once.join(F.broadcast(chosen[0].union(chosen[1])), "h").select("h", "text", "label")
    rows = sorted(some.mapInArrow(_stretches(places), "h long, label int, coded array<int>").collect())
    sequences = [(tuple((k,) if k >= 0 else () for k in r["coded"]), np.array([k >= 0 and r["label"] == 1 for k in r["coded"]])) for r in rows if r["coded"]]
    if any(y.any() for _, y in sequences):
        model.fit(sequences, names)
        # Calibrated on what whole texts give, long ones too.
        whole = sorted(_expected(some, model).collect())
        expected, labelled = np.array([r["expected"] for r in whole]), [r["label"] for r in whole]
        y = np.array(labelled, float)
        weight = np.where(y == 1, sizes[1] / max(1, y.sum()), sizes.get(0, 0) / max(1, (1 - y).sum()))
        model.calibrate(np.maximum(expected, 0.0), y, weight / weight.mean())
    return model


def _stretches(places: dict[str, int]):
    """(h, label, coded): of each text at most FIT_WORDS words, each as its place in the lexicon or -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, codes, counts = coded_words(batch.column(1))
            own = np.fromiter((places.get(f[0], -1) if (f := features(w)) else -1 for w in words), np.int32, len(words))[codes]
            out = []
            for h, label, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), np.split(own, np.cumsum(counts)[:-1]), strict=True):
                hits = np.nonzero(part >= 0)[0]
                at = int(hits[0]) - FIT_WORDS // 2 if label == 1 and len(hits) else h % max(1, len(part) - FIT_WORDS + 1)
                at = max(0, min(at, len(part) - FIT_WORDS))
                out.append(part[at : at + FIT_WORDS].tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.int32()))], ["h", "label", "coded"])

    return run


def _expected(df: DataFrame, model: Field) -> DataFrame:
    """(h, label, expected): the expected number of toxic words of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, codes, counts = coded_words(batch.column(1))
            emission = np.fromiter(map(model.emission, words), float, len(words))[codes]
            expected = row_sums(marginals(*forward_backward(emission, counts, model.moves)), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(expected)], ["h", "label", "expected"])

    return df.mapInArrow(run, "h long, label int, expected double")


def score(df: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, spans): the probability that any word is toxic, and the spans (start, end, marginal) of those that are."""
    held = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("marginal", T.DoubleType())]))
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("score", T.DoubleType()), T.StructField("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in slices(batches):
            words, codes, counts = coded_words(batch.column(1))
            emission = np.fromiter(map(own.emission, words), float, len(words))[codes]
            ahead, behind = forward_backward(emission, counts, own.moves)
            marginal = marginals(ahead, behind)
            toxic = own.document(np.maximum(row_sums(marginal, counts), 0.0))
            bad = marginal >= SPAN_AT
            stops = np.cumsum(counts)
            spans: list[list[dict]] = [[] for _ in counts]
            for k in np.nonzero(row_sums(bad.astype(np.int64), counts))[0].tolist():
                stop = int(stops[k])
                at = np.nonzero(bad[stop - counts[k] : stop])[0].tolist()
                places = [m.span() for m in _WORDS.finditer(batch.column(1)[k].as_py())]
                spans[k] = [{"start": places[j][0], "end": places[j][1], "marginal": float(marginal[stop - counts[k] + j])} for j in at]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(toxic), pa.array(spans, kind)], out.names)

    return df.select(id_col, text_col).mapInArrow(run, out)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    found = score(docs, model)
    spans = F.expr("array_join(transform(spans, x -> concat(x.start, ':', x.end)), ',')").alias("spans")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted, F.size("spans").alias("n_spans"), spans)
