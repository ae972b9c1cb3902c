"""Document quality: Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Preference pairs (a labelled good document over a labelled
bad one) are drawn from all labelled rows by hashes: in each of PAIRS_PER_ROW rounds a row of the larger class meets one of
the other on average. The weights minimise the logistic loss on feature differences, by Newton steps whose sums each
partition makes of its pairs. A quantile of the labelled rows' strengths, at the labels' share of bad rows, is the threshold; the
score is the logistic function of the strength's distance from it, shifted so that the threshold has score `at`.

Features are column expressions, so scoring is one scan of the documents without a shuffle.

Rows: null texts count as empty and get a score like any other, of equal texts an equal one; empty tables give empty
results; a labelled id counts once, with the greater of its labels and the least of its documents' features, however often
it stands in either table; null labels and ids are left out of the fit; without both labels every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import kept, table

PAIRS_PER_ROW = 8
#: Bins into which an order statistic's range is cut at once, whose counts go to the driver.
BINS = 1000
FEATURES = ("length", "word_length", "distinct", "repeats", "upper", "symbols", "digits", "bars", "marked", "lines", "short")


def features(text_col: str = "text") -> Column:
    """The features of a text as an array of doubles, in the order of FEATURES; shares are of characters or of words.

    All are made of one bound text and one bound list of words, so that the text is split once wherever the optimiser puts the column.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def each(x: Column) -> Column:
        t, w, lines = x["t"], x["w"], x["lines"]
        n, k = F.greatest(F.length(t), F.lit(1)), F.greatest(F.size(w), F.lit(1))
        share = lambda others: F.length(F.regexp_replace(t, others, "")) / n
        cols = {
            "length": F.log1p(F.size(w)),
            "word_length": F.log1p(n / k),
            "distinct": F.size(F.array_distinct(w)) / k,
            "repeats": F.size(F.filter(w, lambda v, i: (i > 0) & (v == F.element_at(w, F.greatest(i, F.lit(1)))))) / k,
            "upper": share(r"\P{Lu}+"),
            "symbols": share(r"[\p{L}\p{N}\s.,]+"),
            "digits": share(r"[^0-9]+"),
            "bars": F.size(F.filter(w, lambda v: v == "|")) / k,
            "marked": F.size(F.filter(w, lambda v: v.rlike(r"[#$%&*!]$"))) / k,
            "lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
            "short": F.size(F.filter(w, lambda v: F.length(v) <= 3)) / k,
        }
        return F.array(*(cols[name].cast("double") for name in FEATURES))

    bound = F.struct(text.alias("t"), words.alias("w"), F.filter(F.split(text, "\n"), lambda v: v != "").alias("lines"))
    return F.transform(F.array(bound), each)[0]


@dataclass(frozen=True)
class Ranker:
    weights: tuple[float, ...]
    threshold: float
    at: float

    def score(self, text_col: str = "text") -> Column:
        terms = F.zip_with(features(text_col), F.array(*map(F.lit, self.weights)), lambda f, w: f * w)
        strength = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
        return 1 / (1 + F.exp(F.lit(self.threshold - math.log(self.at / (1 - self.at))) - strength))


def sample_rows(labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """At most `per_class` labelled ids of either class, the first by a hash of the id; and how many there are in all."""
    labels = labels.select(id_col, F.col(label_col).cast("int").alias("label")).where(f"label IN (0, 1) AND {id_col} IS NOT NULL").groupBy(id_col).agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    # About twice as many as are needed are sorted; a hash within so wide a range leaves too few with no chance to speak of.
    hash_ = F.pmod(F.xxhash64(id_col), F.lit(1 << 20))
    each = [
        labels.where((F.col("label") == c) & (hash_ < int(min(1.0, (2 * per_class + 100) / max(1, sizes.get(c, 0))) * (1 << 20)))).orderBy(hash_, id_col).limit(per_class)
        for c in (0, 1)
    ]
    return each[0].union(each[1]), sizes


#: Labelled ids up to which they are sent to every task, so that only their documents' features are counted.
SENT = 200_000


def labelled_features(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """(id, label, f) of every labelled id that has documents."""
    labels = kept(labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("label").alias("label")))
    docs, f = docs.where(F.col(id_col).isNotNull()), features(text_col).alias("f")
    if labels.count() <= SENT:
        rows = docs.select(F.col(id_col).alias("id"), text_col).join(F.broadcast(labels), "id").select("id", "label", f)
    else:  # features are shorter than texts
        rows = docs.select(F.col(id_col).alias("id"), f).join(labels, "id")
    return kept(rows.groupBy("id", "label").agg(F.min("f").alias("f")))


def pairs(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(d): what the features of a good row are above a bad one's, for all that meet by a hash in some round."""
    buckets = max(1, min(sizes[0], sizes[1]))
    dealt = rows.select("label", "f", F.explode(F.transform(F.sequence(F.lit(0), F.lit(PAIRS_PER_ROW - 1)), lambda r: F.struct(r.alias("round"), F.pmod(F.xxhash64("id", r), F.lit(buckets)).alias("at")))).alias("k"))
    side = lambda label, name: dealt.where(F.col("label") == label).select("k.round", "k.at", F.col("f").alias(name))
    return side(1, "good").join(side(0, "bad"), ["round", "at"]).select(F.zip_with("good", "bad", lambda x, y: x - y).alias("d"))


def _slopes(w: np.ndarray, scale: np.ndarray):
    """Of each partition: its number of pairs, and the sums of their losses' gradient and second derivatives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, grad, hess = 0, np.zeros(len(w)), np.zeros((len(w), len(w)))
        for batch in batches:
            diff = np.where(scale > 1e-8, batch.column(0).flatten().to_numpy().reshape(len(batch), len(w)) / scale, 0.0)
            p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
            n, grad, hess = n + len(batch), grad - p @ diff, hess + (diff * (p * (1 - p))[:, None]).T @ diff
        yield pa.RecordBatch.from_arrays([pa.array([[float(n), *grad, *hess.ravel()]], pa.list_(pa.float64()))], ["sums"])

    return run


def _strength(weights: np.ndarray) -> Column:
    return F.aggregate(F.zip_with("f", F.array(*map(F.lit, map(float, weights))), lambda f, w: f * w), F.lit(0.0), lambda total, term: total + term)


def nth_smallest(values: DataFrame, k: int) -> float:
    """The value at place k (from 0) of the column `s` in order; ranges of values are narrowed by the counts of their bins."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        here = values.where(F.col("s").between(low, high))
        at = F.least(F.floor((F.col("s") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        bins = sorted(here.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).collect())
        before = values.where(F.col("s") < low).count()
        for r in bins:
            if k < before + r["n"]:
                break
            before += r["n"]
        low, high = r["low"], r["high"]
    return low


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", at: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    """Learns from all rows of `labels`; leave held-out rows out before."""
    none = Ranker((0.0,) * len(FEATURES), math.log(at / (1 - at)), at)
    rows = labelled_features(docs, labels, label_col, id_col, text_col)
    each = lambda f: [f(F.col("f")[k]) for k in range(len(FEATURES))]
    told = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not told.get(0) or not told.get(1):
        return none
    scale = np.maximum(np.array(rows.agg(*each(F.stddev_pop)).first(), float), 1e-9)
    met = kept(pairs(rows, told))
    w = np.zeros(len(FEATURES))
    for _ in range(25):  # Newton steps on the mean logistic loss with a small ridge
        # One row a partition.
        sums = np.array([r[0] for r in met.mapInArrow(_slopes(w, scale), "sums array<double>").collect()]).sum(axis=0)
        n = max(1.0, sums[0])
        grad = sums[1 : 1 + len(w)] / n + 1e-3 * w
        hess = sums[1 + len(w) :].reshape(len(w), len(w)) / n + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    raw = np.where(scale > 1e-8, w / scale, 0.0)
    strength, total = kept(rows.select(_strength(raw).alias("s"))), told[0] + told[1]
    k = min(told[0] - 1, total - 2)
    below = nth_smallest(strength, k)
    above = below if strength.where(F.col("s") <= below).count() > k + 1 else strength.where(F.col("s") > below).agg(F.min("s")).first()[0]
    return Ranker(tuple(map(float, raw)), float((below + above) / 2), at)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
