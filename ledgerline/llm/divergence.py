"""How the sources of a language differ in the words they use, audited over a vocabulary of minimal acyclic transducers.

Terms that at least LEAST documents of a language hold are kept; the transducers of their sorted ranges (vocabulary.py) give each its
place in byte order. The texts pass through them again to be recounted by source, and places order equal values.

Shares p are whole numbers of billionths with one added to every count, so f = floor((p - q)^2 / q) and its sums are exact: sums
of p over a vocabulary stay near a billion, so the squares' sum stays below 2^63. Counts may be any size.

Rows: null text, lang and source are empty. Documents without terms count as part of their group. Rows that repeat are documents
of their own. Texts are taken whole. An empty table gives no rows; other columns are ignored. The list of groups goes to the
driver, as the result has a row for each two of a language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import vocabulary as V
from ledgerline.llm.common import shared_dir, table

#: Documents that a kept term needs; ranks of the terms of a group that are reported.
LEAST, MOST_TERMS = 3, 200
#: Entries of a block of terms by sources, and counts gathered before they are written.
CELLS, GATHERED = 1 << 20, 1 << 21

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def letters(texts: pa.Array) -> V.Sliced:
    """Runs of ASCII letters, in lower case, and of other characters beyond ASCII."""
    words, doc = V.split(V.translated(texts, _LETTERS))
    return V.Sliced(words, doc, True, np.zeros(0, np.uint8))


def shares(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * count / total) for counts up to total, without overflow below 2^53."""
    whole, rest = count // total, count % total
    for _ in range(3):
        whole, rest = whole * 1000 + rest * 1000 // total, rest * 1000 % total
    return whole + 1


_COUNTED = "range int, langs array<string>, sources array<string>, totals array<long>, ordinals binary, groups binary, counts binary"


def _recounted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices with answers as counts by group and ordinal, gathered over slices, in a row for each range; range -1: totals."""
    names: dict[tuple[str, str], int] = {}
    starts: dict[int, int] = {}
    keys, counts = [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.zeros(len(key), np.int64)
        np.add.at(count, at, np.concatenate(counts))
        ordinal, group = key >> 24, (key & 0xFFFFFF).astype(np.int32)
        ranges = sorted(starts)
        cuts = [*np.searchsorted(ordinal, [starts[r] for r in ranges]), len(ordinal)]
        langs, sources = [k[0] for k in names], [k[1] for k in names]
        rows = [(-1, langs, sources, np.bincount(group, count, len(names)).astype(np.int64).tolist() if count.sum() < 1 << 53 else [int(count[group == g].sum()) for g in range(len(names))], None, None, None)]
        rows += [(r, langs, sources, None, ordinal[a:b].tobytes(), group[a:b].tobytes(), count[a:b].tobytes()) for r, a, b in zip(ranges, cuts[:-1], cuts[1:], strict=True) if b > a]
        keys.clear(), counts.clear()
        yield V._batch(rows, _COUNTED)

    for row in V.each(batches):
        ordinal, _, _ = V.read_parts(row["parts"])
        starts |= {p["range"]: p["base"] for p in row["parts"]}
        pairs = list(zip(row["names"][::2], row["names"][1::2], strict=True))
        own = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
        of_doc, words = V.read_docs(row["docs"], row["n"])
        group, found = np.repeat(own[of_doc], words), ordinal[np.frombuffer(row["codes"], np.int32)]
        key, count = np.unique((found << 24 | group)[found >= 0], return_counts=True)
        keys.append(key)
        counts.append(count)
        if sum(map(len, keys)) > GATHERED:
            yield from flush()
    yield from flush()


_PARTS = "part string, lang string, source string, item string, value long, ordinal long"


def _compared(groups: dict[str, list[tuple[str, int]]], sizes: dict[str, int]):
    """For one range: of every two groups of a language the sum of f over the range's terms, and each group's best terms."""

    def run(counted: pa.Table, vocabulary: pa.Table) -> pa.Table:
        if not len(vocabulary) or not len(counted):
            return pa.Table.from_batches([V._batch([], _PARTS)])
        v = vocabulary.to_pylist()[0]
        machine, of_lang, base, rows, names = V.Transducer.unpacked(v["transducer"]), np.frombuffer(v["befores"], np.int32), v["base"], [], {}
        entries = []
        for c in counted.to_pylist():
            at = np.frombuffer(c["ordinals"], np.int64) - base
            entries.append((at, np.frombuffer(c["groups"], np.int32), np.frombuffer(c["counts"], np.int64), list(zip(c["langs"], c["sources"], strict=True))))
        for nth, lang in enumerate(v["langs"]):
            own, terms = groups[lang], np.nonzero(of_lang == nth)[0]
            column, place = {source: k for k, (source, _) in enumerate(own)}, np.full(len(of_lang), -1)
            place[terms] = np.arange(len(terms))
            counts = np.zeros((len(terms), len(own)), np.int64)
            for at, group, count, pairs in entries:
                to = np.array([column.get(s, -1) if k == lang else -1 for k, s in pairs])[group]
                mine = (to >= 0) & (place[at] >= 0)
                np.add.at(counts, (place[at][mine], to[mine]), count[mine])
            sums, step, best = np.zeros((len(own), len(own)), np.int64), max(1, CELLS // len(own)), [[] for _ in own]
            for a in range(0, len(terms), step):
                block = counts[a : a + step]
                p = np.stack([shares(block[:, k] + 1, n + sizes[lang]) for k, (_, n) in enumerate(own)], axis=1)
                q = shares(block.sum(axis=1) + 1, sum(n for _, n in own) + sizes[lang])
                for k in range(len(own)):
                    sums[k] += ((p[:, k : k + 1] - p) ** 2 // p).sum(axis=0)
                    there = np.nonzero((block[:, k] > 0) & (p[:, k] > q))[0]
                    best[k] += zip(((p[there, k] - q[there]) ** 2 // q[there]).tolist(), (terms[a + there]).tolist(), strict=True)
                    best[k] = sorted(best[k], key=lambda x: (-x[0], x[1]))[:MOST_TERMS]
            for k, (source, _) in enumerate(own):
                rows += [("pair", lang, source, own[h][0], int(sums[k, h]), None) for h in range(len(own)) if h != k]
                for value, at in best[k]:
                    names[at] = names.get(at) or machine.term(at).rpartition(b"\n")[2].decode()
                    rows.append(("term", lang, source, names[at], value, base + at))
        return pa.Table.from_batches([V._batch(rows, _PARTS)])

    return run


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): `pair`, the distance to each other source of the language; `term`, the terms it has more of than the language."""
    spark, empty = df.sparkSession, F.lit("")
    docs = df.select(F.coalesce(F.col(text_col), empty).alias("text"), F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"))
    sliced = spark.read.parquet(V.written(docs, letters, ["lang", "source"]))
    answers = spark.read.parquet(V.answered(sliced, LEAST))
    path = f"{shared_dir(spark)}/divergence-{uuid.uuid4().hex}"
    V.encoded(sliced, answers).select("codes", "docs", "names", "n", "parts").mapInArrow(_recounted, _COUNTED).write.parquet(path)
    counted = spark.read.parquet(path)

    totals = counted.where("range < 0").select(F.explode(F.arrays_zip("langs", "sources", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang"), F.col("t.sources").alias("source")).agg(F.sum("t.totals").alias("n"))
    listed = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).cast("long")).collect()
    kept = answers.where("slice < 0").select(F.explode(F.arrays_zip("langs", "many")).alias("t")).groupBy("t.langs").agg(F.sum("t.many")).collect()
    groups: dict[str, list[tuple[str, int]]] = {}
    for lang, source, n in sorted(map(tuple, listed)):
        groups.setdefault(lang, []).append((source, n))

    ranges = answers.where("slice < 0").select("range", "transducer", "befores", "langs").join(F.broadcast(V.bases(answers).select("range", "base")), "range")
    parts = counted.where("range >= 0").groupBy("range").cogroup(ranges.groupBy("range")).applyInArrow(_compared(groups, {k: int(n) for k, n in kept}), _PARTS)
    path = f"{shared_dir(spark)}/divergence-{uuid.uuid4().hex}"
    parts.write.parquet(path)
    parts = spark.read.parquet(path)
    each = spark.createDataFrame([(lang, a, b) for lang, own in groups.items() for a, _ in own for b, _ in own if a != b], "lang string, source string, item string")
    sums = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = each.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    own = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = parts.where("part = 'term'").withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal"))).where(F.col("rank") <= MOST_TERMS)
    return pairs.withColumn("rank", F.row_number().over(own)).union(terms.select("lang", "source", "part", "item", "value", "rank"))


def op12_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  tok AS (SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  kept AS (SELECT lang, term FROM tok GROUP BY 1, 2 HAVING COUNT(DISTINCT doc) >= 3), v AS (SELECT lang, COUNT(*) AS v FROM kept GROUP BY 1),
  groups AS (SELECT DISTINCT lang, source FROM d), c AS (SELECT lang, source, term, COUNT(*) AS c FROM tok JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
  n AS (SELECT lang, source, SUM(c) AS n FROM c GROUP BY 1, 2), ln AS (SELECT lang, SUM(c) AS n FROM c GROUP BY 1), lc AS (SELECT lang, term, SUM(c) AS c FROM c GROUP BY 1, 2),
  p AS (SELECT lang, source, term, coalesce(c, 0) AS c, CAST(1 + 1000000000 * (coalesce(c, 0) + 1) // (coalesce(n, 0) + v) AS BIGINT) AS p FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
  q AS (SELECT lang, term, CAST(1 + 1000000000 * (c + 1) // (n + v) AS BIGINT) AS q FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
  f AS (SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
  UNION ALL SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM terms) WHERE rank <= 200"""
