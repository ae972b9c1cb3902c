"""Passages, vocabularies, divergence and collocations against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import collocations, divergence, passages, vocabulary
from ledgerline.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.oracle import same

SCHEMA = "doc_id long, text string, lang string, source string, id long, tie long, terms string, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(seed: int, many: int) -> list[tuple]:
    """Texts of few words, so that much repeats, with odd rows among them; each has columns whose names the operators use inside."""
    r, rows = random.Random(seed), []
    passage = [" ".join(r.choice("abcdefghijklmnop") for _ in range(n)) for n in (19, 20, 25, 60)]
    for k in range(many):
        words = r.choice(("ab", "The quick, brown fox. été ÉTÉ naïve x1y über!", "abcdefghijklmnopqrstuvwxyz")).split() if k % 2 else list("abcdefghijklmnopqrstuvwxyz")
        words = list(words[0]) if len(words) == 1 else words
        text = r.choice((" ", "  ", "\n")).join(r.choice(words) for _ in range(r.choice((0, 3, 19, 20, 21, 45, 200))))
        if k % 3 == 0:
            text += "\t" + r.choice(passage) + " " + r.choice(passage)
        rows.append([k, text, r.choice(("en", "de", None)), r.choice(("s1", "s2", "s3", None))])
    rows[3][1], rows[4][1], rows[5][1] = None, "", " \n\t "
    rows[6][1] = "x " * 3000 + "tail"
    rows[7][1] = "w" * 5000 + ". " + "the quick " * 40
    return [(*row, 1, 2, "t", 3) for row in rows]


def removed(rows: list[tuple]) -> dict:
    seen, out = set(), {}
    for d, text in sorted((r[0], r[1]) for r in rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out[d] = (len(words), sum(gone), hashlib.sha256(" ".join(w for w, g in zip(words, gone) if not g).encode()).hexdigest())
    return out


def kept_texts(df):
    return {r[0]: tuple(r[1:]) for r in passages.without_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    rows = documents(seed, 160)
    got = kept_texts(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == removed(rows) and sum(x[1] for x in got.values()) > 1000


def test_passages_over_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op11_passages"](spark, SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    assert got == removed(rows)


def test_passages_without_ids_and_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text + " more"), (7, text), (7, text), (7, "other " + text), (9, None), (None, None)]
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in passages.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # Equal rows are judged alike; of the two texts of id 7 the one with the smaller hash is first; rows without an id are last.
    first = [r[0] for r in spark.createDataFrame([(text,), ("other " + text,)], "t string").select(F.xxhash64("t")).collect()]
    seven = [(7, 30, 0), (7, 30, 0), (7, 31, 30)] if first[0] < first[1] else [(7, 30, 30), (7, 30, 30), (7, 31, 0)]
    assert got == sorted([(0, 31, 30), (0, 0, 0), (9, 0, 0), *seven])


@pytest.mark.parametrize("made", [lambda df: passages.without_repeats(df), lambda df: divergence.divergence(df), lambda df: collocations.collocations(df)])
def test_empty_tables(spark, made):
    assert made(spark.createDataFrame([], SCHEMA)).count() == 0


def test_transducer():
    r = random.Random(4)
    terms = sorted({bytes(r.choice(b"abc\xc3\xa9") for _ in range(r.randint(1, 9))) for _ in range(3000)})
    others = [t + b"z" for t in terms[:50]] + [b"", b"zz"] + [t for t in (x[:-1] for x in terms) if t and t not in set(terms)][:50]
    machine = vocabulary.Transducer.unpacked(vocabulary.Transducer.of(terms).packed())
    assert machine.ordinals(pa.array(terms + others, pa.large_binary())).tolist() == [*range(len(terms)), *[-1] * len(others)]
    assert list(machine.terms()) == terms == [machine.term(k) for k in range(len(terms))]
    assert len(machine.final) < len({t[:k] for t in terms for k in range(len(t) + 1)})  # fewer states than a trie has
    # Minimal: no two states have the same arcs and the same ending.
    ways = {(bool(machine.final[s]), tuple((int(k) & 255, int(t)) for k, t in zip(machine.keys, machine.target) if int(k) >> 8 == s)) for s in range(len(machine.final))}
    assert len(ways) == len(machine.final)
    assert vocabulary.Transducer.of([]).ordinals(pa.array([b"a"], pa.large_binary())).tolist() == [-1]


def test_shares():
    import numpy as np

    for total in (1, 7, 10**6 + 3, 9 * 10**14):
        counts = [0, 1, total // 3, total - 1, total]
        assert divergence.shares(np.array(counts), total).tolist() == [1 + 10**9 * c // total for c in counts]


def audited(rows: list[tuple]) -> set[tuple]:
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(r[2] or "", r[3] or "", term.findall((r[1] or "").translate(LOWER))) for r in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted((t for t, n in held.items() if n >= 3), key=str.encode)
        counts = defaultdict(Counter)
        for name, source, words in docs:
            if name == lang:
                counts[source].update(w for w in words if held[w] >= 3)
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        whole = sum(counts.values(), Counter())
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(whole.values()) + len(kept)) for t in kept}
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= 200:
                        out.add((lang, s, part, item, value, rank))
    return out


def test_divergence(spark):
    rows = documents(3, 200)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert set(map(tuple, divergence.divergence(df).collect())) == audited(rows)


def test_divergence_sql(spark):
    same(spark, QUERIES["op12_divergence"], ORACLE_SQL["op12_divergence"], SMALL)


def phrases(rows: list[tuple]) -> set[tuple]:
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= 10}
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q))) and 100 * b >= 50 * a for q, b in found.items()):
                continue
            cuts = [(10**6 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:2000], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("slice_bytes", [12 << 20, 700])
def test_collocations(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(vocabulary, "SLICE_BYTES", slice_bytes)
    rows = documents(5, 120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = set(map(tuple, collocations.collocations(df).collect()))
    assert got == phrases(rows) and len(got) > 100


def test_collocations_of_few_words_over_many_ranges(spark):
    """A frequent word's pairs are spread over ranges by their second words, so that their ordinals don't ascend with those words."""
    r = random.Random(1)
    rows = [(k, " ".join(f"w{r.randrange(10)}" for _ in range(r.randrange(120))), r.choice(("en", "de", None))) for k in range(600)]
    got = set(map(tuple, collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)).collect()))
    assert got == phrases(rows)


def test_collocations_over_documents(spark):
    rows = [(r[0], r[1], r[2]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    assert set(map(tuple, QUERIES["op13_collocations"](spark, SMALL).collect())) == phrases(rows)
