"""Operators of llm against brute force on small tables, and the cases that their docstrings define."""

import datetime
import hashlib
import os
import re
import subprocess
import sys
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import common, decontaminate, mixing, private_data, quality, queries, simhash, token_counts, token_files, tool_calls, toxicity, vectors
from tests.conftest import SMALL
from tests.oracle import same

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, size int, component_id int, id int"
LONG = "lang word " * 30_000


def docs(spark, *texts, source="s"):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, "en", source, 0, "x", 1, 2, 3) for k, t in enumerate(texts)], SCHEMA)


ODD = (None, "", "  \n\t", "one", "same text here now", "same text here now", LONG, "ünïcode Wörds ▁ <|endoftext|> 日本", "a" * 100_000)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, *ODD)


def files():
    return P.path("word_bpe_49k.json")


def test_all_survive_odd_rows_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "same text here now")], "item_id long, text string")
    runs = {
        "op1": lambda d: token_counts.token_counts(d, P.path("piece_bpe_32k.model")),
        "op2": lambda d: d.select("doc_id", quality.fit(d, labels).score().alias("score")),
        "op3": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "op4": lambda d: simhash.near_duplicates(d),
        "op6": lambda d: private_data.private_spans(d),
        "op7": lambda d: mixing.mix(d),
        "op10": lambda d: token_files.token_files(d, files()),
        "one_of_each": lambda d: simhash.one_of_each(d),
    }
    lost = 3  # an equal text, and two of the three without words
    for name, run in runs.items():
        assert run(odd).count() == len(ODD) - (lost if name == "one_of_each" else 0), name
        assert run(odd.where("false")).count() == 0, name
    found = decontaminate.contaminated(odd, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(3, 3), (4, 4), (5, 4)}
    assert decontaminate.contaminated(odd, bench.where("false")).count() == 0


def test_token_counts_are_best_cuts(spark):
    pieces = token_counts.load_pieces(P.path("piece_bpe_32k.model"))
    low = min(pieces.values()) - 10

    def brute(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            ways = [(best[end - 1][0] + n * low, best[end - 1][1] + n)]
            ways += [(best[s][0] + pieces[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in pieces]
            best.append(max(ways, key=lambda w: (w[0], -w[1])))
        return best[-1][1]

    df = common.table(spark, SMALL, "documents").limit(30)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, P.path("piece_bpe_32k.model")).collect()}
    cache = {}
    for r in df.collect():
        words = r.text.encode().split()
        assert got[r.doc_id] == sum(cache.setdefault(w, brute(token_counts.MARK + w.decode())) for w in words)


def test_long_words_are_cut_alike_without_a_trie():
    trie = token_counts.Trie(token_counts.load_pieces(P.path("piece_bpe_32k.model")))
    for word in ("the" * 100, "ünï日本" * 60, "a1b2-c3" * 50, "x", ""):
        assert trie.cut(token_counts.MARK + word) == trie.add(token_counts.MARK + word)
    words = ["Q" * 300, "the", "theme"]
    assert token_counts.word_counts(words, P.path("piece_bpe_32k.model")).tolist() == [trie.add(token_counts.MARK + w) for w in words]
    assert words[0] not in token_counts._KNOWN[P.path("piece_bpe_32k.model")]


def test_quality_and_toxicity_rank(spark):
    labels = common.table(spark, "/root/testdata/sf0.01", "labels")
    for name, label, least in (("op2_quality", "quality", 0.97), ("op3_toxicity", "toxic", 0.85)):
        rows = queries.QUERIES[name](spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
        assert all(0 <= r.score <= 1 for r in rows)
        held = [r for r in rows if r.held_out]
        assert np.mean([r[label] == r.predicted for r in held]) >= least


def test_quality_is_brute_force(spark):
    """The query's scores from the fitted weights and features counted in Python."""
    docs_ = common.table(spark, SMALL, "documents")
    model = quality.fit(docs_, common.table(spark, SMALL, "labels").where(~quality.held_out()))
    got = {r.doc_id: r for r in queries.QUERIES["op2_quality"](spark, SMALL).collect()}
    for r in docs_.collect():
        t = r.text or ""
        w, lines, n = re.findall(r"[^\x20\x09-\x0d]+", t), [x for x in t.split("\n") if x], max(1, len(t))
        k = max(1, len(w))
        java_space = " \t\n\x0b\f\r"
        f = [np.log1p(len(w)), np.log1p(n / k), len(set(w)) / k, sum(a == b for a, b in zip(w, w[1:], strict=False)) / k]
        f += [sum(unicodedata.category(c) == "Lu" for c in t) / n, sum(not (unicodedata.category(c)[0] in "LN" or c in java_space + ".,") for c in t) / n]
        f += [sum(c in "0123456789" for c in t) / n, sum(x == "|" for x in w) / k, sum(x[-1] in "#$%&*!" for x in w) / k, len(set(lines)) / max(1, len(lines)), sum(len(x) <= 3 for x in w) / k]
        strength = sum(a * b for a, b in zip(model.weights, f, strict=True)) - model.threshold
        want = 1 / (1 + np.exp(-strength) * 7 / 3)
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == (want >= 0.3) and got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """Every labelled row is in some pair or counted in the threshold; the threshold is the exact order statistic."""
    docs_, labels = common.table(spark, SMALL, "documents"), common.table(spark, SMALL, "labels")
    rows = quality.labelled_features(docs_, labels, "quality", "doc_id", "text")
    want = {r[0] for r in labels.where("quality IN (0, 1)").join(docs_, "doc_id").select("doc_id").collect()}
    assert {r[0] for r in rows.select("id").collect()} == want
    monkeypatch.setattr(quality, "SENT", 0)
    assert quality.labelled_features(docs_, labels, "quality", "doc_id", "text").exceptAll(rows).isEmpty()
    values = [float(v) for v in np.random.default_rng(3).normal(size=300).round(1)] + [1e9, -1e9, 1e-12]
    s = spark.createDataFrame([(v,) for v in values], "s double")
    assert [quality.nth_smallest(s, k) for k in (0, 1, 150, 302)] == [sorted(values)[k] for k in (0, 1, 150, 302)]


def test_a_labelled_id_counts_once(spark):
    labels = spark.createDataFrame([(1, 1)] * 500 + [(2, 0)] * 500 + [(None, 1)], "doc_id long, quality int")
    found, sizes = quality.sample_rows(labels, "quality", 10)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (2, 0)] and sizes == {0: 1, 1: 1}
    many = labels.union(spark.range(10, 2000).selectExpr("id", "cast(id % 2 AS int)"))
    assert {c: n for c, n in quality.sample_rows(many, "quality", 50)[0].groupBy("label").count().collect()} == {0: 50, 1: 50}


def test_toxic_spans_and_long_documents(spark):
    """Toxic documents are all longer than a stretch; their insults are found at their places."""
    rng = np.random.default_rng(7)
    clean = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(clean, 900).tolist()) for _ in range(240)]
    for k in range(0, 240, 2):
        w = texts[k].split()
        for at in rng.integers(0, 900, 6):
            w[at] = rng.choice(["Vile!", "grotty"])
        texts[k] = " ".join(w)
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(200)], "doc_id long, toxic int")
    table = docs(spark, *texts, "Vile\u00a0grotty vile", None)
    got = {r.doc_id: r for r in toxicity.score(table, toxicity.fit(table, labels)).collect()}
    assert all((got[k].score >= 0.7) == (k % 2 == 0) for k in range(240)) and got[241].score < 0.7
    for k in range(240):
        assert [(s.start, s.end) for s in got[k].spans] == [m.span() for m in re.finditer(r"(?<!\S)(Vile!|grotty)(?!\S)", texts[k])]


def test_forward_backward_is_exact():
    rng, counts = np.random.default_rng(0), np.array([4, 0, 1, 6])
    e, moves = rng.normal(size=counts.sum()), rng.normal(size=(2, 2))
    got, start = toxicity.marginals(*toxicity.forward_backward(e, counts, moves)), 0
    for n in counts:
        total, mass = 0.0, np.zeros(n)
        for path in range(1 << n):
            y = [path >> k & 1 for k in range(n)]
            w = np.exp(sum(moves[a, b] for a, b in zip([0, *y], y, strict=False)) + sum(e[start + k] * y[k] for k in range(n)))
            total, mass = total + w, mass + w * np.array(y)
        assert np.allclose(got[start : start + n], mass / total)
        start += n


def fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, prints, most=3):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= most:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op4_simhash"](spark, SMALL).collect()}
    prints = {r.doc_id: fingerprint(r.text) for r in common.table(spark, SMALL, "documents").collect()}
    assert {k: int(r.fingerprint, 16) for k, r in got.items()} == prints
    assert {k: r.component_id for k, r in got.items()} == components(sorted(prints), prints)


def test_all_links_of_three_bits_are_found(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(12)]
    near = sorted(set(near))
    signed = [x - 2**64 if x >= 2**63 else x for x in near]
    links = simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert links.where("bit_count(a ^ b) > 3").count() == 0
    part = {r.node: r.component for r in common.connected_components(links).collect()}
    want = components(range(len(near)), near)
    got = [part.get(s, s) for s in signed]
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(near)) for j in range(i))


def stretch(rng, n):
    return [f"w{x}" for x in rng.integers(0, 10**9, n)]


def test_pairs_at_the_similarity_are_found(spark):
    rng, texts = np.random.default_rng(8), []
    for k in range(200):
        n = (24, 104, 404)[k % 3]  # words; shingles are four fewer
        w, cut = stretch(rng, n), (n - 4) // 10  # 0.9 n' common of 1.1 n': similarity 0.818
        texts += [" ".join(w), " ".join(w[: n - cut] + stretch(rng, cut))]
    left = {r.doc_id for r in simhash.one_of_each(docs(spark, *texts)).select("doc_id").collect()}
    assert set(range(0, 400, 2)) <= left and len(left) <= 202


def test_pairs_in_a_bucket_of_unlike_documents_are_found(spark):
    """Families of two at similarity 0.8, all with a passage that makes any two documents about 0.75 alike."""
    rng = np.random.default_rng(9)
    passage, families = stretch(rng, 90), 40
    tails = [stretch(rng, 3) for _ in range(families)]
    texts = [" ".join(passage + tails[k] + stretch(rng, 11)) for _ in range(2) for k in range(families)]
    bags = [set(zip(*(t.split()[j:] for j in range(5)), strict=False)) for t in texts]
    alike = lambda i, j: len(bags[i] & bags[j]) / len(bags[i] | bags[j])
    assert all((alike(i, j) >= 0.8) == (j - i == families) for i in range(len(texts)) for j in range(i + 1, len(texts)))
    left = {r.doc_id for r in simhash.one_of_each(docs(spark, *texts)).select("doc_id").collect()}
    assert left == set(range(families))


def test_near_dedup_meets_by_ball_hashing(spark):
    """Pairs at similarity 0.8 that no band of MinHash brings together, but whose fingerprints agree, as they repeat a line."""

    def text(k, side):
        loop, head = " ".join(f"loop{k}{c}" for c in "abcde"), " ".join(f"t{k}x{j}" for j in range(11))
        return f"{' '.join([loop] * 40)} {head} end{k}p{side} end{k}q{side}"

    texts = [text(k, side) for k in (1054, 3041, 3187, 3483, 6203, 6757, 10667) for side in (0, 1)]
    for a, b in zip(texts[::2], texts[1::2], strict=True):
        bags = [np.unique(simhash.shingle_hashes(t, 5)) for t in (a, b)]
        bands = simhash.min_bands(np.concatenate(bags), np.array([len(x) for x in bags]))
        assert not (bands[0] == bands[1]).any() and len(np.intersect1d(*bags)) == 0.8 * len(np.union1d(*bags))
    left = corpus_pipeline.drop_near_duplicates(spark, docs(spark, *texts), SMALL)
    assert sorted(r.doc_id for r in left.collect()) == list(range(0, len(texts), 2))


def test_near_dedup_takes_few_tasks(spark):
    """Every task of a shuffle leaves files, however few rows it has: with many partitions these outgrow the data."""
    rng, sc, texts = np.random.default_rng(10), spark.sparkContext, []
    for _ in range(6):
        w = stretch(rng, 104)
        texts += [" ".join(w[:k] + ["x"] + w[k + 1 :]) for k in range(5, 100, 12)]
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("20", "false"), strict=True):
            spark.conf.set(k, v)
        sc.setJobGroup("near_dedup", "")
        left = simhash.one_of_each(docs(spark, *texts)).select("doc_id").collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    told = sc.statusTracker()
    stages = {s for j in told.getJobIdsForGroup("near_dedup") for s in told.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(told.getStageInfo, stages) if i)
    assert len(left) == 6 and tasks < 2000, tasks


def test_ball_buckets_are_the_linked_fingerprints(spark):
    rng = np.random.default_rng(21)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(3)]
    signed = [x - 2**64 if x >= 2**63 else x for x in near]
    rows = [(k, fp, 1) for k, fp in enumerate(signed)] + [(1000, signed[0], 0)]
    found = {r.id: r.variant for r in simhash.ball_buckets(spark.createDataFrame(rows, "id long, fp long, n long")).collect()}
    linked = {(i, j) for i in range(len(near)) for j in range(i) if (near[i] ^ near[j]).bit_count() <= 3}
    assert set(found) == {i for pair in linked for i in pair} and all(found[i] == found[j] for i, j in linked)
    assert len(set(found.values())) == len({c for i, c in components(range(len(near)), near).items() if i in found})


def test_similar_across_is_brute_force():
    rng = np.random.default_rng(10)
    bags = []
    for _ in range(12):
        base = rng.integers(0, 2**63, rng.integers(1, 60), dtype=np.uint64)
        bags += [np.unique(np.concatenate([base[rng.random(len(base)) > 0.08], rng.integers(0, 2**63, rng.integers(0, 3), dtype=np.uint64), base[:1]])) for _ in range(8)]
    part, chunk = rng.integers(0, 30, len(bags)), rng.integers(0, 2, len(bags))
    sets = [set(b.tolist()) for b in bags]
    want = [(i, j) for i in range(len(bags)) for j in range(i + 1, len(bags)) if part[i] != part[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert want and simhash.similar_across(bags, part, np.zeros(len(bags), int), 0.8) == want
    assert simhash.similar_across(bags, part, chunk, 0.8) == [p for p in want if chunk[p[0]] != chunk[p[1]]]


def test_word_encoder_remembers_ids_once():
    """Words are learnt in one go, their ids held once, and equal to the tokenizer's own, whatever was learnt before."""
    encoder = token_files.WordEncoder(files())
    own = lambda words: [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    encoder.ids(["qzxvkw"])
    assert len(encoder.flat) == len(own(["qzxvkw"])[0]) and len(encoder.keys) == 1
    times, keep = [], encoder._keep
    encoder._keep = lambda *a: (times.append(1), keep(*a))
    words = ["qzxvkw", "Qzxvkw", "qzxvkw,", "qzxvkw...", "plain", "plain)*", "a1", "---", "Größe...", "ÀÞ", "àþ", "İİ", "Σας,", "中文", "ß!", "\x1cx", "x'"]
    for some in (words[:8], words, words[::-1]):
        ids, counts = encoder.ids(some)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == own(some)
    assert len(times) == 2 and (np.diff(encoder.keys.astype(object)) > 0).all()


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 16))
    rows = [(k, (base[k % 20] + rng.normal(size=16) * 0.05 * (k % 4)).tolist(), k % 20 % 3) for k in range(120)]
    rows += [(120, rows[0][1], rows[0][2]), (121, None, 1), (122, [0.0] * 16, 1), (123, [float("nan")] * 16, 1), (124, [None] * 16, 1), (125, rows[0][1], None), (126, [], 1), (127, [1.0, 2.0], 0)]
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    ok = [r for r in rows[:121]]
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v, _ in ok])
    label = np.array([c for *_, c in ok])
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    found = sum(got[k].n_links for k in range(121))
    assert linked.sum() * 0.97 <= found <= linked.sum()
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(121, 128))
    assert got[120].component_id == 0 and not got[120].kept


def test_vectors_link_within_equal_labels_of_any_type(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.001]
    for kind, labels in (("double", (1.2, 1.9, 1.2, 0.0, -0.0)), ("string", ("a", "b", "a", "", "")), ("date", None)):
        if labels is None:
            labels = tuple(datetime.date(2020, 1, d) for d in (1, 2, 1, 3, 3))
        rows = [(k, v if k % 2 else w, labels[k], "x", 7) for k in range(5)] + [(None, v, labels[1], "x", 7), (9, v, None, "x", 7)]
        table = spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {kind}, node string, many int")
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(table).collect()}
        assert got == {0: (1, 0, True), 1: (1, 1, True), 2: (1, 0, False), 3: (1, 3, True), 4: (1, 3, False), None: (1, 1, False), 9: (0, 9, True)}
        assert vectors.near_duplicates(table.where("false")).count() == 0


def test_private_data_base_is_exact(spark):
    odd = ["a@b.c_d@e.f x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 010.1.1.1", "4539 1488 0343 6467 9" + "1" * 30, "+1 (017) 555-7713+49 30 1234567 +1((((", "9" * 50_000 + " " + "a" * 50_000 + "@", None, "", "日本 a@b.cd 日本 1.1.1.1"]
    texts = [r.text for r in common.table(spark, SMALL, "documents").collect()] + odd
    rows = docs(spark, *texts)
    got = {r.doc_id: r for r in private_data.private_spans(rows).select("doc_id", F.expr(private_data.written("base")).alias("b"), "added").collect()}
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, v):
        d = re.sub("[^0-9]", "", v)
        luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(d[::-1])) % 10 == 0 if len(d) < 30 else False
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]

    slow = re.compile(r"^[9a@ ]{9000,}$")
    for k, t in enumerate(texts):
        if t and slow.match(t):
            assert got[k].b == ""
            continue
        spans = [f"{kind}:{m.start()}:{m.end()}" for kind, p in patterns.items() for m in re.finditer(p, t or "") if good(kind, m.group())]
        assert got[k].b == ",".join(spans), t
    hashed = queries.QUERIES["op6_private"](spark, SMALL).collect()
    assert all(r.base_sha256 == hashlib.sha256(got[r.doc_id].b.encode()).hexdigest() for r in hashed)


def test_mix(spark):
    rows = queries.QUERIES["op7_mix"](spark, SMALL).collect()
    d = {r.doc_id: r for r in common.table(spark, SMALL, "documents").collect()}
    size = {k: len(r.text.encode().split()) for k, r in d.items()}
    assert all(r["size"] == size[r.doc_id] and r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0) for r in rows)
    total = Counter()
    for k, r in d.items():
        total[r.source] += size[k]
    weight = {s: 1 + k % 3 for k, s in enumerate(sorted(total))}
    target, left, open_ = {}, sum(total.values()), set(total)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * total[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * total[s]
            left -= target[s]
            open_.discard(s)
    assert all(abs(r.target - target[d[r.doc_id].source]) < 1e-6 * max(1, r.target) for r in rows)
    taken = Counter()
    for r in rows:
        taken[d[r.doc_id].source] += r.taken
    assert np.mean([abs(taken[s] - target[s]) / target[s] for s in target]) < 0.15  # ten documents a source
    again = {r.doc_id: r.taken for r in queries.QUERIES["op7_mix"](spark, SMALL).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_mix_takes_the_targets(spark):
    """Every row a whole number of times next to its ratio, and each source's words near its target."""
    big = [(2**53 + k, "w " * (k % 40), "abcde"[k % 5]) for k in range(1, 3000, 2)] + [(None, "x y z", "a")] * 700 + [(5, "hot row", "b")] * 3000 + [(None, None, None), (7, "q", None)]
    rows = mixing.mix(spark.createDataFrame(big, "doc_id long, text string, source string")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in big)
    taken, aim, held = Counter(), {}, Counter()
    for r in rows:
        ratio = r.target / r.source_size if r.source_size else 0
        assert np.floor(ratio - 1e-9) <= r.copies <= np.ceil(ratio + 1e-9) and r.copies <= 3
        taken[r.source] += r.copies * r.size
        held[r.source] += r.size
        aim[r.source] = r.target
    assert all(r.source_size == held[r.source] for r in rows)
    assert all(abs(taken[s] - aim[s]) <= max(3, 0.002 * aim[s]) for s in aim)
    hot = [r.copies for r in rows if r.doc_id == 5]
    assert len(set(hot)) == 2 and abs(np.mean(hot) - aim["b"] / held["b"]) < 0.1


def test_targets_stop_at_three_times(spark):
    rows = spark.createDataFrame([("a", 1000), ("b", 10), (None, 0), ("c", 500)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got["b"] == 30 and got[None] == 0
    assert abs(got["a"] - 1480 / 4) < 1e-9 and abs(got["c"] - 1480 * 3 / 4) < 1e-9


def test_flight_keeps_sums():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 500, 300).astype(float)
    p = mixing.flight(np.full(300, 0.3), size, rng)
    assert ((p > 0) & (p < 1)).sum() <= mixing.HELD + 2
    assert abs(p.sum() - 90) < 1e-6 and abs((p * size).sum() - 0.3 * size.sum()) < 1e-5
    assert np.isin(mixing.landing(p, size), (0, 1)).all()


def test_tool_calls(spark):
    same(spark, queries.QUERIES["op8_tool_calls"], queries.ORACLE_SQL["op8_tool_calls"], SMALL)
    none = "cast(array() AS array<string>)"
    rows = [
        (1, 5, "call", "a", "reply", '{"words": 2, "text": "x y"}', ["b"], None),  # needs a call that stands later
        (1, 7, "call", "b", "reply", '{"words":"2","text":"x"}', [], None),
        (1, 8, "result", "b", None, None, [], "done"), (1, 9, "result", "zz", None, None, [], "lost"), (2, 1, "call", "a", "reply", "{broken", [], None),
        (3, 1, "call", "a", "reply", '{"text":"t"}', ["b"], None), (3, 2, "call", "b", "other", "{}", ["a"], None), (None, 1, "call", "a", "reply", None, [], None),
    ]
    df = spark.createDataFrame(rows, CALLS).withColumn("needs", F.coalesce("needs", F.expr(none)))
    got = {(r.conv_id, r.call_id): r for r in tool_calls.linked(df).collect()}
    assert (got[1, "b"].position, got[1, "a"].position) == (0, 1)
    assert got[1, "b"].status == "linked" and got[1, "a"].status == "unanswered" and got[1, "zz"].status == "orphan"
    assert got[1, "b"].errors == ["words: not BIGINT"] and got[1, "a"].errors == [] and got[2, "a"].errors == ["arguments: not JSON"]
    assert got[3, "a"].errors == ["words: missing"] and got[3, "b"].errors == ["name: no such tool"] and got[None, "a"].errors == ["arguments: not JSON"]
    assert got[1, "a"].message == '{"arguments":{"text":"x y","words":2},"id":"a","name":"reply"}'


CALLS = "conv_id long, turn long, kind string, call_id string, name string, arguments string, needs array<string>, content string"


def test_levels_are_longest_ways(spark):
    """A reversed chain of 300 calls, cycles with calls that need them, and drawn graphs, against plain recursion."""
    rng, graphs = np.random.default_rng(11), {1: {k: [k + 1] for k in range(300)}, 2: {0: [1], 1: [2], 2: [0], 3: [2], 4: [5], 5: [], 6: [3, 5]}, 3: {0: [0], 1: [2], 2: []}}
    graphs[1][300] = []
    for g in range(4, 12):
        order = rng.permutation(14).tolist()
        graphs[g] = {x: sorted({order[j] for j in rng.integers(0, 14, 3) if j < k}) for k, x in enumerate(order)}
    rows = [(g, k, "call", f"c{k}", "reply", "{}", [f"c{n}" for n in needs], None) for g, graph in graphs.items() for k, needs in graph.items()]
    got = {(r.conv_id, r.call_id): r.level for r in tool_calls.levels(spark.createDataFrame(rows, CALLS)).collect()}
    for g, graph in graphs.items():
        level = dict.fromkeys(graph, 0)
        for _ in range(len(graph) + 1):
            level = {k: max((level[n] + 1 for n in needs), default=0) for k, needs in graph.items()}
        if any(n >= k for k, needs in graph.items() for n in needs):
            assert {k: got[g, f"c{k}"] for k in graph} == {k: v if v < len(graph) else 1 << 62 for k, v in level.items()}


def test_tool_calls_odd_rows(spark):
    rows = [(None, 1, "call", "a", "reply", "{}", [], None)] * 3 + [(1, None, "call", "a", "reply", "{}", [], None), (1, 2, "call", "a", "reply", "{}", [], None), (1, 2, "call", None, "reply", "{}", [], None), (1, 3, "result", "a", None, None, None, "r")]
    table = spark.createDataFrame([(*r, 5, "clash") for r in rows], CALLS + ", level int, stride string")
    got = tool_calls.linked(table).collect()
    assert Counter((r.conv_id, r.turn, r.call_id, r.position, r.status) for r in got) == Counter(
        {(None, 1, "a", None, "unanswered"): 3, (1, None, "a", None, "linked"): 1, (1, 2, "a", 1, "linked"): 1, (1, 2, None, 0, "unanswered"): 1}
    )
    assert tool_calls.linked(table.where("false")).count() == 0


def test_decontamination_is_brute_force(spark):
    item = "the quick brown fox jumps over the lazy dog while five wizards watch from a hill of old stones by night and day together"
    w = item.split()
    near = " ".join(w[:1] + ["X"] + w[1:])  # an insertion near the start
    far = " ".join(v if k % 3 else "x" for k, v in enumerate(w))
    texts = [f"before {item} after", f"b {item.upper().replace(' ', '  ')}! c", f"q {near} z", far, "nothing here at all", item + " " + far, " ".join(w[3:])]
    bench = spark.createDataFrame([(7, item), (8, "five wizards watch")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs(spark, *texts), bench).collect()}
    want = {}
    for i, text in ((7, item), (8, "five wizards watch")):
        a = [decontaminate.plain(x) for x in text.split(" ")]
        size = min(5, len(a))
        for k, t in enumerate(texts):
            b = [p for p in map(decontaminate.plain, re.split(r"[\x20\x09-\x0d]+", t)) if p]
            best = max((decontaminate.similarity(Counter(decontaminate.shingles(a, size)), Counter(decontaminate.shingles(b[s : s + len(a)], size))) for s in range(max(1, len(b) - len(a) + 1))), default=0)
            if best >= 0.8:
                want[k, i] = best
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_decontamination_of_documents_shorter_than_the_item(spark):
    w = [f"word{k}" for k in range(59)]
    texts = [" ".join(w[:57]), " ".join(w[5:]), " ".join(w[:48]), " ".join(w[:47]), " ".join(w[:4]), "word1 word2 word3"]
    bench = spark.createDataFrame([(7, " ".join(w)), (8, "word1 word2 word3 word4")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontaminate.contaminated(docs(spark, *texts), bench).where("item_id = 7").collect()}
    assert got == {(0, 7): (53 / 55, 0), (1, 7): (50 / 55, 0), (2, 7): (44 / 55, 0)}


def test_decontamination_with_other_white_space(spark):
    words = [f"word{k}" for k in range(30)]
    items = [f"{' '.join(words)}{gap}next to{gap}it {' '.join(words[::-1])}" for gap in ("\u00a0", "\u3000", "\x1f", " \t\n")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, *(f"x {t} y" for t in items)), bench).where("similarity = 1").collect()}
    assert {(k, k) for k in range(4)} <= got


def test_the_index_rules_out_unrelated_windows_and_keeps_similar_ones():
    rng, kept, of = np.random.default_rng(4), 0, 400
    make = lambda n: [f"s{x}" for x in rng.integers(0, 10**9, n)]
    item = decontaminate.prints(decontaminate.hashed(make(55)), 55)[0]
    assert len(decontaminate.within(decontaminate.prints(decontaminate.hashed(make(100_000)), 55), item)[0]) < 100
    for k in range(of):
        n = (20, 55, 300)[k % 3]
        own, cut = make(n), n // 10  # similarity 0.8 and a little
        other = own[cut:] + make(cut)
        a, b = (decontaminate.prints(decontaminate.hashed(x), n) for x in (own, other))
        kept += len(decontaminate.within(a, b[0])[0])
    assert kept >= of - 1


def test_anchors_are_enough(spark):
    """Items that share most of their words, and documents that hold them with words changed, against all windows."""
    rng = np.random.default_rng(6)
    shared = [f"c{x}" for x in rng.integers(0, 10**6, 30)]
    items = [" ".join(shared[: rng.integers(5, 30)] + [f"i{k}x{x}" for x in range(rng.integers(0, 25))] + shared[20:]) for k in range(25)]
    texts = []
    for k in range(200):
        w = items[k % 25].split()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(0, len(w))] = "changed"
        texts.append(" ".join(["lead"] * int(rng.integers(0, 9)) + w + shared[:4]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs(spark, *texts), bench).collect()}
    want = {}
    for i, item in enumerate(items):
        a = item.split()
        bag = Counter(decontaminate.shingles(a))
        for k, t in enumerate(texts):
            b = t.split()
            best = max(decontaminate.similarity(bag, Counter(decontaminate.shingles(b[s : s + len(a)]))) for s in range(max(1, len(b) - len(a) + 1)))
            if best >= 0.8:
                want[k, i] = best
    assert got == want and len(want) > 40


def test_simple8b_round_trips():
    rng = np.random.default_rng(3)
    for n in (0, 1, 59, 60, 61, 500, 5000, 30_000):
        for most in (1, 16, 60):
            ids = (rng.integers(0, 2**60, n) >> rng.integers(60 - most, 60, n)).astype(np.uint64)
            words, starts, places = token_files.pack(ids)
            assert (token_files.unpack(words) == ids).all() and (starts == np.arange(0, n, token_files.OFFSET_EVERY)).all()
            for start, stop in ((0, n), (n // 2, n), (n - 1, n), (n // 3, n // 2)) if n else ():
                assert (token_files.unpack_part(words, places, start, stop) == ids[start:stop]).all()
            if n > 100:
                blocks = np.array([0, 7, n // 2])
                words, starts, places = token_files.pack(ids, blocks)
                assert (token_files.unpack(words) == ids).all() and set(blocks) <= set(starts.tolist())
                assert (token_files.unpack(words[places[starts == n // 2][0] :]) == ids[n // 2 :]).all()
    with pytest.raises(ValueError):
        token_files.pack(np.array([2**61], np.uint64))


def test_words_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(files()), np.random.default_rng(12)
    letters = list("abcXYZéÉßÀÿ") + ["e\u0301", "İ", "ſ", "K", "日", "ﬁ"]
    marks = list("!?.,;:'\"*$%&()[]{}|_-~") + ["'s", "\u0301", "…", "1", "9"]
    words = sorted({"".join(rng.choice(letters, rng.integers(0, 6)).tolist() + rng.choice(marks, rng.integers(0, 4)).tolist() + rng.choice(letters, rng.integers(0, 2)).tolist()) for _ in range(4000)} - {""})
    words.append("z" * 1000)
    for _ in range(2):
        flat, counts = token_files.encoder(files()).ids(words)
        for w, own in zip(words, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
            assert own.tolist() == tokenizer.encode(w, add_special_tokens=False).ids, w


def test_encoding_holds_little_at_once():
    """What a worker needs beyond its batch is little, and goes back to the system after it."""
    code = """
import resource, sys, pyarrow as pa, public_tokenizers
from ledgerline.llm import common, token_files as t
path = public_tokenizers.path("word_bpe_49k.json")
batch = pa.record_batch([pa.array(range(64)), pa.array([("the quick brown fox jumps over it " * 8000)[:1 << 18]] * 64)], ["id", "text"])
t.encode_texts(batch.column(1)[:1], path)
now = lambda: int(next(x for x in open("/proc/self/smaps_rollup") if x.startswith("Rss")).split()[1]) >> 10
base = now()
for b in common.slices([batch], most=getattr(t, "SLICE_BYTES", 4 << 20)):
    t.pack(t.encode_texts(b.column(1), path)[0])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10) - base, now() - base)
"""
    most, left = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(common.__file__) + "/../..").stdout.split())
    assert most < 30 and left < 10


def test_decontamination_holds_little_at_once():
    """What a worker needs for a batch of many different words beyond the batch, whose texts are long or short."""
    code = """
import resource, numpy as np, pyarrow as pa
from ledgerline.llm import decontaminate as d
letters = np.random.default_rng(15).integers(97, 123, (64, 1 << 18)).astype(np.uint8)
letters[:, ::7] = 32
batch = pa.record_batch([pa.array(range(64)), pa.array([x.tobytes().decode() for x in letters])], ["id", "text"])
index = d.Index([(1, batch.column(1)[63].as_py()[:400])])
out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("differing_bits", pa.int32()), ("first_word", pa.int64())])
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
found = pa.Table.from_batches(d.passages(iter([batch]), index, out)).to_pylist()
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10) - base, *(r["doc_id"] for r in found))
"""
    most, *found = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(common.__file__) + "/../..").stdout.split())
    assert found == [63] and most < 80


def test_plain_words_at_once():
    words = ["Ab_c.", "ΟΔΟΣ", "ΣΑ", "İ", "ſ\x85x", "a\u2028b", "_", "...", "e\u0301", "日本。", "ẞ\x1cK"]
    assert decontaminate.all_plain(words) == [decontaminate.plain(w) for w in words] and decontaminate.all_plain([]) == []


def test_decontamination_stage_shuffles_no_texts(spark):
    docs_ = common.table(spark, SMALL, "documents")
    plan = corpus_pipeline.drop_contaminated(spark, docs_, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and not re.search("SortMergeJoin|Exchange hashpartitioning", plan)


def test_ranges_of_ids_are_read_from_the_files(spark, tmp_path):
    rows = [(None if k % 3 else k, "some words of text " * (k % 50)) for k in range(600)] + [(9, "hot id " + str(k)) for k in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write_ids(table, f"{tmp_path}/f", files())
    docs_ = token_files.read_ids(spark, f"{tmp_path}/f")
    total = docs_.agg(F.sum("n_tokens")).first()[0]
    every = [x for r in sorted(token_files.read_range(spark, f"{tmp_path}/f", 0, total).collect()) for x in r.ids]
    for a, b in ((0, 1), (total // 2, total // 2 + 9000), (total - 5, total)):
        assert [x for r in sorted(token_files.read_range(spark, f"{tmp_path}/f", a, b).collect()) for x in r.ids] == every[a:b]
    for r in docs_.collect():
        assert zlib.crc32(np.array(every[r.start : r.start + r.n_tokens], "<u4").tobytes()) == r.ids_crc32
    ids = [r.doc_id for r in docs_.orderBy("start").collect()]
    assert ids == [None] * 400 + sorted(i for i, _ in rows if i is not None)


def test_token_files_hold_what_the_library_encodes(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(files())
    table = odd.select("doc_id", "text").union(common.table(spark, SMALL, "documents").select(F.col("doc_id") + 100, "text"))
    start = 0
    got = sorted(token_files.token_files(table, files()).collect())
    for r, d in zip(got, sorted(table.collect(), key=lambda d: d.doc_id), strict=True):
        ids = np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_mixing_stage_takes_rows_of_one_id_one_by_one(spark):
    rows = [(None, f"a b c d {k % 2}", "a") for k in range(150)] + [(k, "a b c d e", "b") for k in range(150)] + [(7, "a b c d e", "c") for _ in range(100)] + [(8, None, None)]
    docs_ = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = Counter()
    for r in mixing.mix(docs_).collect():
        want[r.doc_id, r.source] += r.copies
    got = Counter((r.doc_id, r.source) for r in corpus_pipeline.mix_sources(spark, docs_, SMALL).collect())
    assert got == +want and want[None, "a"] % 150


def test_pipeline_stages_with_null_and_repeated_ids(spark):
    """Null ids and clashing columns through the stages that join on ids."""
    rng = np.random.default_rng(13)
    long = " ".join(stretch(rng, 60))
    item = common.table(spark, SMALL, "benchmark").orderBy("item_id").first().text
    rows = [(5, long), (3, long + " more"), (None, long + " again"), (None, "alone here"), (None, "alone here"), (None, f"x {item} y"), (8, f"z {item}"), (8, "clean text"), (9, None), (None, "")]
    docs_ = spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, 4, 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, copies int, id int, variant int, size int")
    left = corpus_pipeline.drop_near_duplicates(spark, docs_, SMALL)
    assert left.columns == docs_.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(3, long + " more"), (None, "alone here"), (8, f"z {item}"), (8, "clean text"), (9, None)] + [(None, f"x {item} y")])
    clean = corpus_pipeline.drop_contaminated(spark, docs_, SMALL)
    assert clean.columns == docs_.columns and Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r in rows if item not in (r[1] or ""))
    mixed = corpus_pipeline.mix_sources(spark, docs_, SMALL)
    assert mixed.columns == docs_.columns and {r.doc_id for r in mixed.collect()} <= {i for i, _ in rows}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_.where("false"), SMALL).count() == 0, name


def test_recall_by_similarity(spark):
    """Pairs of two documents by bands of similarity: at least 0.99 of those at 0.8 or more fall into one group."""
    rng, texts, alike = np.random.default_rng(14), [], []
    for _ in range(300):
        w = stretch(rng, int(rng.integers(40, 200)))
        v = list(w)
        for at in rng.integers(0, len(w), int(rng.integers(0, max(2, len(w) // 40)))):
            v[at] = f"new{rng.integers(0, 10**9)}"
        a, b = (set(zip(*(x[j:] for j in range(5)), strict=False)) for x in (w, v))
        texts += [" ".join(w), " ".join(v)]
        alike.append(len(a & b) / len(a | b))
    group = {r.id: r.component_id for r in simhash.similar_groups(docs(spark, *texts)).collect()}
    met = np.array([group[2 * k] == group[2 * k + 1] for k in range(300)])
    alike = np.array(alike)
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1.01)):
        band = (alike >= low) & (alike < high)
        assert band.sum() > 15 and met[band].mean() >= 0.99, (low, met[band].mean())
    assert not met[alike < 0.8].any()


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs_ = common.table(spark, SMALL, "documents")
    columns, seen = docs_.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs_, SMALL).write.parquet(f"{tmp_path}/{k}")
        before, docs_ = docs_, spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs_.count()
        if name == "quality":
            labels = {r.doc_id: r.quality for r in common.table(spark, SMALL, "labels").collect()}
            kept = {r.doc_id for r in docs_.collect()}
            assert np.mean([(i in kept) == q for i, q in labels.items()]) > 0.9
        elif name == "near_dedup":
            rows = {r.doc_id: set(zip(*(r.text.lower().split()[j:] for j in range(5)), strict=False)) or {r.text} for r in before.collect()}
            kept = {r.doc_id for r in docs_.collect()}
            alike = lambda a, b: len(rows[a] & rows[b]) >= 0.8 * len(rows[a] | rows[b])
            ids = sorted(rows)
            assert all(i in kept or any(alike(i, j) for j in ids if j < i) for i in ids)
            assert sum(alike(i, j) for i in kept for j in kept if i < j) <= 1
        elif name == "decontamination":
            bad = {r.doc_id for r in decontaminate.contaminated(before, common.table(spark, SMALL, "benchmark")).collect()}
            assert {r.doc_id for r in docs_.collect()} == {r.doc_id for r in before.collect()} - bad
        elif name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert Counter(r.doc_id for r in docs_.collect()) == {k: v for k, v in copies.items() if v}
        if name != "token_files":
            assert docs_.columns == columns
    assert seen["token_files"] == seen["mixing"] > 0
