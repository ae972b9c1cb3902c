"""Personal data: added spans against a plain Python version, odd addresses, and texts with very many numbers."""

import math
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common, private_data, queries
from tests.conftest import SMALL
from tests.llm.test_llm import docs

pytest.importorskip("public_tokenizers")

LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]+)+",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[0-9_-]*[A-Za-z])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{16,}",
}
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, v):
    d = re.sub("[^0-9]", "", v)
    luhn = len(d) < 30 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(d[::-1])) % 10 == 0
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def votes(kind, v, before, after):
    digits, cue = re.sub("[^0-9]", "", v), private_data.CUES[kind]
    if kind == "email":
        g = int(re.sub("[^A-Za-z0-9.]", ".", v).rsplit(".", 1)[-1].lower() in private_data.DOMAINS)
    elif kind == "ip":
        g = -1 if re.match(r"(0|255)\.", v) else 0 if re.match(r"(10|127|192\.168)\.", v) else 1
    elif kind == "card":
        g = 1 if re.match("4|5[1-5]|2[2-7]|3[47]|6(011|5)", digits) else -1
    elif kind == "secret":
        g = int(bool(re.fullmatch(f"[0-9a-f]+|[0-9A-F]+|{private_data.PREFIXES}.+", v)))
    else:
        g = 1 if re.match(r"\+(1|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])", v) else -1 if v[0] == "+" else 0
    glued = re.search(r"[^\W]$|[_/]$", before) or re.match(r"\w", after) or kind != "secret" and (re.search('["=]$', before) or after == '"')
    c = -1 if glued else int(bool(re.search(cue, before.lower())))
    return g, c, ("s" if re.search(r"[ ().-]", v) else "-") + ("d" if 7 <= len(digits) <= 19 else "-")


def brute(texts):
    """For each text its base spans and the added ones."""
    pools = []
    for t in texts:
        pool = []
        for looser, patterns in ((False, BASE), (True, LOOSE)):
            for kind, p in patterns.items():
                end, last = 0, ""
                found = re.finditer(p, t or "")
                for m in found:
                    gap = t[end : m.start()]
                    before = last[-1:] if not gap else gap[-private_data.CONTEXT :]
                    good = not looser and passes(kind, m.group())
                    test = 1 if good else -1
                    if looser:
                        test = 0 if kind != "secret" else 1 if re.search("([0-9]+[A-Za-z]+){3}", m.group()) else -1
                    pool.append((kind, m.start(), m.end(), good, test, *votes(kind, m.group(), before, t[m.end() : m.end() + 1])))
                    end, last = m.end(), m.group()
        pools.append(pool)
    odds = {}
    for kind in (*private_data.KINDS, "secret"):
        own = Counter((x[4:7], x[7]) for pool in pools for x in pool if x[0] == kind)
        counts = Counter()
        for (v, _), n in own.items():
            counts[v] += n
        post = private_data.reliabilities(sorted((v, float(n)) for v, n in counts.items()))
        total, mass = [1.0, 1.0], defaultdict(lambda: [0.5, 0.5])
        for (v, shape), n in own.items():
            for side, m in enumerate((post[v], 1 - post[v])):
                total[side] += m * n
                for f in (*enumerate(v), (3, shape)):
                    mass[f][side] += m * n
        odds[kind] = lambda x, total=total, mass=mass: math.log(total[0] / total[1]) + sum(
            math.log(mass[f][0] / total[0]) - math.log(mass[f][1] / total[1]) for f in (*enumerate(x[4:7]), (3, x[7]))
        )
    for pool in pools:
        base = [x for x in pool if x[3]]
        added = [x[:3] for x in pool if not x[3] and x[4] >= 0 and odds[x[0]](x) >= 0 and all(b[2] <= x[1] or x[2] <= b[1] for b in base)]
        yield [x[:3] for x in base], sorted(added)


def test_added_spans_are_brute_force(spark):
    texts = [r.text for r in common.table(spark, SMALL, "documents").collect()]
    texts += ["mail me: ann (at) example [dot] org now", "call (555) 123-4567 or 555.123.4567, mail bob[at]x.de", "token = \"0a1b2c3d4e5f60718293\"", "card 4539148803436468 a@b.cd", "+49 (555) 123-4567", None, ""] * 3
    got = {r.doc_id: r for r in private_data.private_spans(docs(spark, *texts)).collect()}
    some = 0
    for k, (base, added) in enumerate(brute(texts)):
        assert [tuple(x) for x in got[k].base] == base and [tuple(x) for x in got[k].added] == added, texts[k]
        some += len(added)
    assert some > 10


def test_added_spans_are_planted_ones(spark):
    """Of what is added in the given documents, all are credentials that follow their name."""
    table = common.table(spark, "/root/testdata/sf0.1", "documents")
    text = {r.doc_id: r.text for r in table.collect()}
    added = [(r.doc_id, x) for r in private_data.private_spans(table).collect() for x in r.added]
    right = [bool(re.search(r"(?i)(password=|token = \")$", text[k][: x.start]) or text[k][x.start :].startswith("AKIA")) for k, x in added]
    planted = sum(len(re.findall(r"(?i)password=[0-9a-f]{16,}|token = \"[0-9a-f]{16,}|AKIA[0-9A-Z]{12,}", t)) for t in text.values())
    assert len(added) > 100 and sum(right) >= 0.95 * len(added) and sum(right) >= 0.9 * planted


def test_zero_parts_of_addresses(spark):
    texts = ["10.0.0.1", "0.0.0.0 and 00.000.0.256", "at 1.02.003.255, 1.2.3.0256"]
    got = {r.doc_id: r for r in private_data.private_spans(docs(spark, *texts)).select("doc_id", F.expr(private_data.written("base")).alias("b")).collect()}
    assert [got[k].b for k in range(3)] == ["ip:0:8", "ip:0:7", "ip:3:15"]


def test_many_numbers_in_one_text(spark):
    many = 200_000
    text = " ".join(f"1.2.3.{k % 256}" for k in range(many))
    began = time.time()
    row = private_data.private_spans(docs(spark, text)).select(F.size("base").alias("n"), F.expr("base[199999].stop").alias("stop")).first()
    assert (row.n, row.stop) == (many, len(text))
    assert time.time() - began < 120


def test_empty_and_repeated_rows(spark):
    same = spark.createDataFrame([(None, "a@b.cd")] * 3 + [(1, None)], "doc_id long, text string")
    rows = private_data.private_spans(same).collect()
    assert sorted(len(r.base) for r in rows) == [0, 1, 1, 1]
    assert queries.QUERIES["op6_private"] and private_data.private_spans(same.where("false")).count() == 0
