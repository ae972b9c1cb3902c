"""Values in archived pages, pages of a source, statistics in prose and tables: against the rules written out plainly."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import archive as A
from ledgerline.operators import extract as E
from ledgerline.plans import registry
from ledgerline.sources.bind import Model
from tests.conftest import SMALL

FALLS = ("负增长", "下降", "下跌", "下滑", "降至", "回落", "减少", "亏损", "负", "-", "－", "−")


def plain(text: str) -> str | None:
    return None if text in ("", "0", "-0") else text


def ways(value: float) -> list[tuple[str, str]]:
    out = []
    for name, factor in (("1x", 1.0), ("wan_yi_1e4", 10000.0)):
        v = value / factor
        fixed = lambda n, x=v: f"{x:.{n}f}".rstrip("0").rstrip(".")
        found = {f"{v:g}" if "e" not in f"{v:g}" else None, plain(fixed(1)), plain(fixed(2))}
        if abs(v - round(v)) < 1e-6 or abs(v) >= 1000:
            found.add(str(int(round(v))))
        if v < 0:
            size = f"{-v:g}"
            found |= set() if "e" in size else {f"下降{size}", f"负{size}"}
            found |= { f"下降{fixed(1, -v)}" if plain(fixed(1, -v)) else None}
        out += [(name, t) for t in sorted((t for t in found if t), key=lambda t: (-len(t), t))]
    return out


def falls_before(text: str, at: int) -> bool:
    clause = re.split("[，。；！？、\n]", text[max(0, at - 12) : at])[-1]
    return any(w in clause for w in FALLS)


def looked_up(text: str, value: float) -> tuple[int, str, str] | None:
    for scale, way in ways(value):
        for m in re.finditer(f"(?={re.escape(way)})", text):
            if value <= 0 or not falls_before(text, m.start()):
                return m.start() + 1, scale, way
    return None


VALUES = [0.0, 0.6, -0.6, 3.14, 12.0, -12.0, 105.25, 1234.0, 20000.0, 353670.0, 5530000.0, -5530000.0, 0.04, -0.04, 99999.5, 123456.0, 1e6, 17.5, 0.00012]


def test_renderings(spark):
    got = spark.createDataFrame([(v,) for v in VALUES], "v double").select("v", A.renderings(F.col("v")).alias("w")).collect()
    for row in got:
        assert [(w["scale"], w["text"]) for w in row.w] == ways(row.v), row.v


def test_values_in_texts(spark):
    r = random.Random(3)
    parts = ["增长", "下降", "，", "。", "比上月", "回落", "0.6", "3.14%", "12", "-12", "下降0.6", "负12", "1234", "353.67", "553", "降幅", "abc", "、", "1.05", "负增长"]
    rows = [("".join(r.choice(parts) for _ in range(r.randint(1, 12))), r.choice(VALUES)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "t string, v double")
    got = df.select("t", "v", A.found_in(F.col("t"), F.col("v"), A.renderings(F.col("v"))).alias("h")).collect()
    for row in got:
        assert (None if row.h is None else (row.h["at"], row.h["scale"], row.h["text"])) == looked_up(row.t, row.v), row
    assert sum(row.h is not None for row in got) > 100


def test_mentions_are_first_places(spark):
    r = random.Random(8)
    texts = [(k, f"p{k}", None, None, "".join(r.choice("abcde") for _ in range(r.choice((0, 2, 30, 400))))) for k in range(60)]
    labels = ["a", "ab", "abc", "deab", "ccccc", "edcba", "zz", ""]
    df = spark.createDataFrame(texts, "page_id long, name string, filed string, year int, text string")
    got = {(x.label, x.page_id): x.place for x in A.mentions(df, spark.createDataFrame([(x,) for x in labels], "label string")).collect()}
    assert got == {(label, t[0]): t[4].find(label) + 1 for label in labels if label for t in texts if label in t[4]}


def test_pages_of_a_source(spark):
    names = ["2001-05-15_a.html", "2001-05-15.b", "2001-05_c", "2003-01-02_d", "page-e", "2000-11-30_f"]
    pages = A.page_texts(spark.createDataFrame([(k, n, "x") for k, n in enumerate(names)], "page_id long, name string, html string"))
    facts = spark.createDataFrame([("rel:20010515", "2001-04"), ("rel:20010516", "2001-04"), ("natdata:1", "2002-03"), (None, "1999-12"), ("legacy", "odd"), (" rel:20030102 ", "2002-12")], "src string, period string")
    got = {}
    for x in A.pages_of(facts, pages.select("page_id", "filed", "year")).collect():
        got.setdefault((x.src, x.period), {})[x.page_id] = x.near
    assert {k: sorted(v) for k, v in got.items()} == {
        ("rel:20010515", "2001-04"): [0, 1], ("natdata:1", "2002-03"): [0, 1, 2, 3, 4], (None, "1999-12"): [4, 5], ("legacy", "odd"): [0, 1, 2, 3, 4, 5], (" rel:20030102 ", "2002-12"): [3],
    }
    assert got[("rel:20010515", "2001-04")][0] == 15 and got[("natdata:1", "2002-03")][4] is None


def test_look_up_states(spark):
    html = "<p>甲业总额 1,234.5 亿元，同比下降 0.6%。</p><p>乙业总额 353.67 万亿元</p>"
    pages = spark.createDataFrame([(1, "2001-05-15_a", html), (2, "2001-06-15_b", "<p>丙业总额 7</p>")], "page_id long, name string, html string")
    facts = [("f1", "a", 1234.5), ("f2", "a", 0.6), ("f3", "a", -0.6), ("f4", "b", 3536700.0), ("f5", "c", 7.0), ("f6", "d", 1.0), ("f7", "a", 99.0)]
    df = spark.createDataFrame([(f, s, "2001-04", v, "rel:20010515") for f, s, v in facts], "fact string, series_id string, period string, value double, src string")
    labels = spark.createDataFrame([("a", 1, "甲业 总额"), ("b", 1, "乙业总额"), ("c", 1, "丙业总额")], "series_id string, nth int, label string")
    got = {x.fact: (x.state, x.scale) for x in A.look_up(df, labels, pages).collect()}
    assert got == {"f1": ("verified", "1x"), "f2": ("mismatch", None), "f3": ("verified", "1x"), "f4": ("verified", "wan_yi_1e4"), "f5": ("gap", None), "f6": ("unverifiable", None), "f7": ("mismatch", None)}
    found = A.look_up(df, labels, pages).where("fact = 'f4'").first()
    assert "353.67" in found.evidence and found.page_id == 1


def test_prose(spark):
    text = "2024年1-2月，……其中,快递业务量完成232.6亿件，同比增长28.5%。2月份，……其中，快递业务量累计完成300.0亿件（注1），同比增长1.0%，其中快递业务量完成85.6亿件，同比下降6.2%（可比）。其中快递业务量完成1.0亿件，同比增长9.0%。"
    texts = spark.createDataFrame([(1, text), (2, "其中快递业务量完成1亿件，同比增长2%"), (3, None), (4, "")], "page_id long, text string")
    got = {(x.page_id, x.measure): x.value for x in E.prose(texts, (("快递业务量", "亿件"),)).collect()}
    assert got == {(1, "ytd"): 232.6, (1, "ytd_yoy"): 28.5, (1, "m"): 85.6, (1, "m_yoy"): -6.2}


def test_nearest_marker(spark):
    r = random.Random(2)
    texts = [(k, "".join(r.choice(["x", "MM", "kk", "T", " "]) for _ in range(40))) for k in range(40)]
    df = spark.createDataFrame(texts, "page_id long, text string")
    got = {(x.page_id, x.nth): x.kind for x in E.nearest_marker(df, "T", (("MM", "m"), ("kk", "k"))).collect()}
    want = {}
    for k, t in texts:
        for n, hit in enumerate(re.finditer("T", t)):
            marks = [m.group() for m in re.finditer("MM|kk", t) if m.end() <= hit.start()]
            want[(k, n)] = {"MM": "m", "kk": "k"}[marks[-1]] if marks else None
    assert got == want


@pytest.mark.parametrize("least", [3, 4])
def test_city_tables(spark, least):
    cells = ["<th rowspan=2>城市</th>", "<th colspan=2>环比</th>", "<td>甲 市</td><td>100.1</td><td>99</td><td>1,000</td>", "<td>乙市</td><td>69.9</td><td>99</td><td>100</td>", "<td>甲市</td><td>120</td><td>99</td><td>1</td>", "<td>丙市</td><td>130</td><td>150</td><td>100</td>", "<td>丁市</td><td>70</td><td>50</td><td>100</td>"]
    html = "<table>" + "".join(f"<tr>{c}</tr>" for c in cells) + "</table><table></table>"
    got = [tuple(x) for x in E.city_tables(spark.createDataFrame([(1, html)], "page_id long, html string"), least).orderBy("nth").collect()]
    assert got == ([(1, 0, 0, "甲市", 100.1, 99.0), (1, 0, 1, "丙市", 130.0, 150.0), (1, 0, 2, "丁市", 70.0, 50.0)] if least == 3 else [])


def test_pages_of_a_source_are_found_without_their_texts(spark, monkeypatch):
    """Only what pages are filed as is joined, so what a task holds doesn't go with the pages."""
    kept, held = [], Model.held
    monkeypatch.setattr(Model, "held", lambda self, df: kept.append(df.columns) or held(self, df))
    registry.queries()["pages_for_src"](spark, SMALL).count()
    assert kept and not any({"html", "text"} & set(columns) for columns in kept)


def test_grams_of_texts_are_thinned_where_they_are_made(spark):
    """Every place of a text, of characters of any width, without a shuffle of all grams."""
    text = "ab😀零售额" * 2
    texts = spark.createDataFrame([(1, text), (2, "")], "page_id int, text string")
    labels = spark.createDataFrame([("😀零售",), ("额a",)], "label string").repartition(2)
    index = A.gram_index(texts, labels)
    assert "SortMergeJoin" not in index._jdf.queryExecution().sparkPlan().toString()
    want = {(g, 1, k + 1) for g in ("😀零售", "额a") for k in range(len(text)) if text.startswith(g, k)}
    assert set(map(tuple, index.collect())) == want


def test_lookups_are_dealt_by_their_number(spark):
    """Pairs of facts and pages are dealt over tasks by their number, which few bytes may hold."""
    kept = []
    pages = spark.createDataFrame([(k, f"2001-02-15_{k}.html", f"<p>甲总额{k}</p>") for k in range(40)], "page_id int, name string, html string")
    facts = spark.createDataFrame([("f", "a", "2001-01", 7.0, None)], "fact string, series_id string, period string, value double, src string")
    labels = spark.createDataFrame([("a", 1, "甲总额")], "series_id string, nth int, label string")
    out = A.look_up(facts, labels, pages, lambda df: kept.append(df) or df.checkpoint())
    assert [(r["state"], r["page_id"]) for r in out.collect()] == [("verified", 7)]
    close = next(df for df in kept if df.columns == ["fact", "page_id", "scale", "evidence"])
    assert "REPARTITION_BY_NUM" in close._jdf.queryExecution().sparkPlan().toString()
