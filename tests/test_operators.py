import ast
import json
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import audit as A
from ledgerline.operators import breaks as B
from ledgerline.operators import gates as K
from ledgerline.operators import merge as G
from ledgerline.operators import publish as U
from ledgerline.operators import series as S
from ledgerline.sources import readers as R
from ledgerline.sources.bind import BREAK_SCHEMA
from ledgerline.streaming import ingest as I

OBS = "series_id string, period string, span int, m double, ytd double, m_yoy double, ytd_yoy double"
CELL = "series_id string, period string, measure string, value double"


def obs(spark, *rows):
    return spark.createDataFrame([("a", *r) if len(r) == 6 else r for r in rows], OBS)


def breaks(spark, *rows):
    return spark.createDataFrame([("a", *r, None, None) for r in rows], BREAK_SCHEMA)


def test_single_from_ytd_keeps_to_the_calendar(spark):
    rows = obs(spark, ("2025-02", 2, 30.0, 30.0, None, None), ("2025-03", 1, None, 50.0, None, None), ("2025-05", 1, None, 90.0, None, None))
    assert {r.period: r.single for r in S.single_from_ytd(rows).collect()} == {"2025-02": 30.0, "2025-03": 20.0, "2025-05": None}
    assert {r.period: r.single for r in S.single_from_ytd(rows, missing_as_zero=True).collect()}["2025-05"] == 90.0


def test_previous_period(spark):
    rows = obs(spark, ("2024-02", 2, 1.0, 1.0, 1.0, 1.0), ("2024-12", 1, 1.0, 9.0, 1.0, 1.0), ("2025-02", 2, 1.0, 1.0, 1.0, 1.0), ("2025-03", 1, 1.0, 2.0, 1.0, 1.0), ("2025-05", 1, 1.0, 4.0, 1.0, 1.0))
    none = spark.createDataFrame([], BREAK_SCHEMA)
    got = {r.period: r.prev for r in S.resolve_prev(rows, none, F.lit(False)).collect()}
    assert got == {"2024-02": None, "2024-12": "2024-02", "2025-02": "2024-02", "2025-03": "2025-02", "2025-05": "2025-03"}
    got = {r.period: r.prev for r in S.resolve_prev(rows, none, F.lit(True)).collect()}
    assert got["2025-03"] == "2025-02" and got["2025-05"] is None
    walled = breaks(spark, ("2025-03", "rebase", True, None))
    assert {r.period: r.prev for r in S.resolve_prev(rows, walled, F.lit(False)).collect()}["2025-03"] is None


def test_windows_are_half_open(spark):
    rows = obs(spark, *[(p, 1, 1.0, 1.0, 1.0, 1.0) for p in ("2025-01", "2025-02", "2025-03", "2025-04")])
    marked = lambda *b: [r.period for r in B.blocked(rows, breaks(spark, *b)).where("blocked").orderBy("period").collect()]
    assert marked(("2025-02", "x", True, "2025-04")) == ["2025-02", "2025-03"]
    assert marked(("2025-02", "x", True, "2025-02")) == []
    assert marked(("2025-03", "x", True, None)) == ["2025-03", "2025-04"]
    assert marked(("2025-01", "x", False, None)) == []


def test_streaks(spark):
    rows = obs(spark, *[(f"2025-{k + 3:02d}", 1, m, m, y, y) for k, (m, y) in enumerate([(1.0, 5.0), (2.0, -1.0), (3.0, -2.0), (4.0, -0.5)])])
    none = spark.createDataFrame([], BREAK_SCHEMA)
    assert [tuple(r) for r in S.rate_streaks(rows, none).collect()] == [("a", "negative", 3)]
    assert [tuple(r) for r in S.level_streaks(rows).collect()] == [("a", 3, "up")]
    stopped = rows.withColumn("m_yoy", F.when(F.col("period") != "2025-05", F.col("m_yoy")))
    assert S.rate_streaks(stopped, none).first()["run"] == 0


def test_merge_is_idempotent_and_logs(spark):
    old = spark.createDataFrame([("a", "2025-01", "m", 1.0), ("a", "2025-02", "m", 2.0), ("a", "2025-02", "ytd", 3.0)], CELL)
    new = spark.createDataFrame([("a", "2025-02", "m", 2.5), ("a", "2025-01", "ytd", 1.0), ("a", "2025-03", "m", 4.0), ("a", "2025-02", "ytd", 3.0)], CELL)
    assert {(r.period, r.measure): r["class"] for r in G.classify(old, new).collect()} == {("2025-02", "m"): "revise", ("2025-01", "ytd"): "first_print", ("2025-03", "m"): "insert", ("2025-02", "ytd"): "noop"}
    after = G.merged(old, new)
    assert after.count() == 5
    assert G.classify(after, new).where("class <> 'noop'").count() == 0


def test_rows_of_one_cell_apply_in_order(spark):
    old = spark.createDataFrame([("a", "2025-01", "m", 1.0)], CELL)
    rows = spark.createDataFrame([("a", "2025-01", "m", 2, 3.0), ("a", "2025-01", "m", 1, 2.0)], "series_id string, period string, measure string, row_no int, value double")
    assert [(r.row_no, r.old, r.new) for r in G.in_order(old, rows).orderBy("row_no").collect()] == [(1, 1.0, 2.0), (2, 2.0, 3.0)]


def test_as_published(spark):
    now = spark.createDataFrame([("a", "2025-01", "m", 3.0), ("a", "2025-02", "m", 9.0)], CELL)
    log = spark.createDataFrame([("a", "2025-01", "m", 1.0, 2.0, "2025-03-01", 1), ("a", "2025-01", "m", 2.0, 3.0, "2025-05-01", 2)], "series_id string, period string, measure string, old double, new double, revised_on string, seq int")
    at = lambda day: {r.period: r.value for r in G.as_published(now, log, day).collect()}
    assert at("2025-02-01") == {"2025-01": 1.0, "2025-02": 9.0}
    assert at("2025-04-01")["2025-01"] == 2.0 and at("2025-06-01")["2025-01"] == 3.0


def clean(spark):
    rows, ytd = [], 0.0
    for k in range(36):
        y, mo = 2023 + k // 12, k % 12 + 1
        ytd = 100.0 + mo if mo == 1 else ytd + 100.0 + mo
        rows.append((f"{y}-{mo:02d}", 1, 100.0 + mo, ytd, 0.0 if k >= 12 else None, 0.0 if k >= 12 else None))
    return obs(spark, *rows)


def test_each_fault_is_caught_by_its_check_and_clean_data_passes(spark):
    rows, none = clean(spark), spark.createDataFrame([], BREAK_SCHEMA)
    new = rows.where("period >= '2025-06'")
    checks = {
        "bounds": lambda d: K.bounds(d), "monotonic": lambda d: K.monotonic(d.withColumn("place", F.col("period"))), "unit_slip": lambda d: K.unit_slip(d.where("period >= '2025-06'"), d),
        "ytd_arithmetic": lambda d: K.ytd_arithmetic(d, new), "yoy_base": lambda d: K.yoy_base(d, none), "schema": lambda d: K.schema(d),
        "break_no_yoy": lambda d: K.break_no_yoy(d, breaks(spark, ("2022-01", "x", True, "2022-06"))),
    }
    assert {k: f(rows).count() for k, f in checks.items()} == dict.fromkeys(checks, 0)
    at = lambda c, v: rows.withColumn(c, F.when(F.col("period") == "2025-08", v).otherwise(F.col(c)))
    faults = {"unit_slip": at("m", F.col("m") * 10000), "bounds": at("m", -F.col("m")), "ytd_arithmetic": at("ytd", F.col("ytd") * 1.5), "yoy_base": at("m_yoy", F.lit(60.0)), "schema": at("period", F.lit("2025-13")), "monotonic": at("span", F.lit(2))}
    for check, data in faults.items():
        assert checks[check](data).count() > 0, check
    assert K.break_no_yoy(rows, breaks(spark, ("2025-01", "x", True, "2025-03"))).where("check_id = 'break_no_yoy'").count() == 2


def test_raw_lines_break_the_rule_that_they_break(spark):
    lines = {
        "good": '{"id": "a", "period": "2025-01", "m": 1.5}', "object": "oops", "required": '{"id": "a", "period": "2025-01", "m": null}', "unknown": '{"id": "a", "period": "2025-01", "m": 1, "x": 1}',
        "type": '{"id": 7, "period": "2025-01", "m": 1}', "choice": '{"id": "a", "period": "2025-01", "m": 1, "span": 3}', "limits": '{"id": "a", "period": "2025-01", "m": -1}', "period": '{"id": "a", "period": "2025-13", "m": 1}',
    }
    df = spark.createDataFrame([(k, "p", v) for k, v in lines.items()], "series_id string, period string, line string")
    found = K.schema_of_lines(df, ("id", "period", "m"), {"id": "text", "period": "text", "m": "number", "span": "number"}, {"span": (1, 2)}, {"m": (0.0, 1e9)})
    assert {(r["series_id"], r["check_id"]) for r in found.collect()} == {(k, f"schema.{k}") for k in lines if k != "good"}


def test_seasons_stand_in_for_rates(spark):
    level = {2018: 100.0, 2019: 110.0, 2020: 120.0, 2021: 133.0, 2022: 145.0, 2023: 160.0}
    rows = obs(spark, *((f"{y}-03", 1, v, None, None, None) for y, v in level.items()), ("2024-03", 1, 1000.0, None, None, None), ("2024-04", 1, 5.0, None, None, None))
    z = K.cohort_z(rows.where("period >= '2024'"), rows).collect()
    steps = np.diff(np.log(list(level.values())))
    mad = np.median(np.abs(steps - np.median(steps)))
    assert [r["period"] for r in z] == ["2024-03"]
    assert abs(z[0]["z"] - (np.log(1000 / 160) - np.median(steps)) / (1.4826 * mad)) < 1e-6
    none = spark.createDataFrame([], "series_id string, at string, m_yoy double")
    judge = lambda least, sure=None: [tuple(r)[1::2] for r in K.seasonal_z(rows.where("period >= '2024'"), none, rows, confirmed=sure, least={"M": least}).collect()]
    assert judge(8) == [("BLOCK", "2024-03")]
    assert judge(8, rows) == [("WARN", "2024-03")]
    assert judge(9) == []


def test_calendar_steps_and_release_identity(spark):
    periods = lambda *rows: spark.createDataFrame(list(rows), "series_id string, period string")
    step = lambda new, last, known=(): [r["severity"] for r in K.calendar_step(periods(("a", new)), periods(("a", last)), known).collect()]
    assert [step("2025-03", last) for last in ("2025-02", "2025-01", "2024-12", "2025-03", "2025-05")] == [[], ["WARN"], ["BLOCK"], ["BLOCK"], ["BLOCK"]]
    assert step("2025-03", "2024-12", (("a", None, "calendar_step", ""),)) == ["WARN"]
    new = spark.createDataFrame([("a", "2025-01", "r1"), ("a", "2025-02", "r2"), ("a", "2025-03", "r3"), ("a", "2025-04", "r1")], "series_id string, period string, release string")
    manifests = spark.createDataFrame([("r1", "x"), ("r1", "y"), ("r2", "x"), ("r2", "z")], "release string, capture string")
    stale = obs(spark, ("2025-01", 1, 1.0, 2.0, None, None), ("2025-04", 1, 3.0, 4.0, None, None))
    sure = spark.createDataFrame([("a", "2025-01", "m", 1.0), ("a", "2025-01", "ytd", 2.0), ("a", "2025-04", "m", 3.0)], CELL)
    found = K.release_identity(new, manifests, spark.createDataFrame([("x",), ("y",)], "capture string"), stale, sure)
    assert {(r["check_id"], r["period"]) for r in found.collect()} == {("release_identity", "2025-02"), ("release_identity", "2025-03"), ("stale_reserve", "2025-04")}


def test_stated_numbers_and_runs(spark):
    rows = [("a", "同比增长 5.9%，增速较上月加快 0.8 个百分点，连续 3 个月加快", 3), ("b", "同比增长 6.9%，连续 3 个月加快", 3), ("c", "同比增长 5.9%，连续 4 个月加快", 3), ("d", "同比增长 5.9%", 3), ("e", "同比增长 5.9%，连续 24 个月以上加快", 30)]
    df = spark.createDataFrame(rows, "series_id string, sentence string, run int").selectExpr("*", "'2025-01' AS period", "5.9D AS y", "5.1D AS yp", "'accel' AS kind")
    assert {(r["series_id"], r["check_id"], r["status"]) for r in A.headline_numbers(df).collect()} == {("b", "headline_numbers", "block"), ("c", "headline_streak", "block"), ("d", "headline_streak", "warn")}


def test_labels_are_found_within_words(spark):
    names = spark.createDataFrame([(1, "pink rose"), (2, "inkpot ink"), (3, "x"), (4, ""), (5, None)], "k int, name string")
    labels = spark.createDataFrame([("ink",), ("nk ros",), ("x",), ("",), (None,), ("rosemary",)], "label string")
    assert sorted(tuple(r) for r in G.label_hits(labels, names, "name").select("k", "label").collect()) == [(1, "ink"), (1, "nk ros"), (2, "ink"), (3, "x")]


def test_stretches_of_names_are_not_sent_whole(spark):
    """Equal names are looked through once, and their stretches, which no estimate of size counts, go to no broadcast."""
    names = spark.createDataFrame([(k, "pink rose") for k in range(3000)], "id int, name string")
    hits = G.label_hits(spark.createDataFrame([(1, "k ros")], "k int, label string"), names, "name")
    plan = hits._jdf.queryExecution().sparkPlan().toString()
    assert hits.count() == 3000 and "SortMergeJoin [_w" in plan and plan.index("Generate") > plan.index("SortMergeJoin [_w")


def test_sentences(spark):
    rows = [(5.9, 5.1), (-1.0, 2.0), (1.0, -2.0), (-3.0, -4.0), (0.0, 1.0), (2.0, None), (2.0, 2.0)]
    df = spark.createDataFrame(rows, "y double, yp double")
    said = U.sentence(F.lit("2026 年 5 月"), F.lit("社会消费品零售总额"), F.lit("增长"), F.col("y"), F.col("yp"), F.lit("上月"), F.lit(False), F.lit(False))
    got = [r[0].removeprefix("2026 年 5 月社会消费品零售总额") for r in df.select(said).collect()]
    assert got == ["同比增长 5.9%，增速较上月加快 0.8 个百分点", "同比由升转降，下降 1.0%", "同比由降转升，增长 1.0%", "同比下降 3.0%，降幅较上月收窄 1.0 个百分点", "同比持平", "同比增长 2.0%", "同比增长 2.0%，与上月持平"]
    assert df.select(U.banned_words(F.lit("由于需求大幅增长"))).first()[0] == ["由于", "大幅"]


def test_documents_keep_absent_and_null_apart(spark, tmp_path):
    doc = {"id": "s", "observations": [{"period": "2025-01", "m": None, "ytd": 1.5}, {"period": "2025-02", "span": 2, "ytd": 2}], "breaks": [{"effective": "2025-01", "kind": "x", "no_yoy_across": True}]}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    (tmp_path / "bad.json").write_text('{"id": "t", nonsense')
    series, rows, _, found, skipped = R.read_series(spark, str(tmp_path))
    assert [(r.period, r.span, r.m, r.ytd, r.present) for r in rows.orderBy("period").collect()] == [("2025-01", 1, None, 1.5, ["m", "ytd"]), ("2025-02", 2, None, 2.0, ["ytd"])]
    assert series.count() == 1 and found.count() == 1 and skipped.count() == 1


def test_stream_takes_a_release_in_once(spark, tmp_path):
    source, root, mark = (str(tmp_path / k) for k in ("in", "state", "mark"))
    rows = [("a", "2025-01", "m", 1.0, "r1"), ("a", "2025-02", "m", 2.0, "r1")]
    spark.createDataFrame(rows, I.ROW).coalesce(1).write.json(source)
    I.start(spark, source, root, mark).awaitTermination()
    spark.createDataFrame([("a", "2025-02", "m", 2.5, "r2")], I.ROW).write.mode("append").json(source)
    I.start(spark, source, root, mark).awaitTermination()
    assert {r.period: r.value for r in I.newest(spark, root).collect()} == {"2025-01": 1.0, "2025-02": 2.5}
    taken, _ = I.ingest(spark, spark.createDataFrame([("a", "2025-03", "m", -1.0)], CELL), root, "snapshot-9")
    assert not taken and I.newest(spark, root).count() == 2
    assert [tuple(r)[1:] for r in I.revisions(spark, root).collect()] == [("a", "2025-02", "m", 1, 2.0, 2.5)]


def test_a_release_rewrites_the_years_it_touches_and_logs_every_step(spark, tmp_path):
    root = str(tmp_path)
    first = [("a", "2024-12", "m", 1.0, "r1"), ("a", "2025-01", "m", 2.0, "r1")]
    again = [("a", "2025-01", "m", 3.0, "r2"), ("a", "2025-01", "m", 4.0, "r3"), ("b", "2025-02", "m", 9.0, "r2")]
    for name, rows in (("s-1", first), ("s-2", again), ("s-2", again)):  # the second is repeated
        assert I.ingest(spark, spark.createDataFrame(rows, I.ROW), root, name)[0]
    assert {(r.series_id, r.period): r.value for r in I.newest(spark, root).collect()} == {("a", "2024-12"): 1.0, ("a", "2025-01"): 4.0, ("b", "2025-02"): 9.0}
    assert sorted(p.name for p in (tmp_path / "cells" / "s-2" / "part=all").iterdir() if p.is_dir()) == ["year=2025"]
    assert [tuple(r) for r in I.revisions(spark, root).orderBy("row_no").collect()] == [("s-2", "a", "2025-01", "m", 1, 2.0, 3.0), ("s-2", "a", "2025-01", "m", 2, 3.0, 4.0)]


def test_sentences_of_every_branch(spark):
    cases = [
        (3.0, 2.0, None, None, "", "2026 年 5 月某业同比增长 3.0%，增速较上月加快 1.0 个百分点"), (3.0, 2.0, None, 5, "", "1-5 月某业累计同比增长 3.0%，增速较 1-4 月加快 1.0 个百分点"),
        (3.0, 2.0, None, 2, "", "1-2 月某业累计同比增长 3.0%"), (-3.0, -2.0, None, None, "，连续 4 个月同比下降", "2026 年 5 月某业同比下降 3.0%，降幅较上月扩大 1.0 个百分点，连续 4 个月同比下降"),
        (5.3, 4.0, -0.2, None, "", "2026 年 5 月某业同比名义增长 5.3%，实际下降 0.2%"), (0.0, 1.0, None, None, "", "2026 年 5 月某业同比持平"),
    ]
    df = spark.createDataFrame([(y, yp, real, month, tail) for y, yp, real, month, tail, _ in cases], "y double, yp double, re double, month int, tail string")
    said = U.sentence(F.lit("2026 年 5 月"), F.lit("某业"), F.lit("增长"), F.col("y"), F.col("yp"), F.lit("上月"), F.lit(False), F.lit(False), F.col("tail"), F.col("re"), F.col("month"))
    assert [r[0] for r in df.select(said).collect()] == [c[-1] for c in cases]
    runs = spark.createDataFrame([("decel", 1), ("decel", 3), ("accel", 30), ("none", 5)], "kind string, run int")
    assert [r[0] for r in runs.select(U.streak_suffix(F.col("kind"), F.col("run"))).collect()] == ["", "，连续3 个月放缓", "，连续24 个月以上加快", ""]


def test_audit_stands_alone():
    tree = ast.parse(Path(A.__file__).read_text())
    names = [n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
    assert not [n for n in names if n and n.startswith("ledgerline")]


def test_nothing_outside_llm_imports_it():
    root = Path(A.__file__).parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert "ledgerline.llm" not in f.read_text(), f
