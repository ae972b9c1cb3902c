"""Stores, ingest by family, trees of digests, strata and sweeps over breaks."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import breaks as B
from ledgerline.operators import merkle as M
from ledgerline.operators import sample as Z
from ledgerline.sources import store as T
from ledgerline.streaming import ingest as I

CELL = "series_id string, period string, measure string, value double"


def test_a_publication_writes_what_changed(spark, tmp_path):
    root, docs = str(tmp_path), lambda *rows: spark.createDataFrame(rows, "document string, body string")
    T.publish(spark, docs(("a", "one\nline"), ("b", "two"), ("c", "two")), root, "1")
    wrote = {r.document: r.written for r in T.publish(spark, docs(("a", "one\nline"), ("b", "new"), ("c", "two")), root, "2").collect()}
    assert wrote == {"a": False, "b": True, "c": False}
    assert len([p for p in (tmp_path / "objects").iterdir() if p.is_dir()]) == 3
    assert {r.document: r.body for r in T.read(spark, root).collect()} == {"a": "one\nline", "b": "new", "c": "two"}
    assert [r.body for r in T.read(spark, root, "b").collect()] == ["new"]
    # A publication that got no further than its manifest is not seen.
    docs(("a", "half")).write.parquet(f"{root}/staged/3")
    assert {r.body for r in T.read(spark, root, "a").collect()} == {"one\nline"}
    assert T.read(spark, str(tmp_path / "none")).count() == 0


def test_families_stand_alone(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda *r: spark.createDataFrame(r, CELL)

    def broken():
        raise RuntimeError("no answer")

    def torn():
        return rows(("t", "2025-01", "m", 1.0)).withColumn("value", F.raise_error(F.lit("half way")).cast("double"))

    good, bad = rows(("a", "2025-01", "m", 1.0)), rows(("b", "2025-01", "m", 1.0), ("b", "2025-02", "m", -1.0))
    state = I.take(spark, {"x": lambda: good, "y": lambda: bad, "z": broken, "t": torn}, root, "r1")
    assert {k: v.split(":")[0] for k, v in state.items()} == {"x": "taken", "y": "blocked", "z": "failed", "t": "failed"}
    assert [tuple(r) for r in I.newest(spark, root).collect()] == [("a", "2025-01", "m", 1.0)]
    state = I.take(spark, {"y": lambda: rows(("b", "2025-01", "m", 5.0)), "x": lambda: rows(("a", "2025-01", "m", 2.0), ("a", "2024-12", "m", 3.0))}, root, "r2")
    assert set(state.values()) == {"taken"}
    I.pack(spark, root)
    I.take(spark, {"x": lambda: rows(("a", "2025-01", "m", 4.0))}, root, "r3")
    I.pack(spark, root)
    want = {("a", "2024-12"): 3.0, ("a", "2025-01"): 4.0, ("b", "2025-01"): 5.0}
    assert {(r.series_id, r.period): r.value for r in I.newest(spark, root).collect()} == want
    assert sorted((r.release, r.old, r.new) for r in I.revisions(spark, root).collect()) == [("r2", 1.0, 2.0), ("r3", 2.0, 4.0)]
    assert [r.name for r in I._commits(spark, root, "r2").collect()] == ["r1"]


def test_trees_find_what_differs(spark, tmp_path):
    r = random.Random(1)
    rows = [(f"s{k % 40}", f"{k}", r.random()) for k in range(3000)]
    other = [x for x in rows if x[1] != "17"] + [("s1", "new", 1.0)]
    other[100] = (*other[100][:2], -1.0)
    other.append(other[50])
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = lambda rows: spark.createDataFrame(rows, "series_id string, period string, v double")
    assert M.write(df(rows), ["series_id", "period"], a) == M.depth_for(3000) == 2
    M.write(df(other).repartition(7), ["series_id", "period"], b, 2)
    got = sorted((x.period, x.side) for x in M.diff(spark, a, b).collect())
    assert got == sorted([("17", "missing"), ("new", "extra"), (other[100][1], "missing"), (other[100][1], "extra"), (other[50][1], "extra")])
    assert M.differing(spark, a, b).count() <= 4 and M.rows_of(spark, a, b)[0].count() < 200
    M.write(df(rows[::-1]), ["series_id", "period"], b, 2)
    assert M.differing(spark, a, b).count() == 0 and M.diff(spark, a, b).count() == 0


def test_sweeps_agree_with_joins(spark):
    r = random.Random(6)
    month = lambda: f"20{r.randint(10, 14)}-{r.randint(1, 12):02d}"
    breaks = spark.createDataFrame([(r.choice("abc"), month(), r.random() < 0.8, month() if r.random() < 0.7 else None) for _ in range(60)], "series_id string, effective string, no_yoy_across boolean, yoy_valid_from string")
    rows = spark.createDataFrame([(r.choice("abcd"), month(), month() if r.random() < 0.9 else None) for _ in range(400)], "series_id string, period string, prior string").distinct()
    one = lambda df, c: sorted(map(str, df.select("series_id", "period", "prior", c).collect()))
    assert one(B.blocked_by_sweep(rows, breaks), "blocked") == one(B.blocked(rows, breaks), "blocked")
    assert one(B.seam_by_sweep(rows, breaks, "prior"), "seam") == one(B.seam_between(rows, breaks, "prior"), "seam")
    windows = breaks.where("yoy_valid_from > effective").select("series_id", "effective", "yoy_valid_from").distinct()
    points = [(x.series_id, x.period) for x in rows.select("series_id", "period").collect()]
    for w in B.rows_within(windows, rows, "effective", "yoy_valid_from", "n").collect():
        assert w.n == sum(s == w.series_id and w.effective <= p < w.yoy_valid_from for s, p in points)


def test_smallest_hashes(spark):
    rows = spark.createDataFrame([("g" if k % 50 else "h", f"s{k}", "2025-01", "single") for k in range(5000)], "grp string, series_id string, period string, caliber string")
    got = Z.smallest(rows, "grp", 70, "x")
    hashed = rows.withColumn("h", Z.hash_of("x")).collect()
    for g, n in (("g", 70), ("h", 70)):
        want = sorted((x.h, x.series_id) for x in hashed if x.grp == g)[:n]
        assert {x.series_id for x in got.where(F.col("grp") == g).collect()} == {s for _, s in want}
