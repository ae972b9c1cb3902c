from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P
from ledgerline.functions import text as X


def one(spark, *cols, rows=((1,),), schema="a int"):
    return [tuple(r) for r in spark.createDataFrame(list(rows), schema).select(*cols).collect()]


def test_periods(spark):
    rows = [("2026-05",), ("2026-Q2",), ("2026",), ("2026-01",), ("x",)]
    got = one(spark, P.period_shape("p"), P.period_ordinal("p"), P.next_period("p"), P.prev_ytd_period("p"), P.year_ago_period("p"), P.encode_code("p"), rows=rows, schema="p string")
    assert got[0] == ("M", 24317, "2026-06", "2026-04", "2025-05", "202605MM")
    assert got[1] == ("Q", 24318, "2026-Q3", "2026-Q1", "2025-Q2", "202602SS")
    assert got[2] == ("A", 24324, "2027", None, "2025", "2026AA")
    assert got[3][3] is None
    assert got[4][0] is None


def test_codes_and_labels(spark):
    got = one(spark, P.decode_code("p"), rows=[("202605MM",), ("202602SS",), ("2026AA",), ("?",)], schema="p string")
    assert [r[0] for r in got] == ["2026-05", "2026-Q2", "2026", None]
    got = one(spark, P.period_label("p", F.col("y"), F.col("s")), rows=[("2026-05", False, 1), ("2026-02", False, 2), ("2026-05", True, 1), ("2026-Q2", False, 1), ("2026", False, 1)], schema="p string, y boolean, s int")
    assert [r[0] for r in got] == ["2026 年 5 月", "2026 年 1-2 月", "2026 年 1-5 月", "2026 年二季度", "2026 年全年"]


def test_steps(spark):
    got = one(spark, P.steps_between("a", "b"), P.months_between("a", "b"), rows=[("2025-11", "2026-02"), ("2025-Q4", "2026-Q2"), ("2025", "2026-Q1")], schema="a string, b string")
    assert got == [(3, 3), (2, 6), (None, 3)]


def test_numbers(spark):
    got = one(spark, N.decimal_places(F.col("v")), N.fmt_pct(F.col("v")), N.up_down_class(F.col("v")), rows=[(1.0,), (-2.35,), (0.0,), (None,)], schema="v double")
    assert got == [(0, "1.0%", "up"), (2, "2.35%", "down"), (0, "0.0%", "flat"), (None, None, "flat")]
    got = one(spark, N.robust_z(F.col("v"), F.lit(5.0), F.col("m")), rows=[(5.0, 0.0), (6.0, 0.0), (4.0, 0.0), (8.0, 1.0)], schema="v double, m double")
    assert [r[0] for r in got][:3] == [0.0, float("inf"), float("-inf")]
    got = one(spark, N.numeric(F.col("t")), rows=[("1,234.5",), ("-",), ("—",), (" 7 ",), ("x",)], schema="t string")
    assert [r[0] for r in got] == [1234.5, None, None, 7.0, None]
    got = one(spark, N.values_equal(F.lit(-0.0), F.lit(0.0)), N.rel_diff(F.lit(0.0), F.lit(0.0)))
    assert got == [(True, 0.0)]


def test_text(spark):
    got = one(spark, X.strip_html(F.col("h")), rows=[("<p>a&amp;b<script>var t=9</script>\n c</p>",), (None,)], schema="h string")
    assert [r[0] for r in got] == ["a&b c", None]
    assert one(spark, X.pangu_join(F.lit("制造业PMI为50.2")))[0][0] == "制造业 PMI 为 50.2"
    assert one(spark, X.slugify(F.lit(" A b/C! ")))[0][0] == "a-b-c"
    assert one(spark, X.direction_before(F.lit("其中出口下降3.2%"), F.lit(7)))[0][0] == -1
    assert one(spark, X.direction_before(F.lit("进口负增长3.2%"), F.lit(6)))[0][0] == -1 and one(spark, X.direction_before(F.lit("出口增长；进口3.2%"), F.lit(8)))[0][0] is None
    assert one(spark, N.to_number(F.lit("约 1,234.5 亿元")))[0][0] == 1234.5 and one(spark, N.to_number(F.lit(" — ")))[0][0] is None
    assert one(spark, N.nice_ticks(F.lit(0.0), F.lit(100.0)))[0][0] == [0.0, 50.0, 100.0] and one(spark, N.nice_ticks(F.lit(2), F.lit(2)))[0][0] == [1.0, 1.5, 2.0, 2.5, 3.0]


def test_titles(spark):
    t = F.col("t")
    rows = [("2026年5月份社会消费品零售总额",), ("2026年1-5月邮政行业运行情况",), ("2025年上半年居民收入和消费支出情况",), ("2025年财政收支情况",), ("2025年前三季度财政收支情况",), ("别的",)]
    got = one(spark, L.title_period_release(t), L.title_period_bulletin(t), L.title_period_income(t), L.title_period_fiscal(t), rows=rows, schema="t string")
    assert got[0][0] == "2026-05" and got[1][0] == got[1][1] == "2026-05" and got[2][1:3] == ("2025-06", "2025-06")
    assert got[3][1] == got[3][3] == "2025-12" and got[4][3] == "2025-09" and got[5] == (None, None, None, None)
    assert one(spark, L.title_period_inferred(F.lit("一季度居民收入和消费支出情况"), F.lit("2024-04-17")))[0][0] == "2024-03"


def test_labels(spark):
    assert one(spark, L.window_start(F.lit("指数(2016-2020)")), L.window_end(F.lit("指数(2021-)")), L.window_start(F.lit("指数"))) == [(2016, 2100, 1990)]
    assert one(spark, L.growth_pair(F.lit("下降5.3（4.1）")))[0][0] == (-5.3, 4.1)
    assert one(spark, L.make_src(F.lit("2026/05/17 10:00"), F.lit(""), F.lit("x")), L.src_indicator_id(F.lit("dg:ab12")), L.src_indicator_id(F.lit("rel:1"))) == [("rel:20260517", "ab12", None)]
    assert one(spark, L.agency_from_id(F.lit("pbc-m2")), L.agency_from_id(F.lit("x-y")), L.circled_numeral(F.lit(3)), L.circled_numeral(F.lit(21))) == [("中国人民银行", "官方数据", "③", "(21)")]
    assert one(spark, L.format_number(F.lit(-1234.56)), L.format_percent(F.lit(3.0), sign=True), L.format_pp(F.lit(-0.25)), L.format_number(F.lit(None).cast("double"))) == [("-1,234.56", "+3.0%", "0.25 个百分点", "—")]
    got = one(spark, L.rule_window(F.lit("2026-01"), F.lit(1), F.lit(9), F.lit(30)))[0][0]
    assert (str(got.opens), str(got.closes)) == ("2026-02-09", "2026-03-03")
    assert one(spark, L.tooltip_period(F.lit("2026-05"), F.lit(True)), L.tooltip_period(F.lit("2026-Q2"), F.lit(False)), L.decimals_for_step(F.lit(0.05))) == [("2026 年 1-5 月", "2026 年 2 季度", 2)]
    assert [str(r[0]) for r in one(spark, L.published_at(F.col("t")), rows=[("2026-5-7",), ("2026/05/07 10:30",), ("?",)], schema="t string")] == ["2026-05-07 00:00:00", "2026-05-07 10:30:00", "None"]
    assert one(spark, L.label_candidates(F.lit("a"), F.array(F.lit("b")), F.lit(None).cast("boolean")), L.severity_for_mismatch(F.lit("cflp"), F.lit(1)), L.level_to_tier(F.lit(4))) == [(["a", "b"], "warn", 2)]
