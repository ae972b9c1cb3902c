"""Queries on derivations along a series, and on selections of rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import periods as P
from ledgerline.operators import breaks as B
from ledgerline.operators import series as S
from ledgerline.plans.joins import AGO, PREV
from ledgerline.plans.registry import query
from ledgerline.plans.sql import BLOCKED

PRIOR = f"+ p AS (SELECT a.*, b.ytd AS before FROM obs a LEFT JOIN obs b ON a.series_id = b.series_id AND b.period = {PREV.format(a='a')})"
SHOCKS = ("1999-05", "2000-02")


@query("single_from_ytd", PRIOR + " SELECT series_id, period, CASE WHEN span = 2 THEN ytd ELSE ytd - before END AS single FROM p")
def _(x):
    return S.single_from_ytd(x.obs).select("series_id", "period", "single")


@query("single_from_ytd_legacy", PRIOR + " SELECT series_id, period, CASE WHEN span = 2 THEN ytd ELSE ytd - COALESCE(before, 0) END AS single FROM p")
def _(x):
    return S.single_from_ytd(x.obs, missing_as_zero=True).select("series_id", "period", "single")


@query("ytd_cumulate", "SELECT series_id, period, CAST(SUM(CAST(m AS DECIMAL(28,2))) OVER (PARTITION BY series_id, substr(period, 1, 4) ORDER BY period) AS DOUBLE) AS cumulated FROM obs")
def _(x):
    return S.ytd_cumulate(x.obs).select("series_id", "period", "cumulated")


@query("computed_yoy", f"SELECT a.series_id, a.period, ROUND((a.m / NULLIF(b.m, 0) - 1) * 100, 1) AS yoy FROM obs a LEFT JOIN obs b ON a.series_id = b.series_id AND a.span = b.span AND b.period = {AGO.format(a='a')}")
def _(x):
    return S.computed_yoy(x.obs).select("series_id", "period", "yoy")


@query("share_yoy_pp", f"""+ t AS (SELECT period, span, SUM(CAST(m AS DECIMAL(28,2)))::DOUBLE AS total FROM obs WHERE series_id LIKE 'mkt-%' GROUP BY 1, 2), s AS (SELECT series_id, period, o.span, m / total * 100 AS share FROM obs o JOIN t USING (period) WHERE series_id LIKE 'mkt-%')
  SELECT a.series_id, a.period, ROUND(a.share, 2) AS share, ROUND(a.share - b.share, 2) AS change FROM s a LEFT JOIN s b ON a.series_id = b.series_id AND a.span = b.span AND b.period = {AGO.format(a='a')}""")
def _(x):
    rows = x.obs.where("series_id LIKE 'mkt-%'")
    total = rows.groupBy("period").agg(F.sum(F.col("m").cast("decimal(28,2)")).cast("double").alias("total"))
    rows = rows.join(total, "period").withColumn("share", F.col("m") / F.col("total") * 100)
    rows = S.year_ago(rows.select("series_id", "period", "span", "share"), {"share": "before"})
    return rows.select("series_id", "period", F.round("share", 2).alias("share"), F.round(F.col("share") - F.col("before"), 2).alias("change"))


@query("index_to_pct", "SELECT series_id, period, ROUND((100 + m_yoy) - 100, 1) AS pct FROM obs WHERE m_yoy IS NOT NULL")
def _(x):
    return x.obs.where("m_yoy IS NOT NULL").select("series_id", "period", F.round((F.col("m_yoy") + 100) - 100, 1).alias("pct"))


RESOLVED = f"""+ c AS (SELECT o.*, k.headline = 'ytd' AS cum, lag(o.period) OVER (PARTITION BY o.series_id ORDER BY o.period) AS last FROM obs o JOIN catalog k USING (series_id)),
  t AS (SELECT *, CASE WHEN span = 2 THEN {AGO.format(a='c')} WHEN cum THEN {PREV.format(a='c')} ELSE last END AS target FROM c),
  r AS (SELECT t.*, b.period AS cand FROM t LEFT JOIN obs b ON b.series_id = t.series_id AND b.period = t.target AND (t.span <> 2 OR b.span = 2)),
  res AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM breaks k WHERE k.series_id = r.series_id AND k.no_yoy_across AND r.cand < k.effective AND k.effective <= r.period) THEN NULL ELSE cand END AS prev FROM r)"""


def resolved(x):
    rows = x.obs.join(x.catalog.select("series_id", (F.col("headline") == "ytd").alias("cum")), "series_id")
    return S.resolve_prev(rows, x.breaks, F.col("cum"))


@query("resolve_prev", RESOLVED + " SELECT series_id, period, prev FROM res")
def _(x):
    return resolved(x).select("series_id", "period", "prev")


#: The rate of the headline caliber, null where a break blocks it; rates of the row and of the one it compares to.
RATES = RESOLVED + f""", y AS (SELECT o.series_id, o.period, CASE WHEN {BLOCKED.format(a='o', p='period')} THEN NULL WHEN k.headline = 'ytd' THEN o.ytd_yoy ELSE o.m_yoy END AS rate, {BLOCKED.format(a='o', p='period')} AS blocked FROM obs o JOIN catalog k USING (series_id)),
  pair AS (SELECT r.series_id, r.period, r.prev, a.rate AS y, b.rate AS yp, b.blocked AS prev_blocked FROM res r JOIN y a USING (series_id, period) LEFT JOIN y b ON b.series_id = r.series_id AND b.period = r.prev)"""


def rates(x):
    """(series_id, period, span, m, ytd, headline, prev, y, yp, prev_blocked)."""
    rows = B.blocked(x.obs.join(x.catalog.select("series_id", "headline"), "series_id"), x.breaks)
    rows = rows.withColumn("y", F.when(~F.col("blocked"), F.when(F.col("headline") == "ytd", F.col("ytd_yoy")).otherwise(F.col("m_yoy"))))
    rows = S.resolve_prev(rows, x.breaks, F.col("headline") == "ytd")
    return S.with_other(rows, F.col("prev"), {"y": "yp", "m": "pm", "ytd": "pytd", "blocked": "prev_blocked"})


@query("break_first", RATES + " SELECT series_id, period, yp IS NULL AND prev IS NOT NULL AND COALESCE(prev_blocked, FALSE) AS first_after_break FROM pair WHERE y IS NOT NULL")
def _(x):
    first = F.col("yp").isNull() & F.col("prev").isNotNull() & F.coalesce("prev_blocked", F.lit(False))
    return rates(x).where("y IS NOT NULL").select("series_id", "period", first.alias("first_after_break"))


@query("delta_pp", RATES + " SELECT series_id, period, ROUND(y - yp, 6) AS delta, CASE WHEN y - yp > 1e-7 THEN 'up' WHEN y - yp < -1e-7 THEN 'down' WHEN y - yp IS NOT NULL THEN 'flat' END AS direction FROM pair")
def _(x):
    d = F.round(F.col("y") - F.col("yp"), 6)
    return rates(x).select("series_id", "period", d.alias("delta"), F.when(d > 0, "up").when(d < 0, "down").when(d == 0, "flat").alias("direction"))


@query("yoy_series_gapped", f"SELECT series_id, period, CASE WHEN {BLOCKED.format(a='o', p='period')} THEN NULL ELSE m_yoy END AS yoy FROM obs o")
def _(x):
    return B.blocked(x.obs, x.breaks).select("series_id", "period", F.when(~F.col("blocked"), F.col("m_yoy")).alias("yoy"))


@query("streak_sign", """+ s AS (SELECT series_id, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS n, m_yoy < 0 AS neg FROM obs), e AS (SELECT series_id, COALESCE(MIN(n) FILTER (WHERE neg IS NOT TRUE), MAX(n) + 1) - 1 AS run FROM s GROUP BY 1)
  SELECT series_id, CAST(CASE WHEN run >= 2 THEN run ELSE 0 END AS BIGINT) AS run FROM e""")
def _(x):
    return S.trailing_run(x.obs, F.when(F.col("m_yoy") < 0, "negative"), 2).select("series_id", "run")


@query("streak_delta", f"""+ b AS (SELECT series_id, period, CASE WHEN {BLOCKED.format(a='o', p='period')} THEN NULL ELSE m_yoy END AS y FROM obs o),
  d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS n, ROUND(y - lag(y) OVER w, 6) AS d, y > 0 AND lag(y) OVER w > 0 AS both_up FROM b WINDOW w AS (PARTITION BY series_id ORDER BY period)),
  s AS (SELECT *, CASE WHEN y < 0 THEN 'negative' END AS neg, CASE WHEN both_up AND d > 0 THEN 'accel' WHEN both_up AND d < 0 THEN 'decel' END AS mv FROM d),
  l AS (SELECT series_id, neg AS neg1, mv AS mv1 FROM s WHERE n = 1),
  r AS (SELECT s.series_id, COALESCE(MIN(n) FILTER (WHERE neg IS NULL), MAX(n) + 1) - 1 AS nrun, CASE WHEN ANY_VALUE(mv1) IS NULL THEN 0 ELSE COALESCE(MIN(n) FILTER (WHERE mv IS DISTINCT FROM mv1), MAX(n) + 1) - 1 END AS mrun, ANY_VALUE(mv1) AS mv1 FROM s JOIN l USING (series_id) GROUP BY 1)
  SELECT series_id, CASE WHEN nrun >= 2 THEN 'negative' WHEN mrun >= 2 THEN mv1 ELSE 'none' END AS kind, CAST(CASE WHEN nrun >= 2 THEN nrun WHEN mrun >= 2 THEN mrun ELSE 0 END AS BIGINT) AS run FROM r""")
def _(x):
    return S.rate_streaks(x.obs, x.breaks)


@query("streak_level", """+ d AS (SELECT series_id, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS n, SIGN(ROUND(m - lag(m) OVER (PARTITION BY series_id ORDER BY period), 6)) AS s FROM obs), l AS (SELECT series_id, s AS s1 FROM d WHERE n = 1),
  r AS (SELECT d.series_id, ANY_VALUE(s1) AS s1, COALESCE(MIN(n) FILTER (WHERE s IS DISTINCT FROM s1 OR s = 0 OR s IS NULL), MAX(n) + 1) - 1 AS run FROM d JOIN l USING (series_id) GROUP BY 1)
  SELECT series_id, CAST(CASE WHEN run >= 3 THEN run ELSE 0 END AS BIGINT) AS run, CASE WHEN run >= 3 THEN CASE WHEN s1 > 0 THEN 'up' ELSE 'down' END END AS state FROM r""")
def _(x):
    return S.level_streaks(x.obs)


@query("seasonal_cohort_change", "SELECT series_id, period, ROUND(LN(m) - LN(lag(m) OVER (PARTITION BY series_id, CASE WHEN span = 2 THEN 'jan_feb' ELSE substr(period, 6, 2) END ORDER BY period)), 8) AS change FROM obs")
def _(x):
    return S.cohort_change(x.obs).select("series_id", "period", F.round("change", 8).alias("change"))


@query("trailing_median_12", "SELECT series_id, period, CASE WHEN COUNT(m) OVER w >= 3 THEN ROUND(quantile_cont(ABS(m), 0.5) OVER w, 4) END AS median FROM obs WHERE span = 1 WINDOW w AS (PARTITION BY series_id ORDER BY period ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)")
def _(x):
    return S.trailing_median(x.obs).select("series_id", "period", F.round("median", 4).alias("median"))


@query("history_before", f"""+ t AS (SELECT series_id, MAX(period) AS period FROM release GROUP BY 1)
  SELECT t.series_id, t.period, COUNT(*) AS n, MIN(h.m_yoy) AS low, MAX(h.m_yoy) AS high FROM t JOIN obs h ON h.series_id = t.series_id AND h.period < t.period WHERE h.m_yoy IS NOT NULL AND h.period NOT IN {SHOCKS} AND NOT {BLOCKED.format(a='h', p='period')} GROUP BY 1, 2""")
def _(x):
    touched = x.release.groupBy("series_id").agg(F.max("period").alias("at"))
    return history(x, touched).groupBy("series_id", F.col("at").alias("period")).agg(F.count("*").alias("n"), F.min("m_yoy").alias("low"), F.max("m_yoy").alias("high"))


def history(x, touched):
    """Rates before each touched period `at`, without shocks and blocked windows."""
    past = B.blocked(x.obs.where(F.col("m_yoy").isNotNull() & ~F.col("period").isin(*SHOCKS)), x.breaks).where("NOT blocked")
    return touched.join(past.select("series_id", "period", "m_yoy"), "series_id").where("period < at")


@query("period_sequence", """+ e AS (SELECT series_id, MIN(period) AS a, MAX(period) AS b FROM obs GROUP BY 1) SELECT series_id, (CAST(substr(b, 1, 4) AS INT) - CAST(substr(a, 1, 4) AS INT)) * 12 + CAST(substr(b, 6, 2) AS INT) - CAST(substr(a, 6, 2) AS INT) AS steps,
  strftime(CAST(b || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS next, strftime(CAST(b || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m') AS back FROM e""")
def _(x):
    ends = x.obs.groupBy("series_id").agg(F.min("period").alias("a"), F.max("period").alias("b"))
    return ends.select("series_id", P.steps_between("a", "b").alias("steps"), P.next_period("b").alias("next"), P.shift("b", -2).alias("back"))


@query("seam_neighbours", "SELECT k.series_id, k.effective, MAX(o.period) FILTER (WHERE o.period < k.effective) AS before, MIN(o.period) FILTER (WHERE o.period >= k.effective) AS after FROM breaks k JOIN obs o USING (series_id) GROUP BY 1, 2")
def _(x):
    return B.seam_neighbours(x.obs, x.breaks)


@query("dedupe_first_wins", "SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS period, MIN(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2", pre=False)
def _(x):
    rows = x.table("orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"), "o_orderkey")
    return rows.groupBy("o_custkey", "period").agg(F.min("o_orderkey").alias("o_orderkey"))


@query("stale_reserve", """+ d AS (SELECT series_id, unnest([period, substr(period, 1, 4) || '-13']) AS period, m, ytd, m_yoy, ytd_yoy FROM obs WHERE period LIKE '%-12' UNION ALL SELECT series_id, period, m, ytd, m_yoy, ytd_yoy FROM obs WHERE period NOT LIKE '%-12'),
  l AS (SELECT series_id, period, m, lag(m) OVER w AS a, ytd, lag(ytd) OVER w AS b, m_yoy, lag(m_yoy) OVER w AS c, ytd_yoy, lag(ytd_yoy) OVER w AS e FROM d WINDOW w AS (PARTITION BY series_id ORDER BY period)),
  s AS (SELECT series_id, period, (m = a IS NOT NULL)::INT + (ytd = b IS NOT NULL)::INT + (m_yoy = c IS NOT NULL)::INT + (ytd_yoy = e IS NOT NULL)::INT AS shared, COALESCE((m = a)::INT, 0) + COALESCE((ytd = b)::INT, 0) + COALESCE((m_yoy = c)::INT, 0) + COALESCE((ytd_yoy = e)::INT, 0) AS same FROM l)
  SELECT series_id, period, shared FROM s WHERE shared >= 2 AND shared = same""")
def _(x):
    december = F.col("period").like("%-12")
    again = x.obs.where(december).withColumn("period", F.concat(F.substring("period", 1, 4), F.lit("-13")))
    return S.stale(x.obs.union(again)).select("series_id", "period", "shared")


# --- selections -------------------------------------------------------------------------------------------------------


@query("touched_scope", """+ r AS (SELECT DISTINCT series_id, period FROM release WHERE series_id LIKE 'nat-%' AND period >= '2001-06'), a AS (SELECT series_id, MAX(period) AS period FROM obs WHERE series_id NOT IN (SELECT series_id FROM r) GROUP BY 1)
  SELECT o.series_id, o.period, o.m FROM obs o WHERE (series_id, period) IN (SELECT series_id, period FROM r UNION ALL SELECT series_id, period FROM a)""")
def _(x):
    touched = x.release.where("series_id LIKE 'nat-%' AND period >= '2001-06'").select("series_id", "period").distinct()
    rest = x.obs.join(touched.select("series_id").distinct(), "series_id", "left_anti").groupBy("series_id").agg(F.max("period").alias("period"))
    return x.obs.join(touched.union(rest), ["series_id", "period"], "left_semi").select("series_id", "period", "m")


@query("measure_block", f"SELECT series_id, period, m, ytd, CASE WHEN b THEN NULL ELSE m_yoy END AS m_yoy, CASE WHEN b THEN NULL ELSE ytd_yoy END AS ytd_yoy FROM (SELECT o.*, {BLOCKED.format(a='o', p='period')} AS b FROM obs o)")
def _(x):
    keep = lambda c: F.when(~F.col("blocked"), F.col(c)).alias(c)
    return B.blocked(x.obs, x.breaks).select("series_id", "period", "m", "ytd", keep("m_yoy"), keep("ytd_yoy"))


@query("range_years_filter", """+ l AS (SELECT series_id, CAST(substr(period, 1, 4) AS INT) * 12 + CAST(substr(period, 6, 2) AS INT) AS o, period, m_yoy FROM obs), e AS (SELECT *, MAX(CASE WHEN m_yoy IS NOT NULL THEN o END) OVER (PARTITION BY series_id) AS e FROM l)
  SELECT series_id, y AS years, COUNT(*) AS n, MIN(period) AS first FROM e, (VALUES (1), (3), (5), (10)) t(y) WHERE e - o BETWEEN 0 AND 12 * y GROUP BY 1, 2""")
def _(x):
    o = P.period_ordinal("period")
    rows = x.obs.withColumn("back", F.max(F.when(F.col("m_yoy").isNotNull(), o)).over(Window.partitionBy("series_id")) - o)
    rows = rows.withColumn("years", F.explode(F.array(*map(F.lit, (1, 3, 5, 10)))))
    return rows.where("back BETWEEN 0 AND 12 * years").groupBy("series_id", "years").agg(F.count("*").alias("n"), F.min("period").alias("first"))


@query("spark_tail", "SELECT series_id, array_to_string(list(period ORDER BY period), ',') AS periods, list(m ORDER BY period)[1] AS first, list(m ORDER BY period)[-1] AS last FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS n FROM obs) WHERE n <= 24 GROUP BY 1")
def _(x):
    return tail(x.obs, 24).select("series_id", F.array_join(F.transform("tail", lambda t: t["period"]), ",").alias("periods"), F.element_at("tail", 1)["m"].alias("first"), F.element_at("tail", -1)["m"].alias("last"))


def tail(rows, many, value="m", key="series_id"):
    """(key, tail): the last `many` rows of each key in order."""
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col("period").desc()))).where(F.col("_n") <= many)
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("period", value))).alias("tail"))


@query("primary_lane", """+ l AS (SELECT series_id, period, m, CASE WHEN series_id LIKE 'nat-1%' THEN NULL ELSE m_yoy END AS y FROM obs), h AS (SELECT *, COUNT(y) OVER (PARTITION BY series_id) > 0 AS has FROM l)
  SELECT series_id, period, CASE WHEN has THEN 'yoy' ELSE 'level' END AS kind, CASE WHEN has THEN y ELSE m END AS value FROM h""")
def _(x):
    rows = x.obs.withColumn("_y", F.when(~F.col("series_id").like("nat-1%"), F.col("m_yoy")))
    has = F.count("_y").over(Window.partitionBy("series_id")) > 0
    return rows.select("series_id", "period", F.when(has, "yoy").otherwise("level").alias("kind"), F.when(has, F.col("_y")).otherwise(F.col("m")).alias("value"))


@query("name_filter", "SELECT series_id, name FROM catalog WHERE contains(name, '1')")
def _(x):
    return x.catalog.where(F.contains("name", F.lit("1"))).select("series_id", "name")


@query("tile_projection", "SELECT series_id, section, name, headline FROM catalog WHERE tier = 1")
def _(x):
    return x.catalog.where("tier = 1").select("series_id", "section", "name", "headline")


@query("tier_partition", "SELECT section, COUNT(*) FILTER (WHERE tier = 1) AS tier1, COUNT(*) FILTER (WHERE tier = 2) AS tier2, COUNT(*) FILTER (WHERE tier = 3) AS tier3 FROM catalog GROUP BY 1")
def _(x):
    n = lambda t: F.count(F.when(F.col("tier") == t, 1)).alias(f"tier{t}")
    return x.catalog.groupBy("section").agg(n(1), n(2), n(3))


@query("recent_revisions", """+ r AS (SELECT o.series_id, o.period, CASE WHEN o.period LIKE '%-03' THEN 'n/a' WHEN o.period LIKE '%-04' THEN NULL ELSE '2001-' || substr(o.period, 6, 2) || '-15' END AS revised_on FROM obs o JOIN old q USING (series_id, period) WHERE o.m <> q.m)
  SELECT series_id, period, revised_on FROM r WHERE TRY_CAST(revised_on AS DATE) >= DATE '2001-10-01' - INTERVAL 90 DAY""")
def _(x):
    old = x.old.select("series_id", "period", F.col("m").alias("before"))
    day = F.when(F.col("period").like("%-03"), "n/a").when(~F.col("period").like("%-04"), F.concat(F.lit("2001-"), F.substring("period", 6, 2), F.lit("-15")))
    rows = x.obs.join(old, ["series_id", "period"]).where("m <> before").select("series_id", "period", day.alias("revised_on"))
    return rows.where(F.col("revised_on").try_cast("date") >= F.date_sub(F.lit("2001-10-01").cast("date"), 90))
