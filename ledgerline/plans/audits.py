"""Queries on the checks of what is published, with known faults in it."""

from pyspark.sql import functions as F

from ledgerline.operators import audit as A
from ledgerline.operators import breaks as B
from ledgerline.operators import merge as G
from ledgerline.operators import reduce as R
from ledgerline.operators import series as S
from ledgerline.plans.publishing import LAST, SENTENCE_SQL, entries, said
from ledgerline.plans.registry import query
from ledgerline.plans.sql import BLOCKED, SEAM
from ledgerline.plans.windows import PRIOR, rates
from ledgerline.sources.readers import aligned_arrays


@query("audit_bundle_source", """+ pub AS (SELECT series_id, CASE WHEN series_id = 'nat-8' THEN 'market' ELSE section END AS section FROM catalog WHERE series_id <> 'nat-9' UNION ALL SELECT 'nat-2', 'nation' UNION ALL SELECT 'ghost', 'nation'),
  p AS (SELECT series_id, COUNT(*) AS n, MIN(section) AS s FROM pub GROUP BY 1), j AS (SELECT COALESCE(c.series_id, p.series_id) AS series_id, c.section, p.n, p.s, COALESCE(c.series_id, p.series_id) = 'nat-6' AS off FROM catalog c FULL JOIN p ON c.series_id = p.series_id)
  SELECT series_id, CASE WHEN section IS NULL THEN 'stray' WHEN n IS NULL THEN 'unpublished' WHEN n > 1 THEN 'twice' WHEN s <> section THEN 'section' ELSE 'index' END AS problem FROM j WHERE section IS NULL OR n IS NULL OR n > 1 OR s <> section OR off""")
def _(x):
    c = x.catalog.select("series_id", "section")
    more = x.rows([("nat-2", "nation"), ("ghost", "nation")], "series_id string, section string")
    published = c.where("series_id <> 'nat-9'").withColumn("section", F.when(F.col("series_id") == "nat-8", "market").otherwise(F.col("section"))).union(more)
    return A.sources(c.where("series_id <> 'nat-6'"), published, c)


@query("audit_latest_anchor", """+ t AS (SELECT series_id, MAX(period) AS p, MAX(period) FILTER (WHERE period <= '2001-01') AS early, MAX(period) FILTER (WHERE period <= '2001-02') AS late FROM obs GROUP BY 1), f AS (SELECT t.*, unnest(['latest', 'yoy_series', 'level_series', 'freshness']) AS field FROM t),
  b AS (SELECT *, CASE WHEN field = 'latest' AND series_id LIKE 'nat-1%' THEN early WHEN field = 'yoy_series' AND series_id LIKE 'mkt-%' THEN NULL WHEN field = 'freshness' AND series_id = 'nat-5' THEN late ELSE p END AS period FROM f)
  SELECT 'latest_anchor.' || field AS check_id, 'block' AS status, series_id, period FROM b WHERE period IS DISTINCT FROM p""")
def _(x):
    """The ends of published arrays, and what the record and the index say of them; some nations lag in one of them, the segments' rates are empty."""
    kinds = x.catalog.select("series_id", "headline", (F.col("tier") < 3).alias("both"))
    arrays = aligned_arrays(B.blocked(x.obs, x.breaks).join(kinds, "series_id"))
    upto = lambda last: F.filter("periods", lambda p: p <= last)
    segment = F.col("series_id").like("mkt-%")
    ends = {
        "latest": F.when(F.col("series_id").like("nat-1%"), upto("2001-01")).otherwise(F.col("periods")), "yoy_series": F.transform(F.slice("yoy", 1, F.when(segment, 0).otherwise(F.size("yoy"))), lambda _, i: F.get("periods", i)),
        "level_series": F.transform("level", lambda _, i: F.get("periods", i)), "freshness": F.when(F.col("series_id") == "nat-5", upto("2001-02")).otherwise(F.col("periods")),
    }
    tails = arrays.select("series_id", F.inline(F.array(*(F.struct(F.lit(k).alias("field"), F.try_element_at(v, F.lit(-1)).alias("period")) for k, v in ends.items()))))
    return A.latest_anchor(tails, x.obs)


@query("audit_yoy_break_nulls", f"""+ b AS (SELECT series_id, period, m_yoy AS y, lag(period) OVER w AS prev, lag(m_yoy) OVER w AS yp FROM obs WINDOW w AS (PARTITION BY series_id ORDER BY period)) SELECT 'yoy_break_nulls' AS check_id, 'block' AS status, series_id, period FROM obs o WHERE m_yoy IS NOT NULL AND {BLOCKED.format(a='o', p='period')}
  UNION ALL SELECT 'yoy_break_nulls.latest', 'block', series_id, period FROM b WHERE y IS NOT NULL AND {BLOCKED.format(a='b', p='period')} UNION ALL SELECT 'yoy_break_nulls.prev', 'block', series_id, period FROM b WHERE yp IS NOT NULL AND {BLOCKED.format(a='b', p='prev')}
  UNION ALL SELECT 'yoy_break_nulls.seam', 'block', series_id, period FROM b WHERE {SEAM.format(a='b', p='period', q='b.prev')}""")
def _(x):
    """Rates as they come, and every row as a latest that compares to the row before, whatever lies between."""
    before = lambda c: F.expr(f"lag({c}) OVER (PARTITION BY series_id ORDER BY period)")
    blocks = x.obs.select("series_id", "period", F.col("m_yoy").alias("yoy"), before("period").alias("prev"), before("m_yoy").alias("prev_yoy"))
    return A.yoy_break_nulls(x.obs.select("series_id", "period", F.col("m_yoy").alias("yoy")), x.breaks, blocks)


@query("audit_prev", LAST + "SELECT 'previous' AS check_id, 'block' AS status, series_id, period FROM e WHERE series_id LIKE 'mkt-%' AND prev IS DISTINCT FROM '1999-01'")
def _(x):
    """All entries are right but the segments', which claim another period."""
    rows = entries(x).select("series_id", "period", "headline", (F.col("span") == 2).alias("merged"), F.when(F.col("series_id").like("mkt-%"), "1999-01").otherwise(F.col("prev")).alias("prev"))
    return A.previous(rows, x.obs, x.breaks)


@query("audit_headline_numbers", SENTENCE_SQL + """, told AS (SELECT b.series_id, b.period, said.kind, said.run, CASE WHEN series_id LIKE 'mkt-%' THEN replace(sentence, '%', '7%') WHEN series_id LIKE 'nat-1%' THEN replace(sentence, '连续 ', '连续 1') WHEN series_id LIKE 'nat-2%' THEN regexp_replace(sentence, '，连续.*$', '') ELSE sentence END AS text FROM b JOIN said USING (series_id))
  SELECT 'headline_numbers' AS check_id, 'block' AS status, series_id, period FROM told WHERE series_id LIKE 'mkt-%' AND contains(text, '%') UNION ALL SELECT 'headline_streak', 'block', series_id, period FROM told WHERE series_id LIKE 'nat-1%' AND contains(text, '连续') UNION ALL SELECT 'headline_streak', 'warn', series_id, period FROM told WHERE run >= 2 AND NOT contains(text, '连续')""")
def _(x):
    """The published sentences; the segments' rates have a digit too many, some nations' runs a wrong length, those of others no run."""
    rows = said(x, x.held(rates(x))).where("y IS NOT NULL")
    s, id_ = F.col("sentence"), F.col("series_id")
    text = F.when(id_.like("mkt-%"), F.replace(s, F.lit("%"), F.lit("7%"))).when(id_.like("nat-1%"), F.replace(s, F.lit("连续 "), F.lit("连续 1"))).when(id_.like("nat-2%"), F.regexp_replace(s, "，连续.*$", "")).otherwise(s)
    real = F.when(id_.like("nat-2%") & (id_ != "nat-2"), F.round(F.col("y") - 1.5, 1))
    return A.headline_numbers(x.held(rows.select("series_id", "period", "name", "y", "yp", "kind", "run", real.alias("real"), text.alias("sentence"))))


@query("audit_derived", """+ t AS (SELECT series_id, substr(period, 1, 4) AS y, period, span, ytd, CASE WHEN series_id = 'nat-7' THEN m * 1.01 WHEN series_id = 'nat-9' AND period LIKE '%-05' THEN NULL ELSE m END AS m FROM obs),
  j AS (SELECT a.series_id, a.period, a.m, CASE WHEN a.span = 2 OR a.period LIKE '%-01' THEN a.ytd ELSE a.ytd - b.ytd END AS v FROM t a LEFT JOIN t b ON b.series_id = a.series_id AND b.y = a.y AND CAST(substr(b.period, 6) AS INT) = CAST(substr(a.period, 6) AS INT) - 1)
  SELECT 'derived' AS check_id, 'block' AS status, series_id, period FROM j WHERE v IS NOT NULL AND (m IS NULL OR ABS(m - v) > GREATEST(1.0, ABS(v) * 0.002))""")
def _(x):
    """Published months against the differences of the year to date, taken by an own join; one nation is 1 % off, another lacks its Mays."""
    may = (F.col("series_id") == "nat-9") & F.col("period").like("%-05")
    published = x.obs.where(~may).select("series_id", "period", F.when(F.col("series_id") == "nat-7", F.col("m") * 1.01).otherwise(F.col("m")).alias("value"))
    place = (F.substring("period", 1, 4).cast("int") * 12 + F.substring("period", 6, 2).cast("int")).alias("place")
    now, before = x.obs.select("series_id", "period", "span", "ytd", place), x.obs.select("series_id", (place + 1).alias("place"), F.col("ytd").alias("before"))
    first = (F.col("span") == 2) | F.col("period").like("%-01")
    again = now.join(before, ["series_id", "place"], "left").select("series_id", "period", F.when(first, F.col("ytd")).otherwise(F.col("ytd") - F.col("before")).alias("value")).where("value IS NOT NULL")
    return A.derived(published.join(again.select("series_id", "period"), ["series_id", "period"], "left_semi"), again, F.greatest(F.lit(1.0), F.abs("_b") * 0.002))


@query("audit_derived_rules", """+ r AS (SELECT 'mean' AS rule, 'all-' || metric AS series_id, period, AVG(m) AS v FROM panel WHERE m IS NOT NULL GROUP BY 2, 3 UNION ALL SELECT 'count', 'up-' || metric, period, COUNT(*) FILTER (WHERE m > 0) FROM panel WHERE m IS NOT NULL GROUP BY 2, 3
    UNION ALL SELECT 'sum', 'total', period, SUM(m) FROM obs WHERE series_id LIKE 'mkt-%' GROUP BY 3 HAVING COUNT(*) = (SELECT COUNT(*) FROM catalog WHERE section = 'market') UNION ALL SELECT 'ratio', 'share', a.period, a.m / b.m * 100 FROM obs a JOIN obs b ON a.series_id = 'mkt-BUILDING' AND b.series_id = 'mkt-MACHINERY' AND a.period = b.period)
  SELECT 'derived.' || rule AS check_id, CASE WHEN series_id = 'total' AND period = '2000-09' THEN 'warn' ELSE 'block' END AS status, series_id, period FROM r WHERE (v <> 0 OR rule = 'mean') AND (substr(period, 6) = CASE rule WHEN 'mean' THEN '03' WHEN 'count' THEN '04' WHEN 'sum' THEN '09' ELSE '06' END OR (rule = 'ratio' AND period LIKE '%-07'))""")
def _(x):
    """Derived series as the operators give them, each rule off in a month of its own and ratios lacking in July, against sums and counts of the parts."""
    panel, segments = x.panel.where("m IS NOT NULL"), x.obs.where("series_id LIKE 'mkt-%'")
    series = lambda rows, rule, id_, value: rows.select(F.lit(rule).alias("rule"), id_.alias("series_id"), "period", value.cast("double").alias("value"))
    all_, up = F.concat(F.lit("all-"), "metric"), F.concat(F.lit("up-"), "metric")
    summed = G.sum_parts(segments, segments.select(F.lit("total").alias("total"), "series_id").distinct())
    part = lambda s: x.obs.where(F.col("series_id") == s)
    one, share = part("mkt-BUILDING"), G.ratio(part("mkt-BUILDING"), part("mkt-MACHINERY"), "m")
    published = (
        series(panel.groupBy("metric", "period").agg(F.avg("m").alias("v")), "mean", all_, F.col("v") + F.when(F.col("period").like("%-03"), 0.02).otherwise(0.0))
        .union(series(panel.groupBy("metric", "period").agg(F.count(F.when(F.col("m") > 0, 1)).alias("v")), "count", up, F.col("v") + F.when(F.col("period").like("%-04") & (F.col("v") != 0), 1).otherwise(0)))
        .union(series(summed, "sum", F.col("total"), F.col("summed") * F.when(F.col("period").like("%-09"), 1.01).otherwise(1.0)))
        .union(series(share.where("period NOT LIKE '%-07'"), "ratio", F.lit("share"), F.col("ratio") * F.when(F.col("period").like("%-06"), 103).otherwise(100)))
    )
    n = panel.groupBy("metric", "period").agg(F.sum("m").alias("s"), F.sum(F.lit(1)).alias("n"), F.sum((F.col("m") > 0).cast("int")).alias("up"))
    need = x.catalog.where("section = 'market'").agg(F.count("*").alias("need"))
    whole = segments.groupBy("period").agg(F.sum("m").alias("v"), F.count("*").alias("n")).join(F.broadcast(need), F.col("n") == F.col("need"))
    two = one.select("period", F.col("m").alias("a")).union(part("mkt-MACHINERY").select("period", (-F.col("m")).alias("a"))).groupBy("period").agg(F.max("a").alias("a"), F.min("a").alias("b"), F.count("*").alias("n")).where("n = 2")
    again = (
        series(n, "mean", all_, F.col("s") / F.col("n")).union(series(n, "count", up, F.col("up"))).union(series(whole, "sum", F.lit("total"), F.col("v"))).union(series(two, "ratio", F.lit("share"), -F.col("a") / F.col("b") * 100))
    )
    return A.derived_rules(published, again, (("total", "2000-09"),))


@query("audit_freshness", LAST + """SELECT 'freshness' AS check_id, 'warn' AS status, series_id, period FROM e WHERE tier = 1 AND date_diff('day', last_day(CAST(period || '-01' AS DATE)), DATE '2001-10-20') > CASE WHEN name < 'F' THEN 30 ELSE 120 END
  UNION ALL SELECT 'freshness.generated_at', 'warn', series_id, n FROM (SELECT 'nat-' || c_nationkey AS series_id, MAX(o_orderdate) AS b, strftime(MAX(o_orderdate) FILTER (WHERE c_nationkey % 3 <> 0 OR o_orderdate < DATE '2001-01-01'), '%Y-%m-%dT%H:%M:%SZ') AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) WHERE strptime(n, '%Y-%m-%dT%H:%M:%SZ') + CASE WHEN series_id LIKE '%1' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END <= b""")
def _(x):
    """Entries that are late, and nations whose index, generated at their last order, is no newer than the one before; some are an hour newer."""
    budgets = x.catalog.select("series_id", F.when(F.col("name") < "F", 30).otherwise(120).alias("days"))
    late = A.freshness(entries(x).select("series_id", "period", "tier"), budgets, "2001-10-20")
    customer = x.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = x.table("orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("at")).join(customer, "o_custkey")
    seen = (F.col("c_nationkey") % 3 != 0) | (F.col("at") < F.lit("2001-01-01").cast("timestamp"))
    runs = orders.groupBy(F.concat(F.lit("nat-"), "c_nationkey").alias("series_id")).agg(F.max("at").alias("b"), F.max(F.when(seen, F.col("at"))).alias("n"))
    hour = F.when(F.col("series_id").endswith("1"), F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    found = A.advanced(runs.select("series_id", stamp(F.col("b") - hour).alias("generated_at")), runs.select("series_id", stamp(F.col("n")).alias("generated_at")))
    return late.union(found)


@query("audit_determinism", """+ b AS (SELECT series_id, period, CASE WHEN series_id = 'nat-5' THEN m + 1 ELSE m END AS m, ytd FROM obs WHERE NOT (series_id = 'nat-6' AND period LIKE '%-07'))
  SELECT series_id, period, 'missing' AS side FROM (SELECT series_id, period, m, ytd FROM obs EXCEPT ALL SELECT * FROM b) UNION ALL SELECT series_id, period, 'extra' FROM (SELECT * FROM b EXCEPT ALL SELECT series_id, period, m, ytd FROM obs)""")
def _(x):
    """A second build from raw cells by another way, of which one nation is off by 1 and another lacks its Julys."""
    month, joint = F.substring("period", 6, 2), (F.col("period") >= "1998") & F.substring("period", 6, 2).isin("01", "02")
    months = x.cells.select(F.explode(F.array(F.concat(F.lit("mkt-"), "seg"), F.concat(F.lit("nat-"), "nat"))).alias("series_id"), F.substring("period", 1, 4).alias("y"), F.when(joint, "02").otherwise(month).alias("mo"), "v")
    totals = months.groupBy("series_id", "y", "mo").agg(F.sum("v").alias("v"))
    year = totals.groupBy("series_id", "y").agg(F.collect_list(F.struct("mo", "v")).alias("all"))
    upto = lambda row: F.aggregate(F.filter("all", lambda o: o["mo"] <= row["mo"]), F.lit(0).cast("decimal(38,2)"), lambda t, o: (t + o["v"]).cast("decimal(38,2)"))
    again = year.select("series_id", "y", F.explode(F.transform("all", lambda row: F.struct(row["mo"].alias("mo"), row["v"].cast("double").alias("m"), upto(row).cast("double").alias("ytd")))).alias("r"))
    again = again.select("series_id", F.concat_ws("-", "y", "r.mo").alias("period"), "r.m", "r.ytd").where("NOT (series_id = 'nat-6' AND period LIKE '%-07')")
    return A.determinism(x.obs, again.withColumn("m", F.when(F.col("series_id") == "nat-5", F.col("m") + 1).otherwise(F.col("m"))))


@query("city_raw_table_check", "SELECT entity, metric, COUNT(*) AS n, COUNT(*) FILTER (WHERE period LIKE '%-06') AS off FROM panel WHERE m IS NOT NULL GROUP BY 1, 2")
def _(x):
    """Published changes against index numbers of the raw table, which are off in June."""
    raw = x.panel.select("entity", "metric", "period", (F.col("m") + 100 + F.when(F.col("period").like("%-06"), 1).otherwise(0)).alias("index"))
    both = x.panel.where("m IS NOT NULL").join(raw, ["entity", "metric", "period"])
    return both.groupBy("entity", "metric").agg(F.count("*").alias("n"), F.count(F.when(F.abs(F.col("m") - (F.col("index") - 100)) > 0.06, 1)).alias("off"))


@query("cumulative_diff", PRIOR + " SELECT series_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE ABS(ytd - before - m) > 0.05) AS off FROM p WHERE before IS NOT NULL AND span = 1 GROUP BY 1")
def _(x):
    rows = S.prior_period(x.obs, {"ytd": "before"}).where("before IS NOT NULL AND span = 1")
    return rows.groupBy("series_id").agg(F.count("*").alias("n"), R.count_where(F.abs(F.col("ytd") - F.col("before") - F.col("m")) > 0.05).alias("off"))


@query("aggregate_recompute", """+ t AS (SELECT period, SUM(CAST(m AS DECIMAL(28,2)))::DOUBLE AS a FROM obs WHERE series_id LIKE 'mkt-%' GROUP BY 1), u AS (SELECT period, SUM(CAST(m AS DECIMAL(28,2)))::DOUBLE AS b FROM obs WHERE series_id LIKE 'nat-%' GROUP BY 1)
  SELECT period, a AS by_segment, b AS by_nation, ABS(a - b) < 0.01 AS same FROM t JOIN u USING (period)""")
def _(x):
    total = lambda like, name: x.obs.where(F.col("series_id").like(like)).groupBy("period").agg(F.sum(F.col("m").cast("decimal(28,2)")).cast("double").alias(name))
    both = total("mkt-%", "by_segment").join(total("nat-%", "by_nation"), "period")
    return both.withColumn("same", F.abs(F.col("by_segment") - F.col("by_nation")) < 0.01)
