"""Queries on the checks before data is accepted, over a staged table with known faults."""

from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.operators import breaks as B
from ledgerline.operators import gates as K
from ledgerline.operators import merge as G
from ledgerline.operators import series as S
from ledgerline.plans import merges
from ledgerline.plans.joins import AGO, PAIRS, PREV
from ledgerline.plans.registry import query
from ledgerline.plans.sql import BLOCKED, SEAM, values
from ledgerline.plans.windows import SHOCKS, history

#: Faults by key: a unit slip, a wild rate, a wrong cumulative value, a missing half-year.
STAGED = """+ staged AS (SELECT series_id, period, span, CASE WHEN series_id = 'nat-1' AND period = '2000-07' THEN m * 10000 WHEN series_id = 'mkt-BUILDING' AND period = '2001-04' THEN -m ELSE m END AS m,
  CASE WHEN series_id = 'nat-4' AND period LIKE '2000-1%' THEN ytd * 1.02 ELSE ytd END AS ytd, CASE WHEN series_id LIKE 'mkt-%' AND period = '2001-05' THEN m_yoy + 400 ELSE m_yoy END AS m_yoy, ytd_yoy
  FROM obs WHERE NOT (series_id = 'nat-3' AND period BETWEEN '2000-07' AND '2000-12'))"""
ROWS = "SELECT check_id, severity, series_id, period FROM ({}) q"


def staged(x):
    at = lambda s, p: F.col("series_id").like(s) & F.col("period").like(p)
    rows = x.obs.where(~((F.col("series_id") == "nat-3") & F.col("period").between("2000-07", "2000-12")))
    return rows.withColumns({
        "m": F.when(at("nat-1", "2000-07"), F.col("m") * 10000).when(at("mkt-BUILDING", "2001-04"), -F.col("m")).otherwise(F.col("m")),
        "ytd": F.when(at("nat-4", "2000-1%"), F.col("ytd") * 1.02).otherwise(F.col("ytd")),
        "m_yoy": F.when(at("mkt-%", "2001-05"), F.col("m_yoy") + 400).otherwise(F.col("m_yoy")),
    })


def touched(x):
    return staged(x).where("period >= '2000-06'")


def find(check, severity, table, where):
    sev = severity if severity.startswith("CASE") else f"'{severity}'"
    return f"SELECT '{check}' AS check_id, {sev} AS severity, series_id, period FROM {table} WHERE {where}"


@query("gate_schema", "+ s AS (SELECT series_id, CASE WHEN series_id = 'nat-5' THEN replace(period, '-', '/') ELSE period END AS period, CASE WHEN series_id = 'nat-6' AND period LIKE '%-11' THEN 3 ELSE span END AS span FROM obs) " + find("schema", "BLOCK", "s", r"NOT regexp_matches(period, '^[0-9]{4}-(0[1-9]|1[0-2])$') OR span NOT IN (1, 2)"))
def _(x):
    p = F.when(F.col("series_id") == "nat-5", F.replace(F.col("period"), F.lit("-"), F.lit("/"))).otherwise(F.col("period"))
    s = F.when((F.col("series_id") == "nat-6") & F.col("period").like("%-11"), 3).otherwise(F.col("span"))
    return K.schema(x.obs.withColumns({"period": p, "span": s}))


@query("gate_schema_lines", """+ b AS (SELECT series_id, period, substr(period, 6) AS mo FROM obs), q AS (SELECT series_id, period, CASE WHEN series_id = 'nat-5' THEN 'period' WHEN series_id = 'nat-6' AND mo = '11' THEN 'choice' WHEN series_id = 'nat-7' AND mo = '04' THEN 'required' WHEN series_id = 'nat-8' AND mo = '05' THEN 'type'
  WHEN series_id = 'nat-9' AND mo = '06' THEN 'unknown' WHEN series_id = 'nat-10' AND mo = '07' THEN 'object' WHEN series_id = 'nat-11' AND mo = '08' THEN 'limits' END AS rule FROM b) SELECT 'schema.' || rule AS check_id, 'BLOCK' AS severity, series_id, period FROM q WHERE rule IS NOT NULL""")
def _(x):
    """Rows as raw JSON; one nation breaks each of the rules."""
    at = lambda n, month="%": (F.col("series_id") == f"nat-{n}") & F.substring("period", 6, 2).like(month)
    line = lambda **other: F.to_json(F.struct(*(other.get(c, F.col(c)).alias(c) for c in ("series_id", "period", "span", "m")), *(v.alias(k) for k, v in other.items() if k == "note")))
    text = (
        F.when(at(5), line(period=F.replace(F.col("period"), F.lit("-"), F.lit("/")))).when(at(6, "11"), line(span=F.lit(3))).when(at(7, "04"), line(m=F.lit(None).cast("double")))
        .when(at(8, "05"), line(m=F.lit("n/a"))).when(at(9, "06"), line(note=F.lit("x"))).when(at(10, "07"), F.lit("oops")).when(at(11, "08"), line(m=F.lit(-1.0))).otherwise(line())
    )
    kinds = {"series_id": "text", "period": "text", "span": "number", "m": "number"}
    return K.schema_of_lines(x.obs.select("series_id", "period", text.alias("line")), ("series_id", "period", "span", "m"), kinds, {"span": (1, 2)}, {"m": (0.0, 1e15)})


@query("gate_caliber", "+ c AS (SELECT l.series_id, l.period, l.measure, k.tier FROM long_obs l JOIN catalog k USING (series_id)) " + find("caliber", "BLOCK", "c", "tier = 3 AND measure IN ('m', 'm_yoy')"))
def _(x):
    calibers = F.when(F.col("tier") == 3, F.array(F.lit("ytd"))).otherwise(F.array(F.lit("single"), F.lit("ytd")))
    return K.caliber(x.long(x.obs), x.catalog.withColumn("calibers", calibers))


TYPED = """, typed AS (SELECT s.* EXCLUDE (m), t.value_type, CASE t.value_type WHEN 'count' THEN ROUND(m) + CASE WHEN period LIKE '%-09' THEN 0.5 ELSE 0 END WHEN 'rate_pct' THEN m_yoy WHEN 'mom_pct' THEN m_yoy / 2 WHEN 'ratio' THEN m_yoy + 60 ELSE m END AS m
  FROM staged s JOIN (SELECT series_id, CASE WHEN section = 'market' THEN 'level' ELSE ['level', 'count', 'rate_pct', 'mom_pct', 'ratio', 'index'][CAST(substr(series_id, 5) AS INT) % 6 + 1] END AS value_type FROM catalog) t USING (series_id))"""


def typed(x):
    """The staged rows as series of every type: nations by their number."""
    kinds = F.array(*map(F.lit, ("level", "count", "rate_pct", "mom_pct", "ratio", "index")))
    kind = F.when(F.col("series_id").like("mkt-%"), "level").otherwise(F.element_at(kinds, F.expr("try_cast(substr(series_id, 5) AS int)") % 6 + 1))
    half = F.when(F.col("period").like("%-09"), 0.5).otherwise(0.0)
    m = F.when(kind == "count", F.round("m") + half).when(kind == "rate_pct", F.col("m_yoy")).when(kind == "mom_pct", F.col("m_yoy") / 2).when(kind == "ratio", F.col("m_yoy") + 60).otherwise(F.col("m"))
    return staged(x).withColumns({"value_type": kind, "m": m})


@query("gate_bounds", STAGED + TYPED + find("bounds", "BLOCK", "typed", """COALESCE(CASE value_type WHEN 'count' THEN m < 0 OR ABS(m - ROUND(m)) > 1e-6 WHEN 'level' THEN m < 0 WHEN 'rate_pct' THEN m NOT BETWEEN 0 AND 100 WHEN 'mom_pct' THEN m NOT BETWEEN -25 AND 25 WHEN 'ratio' THEN COALESCE(m, ytd) NOT BETWEEN 0 AND 100 END, FALSE)
  OR (value_type IN ('index', 'level', 'ratio') AND (COALESCE(m_yoy NOT BETWEEN -80 AND 300, FALSE) OR COALESCE(ytd_yoy NOT BETWEEN -80 AND 300, FALSE)))"""))
def _(x):
    return K.bounds(typed(x))


@query("gate_monotonic", """+ s AS (SELECT series_id, CASE WHEN series_id = 'nat-2' AND period = '1999-07' THEN '1999-05' WHEN series_id = 'nat-6' AND period = '2000-06' THEN '2000-Q2' ELSE period END AS period, CASE WHEN series_id = 'nat-4' AND period = '1999-08' THEN 2 WHEN series_id = 'nat-5' AND period = '2000-02' THEN 1 ELSE span END AS span, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period) AS place FROM obs),
  l AS (SELECT *, lag(period) OVER (PARTITION BY series_id ORDER BY place) AS last FROM s) """ + find("monotonic", "BLOCK", "l", "last >= period OR (span = 2 AND period NOT LIKE '%-02') OR (period >= '1998' AND (period LIKE '%-01' OR (period LIKE '%-02' AND span <> 2))) OR period LIKE '%Q%'"))
def _(x):
    """A period too early, a quarter among months, a merged August and a February that isn't."""
    rows = x.obs.withColumn("place", F.expr("row_number() OVER (PARTITION BY series_id ORDER BY period)"))
    at = lambda s, p: (F.col("series_id") == s) & (F.col("period") == p)
    period = F.when(at("nat-2", "1999-07"), "1999-05").when(at("nat-6", "2000-06"), "2000-Q2").otherwise(F.col("period"))
    span = F.when(at("nat-4", "1999-08"), 2).when(at("nat-5", "2000-02"), 1).otherwise(F.col("span"))
    return K.monotonic(rows.withColumns({"span": span, "period": period, "freq": F.lit("M")}), joint_from="1998")


@query("gate_unit_slip", STAGED + """, h AS (SELECT series_id, period, m, CASE WHEN COUNT(m) OVER w >= 3 THEN quantile_cont(ABS(m), 0.5) OVER w END AS med FROM staged WHERE span = 1 WINDOW w AS (PARTITION BY series_id ORDER BY period ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)) """
       + find("unit_slip", "BLOCK", "h", "period >= '2000-06' AND med > 0 AND m <> 0 AND (ABS(m) / med >= 100 OR ABS(m) / med <= 0.01)"))
def _(x):
    return K.unit_slip(touched(x), staged(x))


@query("gate_seasonal_z", STAGED + f""", u AS (SELECT series_id, period, span, m, CASE WHEN series_id NOT LIKE 'nat-1%' THEN m_yoy END AS m_yoy FROM staged), t AS (SELECT * FROM u WHERE period >= '2001-04' AND series_id IN (SELECT series_id FROM u GROUP BY 1 HAVING COUNT(*) >= 24)),
  p AS (SELECT t.series_id, t.period AS upto, h.m_yoy FROM t JOIN obs h ON h.series_id = t.series_id AND h.period < t.period WHERE t.m_yoy IS NOT NULL AND h.m_yoy IS NOT NULL AND h.period NOT IN {SHOCKS} AND NOT {BLOCKED.format(a='h', p='period')}),
  md AS (SELECT series_id, upto, median(m_yoy) AS med FROM p GROUP BY 1, 2), mad AS (SELECT p.series_id, p.upto, median(ABS(m_yoy - med)) AS mad, ANY_VALUE(med) AS med FROM p JOIN md USING (series_id, upto) GROUP BY 1, 2),
  co AS (SELECT t.series_id, t.period AS upto, t.m AS now, s.period, s.m, MIN(s.m) OVER v > 0 AND t.m > 0 AS logs, COUNT(*) OVER v AS n FROM t JOIN u s ON s.series_id = t.series_id AND s.span = t.span AND substr(s.period, 6) = substr(t.period, 6) AND s.period < t.period
    WHERE s.period NOT IN {SHOCKS} AND NOT EXISTS (SELECT 1 FROM md WHERE md.series_id = t.series_id AND md.upto = t.period) WINDOW v AS (PARTITION BY t.series_id, t.period)),
  cl AS (SELECT *, CASE WHEN logs THEN LN(ABS(m)) ELSE m END AS lv, CASE WHEN logs THEN LN(ABS(now)) ELSE now END AS ln FROM co WHERE n > 4),
  cs AS (SELECT series_id, upto, lv - lag(lv) OVER w AS step, ln - first_value(lv) OVER (PARTITION BY series_id, upto ORDER BY period DESC) AS chg FROM cl WINDOW w AS (PARTITION BY series_id, upto ORDER BY period)),
  cm AS (SELECT series_id, upto, median(step) AS med, ANY_VALUE(chg) AS chg FROM cs GROUP BY 1, 2), cd AS (SELECT cs.series_id, cs.upto, ANY_VALUE(cm.chg) AS v, ANY_VALUE(med) AS med, median(ABS(step - med)) AS mad FROM cs JOIN cm USING (series_id, upto) GROUP BY 1, 2),
  g AS (SELECT t.series_id, t.period, t.m_yoy AS v, med, mad FROM t JOIN mad ON t.series_id = mad.series_id AND t.period = mad.upto UNION ALL SELECT series_id, upto, v, med, mad FROM cd),
  z AS (SELECT series_id, period, ABS(CASE WHEN mad = 0 THEN CASE WHEN v = med THEN 0 ELSE 'inf'::DOUBLE END ELSE (v - med) / (mad * 1.4826) END) AS z FROM g) """
       + find("seasonal_z", "CASE WHEN z >= 7 AND NOT (series_id = 'mkt-BUILDING' AND period = '2001-05') THEN 'BLOCK' ELSE 'WARN' END", "z", "z >= 4"))
def _(x):
    """Some nations publish no rate, so that their seasons are compared; another source confirms one wild rate."""
    rows = staged(x).withColumn("m_yoy", F.when(~F.col("series_id").like("nat-1%"), F.col("m_yoy")))
    new = rows.where("period >= '2001-04'")
    past = history(x, new.where("m_yoy IS NOT NULL").select("series_id", F.col("period").alias("at")))
    return K.seasonal_z(new, past, rows, SHOCKS, rows.where("series_id = 'mkt-BUILDING' AND period = '2001-05'"))


@query("gate_triangulate_dg_press", "SELECT 'dg_press' AS check_id, 'BLOCK' AS severity, a.series_id, a.period FROM long_obs a JOIN long_old b USING (series_id, period, measure) WHERE measure = 'm_yoy' AND ABS(a.value - b.value) > 0.05 + 1e-9")
def _(x):
    off = G.disagreements(x.long(x.obs), x.long(x.old), N.display_tolerance(F.lit(1))).where("measure = 'm_yoy'")
    return K.findings(off, "dg_press", "BLOCK")


@query("gate_triangulate_pairs", f"+ pairs AS (SELECT * FROM (VALUES {values(PAIRS)}) t(a, b, tol)) SELECT 'pairs' AS check_id, 'WARN' AS severity, p.a AS series_id, o.period FROM pairs p JOIN obs o ON o.series_id = p.a JOIN obs q ON q.series_id = p.b AND q.period = o.period WHERE ABS(o.m_yoy - q.m_yoy) > p.tol")
def _(x):
    off = G.republications(x.obs, x.rows(PAIRS, "first_id string, second_id string, tol double"), "m_yoy")
    return K.findings(off.withColumnRenamed("first_id", "series_id"), "pairs", "WARN")


@query("gate_ytd_arith", STAGED + TYPED + f""", r AS (SELECT a.*, b.ytd AS before, b.period >= '2000-06' AS pin FROM typed a LEFT JOIN typed b ON a.series_id = b.series_id AND b.period = {PREV.format(a='a')} WHERE a.period >= '2000-06' AND a.value_type IN ('level', 'count')),
  w AS (SELECT *, CASE WHEN span = 2 THEN m ELSE before + m END AS want, CASE WHEN value_type = 'count' THEN 2 ELSE 0.02 END AS least FROM r) """ + find("ytd_arithmetic", "CASE WHEN COALESCE(pin, FALSE) OR span = 2 THEN 'BLOCK' ELSE 'WARN' END", "w", "ABS(ytd - want) > GREATEST(least, ABS(ytd) * 0.005)"))
def _(x):
    """Series of every type, of which levels and counts add up; counts have no decimals, levels two."""
    return K.ytd_arithmetic(typed(x).withColumn("decimals", F.when(F.col("value_type") == "count", 0).otherwise(2)), touched(x))


@query("gate_yoy_base", STAGED + TYPED + f""", r AS (SELECT a.series_id, a.period, a.m, a.m_yoy, a.ytd, a.ytd_yoy, b.m AS bm, b.ytd AS yb, {AGO.format(a='a')} AS ago FROM typed a JOIN typed b ON a.series_id = b.series_id AND a.span = b.span AND b.period = {AGO.format(a='a')} WHERE a.value_type = 'level'),
  l AS (SELECT series_id, period, ago, m AS v, bm AS base, m_yoy AS rate FROM r UNION ALL SELECT series_id, period, ago, ytd, yb, ytd_yoy FROM r), c AS (SELECT *, v / NULLIF(1 + rate / 100, 0) AS implied FROM l WHERE v IS NOT NULL AND base IS NOT NULL AND rate IS NOT NULL AND NOT {SEAM.format(a='l', p='period', q='l.ago')}),
  d AS (SELECT *, implied IS NULL OR base = 0 OR ABS(implied - base) > ABS(base) * 0.5 AS blk FROM c) """
       + find("yoy_base", "CASE WHEN blk THEN 'BLOCK' ELSE 'WARN' END", "d", "blk OR ABS(rate - (v / base - 1) * 100) > 3"))
def _(x):
    return K.yoy_base(typed(x), x.breaks)


@query("gate_sum_parts", """+ p AS (SELECT period, SUM(CAST(m AS DECIMAL(28,2)))::DOUBLE AS summed, COUNT(*) AS n FROM obs WHERE series_id LIKE 'mkt-%' GROUP BY 1), t AS (SELECT 'all' AS series_id, period, CAST(SUM(CAST(m AS DECIMAL(28,2))) AS DOUBLE) * CASE WHEN period LIKE '%-09' THEN 1.05 ELSE 1 END AS m FROM obs WHERE series_id LIKE 'nat-%' GROUP BY 1, 2)
  SELECT 'sum_of_parts' AS check_id, 'WARN' AS severity, t.series_id, t.period FROM t JOIN p USING (period) WHERE n = (SELECT COUNT(*) FROM catalog WHERE tier = 1) AND ABS(t.m - p.summed) / GREATEST(ABS(t.m), ABS(p.summed)) > 0.02""")
def _(x):
    summed = G.sum_parts(x.obs, x.catalog.where("tier = 1").select(F.lit("all").alias("total"), "series_id"))
    slip = F.when(F.col("period").like("%-09"), 1.05).otherwise(1.0)
    totals = x.obs.where("series_id LIKE 'nat-%'").groupBy(F.lit("all").alias("series_id"), "period").agg(F.sum(F.col("m").cast("decimal(28,2)")).cast("double").alias("m")).withColumn("m", F.col("m") * slip)
    return K.sum_of_parts(totals, summed)


@query("gate_envelope", """+ s AS (SELECT period, MIN(m_yoy) AS lo, MAX(m_yoy) AS hi FROM obs WHERE series_id IN ('mkt-MACHINERY', 'mkt-FURNITURE', 'mkt-HOUSEHOLD') AND m_yoy IS NOT NULL GROUP BY 1 HAVING COUNT(m_yoy) >= 2)
  SELECT 'envelope' AS check_id, 'WARN' AS severity, o.series_id, o.period FROM obs o JOIN s USING (period) WHERE o.series_id = 'mkt-BUILDING' AND (o.m_yoy < lo - 0.05 OR o.m_yoy > hi + 0.05)""")
def _(x):
    items = x.obs.where("series_id IN ('mkt-MACHINERY', 'mkt-FURNITURE', 'mkt-HOUSEHOLD')").select(F.lit("mkt-BUILDING").alias("head"), "period", "m_yoy")
    return K.envelope(x.obs.where("series_id = 'mkt-BUILDING'"), items)


@query("gate_share_bounds", STAGED + ", w AS (SELECT period, m AS whole FROM obs WHERE series_id = 'mkt-MACHINERY') SELECT 'share_bounds' AS check_id, 'WARN' AS severity, s.series_id, s.period FROM staged s JOIN w USING (period) WHERE s.series_id LIKE 'nat-%' AND (s.m > whole * 1.001 OR COALESCE(s.m_yoy + 40 NOT BETWEEN 0 AND 100, FALSE))")
def _(x):
    parts = staged(x).where("series_id LIKE 'nat-%'").withColumn("share", F.col("m_yoy") + 40)
    return K.share_bounds(parts, x.obs.where("series_id = 'mkt-MACHINERY'").select("period", F.col("m").alias("whole")))


KNOWN_STEPS = (("nat-3", None, "calendar_step", "caught up"),)


@query("gate_calendar_step", STAGED + """, l AS (SELECT series_id, MAX(period) AS last FROM staged WHERE period < CASE series_id WHEN 'nat-3' THEN '2001-01' WHEN 'nat-7' THEN '2000-05' WHEN 'nat-8' THEN '2001-01' WHEN 'nat-9' THEN '2000-03' ELSE '2000-06' END GROUP BY 1), n AS (SELECT series_id, MIN(period) AS period FROM staged WHERE period >= CASE WHEN series_id = 'nat-3' THEN '2001-01' ELSE '2000-06' END GROUP BY 1),
  s AS (SELECT n.*, (CAST(substr(period, 1, 4) AS INT) - CAST(substr(last, 1, 4) AS INT)) * 12 + CAST(substr(period, 6, 2) AS INT) - CAST(substr(last, 6, 2) AS INT) AS k FROM n JOIN l USING (series_id)) """ + find("calendar_step", "CASE WHEN k = 2 OR series_id = 'nat-3' THEN 'WARN' ELSE 'BLOCK' END", "s", "k <> 1"))
def _(x):
    """One nation catches up as is known, one goes back, one leaves out more than a month."""
    cut = F.when(F.col("series_id") == "nat-3", "2001-01").otherwise("2000-06")
    at = lambda s: F.col("series_id") == s
    known = F.when(at("nat-7"), "2000-05").when(at("nat-8"), "2001-01").when(at("nat-9"), "2000-03").otherwise(cut)
    latest = staged(x).where(F.col("period") < known).groupBy("series_id").agg(F.max("period").alias("period"))
    return K.calendar_step(staged(x).where(F.col("period") >= cut).groupBy("series_id").agg(F.min("period").alias("period")), latest, KNOWN_STEPS)


#: source, frequency, first and last day, months after the period's end, months without a print of their own.
CALENDAR = (("BUILDING", "M", 9, 15, 1, ["01"]), ("MACHINERY", "M", 14, 31, 1, []), ("HOUSEHOLD", "M", 1, 20, 2, ["02", "08"]), ("AUTOMOBILE", "Q", 9, 12, 1, []))


@query("gate_release_window", f"""WITH cal AS (SELECT * FROM (VALUES {values(tuple((s, f, lo, hi, lag, ",".join(k)) for s, f, lo, hi, lag, k in CALENDAR))}) t(source, freq, low, high, lag, skips)),
  r AS (SELECT 'ord-' || o_orderkey AS series_id, c_mktsegment AS source, strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m') AS period, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON o_custkey = c_custkey), w AS (SELECT r.*, low, high, CAST(CAST(period || '-01' AS DATE) + to_months(lag) AS DATE) AS first FROM r JOIN cal USING (source) WHERE freq = 'M' AND NOT contains(skips, substr(period, 6, 2)))
  SELECT 'release_window' AS check_id, 'WARN' AS severity, series_id, period FROM w WHERE day NOT BETWEEN LEAST(first + CAST(low - 1 AS INT), last_day(first)) - 3 AND LEAST(first + CAST(high - 1 AS INT), last_day(first)) + 3""", pre=False)
def _(x):
    """Every order as a release, on its day, of the month before; segments are sources of which one prints quarters and one has no rule."""
    customer = x.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("source"))
    rows = x.table("orders").join(customer, "o_custkey").select(F.concat(F.lit("ord-"), "o_orderkey").alias("series_id"), "source", F.date_format(F.add_months(F.col("o_orderdate").cast("date"), -1), "yyyy-MM").alias("period"), F.col("o_orderdate").alias("released"))
    return K.release_calendar(rows, x.rows(CALENDAR, "source string, freq string, low int, high int, lag int, skips array<string>"))


@query("gate_completeness", """+ r AS (SELECT DISTINCT nat || '/' || period AS release, seg AS field FROM cells), a AS (SELECT release, g AS "group", f AS field FROM (SELECT DISTINCT release FROM r), (VALUES ('core', 'BUILDING'), ('core', 'MACHINERY'), ('home', 'HOUSEHOLD')) t(g, f))
  SELECT 'completeness' AS check_id, 'BLOCK' AS severity, a.release, a."group" FROM a LEFT JOIN r USING (release, field) GROUP BY 3, 4 HAVING COUNT(r.release) = 0""")
def _(x):
    """A release is a nation's month; it must have a field of every group."""
    groups = F.array(*(F.struct(F.lit(g).alias("group"), F.lit(f).alias("field")) for g, f in (("core", "BUILDING"), ("core", "MACHINERY"), ("home", "HOUSEHOLD"))))
    rows = x.cells.select(F.concat_ws("/", "nat", "period").alias("release"), F.col("seg").alias("field"))
    return K.completeness(rows, rows.select("release").distinct().select("release", F.inline(groups)))


@query("gate_release_identity", STAGED + """, rep AS (SELECT * FROM staged WHERE NOT (series_id IN ('nat-11', 'nat-12') AND period = '2000-10') UNION ALL SELECT series_id, '2000-10', span, m, ytd, m_yoy, ytd_yoy FROM staged WHERE series_id IN ('nat-11', 'nat-12') AND period = '2000-09'),
  n AS (SELECT * FROM rep WHERE period >= '2000-06'), l AS (SELECT series_id, period, lag(m) OVER w = m AND lag(ytd) OVER w = ytd AND COALESCE(lag(m_yoy) OVER w = m_yoy, TRUE) AND COALESCE(lag(ytd_yoy) OVER w = ytd_yoy, TRUE) AS same FROM rep WINDOW w AS (PARTITION BY series_id ORDER BY period))
  SELECT 'release_identity' AS check_id, 'BLOCK' AS severity, series_id, period FROM n WHERE period IN ('2000-09', '2000-11') UNION ALL SELECT 'stale_reserve', 'BLOCK', series_id, period FROM l WHERE same AND period >= '2000-06' AND period NOT IN ('2000-09', '2000-11') AND NOT (series_id = 'nat-12' AND period = '2000-10')""")
def _(x):
    """A month is a release of two captures; one month has no manifest, another lacks a capture. Two nations repeat a month, one of them as a second source confirms."""
    twice = F.col("series_id").isin("nat-11", "nat-12")
    rows = staged(x).where(~(twice & (F.col("period") == "2000-10"))).unionByName(staged(x).where(twice & (F.col("period") == "2000-09")).withColumn("period", F.lit("2000-10")))
    new = rows.where("period >= '2000-06'").select("series_id", "period", F.concat(F.lit("rel-"), "period").alias("release"))
    parts = lambda r: F.array(*(F.concat_ws("/", r, F.lit(k)) for k in "ab"))
    manifests = new.where("period <> '2000-09'").select("release").distinct().select("release", F.explode(parts("release")).alias("capture"))
    confirmed = rows.where("series_id = 'nat-12'").unpivot(["series_id", "period"], ["m", "ytd", "m_yoy", "ytd_yoy"], "measure", "value")
    return K.release_identity(new, manifests, manifests.where("capture <> 'rel-2000-11/b'"), S.stale(rows), confirmed)


#: Windows of the quarters and years of segments: two of a year and less, one longer.
COARSE = (("q-BUILDING", "1997-Q2", True, "1998-Q2"), ("q-MACHINERY", "1998-Q1", True, "1998-Q3"), ("a-BUILDING", "1997", True, "1998"), ("a-HOUSEHOLD", "1996", True, "1999"), ("q-FURNITURE", "1999-Q1", True, None))
COARSE_SCHEMA = "series_id string, effective string, no_yoy_across boolean, yoy_valid_from string"


@query("gate_break_no_yoy", f"""+ rw AS (SELECT series_id, period, m_yoy FROM obs UNION ALL SELECT CASE WHEN period LIKE '%Q%' THEN 'q-' ELSE 'a-' END || substr(series_id, 5), period, CASE WHEN period LIKE '%8%' THEN m END FROM mixed WHERE period LIKE '%Q%' OR length(period) = 4),
  bw AS (SELECT series_id, effective, no_yoy_across, yoy_valid_from FROM breaks UNION ALL SELECT * FROM (VALUES {values(COARSE)})), w AS (SELECT series_id, effective, yoy_valid_from AS vf FROM bw WHERE no_yoy_across AND yoy_valid_from > effective),
  nn AS (SELECT w.series_id, w.vf AS period, COUNT(*) FILTER (WHERE o.period >= w.effective AND o.period < w.vf) AS n, COUNT(*) FILTER (WHERE o.period = w.vf AND o.m_yoy IS NOT NULL) AS y FROM w JOIN rw o USING (series_id) GROUP BY 1, 2)
  SELECT 'break_no_yoy' AS check_id, 'BLOCK' AS severity, series_id, period FROM rw o WHERE m_yoy IS NOT NULL AND {BLOCKED.format(a='o', p='period').replace('FROM breaks', 'FROM bw')} UNION ALL SELECT 'break_restated', 'BLOCK', series_id, period FROM nn WHERE y > 0 AND n < CASE WHEN period LIKE '%Q%' THEN 4 WHEN length(period) = 4 THEN 1 ELSE 12 END""")
def _(x):
    """Months with their breaks, and quarters and years of segments with others; those print a rate in some years."""
    coarse = x.mixed.where("period LIKE '%Q%' OR length(period) = 4")
    id_ = F.concat(F.when(F.col("period").like("%Q%"), "q-").otherwise("a-"), F.expr("substr(series_id, 5)"))
    rows = x.obs.select("series_id", "period", "m_yoy").union(coarse.select(id_, "period", F.when(F.col("period").like("%8%"), F.col("m"))))
    walls = x.breaks.select("series_id", "effective", "no_yoy_across", "yoy_valid_from").union(x.rows(COARSE, COARSE_SCHEMA))
    return K.break_no_yoy(rows, walls)


MANY_SQL = """+ w AS (SELECT 'nat-' || c_nationkey AS series_id, strftime(o_orderdate, '%Y-%m-%d') AS effective, CASE WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m-%d') ELSE strftime(o_orderdate + CAST(o_orderkey % 20 AS INT) * INTERVAL 1 DAY, '%Y-%m-%d') END AS vf FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000),
  d AS (SELECT 'nat-' || s_nationkey AS series_id, strftime(l_shipdate, '%Y-%m-%d') AS period, COUNT(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


def _many(x):
    """Large orders of a nation as windows of some days, of which some end before they begin; and the days on which its suppliers ship."""
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    customer = x.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("nat-"), "c_nationkey").alias("series_id"))
    orders = x.table("orders").where("o_totalprice > 300000").join(customer, "o_custkey")
    days = F.when(F.col("o_orderkey") % 11 == 0, -3).otherwise((F.col("o_orderkey") % 20).cast("int"))
    walls = orders.select("series_id", day(F.col("o_orderdate")).alias("effective"), F.lit(True).alias("no_yoy_across"), day(F.date_add(F.col("o_orderdate").cast("date"), days)).alias("yoy_valid_from"))
    supplier = x.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("nat-"), "s_nationkey").alias("series_id"))
    shipped = x.table("lineitem").select("l_suppkey", day(F.col("l_shipdate")).alias("period")).join(supplier, "l_suppkey").groupBy("series_id", "period").agg(F.count("*").alias("n"))
    return walls, shipped


@query("break_windows_swept", MANY_SQL + " SELECT series_id, period, n, EXISTS (SELECT 1 FROM w WHERE w.series_id = d.series_id AND d.period >= w.effective AND d.period < w.vf) AS blocked FROM d")
def _(x):
    """Thousands of windows a series, by one sort of both."""
    walls, shipped = _many(x)
    return B.blocked_by_sweep(shipped, walls)


@query("break_seams_swept", MANY_SQL + ", g AS (SELECT *, lag(period, 2) OVER (PARTITION BY series_id ORDER BY period) AS prior FROM d) SELECT series_id, period, EXISTS (SELECT 1 FROM w WHERE w.series_id = g.series_id AND g.prior < w.effective AND w.effective <= g.period) AS seam FROM g")
def _(x):
    """Whether a window begins between a day and the last but one before it."""
    walls, shipped = _many(x)
    rows = shipped.withColumn("prior", F.expr("lag(period, 2) OVER (PARTITION BY series_id ORDER BY period)"))
    return B.seam_by_sweep(rows, walls, "prior").select("series_id", "period", "seam")


@query("break_rows_within", MANY_SQL + ", u AS (SELECT DISTINCT series_id, effective, vf FROM w WHERE vf > effective) SELECT u.series_id, u.effective, u.vf AS until, COUNT(d.period) AS n FROM u LEFT JOIN d ON d.series_id = u.series_id AND d.period >= u.effective AND d.period < u.vf GROUP BY 1, 2, 3")
def _(x):
    """How many shipping days each window holds, by running counts."""
    walls, shipped = _many(x)
    windows = walls.where("yoy_valid_from > effective").select("series_id", "effective", F.col("yoy_valid_from").alias("until")).distinct()
    return B.rows_within(windows, shipped, "effective", "until", "n")


@query("gate_break_link", """+ ended AS (SELECT 'nat-' || n_nationkey AS series_id, n_regionkey % 2 = 1 AS ended FROM nation),
  links AS (SELECT 'nat-' || n_nationkey AS series_id, 'nat-' || (n_nationkey + 1) AS other, 'new' AS side FROM nation WHERE n_nationkey % 3 <> 1 UNION ALL SELECT 'nat-' || n_nationkey, 'nat-' || (n_nationkey - 1), 'old' FROM nation WHERE n_nationkey % 4 <> 2),
  j AS (SELECT l.*, e.ended, o.ended AS other_ended, EXISTS (SELECT 1 FROM links r WHERE r.series_id = l.other AND r.other = l.series_id AND r.side <> l.side) AS answered FROM links l LEFT JOIN ended e ON e.series_id = l.series_id LEFT JOIN ended o ON o.series_id = l.other)
  SELECT 'break_link' AS check_id, 'WARN' AS severity, series_id, other AS period FROM j WHERE other_ended IS NULL
  UNION ALL SELECT 'break_link', 'BLOCK', series_id, other FROM j WHERE other_ended IS NOT NULL AND NOT answered
  UNION ALL SELECT 'break_link', 'BLOCK', series_id, other FROM j WHERE CASE side WHEN 'new' THEN NOT ended ELSE other_ended IS NOT NULL AND NOT other_ended END""")
def _(x):
    """Nations that follow one another by number; some lack the way ahead or back, those of even regions are not frozen."""
    key = F.col("n_nationkey")
    id_ = lambda n: F.concat(F.lit("nat-"), n)
    nations = x.table("nation")
    links = nations.select(id_(key).alias("series_id"), F.when(key % 3 != 1, id_(key + 1)).alias("superseded_by"), F.when(key % 4 != 2, id_(key - 1)).alias("supersedes"))
    found = B.link_problems(links, nations.select(id_(key).alias("series_id"), (F.col("n_regionkey") % 2 == 1).alias("ended")))
    return found.select(F.lit("break_link").alias("check_id"), "severity", "series_id", F.col("other").alias("period"))


@query("gate_revision_flood", merges.LOG + """, o AS (SELECT series_id, COUNT(*) AS n, MAX(period) AS period FROM obs GROUP BY 1), r AS (SELECT series_id, COUNT(*) AS k, COUNT(DISTINCT period) AS p FROM log GROUP BY 1)
  SELECT 'revision_flood' AS check_id, CASE WHEN series_id = 'nat-2' THEN 'WARN' ELSE 'BLOCK' END AS severity, series_id, period FROM r JOIN o USING (series_id) WHERE CASE WHEN series_id LIKE 'mkt-%' THEN p > 3 ELSE k > 6 OR k > n * 0.1 END""")
def _(x):
    """Segments count as panels; one nation's revision is known."""
    panels = x.catalog.where("section = 'market'").select("series_id")
    return K.revision_flood(merges._log(x), x.obs, panels, (("nat-2", None, "revision_flood", "benchmark"),))


@query("gate_revision_integrity", merges.LOG + " SELECT 'revision_integrity' AS check_id, 'BLOCK' AS severity, series_id, period FROM log WHERE seq = 2 AND series_id = 'nat-2'")
def _(x):
    log = merges._log(x).where("seq = 2").withColumn("old", F.when(F.col("series_id") == "nat-2", F.col("old") + 1).otherwise(F.col("old")))
    return K.findings(G.integrity(log, x.long(x.old), merges._new(x), merges.TODAY), "revision_integrity", "BLOCK")


@query("gate_catalog", """SELECT 'catalog' AS check_id, 'BLOCK' AS severity, series_id, MAX(period) AS period FROM obs WHERE series_id NOT IN (SELECT series_id FROM catalog WHERE name <> 'BUILDING' AND series_id <> 'nat-12') AND series_id <> 'nat-12' GROUP BY series_id
  UNION ALL SELECT 'catalog.value_type', 'BLOCK', series_id, MAX(period) FROM obs WHERE series_id = 'nat-4' GROUP BY 3 UNION ALL SELECT 'catalog.section', 'BLOCK', series_id, MAX(period) FROM obs WHERE series_id LIKE 'nat-2%' GROUP BY 3
  UNION ALL SELECT DISTINCT 'catalog.field', 'WARN', pri, NULL FROM cells WHERE pri LIKE '1%' OR pri LIKE '5%' UNION ALL SELECT 'catalog', 'WARN', series_id, NULL FROM catalog WHERE series_id = 'nat-8'""")
def _(x):
    """A segment and a nation without an entry, the latter known; a nation without data; some of another type or section; priorities as fields of which two map to nothing."""
    declared = x.catalog.where("name <> 'BUILDING' AND series_id <> 'nat-12'")
    at = lambda c, like, v: F.when(F.col("series_id").like(like), v).otherwise(F.col(c))
    facts = declared.select("series_id", at("value_type", "nat-4", "index").alias("value_type"), at("section", "nat-2%", "market").alias("section"))
    series = F.when(~F.substring("pri", 1, 1).isin("1", "5"), F.concat(F.lit("pri-"), "pri")).alias("series_id")
    return K.catalog(x.obs.where("series_id <> 'nat-8'"), declared, facts, x.cells.select(F.col("pri").alias("field"), series).distinct(), ("nat-12",))


@query("gate_verdict", STAGED + ", f AS (" + find("bounds", "BLOCK", "staged", "m < 0 OR m_yoy NOT BETWEEN -80 AND 300 OR ytd_yoy NOT BETWEEN -80 AND 300") + " UNION ALL SELECT 'pairs', 'WARN', series_id, period FROM obs WHERE ABS(m_yoy) > 50) SELECT COUNT(*) FILTER (WHERE severity = 'BLOCK') AS blocks, COUNT(*) FILTER (WHERE severity = 'WARN') AS warns, CASE WHEN COUNT(*) FILTER (WHERE severity = 'BLOCK') > 0 THEN 2 ELSE 0 END AS exit_code FROM f")
def _(x):
    return K.verdict(K.bounds(staged(x)).union(K.findings(x.obs, "pairs", "WARN", F.abs("m_yoy") > 50)))
