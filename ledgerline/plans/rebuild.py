"""Queries on what is checked after a build: trees of digests over two builds, strata of a sample, cells against API captures."""

from pyspark.sql import functions as F

from ledgerline.operators import merkle as M
from ledgerline.operators import sample as Z
from ledgerline.plans.registry import query
from ledgerline.plans.scans import scratch
from ledgerline.sources.readers import latest_captures

KEYS = ["series_id", "period"]
#: Two builds as text: of the second, one nation is off by a cent, another lacks its Julys, a segment has a period twice.
BUILDS = """+ a AS (SELECT series_id, period, CAST(CAST(m AS DECIMAL(28,2)) AS VARCHAR) AS m, CASE WHEN period NOT LIKE '%-05' THEN CAST(span AS VARCHAR) END AS span FROM obs),
  b AS (SELECT series_id, period, CASE WHEN series_id = 'nat-5' AND period LIKE '2000%' THEN CAST(CAST(m AS DECIMAL(28,2)) + 0.01 AS VARCHAR) ELSE m END AS m, span FROM a WHERE NOT (series_id = 'nat-6' AND period LIKE '%-07') UNION ALL SELECT series_id, period, m, span FROM a WHERE series_id = 'mkt-BUILDING' AND period = '1999-09')"""


def _builds(x):
    exact = F.col("m").cast("decimal(28,2)")
    a = x.obs.select(*KEYS, exact.cast("string").alias("m"), F.when(~F.col("period").like("%-05"), F.col("span").cast("string")).alias("span"))
    off = (F.col("series_id") == "nat-5") & F.col("period").like("2000%")
    b = a.where("NOT (series_id = 'nat-6' AND period LIKE '%-07')").withColumn("m", F.when(off, (F.col("m").cast("decimal(28,2)") + F.lit("0.01").cast("decimal(28,2)")).cast("decimal(28,2)").cast("string")).otherwise(F.col("m")))
    return a, b.union(a.where("series_id = 'mkt-BUILDING' AND period = '1999-09'"))


RANGED = BUILDS + """, ra AS (SELECT *, substr(sha256(series_id || '|' || period), 1, 2) AS r FROM a), rb AS (SELECT *, substr(sha256(series_id || '|' || period), 1, 2) AS r FROM b)"""
LINE = """'{"m":' || COALESCE('"' || m || '"', 'null') || ',"period":"' || period || '","series_id":"' || series_id || '","span":' || COALESCE('"' || span || '"', 'null') || '}'"""


@query("merkle_tree", RANGED + f""", l2 AS (SELECT r AS node, sha256(string_agg({LINE}, chr(10) ORDER BY {LINE})) AS digest, COUNT(*) AS n FROM ra GROUP BY 1),
  l1 AS (SELECT substr(node, 1, 1) AS node, sha256(string_agg(node || ':' || digest, chr(10) ORDER BY node)) AS digest, SUM(n) AS n FROM l2 GROUP BY 1), l0 AS (SELECT '' AS node, sha256(string_agg(node || ':' || digest, chr(10) ORDER BY node)) AS digest, SUM(n) AS n FROM l1)
  SELECT 2 AS depth, * FROM l2 UNION ALL SELECT 1, * FROM l1 UNION ALL SELECT 0, * FROM l0""")
def _(x):
    """Digests of all key ranges of a build, from leaves to root."""
    return M.nodes(_builds(x)[0], KEYS, 2)


@query("merkle_diff", BUILDS + " SELECT *, 'missing' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'extra' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def _(x):
    """What differs between two builds on file, by their trees."""
    root = scratch(x)
    for name, rows in zip("ab", _builds(x), strict=True):
        M.write(rows, KEYS, f"{root}/{name}", 2)
    return M.diff(x.spark, f"{root}/a", f"{root}/b")


@query("merkle_ranges", RANGED + """, d AS (SELECT DISTINCT r FROM (SELECT * FROM (SELECT * FROM ra EXCEPT ALL SELECT * FROM rb) UNION ALL SELECT * FROM (SELECT * FROM rb EXCEPT ALL SELECT * FROM ra)))
  SELECT series_id, COUNT(*) AS compared FROM (SELECT * FROM ra UNION ALL SELECT * FROM rb) WHERE r IN (SELECT r FROM d) GROUP BY 1""")
def _(x):
    """By series, how many rows of both builds are compared: those of the ranges that differ, and no others."""
    root = scratch(x)
    for name, rows in zip("ab", _builds(x), strict=True):
        M.write(rows, KEYS, f"{root}/{name}", 2)
    a, b = M.rows_of(x.spark, f"{root}/a", f"{root}/b")
    return a.union(b.select(a.columns)).groupBy("series_id").agg(F.count("*").alias("compared"))


SEED, DRAWN = "2b7f", 20
POINT_SQL = """+ pts AS (SELECT o.series_id, c.section, o.period, v.caliber FROM obs o JOIN catalog c USING (series_id), (VALUES ('single'), ('ytd')) v(caliber) WHERE CASE WHEN v.caliber = 'ytd' THEN ytd ELSE m END IS NOT NULL AND NOT (c.tier = 3 AND v.caliber = 'single')),
  tc AS (SELECT DISTINCT series_id, period FROM long_obs o JOIN long_old p USING (series_id, period, measure) WHERE period >= '2001-02' AND ABS(o.value - p.value) >= 1e-9),
  sm AS (SELECT series_id, unnest([MAX(period) FILTER (WHERE period < effective), MIN(period) FILTER (WHERE period >= effective)]) AS period FROM (SELECT DISTINCT series_id, period FROM pts) JOIN breaks USING (series_id) GROUP BY series_id, effective),
  st AS (SELECT p.*, (SELECT MAX(period) FROM pts z WHERE z.series_id = p.series_id) AS last, p.series_id LIKE 'nat-2%' AS drv, ROW_NUMBER() OVER (PARTITION BY section ORDER BY sha256('2b7f|' || series_id || '|' || period || '|' || caliber)) AS k FROM pts p),
  sa AS (SELECT series_id, section, period, caliber, CASE WHEN period = last AND NOT drv THEN 'a_latest' WHEN (series_id, period) IN (SELECT series_id, period FROM tc) THEN 'b_last_commit' WHEN (series_id, period) IN (SELECT series_id, period FROM sm WHERE period IS NOT NULL) THEN 'c_break_seam'
    WHEN period LIKE '%-02' AND CAST(substr(period, 1, 4) AS INT) >= (SELECT MAX(CAST(substr(period, 1, 4) AS INT)) - 1 FROM pts) THEN 'd_jan_feb' WHEN period = last THEN 'e_derived_latest' WHEN k <= 20 THEN 'f_random' END AS stratum FROM st)"""


def points(x):
    """Published values of each caliber; third-tier series have the year to date only."""
    rows = x.obs.join(x.catalog.select("series_id", "section", "tier"), "series_id")
    calibers = F.array_compact(F.array(F.when(F.col("m").isNotNull() & (F.col("tier") != 3), "single"), F.when(F.col("ytd").isNotNull(), "ytd")))
    return x.held(rows.select("series_id", "section", "period", F.explode(calibers).alias("caliber")))


@query("sampling_strata", POINT_SQL + " SELECT * FROM sa WHERE stratum IS NOT NULL")
def _(x):
    """Every point that is checked again, with its stratum."""
    before = x.long(x.old).withColumnRenamed("value", "_was")
    touched = x.long(x.obs).join(before, ["series_id", "period", "span", "measure"]).where("period >= '2001-02' AND abs(value - _was) >= 1e-9")
    return Z.strata(points(x), touched, x.breaks, x.catalog.where("series_id LIKE 'nat-2%'"), DRAWN, SEED)


@query("sample_smallest", """WITH p AS (SELECT l_returnflag AS flag, l_orderkey || '/' || l_partkey || '/' || l_suppkey AS series_id, strftime(l_shipdate, '%Y-%m-%d') AS period, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS caliber FROM lineitem), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY flag ORDER BY sha256('2b7f|' || series_id || '|' || period || '|' || caliber), series_id, period, caliber) AS n FROM p)
  SELECT flag, series_id, period, caliber FROM k WHERE n <= 500""", pre=False)
def _(x):
    """Five hundred line items of each flag by the smallest hashes."""
    rows = x.table("lineitem").select(F.col("l_returnflag").alias("flag"), F.concat_ws("/", "l_orderkey", "l_partkey", "l_suppkey").alias("series_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("period"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("caliber"))
    return Z.smallest(rows, "flag", 500, SEED)


API_SQL = """+ n AS (SELECT indicator, code, TRY_CAST(v AS DOUBLE) AS value, fetched FROM captures), rc AS (SELECT indicator, CASE indicator WHEN 'ind-A' THEN 'Returns accepted' WHEN 'ind-N' THEN 'New shipments' ELSE 'Returns refused' END AS name, substr(code, 1, 4) || '-' || substr(code, 5, 2) AS period, arg_max(value, fetched) AS value FROM n WHERE value IS NOT NULL GROUP BY 1, 2, 3),
  cl AS (SELECT 'ser-' || substr(indicator, 5) AS series_id, period, substr(indicator, 5) AS flag, value AS v, SUM(CAST(value AS DECIMAL(28,2))) OVER (PARTITION BY indicator, substr(period, 1, 4) ORDER BY period) AS y FROM rc),
  cc AS (SELECT series_id, period, CASE WHEN flag = 'A' AND period NOT LIKE '%-08' THEN 'dg:ind-A' WHEN flag = 'N' THEN 'natdata:x' END AS src, CASE WHEN period LIKE '%-04' THEN v + 5 WHEN period LIKE '%-05' THEN v - 100 ELSE v END AS m, CAST(y AS DOUBLE) AS ytd, CASE WHEN period LIKE '%-06' THEN 3.5 END AS m_yoy FROM cl),
  pc AS (SELECT series_id, period, src, 'single' AS caliber, 'm' AS field, m AS value FROM cc UNION ALL SELECT series_id, period, src, 'single', 'm_yoy', m_yoy FROM cc WHERE m_yoy IS NOT NULL UNION ALL SELECT series_id, period, src, 'ytd', 'ytd', ytd FROM cc),
  lb AS (SELECT * FROM (VALUES ('ser-N', 'shipments'), ('ser-R', 'Returns'), ('ser-A', 'Sales')) t(series_id, label)),
  ind AS (SELECT p.*, CASE WHEN src LIKE 'dg:%' THEN substr(src, 4) END AS tag FROM pc p), cand AS (SELECT i.series_id, i.period, i.caliber, i.field, i.value, i.tag AS indicator, 'tag' AS by FROM ind i WHERE tag IS NOT NULL
    UNION ALL SELECT i.series_id, i.period, i.caliber, i.field, i.value, w.indicator, CASE WHEN w.indicator IS NULL THEN 'none' ELSE 'label' END FROM ind i LEFT JOIN (SELECT DISTINCT lb.series_id, rc.indicator FROM lb JOIN rc ON contains(rc.name, lb.label)) w ON w.series_id = i.series_id WHERE tag IS NULL)
  SELECT c.series_id, c.period, c.caliber, c.field, CASE WHEN BOOL_OR(COALESCE(ABS(r.value - c.value) <= 0.06 + 1e-9 OR ABS(r.value - 100 - c.value) <= 0.06 + 1e-9, FALSE)) THEN 'verified' WHEN BOOL_OR(r.value IS NOT NULL) THEN 'mismatch' ELSE 'gap' END AS state, MIN(c.by) AS by
  FROM cand c LEFT JOIN rc r ON r.indicator = c.indicator AND r.period = c.period AND r.period NOT LIKE '%-07' GROUP BY 1, 2, 3, 4"""


@query("audit_api_sample", API_SQL)
def _(x):
    """Series of line items against the captures that they come from: by tag, by label, or by neither; some months are off, published less 100, or not captured."""
    name = F.when(F.col("indicator") == "ind-A", "Returns accepted").when(F.col("indicator") == "ind-N", "New shipments").otherwise("Returns refused")
    raw = x.held(latest_captures(x.captures).select("indicator", name.alias("name"), F.concat(F.substring("code", 1, 4), F.lit("-"), F.substring("code", 5, 2)).alias("period"), "value"))
    flag, month = F.expr("substr(indicator, 5)"), F.substring("period", 6, 2)
    ytd = F.expr("sum(CAST(value AS DECIMAL(28,2))) OVER (PARTITION BY indicator, substr(period, 1, 4) ORDER BY period)").cast("double")
    src = F.when((flag == "A") & (month != "08"), "dg:ind-A").when(flag == "N", "natdata:x")
    m = F.when(month == "04", F.col("value") + 5).when(month == "05", F.col("value") - 100).otherwise(F.col("value"))
    none = F.lit(None).cast("double")
    cells = raw.select(F.concat(F.lit("ser-"), flag).alias("series_id"), "period", src.alias("src"), m.alias("m"), F.when(month == "06", 3.5).alias("m_yoy"), ytd.alias("ytd"), none.alias("ytd_yoy"))
    both = cells.select("series_id", "period", F.explode(F.array(F.lit("single"), F.lit("ytd"))).alias("caliber"))
    labels = x.rows([("ser-N", "shipments"), ("ser-R", "Returns"), ("ser-A", "Sales")], "series_id string, label string")
    return Z.api_check(both, cells, raw.where("substr(period, 6, 2) <> '07'"), labels)
