"""Queries on aggregations, sorts, set operations and scalar functions."""

from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P
from ledgerline.functions import text as X
from ledgerline.operators import merge as G
from ledgerline.operators import reduce as R
from ledgerline.plans.registry import query

GROUPS = tuple((n, "core" if n < 4 else "second") for n in range(12))
MEAN = "ROUND(CAST(SUM(CAST(m AS DECIMAL(20,4))) AS DOUBLE) / COUNT(m), 4) AS mean, COUNT(m) AS n"


@query("panel_mean", f"SELECT metric, period, {MEAN} FROM panel GROUP BY 1, 2 HAVING COUNT(m) > 0")
def _(x):
    return R.panel_mean(x.panel)


@query("panel_up_count", "SELECT metric, period, COUNT(*) FILTER (WHERE m > 0) AS up, COUNT(*) FILTER (WHERE m = 0) AS flat, COUNT(*) FILTER (WHERE m < 0) AS down FROM panel GROUP BY 1, 2")
def _(x):
    return R.panel_counts(x.panel)


@query("panel_latest_by_entity", "SELECT a.entity, a.metric, a.period, a.m FROM panel a WHERE period = (SELECT MAX(period) FROM panel b WHERE b.entity = a.entity AND b.metric = a.metric)")
def _(x):
    return R.panel_latest(x.panel)


@query("group_mean", f"""SELECT CASE WHEN entity < 4 THEN 'core' WHEN entity < 12 THEN 'second' ELSE 'other' END AS "group", metric, period, {MEAN} FROM panel GROUP BY 1, 2, 3 HAVING COUNT(m) > 0""")
def _(x):
    return R.group_mean(x.panel, x.rows(GROUPS, "entity int, `group` string"))


@query("sum_parts_series", """+ t AS (SELECT c.section, o.period, SUM(CAST(o.m AS DECIMAL(28,2)))::DOUBLE AS summed, COUNT(*) AS n FROM obs o JOIN catalog c USING (series_id) WHERE c.section = 'market' GROUP BY 1, 2)
  SELECT section AS total, period, summed, n FROM t WHERE n = (SELECT COUNT(*) FROM catalog WHERE section = 'market')""")
def _(x):
    return G.sum_parts(x.obs, x.catalog.where("section = 'market'").select(F.col("section").alias("total"), "series_id"))


@query("true_latest", """+ e AS (SELECT series_id, period, CASE WHEN length(period) = 4 THEN 12 WHEN period LIKE '%Q%' THEN CAST(substr(period, 7, 1) AS INT) * 3 ELSE CAST(substr(period, 6, 2) AS INT) END AS mo,
    CASE WHEN length(period) = 4 THEN 0 WHEN period LIKE '%Q%' THEN CAST(substr(period, 7, 1) AS INT) * 3 - 2 ELSE CAST(substr(period, 6, 2) AS INT) END AS rk FROM mixed)
  SELECT series_id, arg_max(period, CAST(substr(period, 1, 4) AS INT) * 10000 + mo * 100 - rk) AS period FROM e GROUP BY 1""")
def _(x):
    return R.true_latest(x.mixed, ("m",))


@query("latest_by_lane", "SELECT o.series_id, o.period, CASE WHEN c.headline = 'single' THEN o.m ELSE o.ytd END AS value FROM obs o JOIN catalog c USING (series_id) WHERE o.period = (SELECT MAX(period) FROM obs b WHERE b.series_id = o.series_id)")
def _(x):
    from ledgerline.operators.series import resolve_latest

    rows = x.obs.join(x.catalog.select("series_id", "headline"), "series_id").withColumn("value", F.when(F.col("headline") == "single", F.col("m")).otherwise(F.col("ytd")))
    return resolve_latest(rows, "value", "m_yoy").select("series_id", "period", "value")


@query("freshness_max", "SELECT c.section, MAX(period) AS latest, MIN(last) AS oldest FROM (SELECT series_id, period, MAX(period) OVER (PARTITION BY series_id) AS last FROM obs) o JOIN catalog c USING (series_id) GROUP BY 1")
def _(x):
    last = x.obs.groupBy("series_id").agg(F.max("period").alias("last")).join(x.catalog.select("series_id", "section"), "series_id")
    return last.groupBy("section").agg(F.max("last").alias("latest"), F.min("last").alias("oldest"))


FIND = "f AS (SELECT series_id, period, CASE WHEN span = 2 THEN 'jan_feb' ELSE 'yoy' END AS check_id, CASE WHEN ABS(m_yoy) > 100 THEN 'block' WHEN ABS(m_yoy) > 40 THEN 'warn' WHEN m_yoy IS NULL THEN 'skip' ELSE 'pass' END AS status FROM obs)"


def _findings(x):
    size = F.abs("m_yoy")
    status = F.when(size > 100, "block").when(size > 40, "warn").when(size.isNull(), "skip").otherwise("pass")
    return x.obs.select("series_id", "period", F.when(F.col("span") == 2, "jan_feb").otherwise("yoy").alias("check_id"), status.alias("status"))


@query("status_rollup", f"+ {FIND}, r AS (SELECT check_id, MAX(CASE status WHEN 'pass' THEN 1 WHEN 'skip' THEN 2 WHEN 'warn' THEN 3 ELSE 4 END) AS r, COUNT(*) AS n FROM f GROUP BY 1) SELECT check_id, ['pass', 'skip', 'warn', 'block'][r] AS status, n, CASE WHEN r = 4 THEN 2 ELSE 0 END AS exit_code FROM r")
def _(x):
    return R.status_rollup(_findings(x))


@query("write_findings_report", f"+ {FIND} SELECT check_id, status, COUNT(*) AS n FROM f GROUP BY 1, 2")
def _(x):
    return _findings(x).groupBy("check_id", "status").agg(F.count("*").alias("n"))


@query("findings_union", f"+ {FIND} SELECT status, COUNT(*) AS n FROM (SELECT * FROM f UNION ALL SELECT series_id, period, 'again', status FROM f WHERE status = 'block') GROUP BY 1")
def _(x):
    f = _findings(x)
    return f.unionByName(f.where("status = 'block'").withColumn("check_id", F.lit("again"))).groupBy("status").agg(F.count("*").alias("n"))


@query("topn_findings", f"+ {FIND}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY status ORDER BY series_id, period) AS n FROM f WHERE status IN ('block', 'warn')) SELECT series_id, period, status, n FROM r WHERE n <= CASE WHEN status = 'block' THEN 50 ELSE 30 END")
def _(x):
    rows = _findings(x).where("status IN ('block', 'warn')").withColumn("n", F.expr("row_number() OVER (PARTITION BY status ORDER BY series_id, period)"))
    return rows.where("n <= CASE WHEN status = 'block' THEN 50 ELSE 30 END").select("series_id", "period", "status", F.col("n").cast("long").alias("n"))


COV = "s AS (SELECT c.section, CASE WHEN b.m IS NULL THEN 'gap' WHEN ABS(a.m - b.m) < 1e-9 THEN 'verified' ELSE 'mismatch' END AS state FROM obs a LEFT JOIN old b USING (series_id, period) JOIN catalog c USING (series_id))"


@query("coverage_rollup", f"+ {COV} SELECT section, COUNT(*) FILTER (WHERE state = 'verified') AS verified, COUNT(*) FILTER (WHERE state = 'mismatch') AS mismatch, COUNT(*) FILTER (WHERE state = 'gap') AS gap, COUNT(*) AS n, ROUND(COUNT(*) FILTER (WHERE state = 'verified')::DOUBLE / COUNT(*) * 100, 1) AS share FROM s GROUP BY 1")
def _(x):
    old = x.old.select("series_id", "period", F.col("m").alias("b"))
    state = F.when(F.col("b").isNull(), "gap").when(F.abs(F.col("m") - F.col("b")) < 1e-9, "verified").otherwise("mismatch")
    return R.coverage(x.obs.join(old, ["series_id", "period"], "left").withColumn("state", state).join(x.catalog.select("series_id", "section"), "series_id"), ["section"])


@query("profile_series", """SELECT series_id, COUNT(*) AS n, MIN(period) AS first, MAX(period) AS last, 'YYYY-MM' AS formats, COUNT(DISTINCT concat_ws('+', CASE WHEN m IS NOT NULL THEN 'm' END, CASE WHEN ytd IS NOT NULL THEN 'ytd' END, CASE WHEN m_yoy IS NOT NULL THEN 'm_yoy' END, CASE WHEN ytd_yoy IS NOT NULL THEN 'ytd_yoy' END)) AS signatures,
  COUNT(m) AS n_m, COUNT(ytd) AS n_ytd, COUNT(m_yoy) AS n_m_yoy, COUNT(ytd_yoy) AS n_ytd_yoy FROM obs GROUP BY 1""")
def _(x):
    return R.profile(x.obs)


@query("infer_frequency", """+ o AS (SELECT series_id, CAST(substr(period, 1, 4) AS INT) * 12 + CAST(substr(period, 6, 2) AS INT) AS o FROM obs), g AS (SELECT series_id, o - lag(o) OVER (PARTITION BY series_id ORDER BY o) AS gap FROM o),
  c AS (SELECT series_id, gap, COUNT(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2), b AS (SELECT series_id, arg_max(gap, (n, -gap)) AS gap, COUNT(*) AS kinds FROM c GROUP BY 1)
  SELECT series_id, gap, CASE gap WHEN 1 THEN 'monthly' WHEN 3 THEN 'quarterly' WHEN 12 THEN 'annual' ELSE 'irregular' END || CASE WHEN kinds > 1 THEN ' (with gaps)' ELSE '' END AS frequency FROM b""")
def _(x):
    return R.infer_frequency(x.obs)


@query("missing_calendar_periods", """+ e AS (SELECT series_id, MIN(period) AS a, MAX(period) AS b FROM obs GROUP BY 1), q AS (SELECT series_id, strftime(unnest(generate_series(CAST(a || '-01' AS TIMESTAMP), CAST(b || '-01' AS TIMESTAMP), INTERVAL 1 MONTH)), '%Y-%m') AS period FROM e)
  SELECT series_id, period FROM q WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.series_id = q.series_id AND o.period = q.period)""")
def _(x):
    return R.missing_months(x.obs)


@query("entity_coverage", "+ t AS (SELECT metric, period, COUNT(DISTINCT entity) AS entities, COUNT(*) FILTER (WHERE m IS NULL) AS nulls FROM panel GROUP BY 1, 2) SELECT *, entities < (SELECT COUNT(*) FROM nation) AS short FROM t")
def _(x):
    full = x.table("nation").agg(F.count("*").alias("_all"))
    rows = x.panel.groupBy("metric", "period").agg(F.countDistinct("entity").alias("entities"), R.count_where(F.col("m").isNull()).alias("nulls"))
    return rows.join(F.broadcast(full)).select("metric", "period", "entities", "nulls", (F.col("entities") < F.col("_all")).alias("short"))


@query("dead_series", "SELECT series_id, 'dead' AS problem, NULL AS period FROM catalog WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.series_id = catalog.series_id AND o.period < '1995-03') UNION ALL SELECT series_id, 'null', period FROM obs WHERE series_id LIKE 'mkt-%' AND m_yoy IS NULL")
def _(x):
    dead = x.catalog.select("series_id").join(x.obs.where("period < '1995-03'"), "series_id", "left_anti").select("series_id", F.lit("dead").alias("problem"), F.lit(None).cast("string").alias("period"))
    return dead.union(x.obs.where("series_id LIKE 'mkt-%' AND m_yoy IS NULL").select("series_id", F.lit("null"), "period"))


@query("infer_decimals", "SELECT series_id, MAX(CASE WHEN m IS NULL THEN NULL WHEN ABS(ROUND(m, 0) - m) < 1e-9 THEN 0 WHEN ABS(ROUND(m, 1) - m) < 1e-9 THEN 1 WHEN ABS(ROUND(m, 2) - m) < 1e-9 THEN 2 WHEN ABS(ROUND(m, 3) - m) < 1e-9 THEN 3 ELSE 4 END) AS decimals FROM (SELECT series_id, ROUND(m / 7, CAST(substr(period, 7, 1) AS INT) % 3) AS m FROM obs) GROUP BY 1")
def _(x):
    d = F.substring("period", 7, 1).cast("int") % 3
    rounded = F.when(d == 0, F.round(F.col("m") / 7, 0)).when(d == 1, F.round(F.col("m") / 7, 1)).otherwise(F.round(F.col("m") / 7, 2))
    return R.infer_decimals(x.obs.withColumn("m", rounded), "m")


@query("dataset_fingerprint", """+ c AS (SELECT series_id, sha256(period || '|' || span || '|' || CAST(CAST(m AS DECIMAL(28,2)) AS VARCHAR) || '|' || COALESCE(CAST(CAST(ytd AS DECIMAL(28,2)) AS VARCHAR), '~')) AS h FROM obs)
  SELECT series_id, sha256(string_agg(h, chr(10) ORDER BY h)) AS hash FROM c GROUP BY 1""")
def _(x):
    exact = x.obs.withColumn("m", F.col("m").cast("decimal(28,2)")).withColumn("ytd", F.col("ytd").cast("decimal(28,2)"))
    return R.fingerprint(exact, ["period", "span", "m", "ytd"])


# --- sorts ------------------------------------------------------------------------------------------------------------


@query("sort_periods", """+ k AS (SELECT series_id, period, CAST(substr(period, 1, 4) AS INT) * 100 + CASE WHEN length(period) = 4 THEN 0 WHEN period LIKE '%Q%' THEN CAST(substr(period, 7, 1) AS INT) * 3 - 2 ELSE CAST(substr(period, 6, 2) AS INT) END AS sort_key FROM mixed)
  SELECT series_id, period, sort_key, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY sort_key, period) AS place FROM k""")
def _(x):
    rows = x.mixed.select("series_id", "period", P.period_sort_key("period").alias("sort_key"))
    return rows.withColumn("place", F.expr("row_number() OVER (PARTITION BY series_id ORDER BY sort_key, period)").cast("long")).orderBy("series_id", "sort_key")


@query("sort_catalog", "SELECT series_id, section, tier, ROW_NUMBER() OVER (PARTITION BY section ORDER BY tier, series_id) AS place FROM catalog")
def _(x):
    rows = x.catalog.withColumn("place", F.expr("row_number() OVER (PARTITION BY section ORDER BY tier, series_id)").cast("long"))
    return rows.orderBy("section_order", "tier", "series_id").select("series_id", "section", "tier", "place")


@query("rank_entities_latest", """+ l AS (SELECT a.entity, a.metric, a.m FROM panel a WHERE period = (SELECT MAX(period) FROM panel b WHERE b.entity = a.entity AND b.metric = a.metric))
  SELECT metric, entity, m, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY m DESC NULLS LAST, entity) AS place FROM l""")
def _(x):
    rows = R.panel_latest(x.panel).withColumn("place", F.expr("row_number() OVER (PARTITION BY metric ORDER BY m DESC NULLS LAST, entity)").cast("long"))
    return rows.select("metric", "entity", "m", "place")


@query("latest_candidate", "SELECT split_part(split_part(url, '//', 2), '/', 1) AS host, arg_max(page_id, (regexp_extract(url, '[0-9]+'), url)) AS page_id, COUNT(*) AS n FROM pages GROUP BY 1", pre=False)
def _(x):
    host = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    return x.table("pages").groupBy(host.alias("host")).agg(F.max_by("page_id", F.struct(F.regexp_extract("url", "[0-9]+", 0), "url")).alias("page_id"), F.count("*").alias("n"))


@query("nearest_period", """+ t AS (SELECT series_id, period, CAST(substr(period, 1, 4) AS INT) * 12 + CAST(substr(period, 6, 2) AS INT) AS o FROM obs WHERE substr(period, 6, 2) IN ('02', '05', '11'))
  SELECT series_id, arg_min(period, (ABS(o - 23998), o)) AS period FROM t GROUP BY 1""")
def _(x):
    rows = x.obs.where("substr(period, 6, 2) IN ('02', '05', '11')").select("series_id", "period", P.period_ordinal("period").alias("o"))
    return rows.groupBy("series_id").agg(F.min_by("period", F.struct(F.abs(F.col("o") - 23998), "o")).alias("period"))


# --- sets -------------------------------------------------------------------------------------------------------------


@query("id_set_diff", "SELECT series_id, 'missing' AS side FROM (SELECT series_id FROM catalog EXCEPT SELECT series_id FROM obs WHERE series_id <> 'nat-2') UNION ALL SELECT series_id, 'extra' FROM (SELECT series_id FROM obs EXCEPT SELECT series_id FROM catalog WHERE series_id <> 'nat-4')")
def _(x):
    declared, present = x.catalog.select("series_id"), x.obs.select("series_id").distinct()
    missing = declared.subtract(present.where("series_id <> 'nat-2'")).withColumn("side", F.lit("missing"))
    return missing.union(present.subtract(declared.where("series_id <> 'nat-4'")).withColumn("side", F.lit("extra")))


@query("rebuild_set_diff", "SELECT series_id, period, 'only old' AS side FROM (SELECT series_id, period, m FROM old EXCEPT ALL SELECT series_id, period, m FROM obs) UNION ALL SELECT series_id, period, 'only new' FROM (SELECT series_id, period, m FROM obs EXCEPT ALL SELECT series_id, period, m FROM old)")
def _(x):
    a, b = x.old.select("series_id", "period", "m"), x.obs.select("series_id", "period", "m")
    return a.exceptAll(b).select("series_id", "period", F.lit("only old").alias("side")).union(b.exceptAll(a).select("series_id", "period", F.lit("only new")))


@query("common_outputs", "SELECT series_id, period FROM old INTERSECT SELECT series_id, period FROM obs WHERE period >= '2000'")
def _(x):
    return x.old.select("series_id", "period").intersect(x.obs.where("period >= '2000'").select("series_id", "period"))


@query("required_anchor_groups", """+ seen AS (SELECT nat, period, list(DISTINCT seg) AS fields FROM cells GROUP BY 1, 2) SELECT nat, period, len(list_intersect(fields, ['BUILDING', 'MACHINERY'])) > 0 AS first_ok, len(list_intersect(fields, ['HOUSEHOLD'])) > 0 AS second_ok FROM seen""")
def _(x):
    seen = x.cells.groupBy("nat", "period").agg(F.collect_set("seg").alias("fields"))
    has = lambda *names: F.arrays_overlap("fields", F.array(*map(F.lit, names)))
    return seen.select("nat", "period", has("BUILDING", "MACHINERY").alias("first_ok"), has("HOUSEHOLD").alias("second_ok"))


@query("touched_union", "SELECT period FROM release WHERE series_id = 'nat-0' UNION SELECT period FROM release WHERE series_id IN ('nat-1', 'mkt-BUILDING')")
def _(x):
    return x.release.where("series_id = 'nat-0'").select("period").union(x.release.where("series_id IN ('nat-1', 'mkt-BUILDING')").select("period")).distinct()


# --- scalar functions over whole tables --------------------------------------------------------------------------------


@query("fn_periods", """+ p AS (SELECT series_id, period, CASE WHEN length(period) = 4 THEN 'A' WHEN period LIKE '%Q%' THEN 'Q' ELSE 'M' END AS shape, CAST(substr(period, 1, 4) AS INT) AS y FROM mixed),
  q AS (SELECT *, CASE shape WHEN 'A' THEN 12 WHEN 'Q' THEN CAST(substr(period, 7, 1) AS INT) * 3 ELSE CAST(substr(period, 6, 2) AS INT) END AS mo FROM p)
  SELECT series_id, period, shape, y * 12 + mo AS ordinal, last_day(make_date(y, mo, 1)) AS ends, (y - 1) || substr(period, 5) AS ago,
  CASE shape WHEN 'A' THEN CAST(y + 1 AS VARCHAR) WHEN 'Q' THEN CASE WHEN mo = 12 THEN (y + 1) || '-Q1' ELSE y || '-Q' || (mo // 3 + 1) END ELSE CASE WHEN mo = 12 THEN (y + 1) || '-01' ELSE y || '-' || lpad(CAST(mo + 1 AS VARCHAR), 2, '0') END END AS next,
  CASE WHEN shape = 'A' OR (shape = 'Q' AND mo = 3) OR (shape = 'M' AND mo = 1) THEN NULL WHEN shape = 'Q' THEN y || '-Q' || (mo // 3 - 1) ELSE y || '-' || lpad(CAST(mo - 1 AS VARCHAR), 2, '0') END AS prev,
  CASE shape WHEN 'A' THEN y || 'AA' WHEN 'Q' THEN y || '0' || (mo // 3) || 'SS' ELSE y || lpad(CAST(mo AS VARCHAR), 2, '0') || 'MM' END AS code,
  CASE shape WHEN 'A' THEN y || ' 年全年' WHEN 'Q' THEN y || ' 年' || ['一', '二', '三', '四'][mo // 3] || '季度' ELSE y || ' 年 ' || mo || ' 月' END AS label FROM q""")
def _(x):
    return x.mixed.select(
        "series_id", "period", P.period_shape("period").alias("shape"), P.period_ordinal("period").alias("ordinal"), P.period_end_date("period").alias("ends"), P.year_ago_period("period").alias("ago"),
        P.next_period("period").alias("next"), P.prev_ytd_period("period").alias("prev"), P.encode_code("period").alias("code"), P.period_label("period", F.lit(False), F.lit(1)).alias("label"),
    )


@query("fn_numbers", """SELECT series_id, period, CASE WHEN ABS(m_yoy) = 0 THEN 0.0 ELSE ABS(m_yoy - ytd_yoy) / NULLIF(GREATEST(ABS(m_yoy), ABS(ytd_yoy)), 0) END AS rel,
  CASE WHEN ABS(m_yoy) < 10 THEN 0.06 WHEN ABS(m_yoy) < 100 THEN 0.1 WHEN ABS(m_yoy) < 10000 THEN 1.0 ELSE ABS(m_yoy) * 0.001 END AS tolerance,
  CASE WHEN m_yoy > 0 THEN 'up' WHEN m_yoy < 0 THEN 'down' WHEN m_yoy = 0 THEN 'flat' ELSE 'none' END AS direction, format('{:.1f}%', ABS(m_yoy)) AS pct FROM obs WHERE m_yoy IS NOT NULL AND ytd_yoy IS NOT NULL AND m_yoy <> 0""")
def _(x):
    y, z = F.col("m_yoy"), F.col("ytd_yoy")
    rows = x.obs.where("m_yoy IS NOT NULL AND ytd_yoy IS NOT NULL AND m_yoy <> 0")
    return rows.select("series_id", "period", N.rel_diff(y, z).alias("rel"), N.tolerance_for(y).alias("tolerance"), N.up_down_class(y).alias("direction"), N.fmt_pct(y).alias("pct"))


@query("fn_text", r"""SELECT page_id, length(regexp_replace(html, '\s+', '', 'g')) AS compact, substr(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) AS slug, CASE WHEN url LIKE 'https%' THEN 'dg' ELSE 'other' END AS kind FROM pages""", pre=False)
def _(x):
    tag = F.when(F.col("url").startswith("https"), F.concat(F.lit("dg:"), "url")).otherwise(F.col("url"))
    return x.table("pages").select("page_id", F.length(X.compact_text(F.col("html"))).cast("long").alias("compact"), X.slugify(F.col("url")).alias("slug"), X.infer_source_kind(tag).alias("kind"))


@query("fn_labels", """SELECT c.series_id, CASE WHEN tier = 1 THEN 1 WHEN tier <= 4 THEN 2 ELSE 3 END AS tier_of_level, CASE WHEN tier = 3 THEN 'warn' ELSE 'block' END AS severity, '官方数据' AS agency,
  CASE tier WHEN 1 THEN '①' WHEN 2 THEN '②' ELSE '③' END AS numeral, o.period, substr(o.period, 1, 4) || ' 年 ' || CASE WHEN headline = 'ytd' AND CAST(substr(o.period, 6, 2) AS INT) > 1 THEN '1-' ELSE '' END || CAST(substr(o.period, 6, 2) AS INT) || ' 月' AS tooltip,
  CASE WHEN o.m_yoy IS NULL THEN '—' ELSE CASE WHEN o.m_yoy > 0 THEN '+' ELSE '' END || format('{:.1f}%', o.m_yoy) END AS pct FROM catalog c JOIN obs o USING (series_id)""")
def _(x):
    rows = x.catalog.join(x.obs, "series_id")
    return rows.select(
        "series_id", L.level_to_tier(F.col("tier")).alias("tier_of_level"), L.severity_for_mismatch(F.lit(None).cast("string"), F.col("tier")).alias("severity"), L.agency_from_id(F.col("series_id")).alias("agency"),
        L.circled_numeral(F.col("tier")).alias("numeral"), "period", L.tooltip_period("period", F.col("headline") == "ytd").alias("tooltip"), L.format_percent(F.col("m_yoy"), sign=True).alias("pct"),
    )
