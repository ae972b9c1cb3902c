"""Queries on joins: other periods, parts and wholes, breaks, configuration, vintages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.operators import breaks as B
from ledgerline.operators import merge as G
from ledgerline.operators import series as S
from ledgerline.plans.registry import query
from ledgerline.plans.sql import BLOCKED, SEAM, values

PREV = "CASE WHEN substr({a}.period, 6, 2) = '01' THEN NULL ELSE substr({a}.period, 1, 5) || lpad(CAST(CAST(substr({a}.period, 6, 2) AS INT) - 1 AS VARCHAR), 2, '0') END"
AGO = "lpad(CAST(CAST(substr({a}.period, 1, 4) AS INT) - 1 AS VARCHAR), 4, '0') || substr({a}.period, 5)"
#: source, field -> series; one field has no series on file and two have none at all.
FIELDS = (("press", "BUILDING", "mkt-BUILDING"), ("press", "MACHINERY", "mkt-MACHINERY"), ("press", "HOUSEHOLD", "mkt-HOME"), ("press", "AUTOMOBILE", "mkt-AUTOMOBILE"))
#: total -> part
PARTS = tuple(("nat-total", f"nat-{n}") for n in (0, 1, 2))
PAIRS = (("mkt-BUILDING", "mkt-MACHINERY", 5.0), ("nat-1", "nat-2", 20.0), ("nat-3", "nat-999", 1.0))
KNOWN = (("mkt-BUILDING", None, None, "rebase"), (None, "1999-02", "yoy_base", "holiday"), ("nat-7", "2000-05", None, "late"), (None, None, "seasonal", "all"))


@query("join_prior_period", f"SELECT a.series_id, a.period, a.ytd, b.ytd AS prior_ytd FROM obs a LEFT JOIN obs b ON a.series_id = b.series_id AND b.period = {PREV.format(a='a')}")
def _(x):
    return S.prior_period(x.obs, {"ytd": "prior_ytd"}).select("series_id", "period", "ytd", "prior_ytd")


@query("join_year_ago", f"SELECT a.series_id, a.period, a.m, b.m AS base FROM obs a LEFT JOIN obs b ON a.series_id = b.series_id AND a.span = b.span AND b.period = {AGO.format(a='a')}")
def _(x):
    return S.year_ago(x.obs, {"m": "base"}).select("series_id", "period", "m", "base")


@query(
    "join_multi_component",
    f"""+ parts AS (SELECT * FROM (VALUES {values(PARTS)}) t(total, series_id))
    SELECT p.total, o.period, SUM(CAST(o.m AS DECIMAL(28,2)))::DOUBLE AS summed, COUNT(*) AS n FROM obs o JOIN parts p USING (series_id) GROUP BY 1, 2 HAVING COUNT(*) = 3""",
)
def _(x):
    return G.sum_parts(x.obs, x.rows(PARTS, "total string, series_id string"))


@query(
    "join_ratio_inputs",
    "SELECT a.period, ROUND(a.m / NULLIF(b.m, 0) * 100, 2) AS ratio FROM obs a JOIN obs b ON a.period = b.period WHERE a.series_id = 'mkt-BUILDING' AND b.series_id = 'mkt-MACHINERY'",
)
def _(x):
    return G.ratio(x.obs.where("series_id = 'mkt-BUILDING'"), x.obs.where("series_id = 'mkt-MACHINERY'"), "m").select("period", F.round(F.col("ratio") * 100, 2).alias("ratio"))


@query("break_window_join", f"SELECT series_id, period, m_yoy FROM obs o WHERE {BLOCKED.format(a='o', p='period')}")
def _(x):
    return B.blocked(x.obs, x.breaks).where("blocked").select("series_id", "period", "m_yoy")


@query(
    "seam_between_join",
    f"""+ p AS (SELECT series_id, period, lag(period) OVER (PARTITION BY series_id ORDER BY period) AS prior FROM obs)
    SELECT series_id, period, prior FROM p WHERE {SEAM.format(a='p', p='period', q='p.prior')}""",
)
def _(x):
    rows = x.obs.select("series_id", "period", F.lag("period").over(Window.partitionBy("series_id").orderBy("period")).alias("prior"))
    return B.seam_between(rows, x.breaks, "prior").where("seam").drop("seam")


@query(
    "break_link_symmetry",
    """+ f AS (SELECT series_id, superseded_by AS other FROM breaks WHERE superseded_by IS NOT NULL), b AS (SELECT series_id, supersedes AS other FROM breaks WHERE supersedes IS NOT NULL),
    lost AS (SELECT f.series_id, f.other, 'superseded_by' AS side FROM f WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.series_id = f.other AND b.other = f.series_id)
    UNION ALL SELECT b.series_id, b.other, 'supersedes' FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.series_id = b.other AND f.other = b.series_id))
    SELECT l.*, CASE WHEN c.series_id IS NULL THEN 'WARN' ELSE 'BLOCK' END AS severity, (SELECT MAX(period) FROM obs WHERE obs.series_id = l.series_id) AS last_period FROM lost l LEFT JOIN catalog c ON c.series_id = l.other""",
)
def _(x):
    known = x.catalog.select(F.col("series_id").alias("other"), F.lit(True).alias("known"))
    last = x.obs.groupBy("series_id").agg(F.max("period").alias("last_period"))
    lost = B.link_findings(x.breaks).join(known, "other", "left").join(last, "series_id", "left")
    return lost.select("series_id", "other", "side", F.when(F.col("known"), "BLOCK").otherwise("WARN").alias("severity"), "last_period")


@query(
    "map_fields_to_series",
    f"""+ fields AS (SELECT * FROM (VALUES {values(FIELDS)}) t(source, field, series_id)), staged AS (SELECT 'press' AS source, seg AS field, period, SUM(v) AS v FROM cells GROUP BY 1, 2, 3)
    SELECT s.field, f.series_id, CASE WHEN f.series_id IS NULL THEN 'unmapped' WHEN c.series_id IS NULL THEN 'missing' ELSE 'mapped' END AS state, COUNT(*) AS n, CAST(SUM(s.v) AS DOUBLE) AS total
    FROM staged s LEFT JOIN fields f ON s.source = f.source AND s.field = f.field LEFT JOIN catalog c ON c.series_id = f.series_id GROUP BY 1, 2, 3""",
)
def _(x):
    staged = x.cells.groupBy(F.lit("press").alias("source"), F.col("seg").alias("field"), "period").agg(F.sum("v").alias("v"))
    found = G.map_fields(staged, x.rows(FIELDS, "source string, field string, series_id string"), x.catalog.select("series_id"))
    return found.groupBy("field", "series_id", "state").agg(F.count("*").alias("n"), F.sum("v").cast("double").alias("total"))


@query(
    "catalog_bundle_consistency",
    """+ pub AS (SELECT series_id, CASE WHEN series_id LIKE 'mkt-%' THEN 'market' ELSE 'nation' END AS section, COUNT(*) AS n FROM obs WHERE series_id <> 'nat-9' GROUP BY 1, 2 UNION ALL SELECT 'mkt-GHOST', 'market', 1),
    j AS (SELECT COALESCE(c.series_id, p.series_id) AS series_id, c.section AS declared, p.section AS published FROM (SELECT series_id, CASE WHEN series_id = 'nat-8' THEN 'market' ELSE section END AS section FROM catalog) c FULL JOIN pub p ON c.series_id = p.series_id)
    SELECT series_id, CASE WHEN declared IS NULL THEN 'stray' WHEN published IS NULL THEN 'unpublished' ELSE 'wrong section' END AS problem FROM j WHERE declared IS DISTINCT FROM published""",
)
def _(x):
    published = x.obs.where("series_id <> 'nat-9'").select("series_id", F.when(F.col("series_id").startswith("mkt-"), "market").otherwise("nation").alias("section")).distinct()
    published = published.union(x.rows([("mkt-GHOST", "market")], "series_id string, section string"))
    declared = x.catalog.select("series_id", F.when(F.col("series_id") == "nat-8", "market").otherwise(F.col("section")).alias("section"))
    return G.consistency(declared, published)


@query(
    "cross_source_pairs",
    """SELECT a.series_id, a.period, a.measure, a.value AS dg, b.value AS press FROM long_obs a JOIN long_old b USING (series_id, period, measure) WHERE measure LIKE '%yoy' AND ABS(a.value - b.value) > 0.5 * 0.1 + 1e-9""",
)
def _(x):
    return G.disagreements(x.long(x.obs), x.long(x.old), N.display_tolerance(F.lit(1))).where("measure LIKE '%yoy'").select("series_id", "period", "measure", F.col("a").alias("dg"), F.col("b").alias("press"))


@query(
    "republication_pairs",
    f"""+ pairs AS (SELECT * FROM (VALUES {values(PAIRS)}) t(first_id, second_id, tol))
    SELECT p.first_id, p.second_id, a.period, a.m_yoy AS first_value, b.m_yoy AS second_value FROM pairs p JOIN obs a ON a.series_id = p.first_id JOIN obs b ON b.series_id = p.second_id AND a.period = b.period WHERE ABS(a.m_yoy - b.m_yoy) > p.tol""",
)
def _(x):
    return G.republications(x.obs, x.rows(PAIRS, "first_id string, second_id string, tol double"), "m_yoy")


@query(
    "merge_vintages",
    """SELECT series_id, COUNT(*) AS periods, COUNT(*) FILTER (WHERE a.m IS NOT NULL AND b.m IS NOT NULL AND a.m <> b.m) AS mismatches, COUNT(*) FILTER (WHERE b.m IS NULL) AS only_new, COUNT(*) FILTER (WHERE a.m IS NULL) AS only_old,
    CAST(SUM(CAST(COALESCE(a.m, b.m) AS DECIMAL(28,2))) AS DOUBLE) AS total FROM obs a FULL JOIN old b USING (series_id, period) GROUP BY 1""",
)
def _(x):
    both = G.merge_vintages(x.obs.select("series_id", "period", "m"), x.old.select("series_id", "period", "m"), "m")
    n = lambda cond: F.count(F.when(cond, 1))
    return both.groupBy("series_id").agg(F.count("*").alias("periods"), n(F.col("state") == "mismatch").alias("mismatches"), n(F.col("state") == "new").alias("only_new"), n(F.col("state") == "old").alias("only_old"), F.sum(F.col("value").cast("decimal(28,2)")).cast("double").alias("total"))


@query(
    "window_stitch",
    """+ w AS (SELECT series_id, period, CASE WHEN substr(period, 6, 2) = '07' THEN NULL ELSE m END AS m, 2000 AS start FROM obs WHERE period >= '1999-06' UNION ALL SELECT series_id, period, m, 1995 FROM old WHERE period < '2000-12')
    SELECT series_id, period, arg_max(m, start) FILTER (WHERE m IS NOT NULL) AS m, MAX(start) FILTER (WHERE m IS NOT NULL) AS start FROM w GROUP BY 1, 2 HAVING COUNT(m) > 0""",
)
def _(x):
    later = x.obs.where("period >= '1999-06'").select("series_id", "period", F.when(F.substring("period", 6, 2) != "07", F.col("m")).alias("m"), F.lit(2000).alias("start"))
    return G.stitch(later.union(x.old.where("period < '2000-12'").select("series_id", "period", "m", F.lit(1995))), "m", "start")


@query(
    "known_exception_match",
    f"""+ known AS (SELECT * FROM (VALUES {values(KNOWN)}) t(series_id, period, check_id, note)), f AS (SELECT series_id, period, CASE WHEN m_yoy > 0 THEN 'yoy_base' ELSE 'unit' END AS check_id FROM obs WHERE m_yoy IS NOT NULL)
    SELECT f.*, EXISTS (SELECT 1 FROM known k WHERE (k.series_id IS NULL OR k.series_id = f.series_id) AND (k.period IS NULL OR k.period = f.period) AND (k.check_id IS NULL OR k.check_id = f.check_id)) AS known FROM f""",
)
def _(x):
    findings = x.obs.where("m_yoy IS NOT NULL").select("series_id", "period", F.when(F.col("m_yoy") > 0, "yoy_base").otherwise("unit").alias("check_id"))
    return G.known_exceptions(findings, KNOWN)


@query(
    "param_resolve",
    """SELECT series_id, COALESCE(CASE WHEN series_id = 'mkt-BUILDING' THEN 2.5 WHEN series_id = 'nat-3' THEN 3.5 END, CASE WHEN value_type = 'level' AND tier < 3 THEN 4.5 END, 4.0)::DOUBLE AS z_warn FROM catalog""",
)
def _(x):
    own = x.rows([("mkt-BUILDING", 2.5), ("nat-3", 3.5)], "series_id string, own double")
    kinds = x.rows([("level", 1, 4.5), ("level", 2, 4.5)], "value_type string, tier int, kind double")
    return G.resolve_parameter(x.catalog, own, kinds, ["value_type", "tier"], 4.0).select("series_id", F.col("value").alias("z_warn"))


@query(
    "candidate_match",
    """+ srs AS (SELECT p_partkey AS series_id, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 1 WHEN p_partkey % 7 = 0 THEN -1 END AS source_id, substr(split_part(p_name, ' ', 2), 2) AS label FROM part),
    direct AS (SELECT s.series_id, n.p_partkey, 'id' AS way, 0 AS extra FROM srs s JOIN part n ON n.p_partkey = s.source_id),
    lbl AS (SELECT DISTINCT label FROM srs WHERE series_id NOT IN (SELECT series_id FROM direct) AND label <> ''), hits AS (SELECT l.label, n.p_partkey, length(n.p_name) - length(l.label) AS extra FROM lbl l JOIN part n ON contains(n.p_name, l.label)),
    best AS (SELECT label, COUNT(*) AS n, arg_min(p_partkey, (extra, p_partkey)) AS best FROM hits GROUP BY 1)
    SELECT series_id, way, 1 AS n, p_partkey AS best FROM direct UNION ALL SELECT s.series_id, 'label', b.n, b.best FROM srs s JOIN best b USING (label) WHERE s.series_id NOT IN (SELECT series_id FROM direct)""",
)
def _(x):
    """Parts as series: some name their source, of which a few aren't on file; the others are found by a word without its first letter."""
    part, key = x.table("part"), F.col("p_partkey")
    source = F.when(key % 3 == 0, key + 1).when(key % 7 == 0, -1)
    series = part.select(key.alias("series_id"), source.alias("source_id"), F.expr("substr(split_part(p_name, ' ', 2), 2)").alias("label"))
    names = part.select("p_partkey", "p_name")
    direct = G.by_source(series, names, "p_partkey").select("series_id", F.col("by").alias("way"), F.lit(1).cast("long").alias("n"), F.col("p_partkey").alias("best"))
    rest = series.join(direct, "series_id", "left_anti")
    # Series of one label have the same candidates, and parts of one name are alike but for the first: both are looked up once each.
    texts = names.groupBy("p_name").agg(F.count("*").alias("n"), F.min("p_partkey").alias("p_partkey"))
    hits = G.label_hits(rest.select("label").distinct(), texts, "p_name")
    extra = F.char_length("p_name") - F.char_length("label")
    best = hits.groupBy("label").agg(F.sum("n").alias("n"), F.min_by("p_partkey", F.struct(extra.alias("extra"), "p_partkey")).alias("best"))
    return direct.union(rest.join(best, "label").select("series_id", F.lit("label").alias("way"), "n", "best"))
