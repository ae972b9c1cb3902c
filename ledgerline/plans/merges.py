"""Queries on merging releases, revisions and vintages."""

from pyspark.sql import functions as F

from ledgerline.operators import merge as G
from ledgerline.operators import reduce as R
from ledgerline.plans.registry import query
from ledgerline.plans.sql import BLOCKED

TODAY = "2002-03-01"
NEW = f"""+ new AS (SELECT * FROM release r WHERE NOT (measure LIKE '%yoy' AND {BLOCKED.format(a='r', p='period')})),
cls AS (SELECT n.series_id, n.period, n.measure, o.value AS old, n.value AS new,
  CASE WHEN NOT EXISTS (SELECT 1 FROM long_old q WHERE q.series_id = n.series_id AND q.period = n.period) THEN 'insert' WHEN o.value IS NULL THEN 'first_print' WHEN ABS(n.value - o.value) < 1e-9 THEN 'noop' ELSE 'revise' END AS class
  FROM new n LEFT JOIN long_old o USING (series_id, period, measure))"""
#: A log of revisions with dates: those of the release, and rounds of the same cells before.
LOG = NEW + """, log AS (SELECT series_id, period, measure, old, new, '2002-03-01' AS revised_on, 2 AS seq FROM cls WHERE class = 'revise'
  UNION ALL SELECT series_id, period, measure, old - 1, old, '2002-02-01', 1 FROM cls WHERE class = 'revise' AND measure = 'm')"""


def _new(x):
    return G.allowed(x.release, x.breaks)


def _classes(x):
    return G.classify(x.long(x.old), _new(x))


def _log(x):
    cls = _classes(x).where("class = 'revise'")
    first = cls.select(*G.CELL, "old", "new", F.lit(TODAY).alias("revised_on"), F.lit(2).alias("seq"))
    return first.union(cls.where("measure = 'm'").select(*G.CELL, F.col("old") - 1, "old", F.lit("2002-02-01"), F.lit(1)))


@query("revision_merge", NEW + " SELECT series_id, period, measure, CASE WHEN n.value IS NULL OR ABS(n.value - o.value) < 1e-9 THEN o.value ELSE n.value END AS value FROM long_old o FULL JOIN new n USING (series_id, period, measure)")
def _(x):
    return G.merged(x.long(x.old), _new(x))


@query("merge_report", NEW + " SELECT class, COUNT(*) AS n, COUNT(DISTINCT series_id) AS series FROM cls GROUP BY 1")
def _(x):
    return _classes(x).groupBy("class").agg(F.count("*").alias("n"), F.countDistinct("series_id").alias("series"))


@query(
    "merge_multi_row_order",
    """+ r AS (SELECT series_id, period, measure, 1 AS row_no, value + 1 AS value FROM release WHERE measure = 'm' UNION ALL SELECT series_id, period, measure, 2, value FROM release WHERE measure = 'm'),
    s AS (SELECT series_id, period, measure, 0 AS row_no, value FROM long_old WHERE (series_id, period, measure) IN (SELECT series_id, period, measure FROM r) UNION ALL SELECT * FROM r),
    l AS (SELECT *, lag(value) OVER (PARTITION BY series_id, period, measure ORDER BY row_no) AS old FROM s)
    SELECT series_id, period, measure, row_no, old, value AS new FROM l WHERE row_no > 0 AND ABS(value - old) >= 1e-9""",
)
def _(x):
    rows = x.release.where("measure = 'm'").select(*G.CELL, "value")
    both = rows.select(*G.CELL, F.lit(1).alias("row_no"), (F.col("value") + 1).alias("value")).union(rows.select(*G.CELL, F.lit(2), "value"))
    return G.in_order(x.long(x.old), both)


@query("jan_feb_validate", """+ t AS (SELECT series_id, period, CASE WHEN period = '1999-02' AND series_id LIKE 'nat-1%' THEN 1 ELSE span END AS span, span = 2 AS f FROM obs UNION ALL SELECT series_id, '2000-01', 1, FALSE FROM catalog WHERE tier = 1),
  y AS (SELECT DISTINCT series_id, substr(period, 1, 4) AS y FROM t WHERE f)
  SELECT t.series_id, t.period, t.span, CASE WHEN f THEN 'flag' ELSE 'january' END AS problem FROM t WHERE (f AND (period NOT LIKE '%-02' OR span <> 2)) OR (period LIKE '%-01' AND (series_id, substr(period, 1, 4)) IN (SELECT series_id, y FROM y))""")
def _(x):
    wrong = F.when((F.col("period") == "1999-02") & F.col("series_id").startswith("nat-1"), 1).otherwise(F.col("span"))
    rows = x.obs.select("series_id", "period", wrong.alias("span"), (F.col("span") == 2).alias("f"))
    rows = rows.union(x.catalog.where("tier = 1").select("series_id", F.lit("2000-01"), F.lit(1), F.lit(False)))
    return G.jan_feb_problems(rows, F.col("f"))


@query("as_published_vintage", LOG + """, cur AS (SELECT series_id, period, measure, COALESCE(n.value, o.value) AS value FROM long_old o FULL JOIN new n USING (series_id, period, measure))
  SELECT c.series_id, c.period, c.measure, CASE WHEN l.series_id IS NULL THEN c.value ELSE l.old END AS value FROM cur c LEFT JOIN (SELECT series_id, period, measure, arg_min(old, seq) AS old FROM log WHERE revised_on > '2002-02-15' GROUP BY 1, 2, 3) l USING (series_id, period, measure)""")
def _(x):
    a, b = x.long(x.old).select(*G.CELL, F.col("value").alias("o")), _new(x).select(*G.CELL, F.col("value").alias("n"))
    current = a.join(b, G.CELL, "full_outer").select(*G.CELL, F.coalesce("n", "o").alias("value"))
    return G.as_published(current, _log(x), "2002-02-15")


@query("vintage_twin_revisions", "SELECT series_id, period, measure, o.value AS old, n.value AS new FROM long_old o JOIN long_obs n USING (series_id, period, measure) WHERE o.value <> n.value")
def _(x):
    return G.twin_revisions(x.long(x.old), x.long(x.obs))


@query("stage_identity_replay", NEW + " SELECT (SELECT COUNT(*) FROM cls WHERE class <> 'noop') AS first, (SELECT COUNT(*) FROM new WHERE series_id = 'nat-4' AND measure = 'm') AS again")
def _(x):
    """How many cells a release changes, and how many when it comes again with one nation's levels moved: those only."""
    new = _new(x)
    state = G.merged(x.long(x.old), new)
    moved = new.withColumn("value", F.when((F.col("series_id") == "nat-4") & (F.col("measure") == "m"), F.col("value") + 1).otherwise(F.col("value")))
    count = lambda cls, name: cls.where("class <> 'noop'").agg(F.count("*").alias(name))
    return count(G.classify(x.long(x.old), new), "first").join(count(G.classify(state, moved), "again"))  # one row each


@query("revision_integrity", LOG + """, r AS (SELECT series_id, period, measure, CASE WHEN series_id = 'nat-2' THEN old + 1 ELSE old END AS old, CASE WHEN series_id = 'nat-4' THEN new + 1 ELSE new END AS new, CASE WHEN series_id = 'nat-6' THEN '2002-02-28' ELSE revised_on END AS revised_on FROM log WHERE seq = 2)
  SELECT series_id, period, measure, old, new, CASE series_id WHEN 'nat-2' THEN 'old' WHEN 'nat-4' THEN 'new' ELSE 'date' END AS problem FROM r WHERE series_id IN ('nat-2', 'nat-4', 'nat-6')""")
def _(x):
    log = _log(x).where("seq = 2")
    bump = lambda c, s: F.when(F.col("series_id") == s, F.col(c) + 1).otherwise(F.col(c))
    log = log.withColumns({"old": bump("old", "nat-2"), "new": bump("new", "nat-4"), "revised_on": F.when(F.col("series_id") == "nat-6", "2002-02-28").otherwise(F.col("revised_on"))})
    return G.integrity(log, x.long(x.old), _new(x), TODAY)


@query("revision_log_kept", LOG + " SELECT series_id, period, measure, old, new, revised_on FROM log WHERE measure = 'm' AND seq = 1 AND series_id = 'mkt-FURNITURE'")
def _(x):
    """The old log must be contained in the new one, as often; here the new one has lost a series' first round."""
    log = _log(x).drop("seq")
    return G.lost_revisions(log, log.where("NOT (measure = 'm' AND revised_on = '2002-02-01' AND series_id = 'mkt-FURNITURE')"))


@query("revision_flood", LOG + """, o AS (SELECT series_id, COUNT(*) AS observations FROM obs GROUP BY 1), r AS (SELECT series_id, COUNT(*) AS revised FROM log GROUP BY 1)
  SELECT series_id, revised, observations FROM r JOIN o USING (series_id) WHERE revised > 6 OR revised > observations * 0.1""")
def _(x):
    return G.flood(_log(x), x.obs)


@query("catalog_fragment_merge", """+ frag AS (SELECT series_id, section, section_order, tier, CASE WHEN series_id = 'nat-3' THEN 'OTHER' ELSE name END AS name, value_type, headline FROM catalog WHERE tier = 2 OR series_id = 'nat-3' UNION ALL SELECT 'nat-' || (n_nationkey + 100), 'nation', 2, 3, n_name, 'level', 'ytd' FROM nation WHERE n_regionkey = 0)
  SELECT series_id, COALESCE(c.section, f.section) AS section, COALESCE(c.section_order, f.section_order) AS section_order, COALESCE(c.tier, f.tier) AS tier, COALESCE(c.name, f.name) AS name, COALESCE(c.value_type, f.value_type) AS value_type, COALESCE(c.headline, f.headline) AS headline,
  CASE WHEN f.tier IS NULL THEN 'kept' WHEN c.tier IS NULL THEN 'inserted' WHEN c.name = f.name THEN 'same' ELSE 'conflict' END AS state FROM catalog c FULL JOIN frag f USING (series_id)""")
def _(x):
    c = x.catalog
    frag = c.where("tier = 2 OR series_id = 'nat-3'").withColumn("name", F.when(F.col("series_id") == "nat-3", "OTHER").otherwise(F.col("name")))
    more = x.table("nation").where("n_regionkey = 0").select(F.concat(F.lit("nat-"), F.col("n_nationkey") + 100), F.lit("nation"), F.lit(2), F.lit(3), "n_name", F.lit("level"), F.lit("ytd"))
    return G.fragment_merge(c, frag.union(more))


@query("level_jump_test", """+ b AS (SELECT series_id, period, m, lag(m) OVER w AS last, ROW_NUMBER() OVER w AS n FROM obs WINDOW w AS (PARTITION BY series_id ORDER BY period)), c AS (SELECT *, ABS(m / last - 1) AS chg FROM b),
  s AS (SELECT c.series_id, c.period, c.n, c.chg FROM c JOIN breaks k ON k.series_id = c.series_id WHERE c.period = (SELECT MIN(period) FROM obs o WHERE o.series_id = k.series_id AND o.period >= k.effective))
  SELECT s.series_id, s.period, ROUND(s.chg * 100, 1) AS jump_pct, CASE WHEN s.chg > GREATEST(5 * (SELECT AVG(chg) FROM c WHERE c.series_id = s.series_id AND c.n < s.n AND c.n >= s.n - 12), 0.03) THEN 'redefined' ELSE 'restated' END AS verdict FROM s""")
def _(x):
    return R.level_jumps(x.obs, x.breaks)
