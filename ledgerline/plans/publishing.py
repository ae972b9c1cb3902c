"""Queries on what is published, and on further table operations around it."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import periods as P
from ledgerline.operators import breaks as B
from ledgerline.operators import publish as U
from ledgerline.operators import series as S
from ledgerline.plans.registry import query
from ledgerline.plans.sql import BLOCKED
from ledgerline.plans.windows import RATES, rates, tail
from ledgerline.sources import readers as R
from ledgerline.sources import store as T

LAST = RATES + ", e AS (SELECT p.*, c.name, c.section, c.tier, c.headline, o.span, CASE WHEN c.headline = 'ytd' THEN o.ytd ELSE o.m END AS value FROM pair p JOIN obs o USING (series_id, period) JOIN catalog c USING (series_id) WHERE p.period = (SELECT MAX(period) FROM obs z WHERE z.series_id = p.series_id))"
FMT = "CASE WHEN ROUND(ABS({0}), 1) = ABS(ROUND({0}, 6)) THEN format('{{:.1f}}', ABS({0})) ELSE format('{{:.2f}}', ABS({0})) END"
#: Runs of the headline rate that end at the last row, at least two rows long.
STREAK_SQL = """, sd AS (SELECT series_id, period, y, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS n, ROUND(y - lag(y) OVER w, 6) AS d, y > 0 AND lag(y) OVER w > 0 AS both_up FROM pair WINDOW w AS (PARTITION BY series_id ORDER BY period)),
  ss AS (SELECT *, CASE WHEN y < 0 THEN 'negative' END AS neg, CASE WHEN both_up AND d > 0 THEN 'accel' WHEN both_up AND d < 0 THEN 'decel' END AS mv FROM sd), sl AS (SELECT series_id, mv AS mv1 FROM ss WHERE n = 1),
  sr AS (SELECT ss.series_id, COALESCE(MIN(n) FILTER (WHERE neg IS NULL), MAX(n) + 1) - 1 AS nrun, CASE WHEN ANY_VALUE(mv1) IS NULL THEN 0 ELSE COALESCE(MIN(n) FILTER (WHERE mv IS DISTINCT FROM mv1), MAX(n) + 1) - 1 END AS mrun, ANY_VALUE(mv1) AS mv1 FROM ss JOIN sl USING (series_id) GROUP BY 1),
  streak AS (SELECT series_id, CASE WHEN nrun >= 2 THEN 'negative' WHEN mrun >= 2 THEN mv1 ELSE 'none' END AS kind, CAST(CASE WHEN nrun >= 2 THEN nrun WHEN mrun >= 2 THEN mrun ELSE 0 END AS BIGINT) AS run FROM sr)"""
SENTENCE_SQL = LAST + STREAK_SQL + f""", s0 AS (SELECT e.*, CAST(substr(e.period, 6, 2) AS INT) AS mo, prev IS NOT NULL AND yp IS NULL AND COALESCE(prev_blocked, FALSE) AS brk, CASE WHEN series_id LIKE 'nat-2%' AND series_id <> 'nat-2' THEN ROUND(y - 1.5, 1) END AS re, kind, run FROM e JOIN streak USING (series_id) WHERE y IS NOT NULL),
  s AS (SELECT * EXCLUDE (yp), CASE WHEN headline = 'ytd' AND mo <= 2 THEN NULL ELSE yp END AS yp, CASE WHEN headline = 'ytd' THEN ' 1-' || (mo - 1) || ' 月' ELSE '上月' END AS ref,
    CASE WHEN headline = 'ytd' THEN '1-' || mo || ' 月 ' || name || ' 累计' ELSE substr(period, 1, 4) || ' 年 ' || CASE WHEN span = 2 THEN '1-' ELSE '' END || mo || ' 月 ' || name || ' ' END AS head, {FMT.format('y')} || '%' AS pct, {FMT.format('re')} || '%' AS rpct FROM s0),
  w AS (SELECT *, {FMT.format('(y - yp)')} || ' 个百分点' AS pp, ROUND(y - yp, 6) AS d, CASE WHEN y > 0 THEN '增长' ELSE '下降' END AS word,
    CASE WHEN run < 2 THEN '' ELSE '，连续 ' || CASE WHEN run > 24 THEN '24 个月以上' ELSE run || ' 个月' END || CASE kind WHEN 'negative' THEN '同比下降' WHEN 'accel' THEN '加快' ELSE '放缓' END END AS tail FROM s),
  b AS (SELECT *, CASE WHEN re IS NOT NULL THEN '同比名义' || CASE WHEN y >= 0 THEN '增长 ' ELSE '下降 ' END || pct || '，实际' || CASE WHEN re >= 0 THEN '增长 ' ELSE '下降 ' END || rpct
    WHEN y = 0 THEN '同比持平' || tail WHEN yp IS NULL OR yp = 0 THEN '同比' || word || ' ' || pct || tail WHEN yp > 0 AND y < 0 THEN '同比由升转降，下降 ' || pct || tail WHEN yp < 0 AND y > 0 THEN '同比由降转升，增长 ' || pct || tail
    WHEN d = 0 THEN '同比' || word || ' ' || pct || '，与' || ref || '持平' || tail ELSE '同比' || word || ' ' || pct || '，' || CASE WHEN y < 0 THEN '降幅' ELSE '增速' END || '较' || ref || CASE WHEN y < 0 THEN CASE WHEN d > 0 THEN '收窄' ELSE '扩大' END WHEN d > 0 THEN '加快' ELSE '放缓' END || ' ' || pp || tail END AS body FROM w),
  said AS (SELECT series_id, kind, run, CASE WHEN brk THEN '口径调整后首期数据：' || name || CASE WHEN y = 0 THEN ' 持平' ELSE ' ' || word || ' ' || pct END || '（与旧口径不可比）' ELSE head || body || CASE WHEN span = 2 THEN '（1-2 月合并统计）' ELSE '' END END AS sentence FROM b)"""
ENTRY_SQL = SENTENCE_SQL + """, n AS (SELECT o.series_id, COUNT(*) AS points, MIN(o.period) AS since FROM obs o GROUP BY 1),
  sp AS (SELECT series_id, period, y, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS k FROM pair), spark AS (SELECT series_id, string_agg(COALESCE(format('{:.1f}', y), '-'), ',' ORDER BY period) AS spark, MIN(period) AS spark_from FROM sp WHERE k <= 24 GROUP BY 1),
  mk AS (SELECT series_id, string_agg(effective || ':' || kind, ',' ORDER BY effective) AS annotations FROM breaks GROUP BY 1),
  lv AS (SELECT series_id, string_agg(COALESCE(format('{:.2f}', CASE WHEN headline = 'ytd' THEN ytd ELSE m END), '-'), ',' ORDER BY period) AS levels, CASE WHEN ANY_VALUE(tier) < 3 THEN string_agg(format('{:.2f}', ytd), ',' ORDER BY period) END AS levels_ytd, CASE WHEN ANY_VALUE(tier) < 3 THEN string_agg(COALESCE(format('{:.1f}', CASE WHEN NOT blk THEN ytd_yoy END), '-'), ',' ORDER BY period) END AS spark_ytd
    FROM (SELECT o.*, c.headline, c.tier, """ + BLOCKED.format(a="o", p="period") + """ AS blk, ROW_NUMBER() OVER (PARTITION BY o.series_id ORDER BY o.period DESC) AS k FROM obs o JOIN catalog c USING (series_id)) WHERE k <= 24 GROUP BY 1),
  rv AS (SELECT o.series_id, COUNT(*) AS revisions FROM long_obs o JOIN long_old p USING (series_id, period, measure) WHERE ABS(o.value - p.value) >= 1e-9 GROUP BY 1)
  SELECT e.series_id, section, tier, name, e.period, value, y, prev, yp, ROUND(y - yp, 6) AS delta, CASE WHEN ROUND(y - yp, 6) > 0 THEN 'up' WHEN ROUND(y - yp, 6) < 0 THEN 'down' WHEN y - yp IS NOT NULL THEN 'flat' END AS direction, span = 2 AS merged, points, since,
    COALESCE(said.kind, 'none') AS streak_kind, COALESCE(run, 0) AS streak, sentence, spark, spark_from, COALESCE(annotations, '') AS annotations, COALESCE(revisions, 0) AS revisions, levels, levels_ytd, spark_ytd,
    concat_ws(',', CASE WHEN span = 2 THEN 'jan_feb' END, CASE WHEN EXISTS (SELECT 1 FROM breaks k WHERE k.series_id = e.series_id AND (2001 * 12 + 8) - (CAST(substr(k.effective, 1, 4) AS INT) * 12 + CAST(substr(k.effective, 6, 2) AS INT)) BETWEEN 0 AND 12) THEN 'break_recent' END) AS flags
  FROM e JOIN n USING (series_id) JOIN spark USING (series_id) JOIN lv USING (series_id) LEFT JOIN said USING (series_id) LEFT JOIN mk USING (series_id) LEFT JOIN rv USING (series_id)"""


def entries(x):
    """Each series' latest row with what it compares to."""
    return _latest(x, rates(x))


def _latest(x, rows):
    rows = rows.withColumn("value", F.when(F.col("headline") == "ytd", F.col("ytd")).otherwise(F.col("m"))).drop("headline")
    return S.resolve_latest(rows, "value", "y").join(x.catalog, "series_id")


def said(x, rows):
    """Latest rows with the streak of their rate and their sentence."""
    streaks = S.rate_streaks(rows.select("series_id", "period", "y"), x.breaks, "y")
    latest = _latest(x, rows).join(streaks, "series_id")
    label = P.period_label("period", F.lit(False), F.col("span"))
    first = F.col("yp").isNull() & F.col("prev").isNotNull() & F.coalesce("prev_blocked", F.lit(False))
    real = F.when(F.col("series_id").like("nat-2%") & (F.col("series_id") != "nat-2"), F.round(F.col("y") - 1.5, 1))
    upto = F.when(F.col("headline") == "ytd", F.substring("period", 6, 2).cast("int"))
    # Names are Latin here: the space between label and name is theirs.
    text = U.sentence(
        F.concat(label, F.lit(" ")), F.col("name"), U.verb(F.col("value_type")), F.col("y"), F.col("yp"), U.reference(P.period_shape_loose("period")), first, F.col("span") == 2,
        U.streak_suffix(F.col("kind"), F.col("run")), real, upto,
    )
    return latest.withColumn("sentence", text)


@query("bundle_entry", ENTRY_SQL)
def bundle_entry(x):
    """The published record of every series: latest and previous, streak and sentence, its last 24 levels and rates, those of the year to date where it has both, flags, breaks and revisions."""
    rows = x.held(rates(x))
    d = F.round(F.col("y") - F.col("yp"), 6)
    points = x.obs.groupBy("series_id").agg(F.count("*").alias("points"), F.min("period").alias("since"))
    last = rows.withColumn("_k", F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("period")))).where("_k <= 24")
    level = F.when(F.col("headline") == "ytd", F.col("ytd")).otherwise(F.col("m"))
    kept = F.array_sort(F.collect_list(F.struct("period", "y", level.alias("level"), "ytd", F.when(~F.col("blocked"), F.col("ytd_yoy")).alias("ytd_yoy"))))
    text = lambda c, digits: F.array_join(F.transform("a", lambda r: F.when(r[c].isNull(), "-").otherwise(F.format_string(f"%.{digits}f", r[c]))), ",")
    arrays = last.groupBy("series_id").agg(kept.alias("a"), F.min("period").alias("spark_from"))
    spark = arrays.select("series_id", "spark_from", text("y", 1).alias("spark"), text("level", 2).alias("levels"), text("ytd", 2).alias("levels_ytd"), text("ytd_yoy", 1).alias("spark_ytd"))
    recent = U.break_recent(x.breaks, "2001-08-01").withColumn("recent", F.lit(True))
    notes = x.breaks.groupBy("series_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "effective", "kind"))), ",").alias("annotations"))
    before = x.long(x.old).withColumnRenamed("value", "_was")
    revised = x.long(x.obs).join(before, ["series_id", "period", "span", "measure"]).where("abs(value - _was) >= 1e-9").groupBy("series_id").agg(F.count("*").alias("revisions"))
    out = said(x, rows).join(points, "series_id").join(spark, "series_id").join(notes, "series_id", "left").join(revised, "series_id", "left").join(recent, "series_id", "left")
    both = F.col("tier") < 3
    return out.select(
        "series_id", "section", "tier", "name", "period", "value", "y", "prev", "yp", d.alias("delta"),
        F.when(d > 0, "up").when(d < 0, "down").when(d == 0, "flat").alias("direction"), (F.col("span") == 2).alias("merged"), "points", "since",
        F.when(F.col("y").isNull(), "none").otherwise(F.col("kind")).alias("streak_kind"), F.when(F.col("y").isNull(), 0).otherwise(F.col("run")).cast("long").alias("streak"), "sentence", "spark", "spark_from",
        F.coalesce("annotations", F.lit("")).alias("annotations"), F.coalesce("revisions", F.lit(0)).cast("long").alias("revisions"),
        "levels", F.when(both, F.col("levels_ytd")).alias("levels_ytd"), F.when(both, F.col("spark_ytd")).alias("spark_ytd"), F.concat_ws(",", F.when(F.col("span") == 2, "jan_feb"), F.when(F.col("recent"), "break_recent")).alias("flags"),
    )


@query("headline_sentence", SENTENCE_SQL + " SELECT series_id, sentence FROM said")
def _(x):
    return said(x, x.held(rates(x))).where("y IS NOT NULL").select("series_id", "sentence")


@query("level_sentence", """+ l AS (SELECT series_id, period, CASE WHEN series_id LIKE 'mkt-%' THEN ROUND(m_yoy / 4 + 50, 1) ELSE ROUND(LEAST(ABS(m_yoy), 60) / 10, 1) END AS v, series_id LIKE 'nat-%' AS rate FROM obs WHERE m_yoy IS NOT NULL AND span = 1), g AS (SELECT *, lag(v) OVER (PARTITION BY series_id ORDER BY period) AS p FROM l), d AS (SELECT *, ROUND(v - p, 6) AS d FROM g),
  rn AS (SELECT *, sign(d) AS sg, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS n, FIRST_VALUE(sign(d)) OVER (PARTITION BY series_id ORDER BY period DESC) AS s1 FROM d), run AS (SELECT series_id, ANY_VALUE(s1) AS s1, COALESCE(MIN(n) FILTER (WHERE sg IS DISTINCT FROM s1 OR s1 = 0 OR sg IS NULL), MAX(n) + 1) - 1 AS run FROM rn GROUP BY 1),
  z AS (SELECT d.*, CASE WHEN period = MAX(period) OVER (PARTITION BY d.series_id) THEN run END AS run, s1 FROM d JOIN run USING (series_id))
  SELECT series_id, period, substr(period, 1, 4) || ' 年 ' || CAST(substr(period, 6, 2) AS INT) || ' 月' || CASE WHEN rate THEN '失业率' ELSE '制造业 PMI ' END || '为 ' || format('{:.1f}', v) || CASE WHEN rate THEN '%' ELSE '' END || CASE WHEN d IS NULL THEN '' WHEN d = 0 THEN '，与上月持平' ELSE '，比上月' || CASE WHEN d > 0 THEN '上升' WHEN rate THEN '下降' ELSE '回落' END || ' ' || format('{:.1f}', ABS(d)) || CASE WHEN rate THEN ' 个百分点' ELSE ' 个点' END END
   || CASE WHEN NOT rate AND (COALESCE((p >= 50) <> (v >= 50), FALSE) OR ABS(v - 50) <= 0.5) THEN '，位于荣枯线' || CASE WHEN v >= 50 THEN '上方' ELSE '下方' END ELSE '' END
   || CASE WHEN rate AND run >= 3 THEN '，连续 ' || CASE WHEN run > 24 THEN '24 个月以上' ELSE run || ' 个月' END || CASE WHEN s1 > 0 THEN '上升' ELSE '下降' END ELSE '' END AS sentence FROM z""")
def _(x):
    """Segments as an index with a line, nations as a rate in percent whose last row counts its steps."""
    rate = F.col("series_id").like("nat-%")
    v = F.when(rate, F.round(F.least(F.abs("m_yoy"), F.lit(60.0)) / 10, 1)).otherwise(F.round(F.col("m_yoy") / 4 + 50, 1))
    rows = x.held(x.obs.where("m_yoy IS NOT NULL AND span = 1").select("series_id", "period", v.alias("v"), rate.alias("rate")))
    streaks = S.level_streaks(rows, "v", U.LEVEL_STREAK).select("series_id", "run", "state")
    w = Window.partitionBy("series_id").orderBy("period")
    rows = rows.withColumns({"p": F.lag("v").over(w), "last": F.lead("v").over(w).isNull()}).join(streaks, "series_id")
    label, name = P.period_label("period", F.lit(False), F.lit(1)), F.when(F.col("rate"), "失业率").otherwise("制造业 PMI")
    text = U.level_sentence(label, name, F.col("v"), F.col("p"), F.lit("上月"), 50.0, F.col("rate"), F.col("rate"), F.col("state"), F.when(F.col("last") & F.col("rate"), F.col("run")))
    return rows.select("series_id", "period", text.alias("sentence"))


@query("verb", "SELECT series_id, CASE WHEN tier = 3 THEN '上涨' ELSE '增长' END AS verb FROM catalog")
def _(x):
    return x.catalog.select("series_id", U.verb(F.when(F.col("tier") == 3, "index").otherwise("level")).alias("verb"))


@query("banned_words", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN '由于,大幅' WHEN n_nationkey % 3 = 1 THEN '明显' ELSE '' END AS banned FROM nation", pre=False)
def _(x):
    n = F.col("n_nationkey") % 3
    text = F.concat("n_name", F.when(n == 0, "由于需求大幅增长").when(n == 1, "明显下降").otherwise("同比持平"))
    return x.table("nation").select("n_nationkey", F.array_join(U.banned_words(text), ",").alias("banned"))


@query("yoy_only_slot", """+ t AS (SELECT series_id, MAX(CASE WHEN series_id LIKE 'nat-1%' THEN NULL ELSE CASE WHEN m_yoy IS NOT NULL AND period < '2001-06' THEN period END END) AS a, MAX(CASE WHEN series_id = 'nat-2' THEN NULL ELSE CASE WHEN ytd_yoy IS NOT NULL THEN period END END) AS b FROM obs GROUP BY 1)
  SELECT series_id, CASE WHEN a IS NOT NULL AND (b IS NULL OR a >= b) THEN 'm_yoy' WHEN b IS NOT NULL THEN 'ytd_yoy' END AS slot FROM t""")
def _(x):
    a = F.when(~F.col("series_id").like("nat-1%") & (F.col("period") < "2001-06"), F.col("m_yoy"))
    return U.yoy_only_slot(x.obs.withColumns({"m_yoy": a, "ytd_yoy": F.when(F.col("series_id") != "nat-2", F.col("ytd_yoy"))}), ("m_yoy", "ytd_yoy"))


@query("level_only", "SELECT series_id FROM obs WHERE period < '1995-11' OR series_id LIKE 'nat-2%' GROUP BY 1 HAVING COUNT(COALESCE(m_yoy, ytd_yoy)) = 0")
def _(x):
    return U.level_only(x.obs.where("period < '1995-11' OR series_id LIKE 'nat-2%'"), x.catalog)


@query("flags_latest", LAST + "SELECT series_id, span = 2 AS jan_feb, EXISTS (SELECT 1 FROM breaks k WHERE k.series_id = e.series_id AND (2001 * 12 + 8) - (CAST(substr(k.effective, 1, 4) AS INT) * 12 + CAST(substr(k.effective, 6, 2) AS INT)) BETWEEN 0 AND 12) AS break_recent FROM e")
def _(x):
    recent = U.break_recent(x.breaks, "2001-08-01").withColumn("r", F.lit(True))
    return entries(x).join(recent, "series_id", "left").select("series_id", (F.col("span") == 2).alias("jan_feb"), F.coalesce("r", F.lit(False)).alias("break_recent"))


RECORD_SQL = ENTRY_SQL.replace("\n  SELECT e.series_id, section", "\n  , rec AS (SELECT e.series_id, section") + ")"
MARK_SQL = "series_id || '|' || period || '|' || format('{:.2f}', value) || '|' || COALESCE(format('{:.1f}', y), '-') || '|' || COALESCE(prev, '-') || '|' || streak"


def _mark():
    """A record in short: id, latest, value, rate, previous, streak."""
    return F.concat_ws("|", "series_id", "period", F.format_string("%.2f", "value"), F.when(F.col("y").isNull(), "-").otherwise(F.format_string("%.1f", "y")), F.coalesce("prev", F.lit("-")), F.col("streak").cast("string"))


def _listed(texts, *order):
    """Texts of a group in the order of some columns; nulls are left out."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(texts.isNotNull(), F.struct(*order, texts.alias("text"))))), lambda s: s["text"]), ";")


@query("section_bundle", RECORD_SQL + f" SELECT section, COUNT(*) AS series, MAX(period) AS latest, string_agg({MARK_SQL} || '|' || COALESCE(sentence, '-') || '|' || spark, ';' ORDER BY tier, series_id) AS records FROM rec GROUP BY 1")
def _(x):
    """One row a section with all its records, of which a section has some hundreds."""
    records = _listed(F.concat_ws("|", _mark(), F.coalesce("sentence", F.lit("-")), "spark"), "tier", "series_id")
    return bundle_entry(x).groupBy("section").agg(F.count("*").alias("series"), F.max("period").alias("latest"), records.alias("records"))


@query("index_bundle", RECORD_SQL + f" SELECT section, COALESCE(string_agg({MARK_SQL} || '|' || COALESCE(sentence, '-'), ';' ORDER BY series_id) FILTER (WHERE tier = 1), '') AS tiles, string_agg(series_id || ':' || period || ':' || revisions, ';' ORDER BY series_id) AS freshness FROM rec GROUP BY 1")
def _(x):
    """By section: first-tier records without their arrays, and how fresh every series is."""
    tile = F.when(F.col("tier") == 1, F.concat_ws("|", _mark(), F.coalesce("sentence", F.lit("-"))))
    fresh = F.concat_ws(":", "series_id", "period", F.col("revisions").cast("string"))
    return bundle_entry(x).groupBy("section").agg(_listed(tile, "series_id").alias("tiles"), _listed(fresh, "series_id").alias("freshness"))


PUBLISHED_SQL = f"""SELECT 'section/' || section AS document, series_id, COUNT(*) AS points, MAX(period) AS last, CAST(SUM(CAST(CASE WHEN headline = 'ytd' THEN ytd ELSE m END AS DECIMAL(28,2))) AS DOUBLE) AS level, COUNT(CASE WHEN NOT blk THEN CASE WHEN headline = 'ytd' THEN ytd_yoy ELSE m_yoy END END) AS yoy,
    CASE WHEN tier < 3 THEN CAST(SUM(CAST(ytd AS DECIMAL(28,2))) AS DOUBLE) END AS level_ytd, CASE WHEN tier < 3 THEN COUNT(CASE WHEN NOT blk THEN ytd_yoy END) END AS yoy_ytd, section = 'market' AS written FROM pb GROUP BY 1, 2, section, tier"""


@query("write_bundles", f"""+ src AS (SELECT * FROM obs WHERE series_id LIKE 'mkt-%' UNION ALL SELECT * FROM old WHERE series_id LIKE 'nat-%'), pb AS (SELECT c.section, c.tier, c.headline, o.*, {BLOCKED.format(a='o', p='period')} AS blk FROM src o JOIN catalog c USING (series_id)),
  fr AS (SELECT * FROM (SELECT DISTINCT metric, period FROM panel) JOIN (SELECT DISTINCT metric, entity FROM panel) USING (metric)) {PUBLISHED_SQL}
  UNION ALL SELECT 'index', section, COUNT(DISTINCT series_id), MAX(period), NULL, NULL, NULL, NULL, TRUE FROM pb GROUP BY section
  UNION ALL SELECT 'panel', entity || '/' || metric, COUNT(*), MAX(period), CAST(SUM(CAST(p.m AS DECIMAL(28,1))) AS DOUBLE), COUNT(p.m), NULL, NULL, FALSE FROM fr LEFT JOIN panel p USING (entity, metric, period) GROUP BY 2""")
def _(x):
    """Two publications, of which the second has new segments; what a reader finds then, and what had to be written for it."""
    both = (F.col("tier") < 3).alias("both")
    kinds = x.catalog.select("series_id", "headline", both)
    arrays = lambda rows: R.aligned_arrays(B.blocked(rows, x.breaks).join(kinds, "series_id"))
    panel, root = R.assemble_panel(x.panel, x.panel.where("false")), x.scratch()
    T.publish(x.spark, R.bundle_documents(arrays(x.old), x.catalog, panel), root, "2001-04")
    mixed = x.obs.where("series_id LIKE 'mkt-%'").union(x.old.where("series_id LIKE 'nat-%'"))
    wrote = T.publish(x.spark, R.bundle_documents(arrays(mixed), x.catalog, panel), root, "2001-09").select("document", "written")
    docs = x.held(T.read(x.spark, root))
    none, long = F.lit(None).cast("double"), F.lit(None).cast("long")
    total = lambda c, d: F.aggregate(F.transform(F.filter(c, lambda v: v.isNotNull()), lambda v: v.cast(f"decimal(28,{d})")), F.lit(0).cast(f"decimal(38,{d})"), lambda a, v: (a + v).cast(f"decimal(38,{d})")).cast("double")
    some = lambda c: F.size(F.filter(c, lambda v: v.isNotNull())).cast("long")
    parsed = lambda like, schema: docs.where(F.col("document").like(like)).select("document", F.from_json("body", schema).alias("d"))
    s = parsed("section/%", R.SECTION).select("document", F.explode("d.series").alias("s")).select("document", "s.*")
    rows = s.select("document", F.col("id").alias("series_id"), F.size("periods").cast("long").alias("points"), F.element_at("periods", -1).alias("last"), total("level", 2).alias("level"), some("yoy").alias("yoy"), F.when(F.col("level_ytd").isNotNull(), total("level_ytd", 2)).alias("level_ytd"), F.when(F.col("yoy_ytd").isNotNull(), some("yoy_ytd")).alias("yoy_ytd"))
    i = parsed("index", R.INDEX).select("document", F.explode("d.sections").alias("s")).select("document", "s.section", "s.series", "s.latest", none, long, none, long)
    p = parsed("panel", R.PANEL).select("document", F.explode("d.cells").alias("s")).select("document", "s.*")
    filled = F.filter("values", lambda v: v.isNotNull())
    p = p.select("document", F.concat_ws("/", "entity", "metric"), F.size("periods").cast("long"), F.element_at("periods", -1), F.when(F.size(filled) > 0, total("values", 1)), F.size(filled).cast("long"), none, long)
    return rows.union(i).union(p).join(wrote, "document")


@query("diary_diff", """+ n AS (SELECT series_id, MAX(period) AS period FROM obs GROUP BY 1), b AS (SELECT series_id, MAX(period) AS before FROM old WHERE series_id <> 'nat-0' GROUP BY 1), r AS (SELECT series_id, period, COUNT(*) AS n FROM long_obs o JOIN long_old p USING (series_id, period, measure) WHERE ABS(o.value - p.value) >= 1e-9 GROUP BY 1, 2)
  SELECT series_id, before, period, CASE WHEN before IS NULL THEN 'new' ELSE 'advanced' END AS kind, series_id || ': ' || COALESCE(before || ' → ', '') || period AS line FROM n LEFT JOIN b USING (series_id) WHERE period IS DISTINCT FROM before UNION ALL SELECT series_id, period, period, 'revised', series_id || ': ' || period || ' (' || n || ')' FROM r""")
def _(x):
    last = lambda t: t.groupBy("series_id").agg(F.max("period").alias("period"))
    before = x.long(x.old).withColumnRenamed("value", "_was")
    revised = x.long(x.obs).join(before, ["series_id", "period", "span", "measure"]).where("abs(value - _was) >= 1e-9")
    return U.diary(last(x.obs), last(x.old.where("series_id <> 'nat-0'")), revised)


@query("city_rows", """+ w AS (SELECT entity, period, MAX(m) FILTER (WHERE metric LIKE '1%') AS a, MAX(m) FILTER (WHERE metric LIKE '2%') AS b FROM panel WHERE metric LIKE '1%' OR metric LIKE '2%' GROUP BY 1, 2), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity ORDER BY period DESC) AS n FROM w)
  SELECT entity, string_agg(COALESCE(format('{:.1f}', a), '-'), ',' ORDER BY period) AS cells, MAX(a) FILTER (WHERE n = 1) AS latest, MAX(b) FILTER (WHERE n = 1) AS second, COUNT(a) AS points, MIN(period) AS since FROM r WHERE n <= 24 GROUP BY 1""")
def _(x):
    rows = U.city_rows(x.panel, "1-URGENT", "2-HIGH")
    return rows.withColumn("cells", F.array_join(F.transform("cells", lambda c: F.when(c["m"].isNull(), "-").otherwise(F.format_string("%.1f", c["m"]))), ","))


@query("small_multiples_scale", """+ e AS (SELECT substr(series_id, 1, 3) AS grp, LEAST(MIN(m_yoy), 0) AS lo, GREATEST(MAX(m_yoy), 0) AS hi FROM obs GROUP BY 1), s AS (SELECT *, GREATEST((hi - lo) / 4, 1e-9) AS raw FROM e), q AS (SELECT *, POW(10.0, FLOOR(LOG10(raw))) AS pw FROM s),
  st AS (SELECT *, pw * CASE WHEN raw / pw <= 1 THEN 1.0 WHEN raw / pw <= 2 THEN 2.0 WHEN raw / pw <= 5 THEN 5.0 ELSE 10.0 END AS step FROM q) SELECT grp, FLOOR(lo / step) * step AS low, CEIL(hi / step) * step AS high, step FROM st""")
def _(x):
    return U.shared_axis(x.obs.withColumn("grp", F.substring("series_id", 1, 3)), "grp", "m_yoy")


@query("caliber_toggle", "SELECT series_id, 'single' AS lane, COUNT(m) AS n, MAX(m) AS top FROM obs GROUP BY 1 UNION ALL SELECT series_id, 'ytd', COUNT(ytd), MAX(ytd) FROM obs GROUP BY 1")
def _(x):
    lanes = x.obs.select("series_id", F.explode(F.array(F.struct(F.lit("single").alias("lane"), F.col("m").alias("v")), F.struct(F.lit("ytd").alias("lane"), F.col("ytd").alias("v")))).alias("l"))
    return lanes.groupBy("series_id", "l.lane").agg(F.count("l.v").alias("n"), F.max("l.v").alias("top"))


# --- further table operations ------------------------------------------------------------------------------------------


@query("align_measures", "SELECT series_id, period, MAX(value) FILTER (WHERE measure = 'm') AS m, MAX(value) FILTER (WHERE measure = 'ytd') AS ytd FROM release WHERE measure IN ('m', 'ytd') GROUP BY 1, 2")
def _(x):
    return x.release.where("measure IN ('m', 'ytd')").groupBy("series_id", "period").pivot("measure", ["m", "ytd"]).agg(F.max("value"))


@query("batch_pivot", "SELECT series_id, period, MAX(span) AS span, MAX(value) FILTER (WHERE measure = 'm') AS m, MAX(value) FILTER (WHERE measure = 'm_yoy') AS m_yoy FROM release GROUP BY 1, 2")
def _(x):
    rows = x.release.groupBy("series_id", "period").pivot("measure", ["m", "m_yoy"]).agg(F.max("value").alias("v"), F.max("span").alias("s"))
    whole = x.release.groupBy("series_id", "period").agg(F.max("span").alias("span"))
    return whole.join(rows, ["series_id", "period"]).select("series_id", "period", "span", F.col("m_v").alias("m"), F.col("m_yoy_v").alias("m_yoy"))


@query("batch_io", "SELECT series_id, period, value FROM release WHERE measure = 'm'")
def _(x):
    text = x.release.where("measure = 'm'").select(F.to_json(F.struct("series_id", "period", "value")).alias("line"))
    return text.select(F.from_json("line", "series_id string, period string, value double").alias("d")).select("d.*")


@query("load_config", "SELECT c.series_id, CASE WHEN c.tier = 1 THEN 10 ELSE 20 END AS low, CASE WHEN c.tier = 1 THEN 15 ELSE 28 END AS high FROM catalog c")
def _(x):
    calendar = x.rows([('{"tier":1,"window":[10,15]}',), ('{"tier":2,"window":[20,28]}',), ('{"tier":3,"window":[20,28]}',)], "line string")
    rules = calendar.select(F.from_json("line", "tier int, window array<int>").alias("r")).select("r.*")
    return x.catalog.join(F.broadcast(rules), "tier").select("series_id", F.col("window")[0].alias("low"), F.col("window")[1].alias("high"))


@query("latest_per_series_dir", "SELECT series_id, MAX(period) AS latest FROM obs WHERE series_id IN (SELECT series_id FROM catalog WHERE tier < 3) GROUP BY 1")
def _(x):
    return x.obs.join(x.catalog.where("tier < 3"), "series_id", "left_semi").groupBy("series_id").agg(F.max("period").alias("latest"))


@query("capability_scan", "SELECT series_id, BOOL_OR(m IS NOT NULL) AS single, BOOL_OR(ytd_yoy IS NOT NULL AND period < '1996-03') AS ytd FROM obs GROUP BY 1")
def _(x):
    return x.obs.groupBy("series_id").agg(F.bool_or(F.col("m").isNotNull()).alias("single"), F.bool_or(F.col("ytd_yoy").isNotNull() & (F.col("period") < "1996-03")).alias("ytd"))


@query("catalog_build", "SELECT c.series_id, c.section, c.tier, MIN(o.period) AS start, MAX(o.period) AS latest, arg_max(o.m, o.period) AS value FROM catalog c JOIN obs o USING (series_id) GROUP BY 1, 2, 3")
def _(x):
    facts = x.obs.groupBy("series_id").agg(F.min("period").alias("start"), F.max("period").alias("latest"), F.max_by("m", "period").alias("value"))
    return x.catalog.join(facts, "series_id").select("series_id", "section", "tier", "start", "latest", "value").orderBy("section", "tier", "series_id")


@query("migration_invariants", "SELECT series_id, 'unresolved' AS problem, COUNT(*) AS n FROM obs WHERE series_id = 'nat-3' GROUP BY 1 UNION ALL SELECT series_id, 'twice', COUNT(*) FROM obs WHERE series_id = 'nat-5' GROUP BY 1")
def _(x):
    rows = x.obs.union(x.obs.where("series_id = 'nat-5'"))
    twice = rows.groupBy("series_id", "period").count().where("count > 1").groupBy("series_id").agg(F.count("*").alias("n")).select("series_id", F.lit("twice").alias("problem"), "n")
    lost = rows.join(x.catalog.where("series_id <> 'nat-3'"), "series_id", "left_anti").groupBy("series_id").agg(F.count("*").alias("n")).select("series_id", F.lit("unresolved").alias("problem"), "n")
    return lost.union(twice).union(rows.where("span = 2 AND period NOT LIKE '%-02'").groupBy("series_id").agg(F.count("*").alias("n")).select("series_id", F.lit("span").alias("problem"), "n"))


@query("smoke_sample_compare", """+ r AS (SELECT c.section, o.series_id, o.period, o.m, CASE WHEN o.period LIKE '%-06' THEN o.m + 1 ELSE o.m END AS result FROM obs o JOIN catalog c USING (series_id)),
  d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY sha256(series_id || period), series_id, period) AS n FROM r) SELECT section, COUNT(*) AS sampled, COUNT(*) FILTER (WHERE m = result) AS same FROM d WHERE n <= 15 GROUP BY 1""")
def _(x):
    """Fifteen cells of each section, drawn by a hash, of a result that is off in June, compared with sums taken anew from the orders."""
    off = F.when(F.col("period").like("%-06"), 1.0).otherwise(0.0)
    rows = x.obs.select("series_id", "period", (F.col("m") + off).alias("value")).join(x.catalog.select("series_id", "section"), "series_id")
    order = [F.sha2(F.concat("series_id", "period"), 256), "series_id", "period"]
    drawn = rows.withColumn("_n", F.row_number().over(Window.partitionBy("section").orderBy(*order))).where("_n <= 15")
    joint = (F.col("period") >= "1998") & F.substring("period", 6, 2).isin("01", "02")
    period = F.when(joint, F.concat(F.substring("period", 1, 4), F.lit("-02"))).otherwise(F.col("period")).alias("period")
    source = x.cells.select(F.explode(F.array(F.concat(F.lit("mkt-"), "seg"), F.concat(F.lit("nat-"), "nat"))).alias("series_id"), period, "v").groupBy("series_id", "period").agg(F.sum("v").cast("double").alias("source"))
    return drawn.join(source, ["series_id", "period"]).groupBy("section").agg(F.count("*").alias("sampled"), F.count(F.when(F.col("value") == F.col("source"), 1)).alias("same"))


@query("unpivot_metrics", "SELECT l_returnflag, field, SUM(CAST(value AS DECIMAL(28,2)))::DOUBLE AS total, COUNT(*) AS n FROM (UNPIVOT (SELECT l_returnflag, CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem) ON quantity, price INTO NAME field VALUE value) GROUP BY 1, 2", pre=False)
def _(x):
    rows = x.table("lineitem").select("l_returnflag", F.col("l_quantity").cast("decimal(18,2)").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return rows.unpivot(["l_returnflag"], ["quantity", "price"], "field", "value").groupBy("l_returnflag", "field").agg(F.sum("value").cast("double").alias("total"), F.count("*").alias("n"))


@query("version_fields_fill", "SELECT series_id, period, COALESCE(n.m, o.m) AS latest, CASE WHEN o.m IS NOT NULL THEN o.m ELSE n.m END AS published FROM obs n FULL JOIN old o USING (series_id, period)")
def _(x):
    old = x.old.select("series_id", "period", F.col("m").alias("o"))
    return x.obs.select("series_id", "period", "m").join(old, ["series_id", "period"], "full_outer").select("series_id", "period", F.coalesce("m", "o").alias("latest"), F.coalesce("o", "m").alias("published"))


@query("difference_series", """+ t AS (SELECT period, span, SUM(CAST(m AS DECIMAL(28,2))) AS total, SUM(CASE WHEN series_id = 'mkt-BUILDING' THEN CAST(m AS DECIMAL(28,2)) END) AS part FROM obs WHERE series_id LIKE 'mkt-%' GROUP BY 1, 2)
  SELECT period, CAST(total - part AS DOUBLE) AS residual, ROUND(CAST(part AS DOUBLE) / CAST(total AS DOUBLE) * 100, 2) AS share FROM t WHERE part IS NOT NULL""")
def _(x):
    v = F.col("m").cast("decimal(28,2)")
    t = x.obs.where("series_id LIKE 'mkt-%'").groupBy("period", "span").agg(F.sum(v).alias("total"), F.sum(F.when(F.col("series_id") == "mkt-BUILDING", v)).alias("part")).where("part IS NOT NULL")
    return t.select("period", (F.col("total") - F.col("part")).cast("double").alias("residual"), F.round(F.col("part").cast("double") / F.col("total").cast("double") * 100, 2).alias("share"))


@query("city_history_long", "SELECT entity, metric, field, COUNT(*) AS n FROM (SELECT entity, metric, unnest(['m', 'index']) AS field, m FROM panel WHERE m IS NOT NULL) GROUP BY 1, 2, 3")
def _(x):
    nested = x.panel.where("m IS NOT NULL").groupBy("entity", "period").agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct("m", (F.col("m") + 100).alias("index"))))).alias("metrics"))
    long = nested.select("entity", "period", F.explode("metrics").alias("metric", "f")).select("entity", "period", "metric", "f.m", "f.index").unpivot(["entity", "period", "metric"], ["m", "index"], "field", "value")
    return long.groupBy("entity", "metric", "field").agg(F.count("*").alias("n"))


@query("block_context_fill", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS heading FROM conversations", pre=False)
def _(x):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return x.table("conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("heading"))


@query("caliber_arrays", "SELECT series_id, array_to_string(list(period ORDER BY period), ',') AS periods, COUNT(*) AS n FROM obs o JOIN catalog c USING (series_id) WHERE CASE WHEN c.headline = 'ytd' THEN ytd_yoy ELSE m_yoy END IS NOT NULL GROUP BY 1")
def _(x):
    rows = x.obs.join(x.catalog.select("series_id", "headline"), "series_id").withColumn("v", F.when(F.col("headline") == "ytd", F.col("ytd_yoy")).otherwise(F.col("m_yoy"))).where("v IS NOT NULL")
    return rows.groupBy("series_id").agg(F.array_join(F.array_sort(F.collect_list("period")), ",").alias("periods"), F.count("*").alias("n"))


@query("tier3_row", LAST + "SELECT series_id, name, period, value, ROUND(y - yp, 6) AS delta FROM e WHERE tier = 3")
def _(x):
    return entries(x).where("tier = 3").select("series_id", "name", "period", "value", F.round(F.col("y") - F.col("yp"), 6).alias("delta"))


@query("tier3_tail", "SELECT series_id, COUNT(*) AS n FROM (SELECT o.*, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period DESC) AS k FROM obs o JOIN catalog c USING (series_id) WHERE c.tier = 3) WHERE k <= 24 GROUP BY 1")
def _(x):
    rows = x.obs.join(x.catalog.where("tier = 3"), "series_id", "left_semi")
    return tail(rows, 24).select("series_id", F.size("tail").cast("long").alias("n"))


@query("shared_unit", "SELECT section, CASE WHEN COUNT(DISTINCT tier) = 1 THEN 'tier ' || MIN(tier) END AS unit FROM catalog GROUP BY 1")
def _(x):
    return x.catalog.groupBy("section").agg(F.when(F.countDistinct("tier") == 1, F.concat(F.lit("tier "), F.min("tier"))).alias("unit"))


@query("footnote_rank", """+ m AS (SELECT series_id, effective AS period, kind AS text FROM breaks UNION ALL SELECT series_id, period, 'high' FROM obs WHERE m_yoy > 60)
  SELECT series_id, period, text, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period, text) AS number FROM m WHERE period BETWEEN '1997-01' AND '2000-12'""")
def _(x):
    marks = x.breaks.select("series_id", F.col("effective").alias("period"), F.col("kind").alias("text")).union(x.obs.where("m_yoy > 60").select("series_id", "period", F.lit("high")))
    return U.footnotes(marks, "1997-01", "2000-12").withColumn("number", F.col("number").cast("long"))


@query("chart_gap_segments", """+ s AS (SELECT series_id, period, m_yoy, SUM(CASE WHEN m_yoy IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY period) AS s FROM obs), r AS (SELECT series_id, s, MIN(period) AS first, MAX(period) AS last, COUNT(*) AS n FROM s WHERE m_yoy IS NOT NULL GROUP BY 1, 2)
  SELECT series_id, first, last, n, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY first) AS segment FROM r""")
def _(x):
    return U.gap_segments(x.obs, "m_yoy").withColumn("segment", F.col("segment").cast("long"))


@query("freshness_budget", "SELECT series_id, CASE WHEN section = 'market' THEN 45 WHEN tier = 2 THEN 60 ELSE 90 END AS days FROM catalog")
def _(x):
    rules = x.rows([("market", 30), ("market", 45), ("nation", 60)], "section string, days int").groupBy("section").agg(F.max("days").alias("rule"))
    return x.catalog.join(rules, "section", "left").select("series_id", F.when((F.col("section") == "nation") & (F.col("tier") == 3), 90).otherwise(F.coalesce("rule", F.lit(90))).alias("days"))


@query("annotations_explode", "SELECT series_id, NULL AS period, 'series ' || name AS note FROM catalog WHERE tier = 1 UNION ALL SELECT o.series_id, o.period, 'high' FROM obs o JOIN catalog c USING (series_id) WHERE c.tier = 1 AND o.m_yoy > 30")
def _(x):
    """Nested maps of notes as rows; the key _series stands for the series as a whole."""
    tier1 = x.catalog.where("tier = 1")
    high = x.obs.where("m_yoy > 30").join(tier1, "series_id", "left_semi").groupBy("series_id").agg(F.collect_list(F.struct("period", F.lit("high").alias("note"))).alias("high"))
    entry = F.concat(F.array(F.struct(F.lit("_series").alias("period"), F.concat(F.lit("series "), "name").alias("note"))), F.coalesce("high", F.expr("cast(array() AS array<struct<period:string,note:string>>)")))
    nested = tier1.join(high, "series_id", "left").select(F.create_map("series_id", F.map_from_entries(entry)).alias("notes"))
    rows = nested.select(F.explode("notes").alias("series_id", "n")).select("series_id", F.explode("n").alias("key", "note"))
    return rows.select("series_id", F.when(F.col("key") != "_series", F.col("key")).alias("period"), "note")
