"""Queries on release pages, calendars and incremental ingest."""

from pyspark.sql import functions as F

from ledgerline.functions import text as X
from ledgerline.operators import archive as A
from ledgerline.operators import calendar as C
from ledgerline.operators import extract as E
from ledgerline.operators import gates as K
from ledgerline.operators import merge as G
from ledgerline.plans.joins import PAIRS
from ledgerline.plans.registry import query
from ledgerline.plans.scans import scratch
from ledgerline.plans.sql import BLOCKED
from ledgerline.streaming import ingest as I

#: source, first and last day of the window, months between period and release.
RULES = (("BUILDING", 5, 9, 1), ("MACHINERY", 8, 31, 1), ("HOUSEHOLD", 20, 28, 1), ("AUTOMOBILE", 9, 12, 2))


@query("extract_table_rows", "+ t AS (SELECT nat || '/' || period AS page_id, pri, SUM(v)::DOUBLE AS v FROM cells GROUP BY 1, 2) SELECT page_id, pri AS label, 'm' AS measure, v AS value FROM t UNION ALL SELECT page_id, pri, 'half', v / 2 FROM t")
def _(x):
    """A page for each nation and month with a table of its order priorities, read back from its HTML."""
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    sums = x.cells.groupBy(F.concat_ws("/", "nat", "period").alias("page_id"), "pri").agg(F.sum("v").alias("v"))
    row = F.concat(F.lit("<tr>"), cell(F.col("pri")), cell(F.format_number(F.col("v").cast("double"), 2)), cell((F.col("v").cast("double") / 2).cast("string")), F.lit("</tr>"))
    pages = sums.groupBy("page_id").agg(F.concat(F.lit("<table><tr><th>Item</th><th>Value &amp; unit</th><th>Half</th></tr>"), F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table>")).alias("html"))
    out, _ = E.measured_rows(E.table_rows(pages), x.rows([("Value & unit", "m"), ("Half", "half")], "text string, measure string"), x.rows([("1-URGENT",)], "label string"))
    return out


@query("extract_required_rows", "+ n AS (SELECT nat || '/' || period AS page_id, COUNT(*) FILTER (WHERE pri = '1-URGENT') AS k FROM cells GROUP BY 1) SELECT page_id, '1-URGENT' AS label FROM n WHERE k = 0")
def _(x):
    """Pages, one for each nation and month, that lack a required row."""
    rows = x.cells.groupBy(F.concat_ws("/", "nat", "period").alias("page_id")).agg(F.collect_set("pri").alias("p"))
    html = F.concat(F.lit("<table><tr><th>Item</th><th>Value</th></tr>"), F.array_join(F.transform("p", lambda p: F.concat(F.lit("<tr><td>"), p, F.lit("</td><td>1</td></tr>"))), ""), F.lit("</table>"))
    _, missing = E.measured_rows(E.table_rows(rows.select("page_id", html.alias("html"))), x.rows([("Value", "m")], "text string, measure string"), x.rows([("1-URGENT",)], "label string"))
    return missing


MONTHS = 90
BULLETIN_SQL = f"""+ pm AS (SELECT page_id, strftime(DATE '1995-01-15' + to_months(CAST(page_id % {MONTHS} AS INT)), '%Y-%m') AS period FROM pages)"""
FIELDS = (("快递业务量", "亿件", "mkt-BUILDING"), ("快递业务收入", "亿元", "mkt-MACHINERY"))


def bulletins(x):
    """(page_id, text): every page as the bulletin of a month, with two fields' figures of the year so far and of the month among what it says.

    Of four pages one leaves out the word for the year so far, one that and the mark before it; one says the month twice, the second time wrongly.
    """
    period = F.date_format(F.add_months(F.lit("1995-01-15").cast("date"), (F.col("page_id") % MONTHS).cast("int")), "yyyy-MM")
    pages = x.table("pages").select("page_id", (F.col("page_id") % 4).alias("k"), period.alias("period"), A.compact(X.strip_html(F.col("html"))).alias("text"))
    names = x.rows(FIELDS, "label string, unit string, series_id string")
    k, month = F.col("k"), F.substring("period", 6, 2).cast("int").cast("string")
    amount = lambda c: F.col(c).cast("decimal(28,2)").cast("string")
    rate = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit("，同比"), F.when(F.col(c) < 0, "下降").otherwise("增长"), F.format_string("%.1f", F.abs(c)), F.lit("%（可比口径）。")))
    year = F.concat(F.when(k == 2, "全行业稳步发展，").otherwise(F.concat(F.lit("1-"), month, F.lit("月，全行业稳步发展，"))), F.lit("其中，"), "label", F.when(k.isin(1, 2), "").otherwise("累计"), F.lit("完成"), amount("ytd"), "unit", rate("ytd_yoy"))
    one = lambda c: F.concat(month, F.lit("月份，全行业稳步发展，其中"), "label", F.lit("完成"), c, "unit", F.lit("（注1）"), rate("m_yoy"))
    said = F.concat(F.coalesce(year, F.lit("")), F.coalesce(one(amount("m")), F.lit("")), F.coalesce(F.when(k == 3, one(F.lit("1.5"))), F.lit("")))
    told = pages.select("page_id", "k", "period").join(x.obs.join(names, "series_id"), "period").groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("label", said.alias("said")))), lambda s: s["said"]), "").alias("told"))
    return pages.join(told, "page_id", "left").select("page_id", F.concat("text", F.coalesce("told", F.lit(""))).alias("text"))


@query("extract_prose_stats", BULLETIN_SQL + """, f AS (SELECT * FROM (VALUES ('快递业务收入', 'mkt-MACHINERY'), ('快递业务量', 'mkt-BUILDING')) t(field, series_id)), j AS (SELECT p.page_id, p.page_id % 4 AS k, f.field, o.m, o.ytd, o.m_yoy, o.ytd_yoy, MAX(o.m_yoy IS NOT NULL) OVER (PARTITION BY p.page_id ORDER BY f.field ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS marked FROM pm p JOIN obs o USING (period) JOIN f USING (series_id))
  , v AS (SELECT page_id, field, 'ytd' AS c, ytd AS level, ytd_yoy AS rate FROM j WHERE ytd_yoy IS NOT NULL AND k <> 2 UNION ALL SELECT page_id, field, 'm', ytd, ytd_yoy FROM j WHERE ytd_yoy IS NOT NULL AND k = 2 AND marked
    UNION ALL SELECT page_id, field, 'm', m, m_yoy FROM j WHERE m_yoy IS NOT NULL AND NOT (k = 2 AND COALESCE(marked, FALSE) AND ytd_yoy IS NOT NULL))
  SELECT page_id, field, c AS measure, level AS value FROM v UNION ALL SELECT page_id, field, c || '_yoy', rate FROM v""")
def _(x):
    """What the bulletins say; where nothing marks a sentence on the year so far it is left out, or taken for the month that the field before ended with."""
    return E.prose(bulletins(x), tuple((label, unit) for label, unit, _ in FIELDS)).drop("place")


@query("nearest_marker_caliber", """WITH d AS (SELECT doc_id AS page_id, text FROM documents), h AS (SELECT page_id, unnest(string_split(text, ' the ')) AS gap, generate_subscripts(string_split(text, ' the '), 1) AS i FROM d),
  hit AS (SELECT page_id, i - 1 AS nth, SUM(length(gap) + 5) OVER (PARTITION BY page_id ORDER BY i) - 5 + 1 AS at FROM h QUALIFY i < MAX(i) OVER (PARTITION BY page_id)),
  m AS (SELECT page_id, kind, unnest(string_split(text, word)) AS gap, generate_subscripts(string_split(text, word), 1) AS i, length(word) AS n FROM d, (VALUES ('ing', 'g'), ('ea', 'v')) v(word, kind)), mark AS (SELECT page_id, kind, SUM(length(gap) + n) OVER (PARTITION BY page_id, kind ORDER BY i) + 1 AS after FROM m QUALIFY i < MAX(i) OVER (PARTITION BY page_id, kind))
  SELECT hit.page_id, hit.nth, mark.kind FROM hit ASOF LEFT JOIN mark ON hit.page_id = mark.page_id AND hit.at >= mark.after""", pre=False)
def _(x):
    """Every place of a word in the documents, with the kind of the last of two marks before it."""
    texts = x.table("documents").select(F.col("doc_id").alias("page_id"), "text")
    return E.nearest_marker(texts, " the ", (("ing", "g"), ("ea", "v")))


@query("janfeb_mirror", "SELECT series_id, period, measure, COUNT(*) AS n FROM (SELECT series_id, period, span, measure FROM long_obs WHERE NOT (measure = 'm' AND series_id LIKE 'nat-%') UNION ALL SELECT series_id, period, span, 'm' FROM long_obs WHERE measure = 'ytd' AND span = 2 AND series_id LIKE 'nat-%') WHERE period >= '2000' GROUP BY 1, 2, 3")
def _(x):
    rows = x.long(x.obs).where("NOT (measure = 'm' AND series_id LIKE 'nat-%')")
    return E.mirror(rows).where("period >= '2000'").groupBy("series_id", "period", "measure").agg(F.count("*").alias("n"))


@query("headline_crosscheck", "SELECT series_id, period FROM obs WHERE m_yoy IS NOT NULL AND span = 1 AND period LIKE '%-10'")
def _(x):
    """Titles print the rate, in October one that is 0.3 off."""
    slip = F.when(F.col("period").like("%-10"), 0.3).otherwise(0.0)
    rows = x.obs.where("m_yoy IS NOT NULL AND span = 1").withColumn("title", F.concat(F.col("period"), F.lit(" 同比 "), F.format_string("%.1f", F.col("m_yoy") + slip), F.lit("%")))
    said = F.regexp_extract("title", r"同比 (-?[0-9.]+)%", 1).cast("double")
    return rows.where(F.abs(said - F.col("m_yoy")) > 0.05 + 1e-9).select("series_id", "period")


CITY_SQL = """+ t AS (SELECT nat, pri, period, SUM(v)::DOUBLE AS v FROM cells GROUP BY 1, 2, 3), w AS (SELECT a.period, '城' || a.nat || '区' || substr(a.pri, 1, 1) AS city, ROUND(LEAST(a.v / b.v, 9) * 20 + 80) AS mom, ROUND(LEAST(a.v / b.v, 9) * 30 + 65) AS yoy FROM t a JOIN t b ON a.nat = b.nat AND a.pri = b.pri AND b.period = strftime(CAST(a.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') WHERE NOT (a.period LIKE '%-08' AND a.pri < '4')),
  ok AS (SELECT period, city, CASE WHEN mom BETWEEN 70 AND 130 THEN mom ELSE 99.9 END AS mom, yoy, ROW_NUMBER() OVER (PARTITION BY period ORDER BY city) AS k, COUNT(*) OVER (PARTITION BY period) AS n FROM w WHERE yoy BETWEEN 50 AND 150), c AS (SELECT * FROM ok WHERE n >= {least} AND k <= {most})"""


def city_pages(x):
    """(page_id, html): a page for each month whose table has rows of cities under headers that span columns, the first of them twice, the second time with another number; one month has few."""
    t = x.cells.groupBy("nat", "pri", "period").agg(F.sum("v").cast("double").alias("v"))
    before = t.select("nat", "pri", F.date_format(F.add_months(F.to_date(F.concat("period", F.lit("-01"))), 1), "yyyy-MM").alias("period"), F.col("v").alias("b"))
    rows = t.join(before, ["nat", "pri", "period"]).withColumn("city", F.concat(F.lit("城"), "nat", F.lit("区"), F.substring("pri", 1, 1)))
    ratio = F.least(F.col("v") / F.col("b"), F.lit(9.0))
    rows = rows.where("NOT (period LIKE '%-08' AND pri < '4')").select("period", "city", F.round(ratio * 20 + 80).alias("mom"), F.round(ratio * 30 + 65).alias("yoy"))
    text = lambda c: F.format_number(c, 1)
    line = lambda city, mom: F.concat(F.lit("<tr><td>"), city, F.lit(" </td><td align=right>"), mom, F.lit("</td><td>"), text("yoy"), F.lit("</td><td>100.0</td></tr>"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("city", line(F.col("city"), text(F.col("mom"))).alias("l"), line(F.col("city"), F.lit("99.9")).alias("again")))), lambda s: F.concat(s["l"], s["again"]))
    head = "<p>70 cities</p><table border=1><tr><th rowspan=2>城市</th><th colspan=3>新建商品住宅</th></tr><tr><th>环比</th><th>同比</th><th>定基</th></tr>"
    return rows.groupBy(F.col("period").alias("page_id")).agg(F.concat(F.lit(head), F.array_join(lines, ""), F.lit("</table><table><tr><td>城9</td><td>100</td><td>100</td><td>100</td></tr></table>")).alias("html"))


@query("city_table_extract", CITY_SQL.format(least=15, most=70) + " SELECT period AS page_id, CAST(k - 1 AS INT) AS nth, city, mom, yoy FROM c")
def _(x):
    """Cities and their index numbers from a scan over cells; implausible numbers, repeats and tables of too few cities are left out."""
    return E.city_tables(city_pages(x), least=15).where("table = 0").drop("table")


@query("city_table_summary", CITY_SQL.format(least=60, most=70) + " SELECT period AS page_id, COUNT(*) AS n, ROUND(SUM(mom - 100) / COUNT(*), 6) AS avg_mom, COUNT(*) FILTER (WHERE mom > 100) AS up, COUNT(*) FILTER (WHERE mom = 100) AS flat, COUNT(*) FILTER (WHERE mom < 100) AS down FROM c GROUP BY 1")
def _(x):
    """Of each table of 60 cities or more its first 70: the mean change and how many rise, stand and fall."""
    rows = E.city_tables(city_pages(x))
    n = lambda c: F.count(F.when(c, 1))
    return rows.groupBy("page_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("mom") - 100) / F.count("*"), 6).alias("avg_mom"), n(F.col("mom") > 100).alias("up"), n(F.col("mom") == 100).alias("flat"), n(F.col("mom") < 100).alias("down"))


@query("link_select", r"""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?s)<a[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a, generate_subscripts(regexp_extract_all(html, '(?s)<a[^>]*href="[^"]*"[^>]*>.*?</a>'), 1) AS place FROM pages),
  t AS (SELECT page_id, url, place, regexp_extract(a, 'href="([^"]*)"', 1) AS h, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(a, '<[^>]*>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM l),
  w AS (SELECT page_id, place, title, CASE WHEN regexp_matches(h, '^[a-z]+:') THEN h WHEN h LIKE '//%' THEN 'http:' || h WHEN h LIKE '/%' THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || h ELSE url || '/' || h END AS href FROM t)
  SELECT page_id, href, arg_min(title, place) AS title FROM w WHERE regexp_matches(title, '^[a-zA-Z]') AND title NOT IN ('to', 'and') AND (regexp_extract(href, '^https?://([^/:?#]+)', 1) LIKE '%.example.com' OR regexp_extract(href, '^https?://([^/:?#]+)', 1) LIKE '%.example.org') GROUP BY 1, 2""", pre=False)
def _(x):
    """Links of all pages to two of the three domains, as whole addresses."""
    return E.links(x.table("pages").select("page_id", "url", "html"), "(?i)^[a-z]", "^(to|and)$", ("example.com", "example.org"))


@query("page_value_check", r"""WITH t AS (SELECT page_id, html, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gsi'), '<style[^>]*>.*?</style>', ' ', 'gsi'), '<[^>]*>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM pages)
  SELECT page_id, contains(t, CAST(page_id % 1000 AS VARCHAR)) AS found, contains(html, CAST(page_id % 1000 AS VARCHAR)) AS in_markup FROM t""", pre=False)
def _(x):
    """Whether a page's text has a number, its own id's last digits; and whether its markup has."""
    value = (F.col("page_id") % 1000).cast("string")
    return x.table("pages").select("page_id", F.contains(X.strip_html(F.col("html")), value).alias("found"), F.contains("html", value).alias("in_markup"))


@query("due_sources", """+ r AS (SELECT * FROM (VALUES ('BUILDING', 5, 9, 1), ('MACHINERY', 8, 31, 1), ('HOUSEHOLD', 20, 28, 1), ('AUTOMOBILE', 9, 12, 2)) t(source, low, high, lag)), l AS (SELECT seg AS source, MAX(period) AS latest FROM cells WHERE NOT (seg IN ('BUILDING', 'AUTOMOBILE') AND period > '2001-05') GROUP BY 1)
  SELECT source, CASE lag WHEN 1 THEN '2001-06' ELSE '2001-05' END AS expected, latest FROM r LEFT JOIN l USING (source) WHERE 11 BETWEEN low AND LEAST(high, 31) + 3 AND (latest IS NULL OR latest < CASE lag WHEN 1 THEN '2001-06' ELSE '2001-05' END)""")
def _(x):
    late = x.cells.where("NOT (seg IN ('BUILDING', 'AUTOMOBILE') AND period > '2001-05')").groupBy(F.col("seg").alias("source")).agg(F.max("period").alias("latest"))
    return C.due(x.rows(RULES, "source string, low int, high int, lag int"), late, "2001-07-11")


@query("lookback_repull", "SELECT series_id, period, measure, value FROM release WHERE period IN ('2001-04', '2001-05', '2001-06')")
def _(x):
    return C.lookback(x.release, "2001-06").select("series_id", "period", "measure", "value")


@query("frozen_skip", "SELECT series_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE series_id IN (SELECT series_id FROM catalog WHERE tier < 3) AND NOT (series_id = 'nat-5' AND period >= '1999-02') AND NOT (series_id = 'nat-3' AND period >= '1998-04')) AS taken FROM obs GROUP BY 1")
def _(x):
    ended = x.breaks.where("superseded_by IS NOT NULL")
    rows = C.frozen(x.obs, x.catalog.where("tier < 3"), ended)
    return rows.groupBy("series_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("taken"), 1)).alias("taken"))


@query("series_split_at_break", "SELECT CASE WHEN period >= '1998-06' THEN 'seg-new' ELSE 'seg-old' END AS series_id, period, m, period = (SELECT MIN(period) FROM obs q WHERE q.series_id = 'mkt-BUILDING' AND q.period >= '1998-06') AS break_first FROM obs WHERE series_id = 'mkt-BUILDING'")
def _(x):
    return C.split_at(x.obs.where("series_id = 'mkt-BUILDING'"), "seg-old", "seg-new", "1998-06").select("series_id", "period", "m", "break_first")


@query("manifest_link", "+ c AS (SELECT nat AS release, COUNT(DISTINCT period) AS listed, COUNT(DISTINCT CASE WHEN period = '1996-03' AND nat % 4 = 0 THEN period END) AS missing FROM cells WHERE period LIKE '1996%' GROUP BY 1) SELECT release, listed, missing, listed > 0 AND missing = 0 AS satisfied FROM c")
def _(x):
    rows = x.cells.where("period LIKE '1996%'").select(F.col("nat").alias("release"), "period").distinct()
    name = F.concat_ws("/", "release", "period")
    manifest = rows.groupBy("release").agg(F.collect_list(name).alias("captures"))
    return C.manifests(manifest, rows.where("NOT (period = '1996-03' AND release % 4 = 0)").select(name.alias("capture")))


@query("latest_release_asof", "+ t AS (SELECT DISTINCT period FROM obs) SELECT c.series_id, (SELECT MAX(period) FROM t WHERE period <= '2000-0' || (1 + c.tier)) AS period FROM catalog c")
def _(x):
    """As-of: for each series the last calendar period up to a day that its tier sets; the dates are few, so the bound is joined."""
    dates = x.obs.select("period").distinct()
    tiers = x.catalog.select("tier").distinct().withColumn("until", F.concat(F.lit("2000-0"), (F.col("tier") + 1).cast("string")))
    last = tiers.join(dates, F.col("period") <= F.col("until")).groupBy("tier").agg(F.max("period").alias("period"))
    return x.catalog.join(last, "tier").select("series_id", "period")


#: Families of series, and what the checks know of a release of the first months of 2001.
FAMILY_SQL = "CASE WHEN section = 'market' THEN 'market' WHEN tier = 2 THEN 'near' ELSE 'far' END"
KNOWN = ((None, None, "seasonal_z", "sums of few orders"), (None, None, "unit_slip", "sums of few orders"), (None, None, "yoy_base", "rates of another vintage"), (None, None, "bounds", "rates of few orders"), (None, None, "break_link", "links of one side"))


def _families(x, root):
    """All of the older vintage, then a release of its last month and those after it as a pull for each family: one has a level below zero, one can't be read."""
    family = F.when(F.col("section") == "market", "market").when(F.col("tier") == 2, "near").otherwise("far").alias("family")
    of = F.broadcast(x.held(x.catalog.select("series_id", family)))
    cells = lambda t: x.long(t).unionByName(t.select("series_id", "period", "span", F.lit("span").alias("measure"), F.col("span").cast("double").alias("value"))).drop("span")
    I.take(x.spark, G.allowed(cells(x.old), x.breaks).join(of, "series_id"), root, "release-1")
    new = x.held(G.allowed(cells(x.obs.where("period BETWEEN '2001-03' AND '2001-05'")), x.breaks).join(of, "series_id"))
    slip = F.when((F.col("series_id") == new.agg(F.min(F.when(F.col("family") == "near", F.col("series_id")))).first()[0]) & (F.col("period") == "2001-04") & (F.col("measure") == "m"), -F.col("value")).otherwise(F.col("value"))

    def unread():
        raise OSError("the source doesn't answer")

    pull = lambda name: lambda: new.where(F.col("family") == name).withColumn("value", slip)
    calibers = F.array(F.lit("single"), F.lit("ytd"), F.lit("span"))
    series = x.catalog.withColumn("calibers", calibers)
    releases = x.catalog.select("series_id", family).withColumnRenamed("family", "release")
    manifests = x.rows([(f, f"{f}.json") for f in ("market", "near", "far")], "release string, capture string")
    context = K.Context(
        catalog=series, breaks=x.breaks, today="2001-06-20", known=KNOWN, second=x.long(x.obs).where("measure = 'm_yoy'"), pairs=x.rows(PAIRS, "first_id string, second_id string, tol double"),
        parts=x.rows([("mkt-BUILDING", "mkt-MACHINERY")], "total string, series_id string"), heads=x.rows([("mkt-BUILDING", "mkt-MACHINERY"), ("mkt-BUILDING", "mkt-HOUSEHOLD")], "head string, series_id string"),
        wholes=x.rows([("nat-1", "mkt-BUILDING")], "series_id string, whole_id string"), window=x.catalog.select("series_id", F.lit(20).alias("day"), F.lit(9).alias("low"), F.lit(15).alias("high")),
        anchors=x.rows([("market", "core", "mkt-BUILDING"), ("far", "core", "nat-9")], "release string, group string, field string"), fields=new.select(F.col("family").alias("release"), F.col("series_id").alias("field")).distinct(),
        releases=releases, manifests=manifests, captures=manifests.select("capture"), ended=x.catalog.select("series_id", F.lit(True).alias("ended")), joint_from="1998",
    )
    gate = lambda now, rows, before, log: K.all_checks(now, rows, before, log, context, x.held)
    state = I.take(x.spark, {"market": pull("market"), "near": pull("near"), "far": pull("far"), "press": unread}, root, "release-2", gate)
    I.pack(x.spark, root)
    return state


@query("ingest_increment", f"""+ f AS (SELECT series_id, {FAMILY_SQL} AS family FROM catalog), n AS (SELECT o.* FROM long_obs o JOIN f USING (series_id) WHERE period BETWEEN '2001-03' AND '2001-05' AND family <> 'near' AND NOT (measure LIKE '%yoy' AND {BLOCKED.format(a='o', p='period')})), q AS (SELECT * FROM long_old o WHERE NOT (measure LIKE '%yoy' AND {BLOCKED.format(a='o', p='period')}))
  SELECT series_id, period, measure, COALESCE(n.value, q.value) AS value FROM q FULL JOIN n USING (series_id, period, measure)""")
def _(x):
    """A release of four families: one is blocked by the checks, one fails, the others are taken in; the state after it."""
    root = scratch(x)
    _families(x, root)
    return I.newest(x.spark, root).where("measure <> 'span'")


@query("ingest_families", "SELECT * FROM (VALUES ('market', 'taken'), ('near', 'blocked'), ('far', 'taken'), ('press', 'failed: OSError')) t(family, state)", pre=False)
def _(x):
    """What became of each family of that release."""
    return x.rows(list(_families(x, scratch(x)).items()), "family string, state string")


@query("ingest_revisions", f"""+ f AS (SELECT series_id, {FAMILY_SQL} AS family FROM catalog) SELECT 'release-2' AS release, series_id, period, measure, 1 AS row_no, p.value AS old, o.value AS new FROM long_obs o JOIN long_old p USING (series_id, period, measure) JOIN f USING (series_id)
  WHERE period = '2001-03' AND family <> 'near' AND ABS(o.value - p.value) >= 1e-9 AND NOT (measure LIKE '%yoy' AND {BLOCKED.format(a='o', p='period')})""")
def _(x):
    """What the families that were taken in have changed of what was on file."""
    root = scratch(x)
    _families(x, root)
    return I.revisions(x.spark, root).where("measure <> 'span'")


@query("ingest_stream", "SELECT series_id, period, measure, value FROM release WHERE measure = 'm'")
def _(x):
    """The release as files through the stream, until all are taken in; the state after it."""
    root = scratch(x)
    rows = x.release.where("measure = 'm'").select(*I.G.CELL, "value", F.lit("r1").alias("release_id"))
    rows.write.json(f"{root}/in")
    query_ = I.start(x.spark, f"{root}/in", f"{root}/state", f"{root}/checkpoint")
    query_.awaitTermination()
    return I.newest(x.spark, f"{root}/state")
