"""Queries on the archive: pages of a dated source, labels and values in their text, published cells looked up in them.

The archive is the table of pages, each filed as the release of a month, with the month's figures printed among what the page holds.
Some months print them wrongly.
"""

from pyspark.sql import functions as F

from ledgerline.functions.text import CLAUSE_ENDS, NEGATIVE
from ledgerline.operators import archive as A
from ledgerline.plans.registry import query

MONTHS = 90

TEXT_SQL = r"""regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace({}, '<script[^>]*>.*?</script>', ' ', 'gsi'), '<style[^>]*>.*?</style>', ' ', 'gsi'), '<[^>]*>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[\s\x{{00A0}}\x{{3000}},]+', '', 'g')"""

#: Pages with their names; what a month's pages print of each series; the archive of both.
ARCHIVE_SQL = rf"""+ pg AS (SELECT page_id, html, strftime(DATE '1995-02-15' + to_months(CAST(page_id % {MONTHS} AS INT)), '%Y-%m-%d') AS day FROM pages),
  nm AS (SELECT page_id, html, day, CASE WHEN page_id % 37 = 5 THEN 'page-' || page_id WHEN page_id % 10 = 3 THEN substr(day, 1, 7) || '_' || page_id || '.html' ELSE day || '_' || page_id || '.html' END AS name FROM pg),
  pr AS (SELECT o.series_id, c.section, o.period, strftime(CAST(o.period || '-15' AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') AS day, c.name || '总额' || CASE WHEN section = 'market' THEN format('{{:.4f}}', ROUND(o.m * CASE WHEN o.period LIKE '%-07' THEN 1.1 ELSE 1 END) / 10000) || '万亿元' ELSE format('{{:,}}', CAST(ROUND(o.m * CASE WHEN o.period LIKE '%-07' THEN 1.1 ELSE 1 END) AS BIGINT)) || ' 亿元' END
    || COALESCE('，同比' || CASE WHEN (o.m_yoy < 0) <> (o.period LIKE '%-03') THEN '下降' ELSE '增长' END || format('{{:.1f}}', ABS(o.m_yoy)) || '%', '') || '。' AS said, CASE WHEN section = 'nation' THEN CAST(substr(o.series_id, 5) AS INT) END AS nat FROM obs o JOIN catalog c USING (series_id) WHERE o.series_id <> 'nat-8'),
  ar AS (SELECT n.page_id, ANY_VALUE(n.name) AS name, ANY_VALUE(n.html) || '<p>' || COALESCE(string_agg(said, '</p><p>' ORDER BY series_id), '') || '</p>' AS html FROM nm n LEFT JOIN pr ON pr.day = n.day AND (pr.section = 'market' OR (pr.nat + n.page_id) % 7 = 0) GROUP BY 1),
  tx AS (SELECT page_id, name, CASE WHEN regexp_matches(name, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN substr(name, 1, 10) END AS filed, CASE WHEN regexp_matches(name, '^[0-9]{{4}}-') THEN CAST(substr(name, 1, 4) AS INT) END AS year, {TEXT_SQL.format("html")} AS t FROM ar),
  tag AS (SELECT series_id, period, m, m_yoy, CASE WHEN series_id LIKE 'mkt-%' THEN 'rel:' || strftime(CAST(period || '-15' AS DATE) + INTERVAL 1 MONTH, '%Y%m%d') WHEN series_id LIKE 'nat-1%' THEN 'natdata:' || period END AS src FROM obs)"""


def page_names(x):
    """(page_id, html, day, name): the pages as they are filed."""
    day = F.date_format(F.add_months(F.lit("1995-02-15").cast("date"), (F.col("page_id") % MONTHS).cast("int")), "yyyy-MM-dd")
    id_ = F.col("page_id").cast("string")
    name = F.when(F.col("page_id") % 37 == 5, F.concat(F.lit("page-"), id_)).otherwise(F.concat(F.when(F.col("page_id") % 10 == 3, F.substring("day", 1, 7)).otherwise(F.col("day")), F.lit("_"), id_, F.lit(".html")))
    return x.table("pages").select("page_id", "html", day.alias("day")).withColumn("name", name)


def pages(x):
    """(page_id, name, html) of the archive."""
    named = page_names(x)
    rows = x.obs.where("series_id <> 'nat-8'").join(x.catalog.select("series_id", "section", "name"), "series_id")
    m = F.round(F.col("m") * F.when(F.col("period").like("%-07"), 1.1).otherwise(1.0))
    amount = F.when(F.col("section") == "market", F.concat(F.format_string("%.4f", m / 10000), F.lit("万亿元"))).otherwise(F.concat(F.format_number(m, 0), F.lit(" 亿元")))
    way = F.when((F.col("m_yoy") < 0) != F.col("period").like("%-03"), "下降").otherwise("增长")
    rate = F.when(F.col("m_yoy").isNotNull(), F.concat(F.lit("，同比"), way, F.format_string("%.1f", F.abs("m_yoy")), F.lit("%"))).otherwise("")
    said = rows.select("series_id", _next_day().alias("day"), F.concat("name", F.lit("总额"), amount, rate, F.lit("。")).alias("said"), F.regexp_extract("series_id", "^nat-([0-9]+)$", 1).try_cast("int").alias("nat"))
    met = named.select("page_id", "day").join(said, "day").where("nat IS NULL OR (nat + page_id) % 7 = 0")
    told = met.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("series_id", "said"))), lambda s: s["said"]), "</p><p>").alias("told"))
    html = F.concat("html", F.lit("<p>"), F.coalesce("told", F.lit("")), F.lit("</p>"))
    parts = A.parts_of(named, "html")
    return x.held(named.join(told, "page_id", "left").select("page_id", "name", html.alias("html")).repartition(parts, "page_id"))


def _next_day(form="yyyy-MM-dd"):
    """The fifteenth of the month after a period."""
    return F.date_format(F.add_months(F.to_date(F.concat("period", F.lit("-15"))), 1), form)


def tagged(x):
    """Observations with their source tag: segments by release day, some nations by period, others without."""
    src = F.when(F.col("series_id").like("mkt-%"), F.concat(F.lit("rel:"), _next_day("yyyyMMdd"))).when(F.col("series_id").like("nat-1%"), F.concat(F.lit("natdata:"), "period"))
    return x.obs.select("series_id", "period", "m", "m_yoy", src.alias("src"))


MAY_SQL = "a.src LIKE 'rel:%' AND {p}.filed = substr(a.src, 5, 4) || '-' || substr(a.src, 9, 2) || '-' || substr(a.src, 11, 2) OR (a.src IS NULL OR a.src NOT LIKE 'rel:%') AND ({p}.year IS NULL OR ABS({p}.year - CAST(substr(a.period, 1, 4) AS INT)) <= 1)"
NEAR_SQL = "ABS(date_diff('day', last_day(CAST(a.period || '-01' AS DATE)), CAST(p.filed AS DATE)))"


@query("pages_for_src", ARCHIVE_SQL + f""", pair AS (SELECT a.series_id, a.period, a.src, p.page_id, p.filed, {NEAR_SQL} AS near FROM tag a LEFT JOIN tx p ON {MAY_SQL.format(p="p")})
  SELECT series_id, period, src, COUNT(page_id) AS pages, MIN(near) AS near, arg_min(page_id, near * 1000000 + page_id) AS nearest FROM pair GROUP BY 1, 2, 3""")
def _(x):
    """Of every observation the pages that may hold it, and the nearest in time, of ties the first."""
    rows = tagged(x).select("series_id", "period", "src")
    # Pages filed alike may hold the same observations, so observations meet days and months, however many pages each has.
    filed = A.page_dates(page_names(x)).groupBy("filed", "year").agg(F.count("*").alias("n"), F.min("page_id").alias("page_id"))
    may = A.pages_of(rows, x.held(filed))
    found = may.groupBy("series_id", "period").agg(F.sum("n").alias("pages"), F.min("near").cast("long").alias("near"), F.min_by("page_id", F.when(F.col("near").isNotNull(), F.struct("near", "page_id"))).alias("nearest"))
    return rows.join(found, ["series_id", "period"], "left").withColumn("pages", F.coalesce("pages", F.lit(0)).cast("long"))


def labels(x):
    """Two names of most series, of which the second is printed; one nation has none, another one that no page has."""
    rows = x.catalog.where("series_id <> 'nat-9'").select("series_id", "name")
    return rows.select("series_id", F.inline(F.array(F.struct(F.lit(1).alias("nth"), F.concat("name", F.lit("零售额")).alias("label")), F.struct(F.lit(2).alias("nth"), F.concat("name", F.lit("总额")).alias("label")))))


LABEL_SQL = """, lb AS (SELECT series_id, nth, regexp_replace(name || tail, '[\\s,]+', '', 'g') AS label FROM catalog, (VALUES (1, '零售额'), (2, '总额')) v(nth, tail) WHERE series_id <> 'nat-9'),
  me AS (SELECT l.series_id, l.nth, l.label, p.page_id, instr(p.t, l.label) AS place FROM lb l JOIN tx p ON contains(p.t, l.label))"""


@query("page_label_value_search", ARCHIVE_SQL + LABEL_SQL + " SELECT label, COUNT(*) AS pages, MIN(page_id) AS first_page, SUM(place) AS places, COUNT(*) FILTER (WHERE regexp_matches(substr(t, place + length(label), 12), '^[0-9]')) AS with_number FROM me JOIN tx USING (page_id) GROUP BY 1")
def _(x):
    """Pages that have a label, found through the index of grams, and whether a number follows it."""
    texts = x.held(A.page_texts(pages(x)))
    found = A.mentions(texts, labels(x), x.held).join(texts.select("page_id", "text"), "page_id")
    after = F.substr("text", F.col("place") + F.char_length("label"), F.lit(12))
    return found.groupBy("label").agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page"), F.sum(F.col("place").cast("long")).alias("places"), F.count(F.when(after.rlike("^[0-9]"), 1)).alias("with_number"))


def _bare_sql(v: str, digits: int) -> str:
    return f"regexp_replace(format('{{:.{digits}f}}', {v}), '\\.?0+$', '')" if digits else f"format('{{:.0f}}', {v})"


def _ways_sql(v: str) -> str:
    """The texts in which a value may be printed, as the list of a DuckDB query; equal texts once."""
    size = f"ABS({v})"
    bounds = ((0, 100000), (1, 10000), (2, 1000), (3, 100), (4, 10), (5, 1), (6, 0.1), (7, 0.01), (8, 0.001), (9, 0.0001))
    general = lambda w: f"CASE WHEN {w} = 0 THEN '0' WHEN {size} >= 1000000 THEN NULL " + " ".join(f"WHEN {size} >= {least} THEN {_bare_sql(w, d)}" for d, least in bounds) + " END"
    fixed = [f"CASE WHEN {_bare_sql(v, d)} NOT IN ('', '0', '-0', '-') THEN {_bare_sql(v, d)} END" for d in (1, 2)]
    whole = f"CASE WHEN ABS({v} - round_even({v}, 0)) < 0.000001 OR {size} >= 1000 THEN {_bare_sql(v, 0)} END"
    low = [f"'下降' || {general(size)}", f"'负' || {general(size)}", f"CASE WHEN {_bare_sql(size, 1)} <> '0' THEN '下降' || {_bare_sql(size, 1)} END"]
    each = ", ".join([general(v), *fixed, whole, *(f"CASE WHEN {v} < 0 THEN {x} END" for x in low)])
    return f"list_filter(list_distinct([{each}]), lambda w: w IS NOT NULL)"


#: Whether window {w} has a text of list {c} for a value {v}: a positive one not after a word for a fall in the clause, within twelve characters.
HAS_SQL = """len(list_filter({c}, lambda k: contains({w}, k) AND ({v} <= 0 OR len(list_filter(range(1, len(string_split({w}, k))), lambda i: NOT regexp_matches(regexp_extract(right(left({w}, CAST(list_sum(list_transform(string_split({w}, k)[1:i], lambda p: length(p))) AS BIGINT) + (i - 1) * length(k)), 12), '[^""" + CLAUSE_ENDS.replace("\n", "") + """]*$'), '""" + "|".join(NEGATIVE) + """'))) > 0))) > 0"""

LOOKED_SQL = ARCHIVE_SQL + LABEL_SQL + f""", fact AS (SELECT series_id, period, src, 'm' AS field, m AS value FROM tag WHERE m IS NOT NULL UNION ALL SELECT series_id, period, src, 'm_yoy', m_yoy FROM tag WHERE m_yoy IS NOT NULL),
  ways AS (SELECT *, {_ways_sql("value")} AS w1, {_ways_sql("(value / 10000)")} AS w2 FROM fact),
  may AS (SELECT a.series_id, a.period, a.field, a.value, a.w1, a.w2, p.page_id, {NEAR_SQL} AS near, e.nth, e.place, e.label, p.t FROM ways a JOIN me e USING (series_id) JOIN tx p USING (page_id) WHERE {MAY_SQL.format(p="p")}),
  win AS (SELECT *, substr(t, GREATEST(place - 220, 1), LEAST(place - 1, 220) + length(label) + 320) AS w FROM may),
  one AS (SELECT *, {HAS_SQL.format(w="w", c="w1", v="value")} AS a1, {HAS_SQL.format(w="w", c="w2", v="value")} AS a2 FROM win),
  hit1 AS (SELECT series_id, period, field, arg_min(struct_pack(page_id := page_id, scale := CASE WHEN a1 THEN '1x' ELSE 'wan_yi_1e4' END), COALESCE(near, 1073741824) * 10000000 + page_id * 10 + nth) AS h FROM one WHERE a1 OR a2 GROUP BY 1, 2, 3),
  two AS (SELECT *, {HAS_SQL.format(w="t", c="w1", v="value")} AS a1, {HAS_SQL.format(w="t", c="w2", v="value")} AS a2 FROM may WHERE NOT EXISTS (SELECT 1 FROM hit1 h WHERE h.series_id = may.series_id AND h.period = may.period AND h.field = may.field)),
  hit2 AS (SELECT series_id, period, field, arg_min(struct_pack(page_id := page_id, scale := CASE WHEN a1 THEN '1x' ELSE 'wan_yi_1e4' END), COALESCE(near, 1073741824) * 10000000 + page_id * 10) AS h FROM two WHERE a1 OR a2 GROUP BY 1, 2, 3),
  hit AS (SELECT * FROM hit1 UNION ALL SELECT * FROM hit2), seen AS (SELECT DISTINCT series_id, period, field FROM may),
  looked AS (SELECT f.series_id, f.period, f.field, h.page_id, h.scale, CASE WHEN f.series_id NOT IN (SELECT series_id FROM lb) THEN 'unverifiable' WHEN s.series_id IS NULL THEN 'gap' WHEN h IS NOT NULL THEN 'verified' ELSE 'mismatch' END AS state
    FROM fact f LEFT JOIN hit USING (series_id, period, field) LEFT JOIN seen s USING (series_id, period, field))"""


@query("audit_archive_sample", LOOKED_SQL + """ SELECT l.series_id, period, field, state, CASE WHEN state = 'verified' THEN 'pass' WHEN state = 'mismatch' AND c.tier < 3 AND c.name <> 'BUILDING' THEN 'block' ELSE 'warn' END AS status, page_id, scale FROM looked l JOIN catalog c USING (series_id)""")
def _(x):
    """Every level and rate looked up in the archive; one segment counts as the association's."""
    cells = tagged(x).unpivot(["series_id", "period", "src"], ["m", "m_yoy"], "field", "value").where("value IS NOT NULL")
    found = A.look_up(x.held(cells.withColumn("fact", F.concat_ws("|", "series_id", "period", "field"))), labels(x), pages(x), x.held)
    agency = F.when(F.col("name") == "BUILDING", "cflp").otherwise("gov")
    rows = found.join(x.catalog.select("series_id", "tier", "name"), "series_id")
    return rows.select("series_id", "period", "field", "state", A.severity(F.col("state"), F.col("tier"), agency).alias("status"), "page_id", "scale")
