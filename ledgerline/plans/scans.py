"""Queries on reading and writing documents."""

from pyspark.sql import functions as F

from ledgerline.functions import periods as P
from ledgerline.plans.registry import query
from ledgerline.sources import readers as R


def scratch(x) -> str:
    """A folder of its own under the one that driver and executors share."""
    return x.scratch()


def documents(x):
    """The bound series as series documents: every fourth March print lacks m, every fifth is null."""
    pairs = F.concat(
        F.array(F.struct(F.lit("period").alias("k"), F.col("period").alias("v")), F.struct(F.lit("span").alias("k"), F.col("span").cast("string").alias("v"))),
        F.when(F.substring("period", 6, 2) == "03", F.expr("cast(array() AS array<struct<k:string,v:string>>)")).otherwise(F.array(F.struct(F.lit("m").alias("k"), F.col("m").cast("string").alias("v")))),
        F.array(F.struct(F.lit("ytd").alias("k"), F.when(F.substring("period", 6, 2) != "05", F.col("ytd").cast("string")).alias("v"))),
    )
    rows = x.obs.withColumn("o", F.map_from_entries(pairs))
    docs = rows.groupBy(F.col("series_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("period", F.to_json("o", {"ignoreNullFields": "false"}).alias("o")))).alias("obs"))
    head = {"schema": "series/v1", "value_type": "level", "freq": "M"}
    body = F.concat(F.lit('{"id":"'), "id", F.lit('",' + ",".join(f'"{k}":"{v}"' for k, v in head.items()) + ',"observations":['), F.array_join(F.transform("obs", lambda o: o["o"]), ","), F.lit("]}"))
    return docs.select(F.when(F.col("id") == "nat-9", F.lit('{"id": "nat-9", broken')).otherwise(body).alias("value"))


FLAT = "SELECT series_id, period, span, CASE WHEN substr(period, 6, 2) = '03' THEN NULL ELSE m END AS m, CASE WHEN substr(period, 6, 2) = '05' THEN NULL ELSE ytd END AS ytd, CASE WHEN substr(period, 6, 2) = '03' THEN 'ytd' ELSE 'm,ytd' END AS present FROM obs WHERE series_id <> 'nat-9'"


@query("flatten_observations", FLAT)
def _(x):
    docs = documents(x).select(F.from_json("value", R.SERIES_SCHEMA).alias("d")).select("d.*").where("id IS NOT NULL AND observations IS NOT NULL")
    return R.flatten_observations(docs).select("series_id", "period", "span", "m", "ytd", F.array_join("present", ",").alias("present"))


@query("scan_series", "SELECT series_id, COUNT(*) AS n FROM obs WHERE series_id <> 'nat-9' GROUP BY 1 UNION ALL SELECT 'skipped', 1 WHERE EXISTS (SELECT 1 FROM obs WHERE series_id = 'nat-9')")
def _(x):
    path = scratch(x)
    documents(x).repartition(40, F.xxhash64("value")).write.option("lineSep", "\n").text(path)
    docs = x.spark.read.json(path, schema=R.SERIES_SCHEMA, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad").withColumn("_file", F.input_file_name())
    _, rows, _, _, skipped = R.split_series(docs)
    return rows.groupBy("series_id").agg(F.count("*").alias("n")).union(skipped.groupBy(F.lit("skipped")).agg(F.count("*")))


@query("pivot_wide_records", """+ r AS (SELECT period, CASE WHEN period LIKE '%-02' AND period >= '1998' THEN 'jan_feb' ELSE 'month' END AS g, seg, SUM(v)::DOUBLE AS v, SUM(n)::DOUBLE AS n FROM cells GROUP BY 1, 2, 3)
  SELECT 'mkt-' || seg AS series_id, period, CASE WHEN g = 'jan_feb' AND seg <> 'HOUSEHOLD' THEN 'ytd' ELSE 'm' END AS measure, v AS value FROM r UNION ALL SELECT 'cnt-' || seg, period, 'm', n FROM r WHERE seg IN ('BUILDING', 'MACHINERY')""")
def _(x):
    """Records of a month with a map of all metrics, sums and counts of every segment; merged prints give sums as the year so far, but for one segment; three counts have no series."""
    group = F.when(F.col("period").like("%-02") & (F.col("period") >= "1998"), "jan_feb").otherwise("month")
    sums = x.cells.groupBy("period", "seg").agg(F.sum("v").cast("double").alias("v"), F.sum("n").cast("double").alias("n"))
    pairs = sums.select("period", F.explode(F.array(F.struct(F.concat(F.col("seg"), F.lit("_value")).alias("k"), F.col("v").alias("v")), F.struct(F.concat(F.col("seg"), F.lit("_count")).alias("k"), F.col("n").alias("v")))).alias("e"))
    records = pairs.groupBy("period").agg(F.map_from_entries(F.collect_list("e")).alias("metrics")).select("period", group.alias("group"), "metrics")
    segments = x.catalog.where("section = 'market'").select("name")
    value, series = F.concat("name", F.lit("_value")), F.concat(F.lit("mkt-"), "name")
    none = F.lit(None).cast("string")
    fields = segments.select(value.alias("metric"), none.alias("group"), series.alias("series_id"), F.lit("m").alias("measure"))
    fields = fields.union(segments.where("name <> 'HOUSEHOLD'").select(value, F.lit("jan_feb"), series, F.lit("ytd")))
    fields = fields.union(segments.where("name IN ('BUILDING', 'MACHINERY')").select(F.concat("name", F.lit("_count")), none, F.concat(F.lit("cnt-"), "name"), F.lit("m")))
    return R.pivot_wide(records, fields)


@query("panel_explode", "SELECT entity::VARCHAR AS entity, metric, period, m AS value FROM panel")
def _(x):
    wide = R.assemble_panel(x.panel, x.panel.where("false"))
    there = x.panel.select(F.col("entity").cast("string").alias("entity"), "metric", "period")
    nested = wide.select(F.lit("p").alias("id"), "periods", F.create_map(F.col("entity").cast("string"), F.create_map("metric", F.create_map(F.lit("m"), "values"))).alias("cells"))
    return R.explode_panel(nested).join(there, ["entity", "metric", "period"], "left_semi").select("entity", "metric", "period", "value")


@query("panel_assemble", """+ a AS (SELECT * FROM panel WHERE period < '1999'), b AS (SELECT entity, metric, period, m + 1 AS m FROM panel WHERE period >= '1998'), c AS (SELECT entity, metric, period, COALESCE(a.m, b.m) AS m FROM a FULL JOIN b USING (entity, metric, period)),
  f AS (SELECT * FROM (SELECT DISTINCT metric, period FROM c) JOIN (SELECT DISTINCT metric, entity FROM c) USING (metric)) SELECT entity, metric, COUNT(*) AS n, COUNT(c.m) AS filled, CAST(SUM(CAST(c.m AS DECIMAL(20,1))) AS DOUBLE) AS total FROM f LEFT JOIN c USING (entity, metric, period) GROUP BY 1, 2""")
def _(x):
    wide = R.assemble_panel(x.panel.where("period < '1999'"), x.panel.where("period >= '1998'").withColumn("m", F.col("m") + 1))
    filled = F.filter("values", lambda v: v.isNotNull())
    total = F.aggregate(F.transform(filled, lambda v: v.cast("decimal(28,1)")), F.lit(0).cast("decimal(28,1)"), lambda a, v: (a + v).cast("decimal(28,1)"))
    return wide.select("entity", "metric", F.size("values").cast("long").alias("n"), F.size(filled).cast("long").alias("filled"), F.when(F.size(filled) > 0, total.cast("double")).alias("total"))


@query("scan_api_captures", "+ n AS (SELECT indicator, code, TRY_CAST(v AS DOUBLE) AS value, fetched FROM captures) SELECT indicator, code, arg_max(value, fetched) AS value, MAX(fetched) AS fetched FROM n WHERE value IS NOT NULL GROUP BY 1, 2")
def _(x):
    return R.latest_captures(x.captures)


@query("period_code_decode", """+ c AS (SELECT DISTINCT unnest([code, substr(code, 1, 4) || '0' || ((CAST(substr(code, 5, 2) AS INT) + 2) // 3) || 'SS', substr(code, 1, 4) || 'AA']) AS code FROM captures)
  SELECT code, CASE WHEN code LIKE '%MM' THEN substr(code, 1, 4) || '-' || substr(code, 5, 2) WHEN code LIKE '%SS' THEN substr(code, 1, 4) || '-Q' || CAST(substr(code, 5, 2) AS INT) ELSE substr(code, 1, 4) END AS period FROM c""")
def _(x):
    quarter = F.floor((F.substring("code", 5, 2).cast("int") + 2) / 3).cast("string")
    codes = F.array(F.col("code"), F.concat(F.substring("code", 1, 4), F.lit("0"), quarter, F.lit("SS")), F.concat(F.substring("code", 1, 4), F.lit("AA")))
    return x.captures.select(F.explode(codes).alias("code")).distinct().select("code", P.decode_code("code").alias("period"))


@query("scan_html_captures", r"""WITH t AS (SELECT page_id, page_id % 5 AS k, url, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gsi'), '<style[^>]*>.*?</style>', ' ', 'gsi'), '<[^>]*>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages)
  SELECT page_id, CASE WHEN k = 2 THEN '{"n":' || page_id || ',"url":"' || url || '"}' ELSE text END AS text FROM t WHERE k < 3 AND text <> ''""", pre=False)
def _(x):
    """Pages as files: as they are, in a JSON envelope, with an object as payload, cut off, and of another kind."""
    k, html = F.col("page_id") % 5, F.col("html")
    wrapped = F.to_json(F.struct(html.alias("payload"), F.lit("x").alias("source")))
    bare = F.to_json(F.struct(F.struct(F.col("page_id").alias("n"), "url").alias("payload")))
    raw = F.when(k == 1, wrapped).when(k == 2, bare).when(k == 3, F.concat(F.lit('{"payload": "'), F.col("url"))).otherwise(html)
    name = F.concat(F.col("page_id").cast("string"), F.when(k == 0, ".html").when(k == 4, ".pdf").otherwise(".json"))
    return R.capture_texts(x.table("pages").select("page_id", name.alias("name"), raw.alias("raw"))).select("page_id", "text")


@query("write_series_canonical", """SELECT series_id, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY period) AS place, '{"period":"' || period || '","span":' || span || ',"m":' || format('{:.2f}', m) || COALESCE(',"m_yoy":' || format('{:.1f}', m_yoy), '') || COALESCE(',"ytd":' || format('{:.2f}', ytd), '') || COALESCE(',"ytd_yoy":' || format('{:.1f}', ytd_yoy), '') || '}' AS line FROM obs""")
def _(x):
    """Every observation as its line, levels with two decimals and rates with one."""
    fixed = x.obs.withColumns({c: F.col(c).cast(f"decimal(28,{d})") for c, d in (("m", 2), ("ytd", 2), ("m_yoy", 1), ("ytd_yoy", 1))})
    return R.canonical_lines(fixed).select("series_id", F.col("place").cast("long").alias("place"), "line")


@query("promote_staged", "SELECT series_id, COUNT(*) AS n, MAX(period) AS last FROM (SELECT series_id, period FROM old WHERE series_id NOT LIKE 'mkt-%' UNION ALL SELECT series_id, period FROM obs WHERE series_id LIKE 'mkt-%') GROUP BY 1")
def _(x):
    path = R.promote(x.old, x.obs.where("series_id LIKE 'mkt-%'"), scratch(x))
    return x.spark.read.parquet(path).groupBy("series_id").agg(F.count("*").alias("n"), F.max("period").alias("last"))


@query("scan_bundles", "SELECT section, COUNT(*) AS series FROM catalog GROUP BY 1")
def _(x):
    path = scratch(x)
    x.catalog.groupBy("section").agg(F.collect_list(F.struct("series_id", "name")).alias("series")).write.json(path)
    back = x.spark.read.json(path, schema="section string, series array<struct<series_id:string,name:string>>")
    return back.select("section", F.explode("series").alias("s")).groupBy("section").agg(F.count("*").alias("series"))
