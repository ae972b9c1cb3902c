"""Readers and writers of published documents: series, panels, captures, bundles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import strip_html

MEASURES = ("m", "m_yoy", "ytd", "ytd_yoy", "mom", "real_yoy")
SERIES_SCHEMA = (
    "schema string, id string, name_zh string, name_en string, unit_zh string, value_type string, freq string, calibers array<string>, decimals int, generated_at string, "
    "observations array<map<string,string>>, revisions array<struct<period:string,measure:string,old:double,new:double,revised_on:string,source:string,note:string>>, "
    "breaks array<struct<effective:string,kind:string,no_yoy_across:boolean,yoy_valid_from:string,supersedes:string,superseded_by:string>>, _bad string"
)


def read_series(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(series, observations, revisions, breaks, skipped) of series documents, one JSON document a file."""
    docs = spark.read.json(path, schema=SERIES_SCHEMA, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    return split_series(docs.withColumn("_file", F.input_file_name()))


def split_series(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """The tables in documents; those without an id or that couldn't be read are `skipped`."""
    good, bad = docs.where("id IS NOT NULL AND _bad IS NULL"), docs.where("id IS NULL OR _bad IS NOT NULL")
    one = lambda c: good.select(F.col("id").alias("series_id"), F.explode(c).alias("x")).select("series_id", "x.*")
    return good.drop("observations", "revisions", "breaks", "_bad", "_file"), flatten_observations(good), one("revisions"), one("breaks"), bad.select("_file", F.col("_bad").alias("content"))


def flatten_observations(docs: DataFrame) -> DataFrame:
    """A row for each observation; `present` names the measures whose key stands there, be its value null or not."""
    rows = docs.select(F.col("id").alias("series_id"), F.posexplode("observations").alias("place", "o"))
    numbers = [F.col("o")[m].try_cast("double").alias(m) for m in MEASURES]
    present = F.array_sort(F.filter(F.map_keys("o"), lambda k: k.isin(*MEASURES)))
    return rows.select("series_id", "place", F.col("o")["period"].alias("period"), F.coalesce(F.col("o")["span"].try_cast("int"), F.lit(1)).alias("span"), *numbers, present.alias("present"))


def capture_texts(captures: DataFrame) -> DataFrame:
    """Captures (name, raw, ...) with `text`, what a reader sees: pages without markup; of JSON files the text of their payload, be it a page or an
    object, or of the whole document if they have none. Files of other kinds, JSON that can't be read, and captures without text are left out.
    """
    doc = F.try_parse_json("raw")
    payload = F.try_variant_get(doc, "$.payload", "variant")
    kind = F.schema_of_variant(payload)
    inner = F.when(kind == "STRING", F.try_variant_get(doc, "$.payload", "string")).when(kind.startswith("OBJECT"), F.to_json(payload)).otherwise(F.to_json(doc))
    text = F.when(F.lower("name").rlike(r"\.html?$"), strip_html(F.col("raw"))).when(F.lower("name").endswith(".json"), strip_html(inner))
    return captures.withColumn("text", text).where("text <> ''")


def pivot_wide(records: DataFrame, fields: DataFrame) -> DataFrame:
    """(series_id, period, measure, value) of wide records (period, group, metrics: map of names to numbers).

    `fields` is (metric, group, series_id, measure): what a name stands for in records of a group, or of any where the group is
    null; a group's own line goes first, so that it may give a name another caliber. Names without a line are left out.
    """
    rows = records.select("period", "group", F.explode("metrics").alias("metric", "value")).where("value IS NOT NULL")
    own = fields.where("group IS NOT NULL").select("metric", "group", F.col("series_id").alias("_s1"), F.col("measure").alias("_m1"))
    every = fields.where("group IS NULL").select("metric", F.col("series_id").alias("_s2"), F.col("measure").alias("_m2"))
    both = rows.join(F.broadcast(own), ["metric", "group"], "left").join(F.broadcast(every), "metric", "left")
    return both.select(F.coalesce("_s1", "_s2").alias("series_id"), "period", F.coalesce("_m1", "_m2").alias("measure"), "value").where("series_id IS NOT NULL")


def explode_panel(panels: DataFrame) -> DataFrame:
    """Long cells from panels (id, periods, cells: entity -> metric -> measure -> values aligned to periods)."""
    rows = panels.select("id", "periods", F.explode("cells").alias("entity", "_m")).select("id", "periods", "entity", F.explode("_m").alias("metric", "_v")).select("id", "periods", "entity", "metric", F.explode("_v").alias("measure", "_a"))
    zipped = rows.select("id", "entity", "metric", "measure", F.explode(F.arrays_zip("periods", F.col("_a").alias("value"))).alias("z"))
    return zipped.select("id", "entity", "metric", "measure", F.col("z.periods").alias("period"), F.col("z.value").alias("value"))


def assemble_panel(first: DataFrame, second: DataFrame) -> DataFrame:
    """(entity, metric, periods, values): cells of two sources, the first one's if both have one, aligned to all periods of the metric."""
    a, b = first.select("entity", "metric", "period", F.col("m").alias("_a")), second.select("entity", "metric", "period", F.col("m").alias("_b"))
    cells = a.join(b, ["entity", "metric", "period"], "full_outer").select("entity", "metric", "period", F.coalesce("_a", "_b").alias("m"))
    frame = cells.select("metric", "period").distinct().join(cells.select("metric", "entity").distinct(), "metric")
    full = frame.join(cells, ["entity", "metric", "period"], "left")
    rows = full.groupBy("entity", "metric").agg(F.array_sort(F.collect_list(F.struct("period", "m"))).alias("c"))
    return rows.select("entity", "metric", F.transform("c", lambda c: c["period"]).alias("periods"), F.transform("c", lambda c: c["m"]).alias("values"))


def latest_captures(captures: DataFrame) -> DataFrame:
    """The number of the capture fetched last for each indicator and code, of those that have one."""
    there = captures.withColumn("value", F.col("v").try_cast("double")).where("value IS NOT NULL")
    return there.groupBy("indicator", "code").agg(F.max_by("value", "fetched").alias("value"), F.max("fetched").alias("fetched"))


def aligned_arrays(rows: DataFrame) -> DataFrame:
    """(series_id, periods, level, yoy, level_ytd, yoy_ytd): a series' published arrays, aligned to its periods.

    Rows are (series_id, period, headline, both, blocked, m, ytd, m_yoy, ytd_yoy): the first two arrays are of the headline caliber, the
    last two of the year to date where a series has `both`, else null. Rates in a window without rates are null.
    """
    cum, free = F.col("headline") == "ytd", ~F.col("blocked")
    at = F.struct(
        "period", F.when(cum, F.col("ytd")).otherwise(F.col("m")).alias("level"), F.when(free, F.when(cum, F.col("ytd_yoy")).otherwise(F.col("m_yoy"))).alias("yoy"),
        F.col("ytd").alias("level_ytd"), F.when(free, F.col("ytd_yoy")).alias("yoy_ytd"),
    )
    one = rows.groupBy("series_id").agg(F.array_sort(F.collect_list(at)).alias("a"), F.max("both").alias("both"))
    part = lambda c: F.transform("a", lambda r: r[c])
    return one.select("series_id", part("period").alias("periods"), part("level").alias("level"), part("yoy").alias("yoy"), *(F.when(F.col("both"), part(c)).alias(c) for c in ("level_ytd", "yoy_ytd")))


def bundle_documents(arrays: DataFrame, catalog: DataFrame, panel: DataFrame) -> DataFrame:
    """(document, body): a document for each section with its series' arrays, one for the panel's, and the index of sections; all as JSON with nulls kept."""
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    own = arrays.join(catalog.select("series_id", "section", "tier", "name"), "series_id")
    series = F.struct("tier", F.col("series_id").alias("id"), "name", "periods", "level", "yoy", "level_ytd", "yoy_ytd")
    sections = own.groupBy("section").agg(F.array_sort(F.collect_list(series)).alias("series")).select(F.concat(F.lit("section/"), "section").alias("document"), text(F.struct("section", "series")).alias("body"))
    last = F.element_at("periods", -1)
    listed = own.groupBy("section").agg(F.count("*").alias("series"), F.max(last).alias("latest"))
    index = listed.agg(text(F.struct(F.array_sort(F.collect_list(F.struct("section", "series", "latest"))).alias("sections")))).select(F.lit("index").alias("document"), F.col("*")).toDF("document", "body")
    cells = panel.agg(text(F.struct(F.array_sort(F.collect_list(F.struct("entity", "metric", "periods", "values"))).alias("cells")))).select(F.lit("panel").alias("document"), F.col("*")).toDF("document", "body")
    return sections.union(index).union(cells)


#: What a reader takes from a document.
SECTION = "section string, series array<struct<tier:int,id:string,name:string,periods:array<string>,level:array<double>,yoy:array<double>,level_ytd:array<double>,yoy_ytd:array<double>>>"
INDEX = "sections array<struct<section:string,series:bigint,latest:string>>"
PANEL = "cells array<struct<entity:bigint,metric:string,periods:array<string>,values:array<double>>>"


def canonical_lines(rows: DataFrame) -> DataFrame:
    """(series_id, place, line): an observation a line, keys in fixed order, nulls left out."""
    line = F.to_json(F.struct("period", "span", "m", "m_yoy", "ytd", "ytd_yoy"))
    return rows.select("series_id", F.expr("row_number() OVER (PARTITION BY series_id ORDER BY period)").alias("place"), line.alias("line"))


def promote(live: DataFrame, staged: DataFrame, root: str) -> str:
    """Writes a new snapshot, in which series of `staged` replace theirs of `live`, into a folder of its own and returns it.

    Readers switch to it by its name, so that none sees half a snapshot and a failed write changes nothing.
    """
    kept = live.join(staged.select("series_id").distinct(), "series_id", "left_anti")
    path = f"{root}/snapshot-{uuid.uuid4().hex}"
    kept.unionByName(staged).repartition("series_id").sortWithinPartitions("series_id", "period").write.parquet(path)
    return path
