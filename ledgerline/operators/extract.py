"""Statistics from the text and tables of release pages; a page is a row (page_id, url, html)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import text as X


def items(pages: DataFrame, tag: str) -> DataFrame:
    """(page_id, place, text): the contents of every element of a tag, in order."""
    pattern = rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("place", "raw"))
    return rows.select("page_id", "place", X.strip_html(F.col("raw")).alias("text"))


def table_rows(pages: DataFrame) -> DataFrame:
    """(page_id, row, cell, text): the cells of all tables, in order."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "raw"))
    cells = rows.select("page_id", "row", F.posexplode(F.regexp_extract_all("raw", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))).alias("cell", "c"))
    return cells.select("page_id", "row", "cell", X.strip_html(F.col("c")).alias("text"))


def measured_rows(cells: DataFrame, headers: DataFrame, required: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers of tables whose first row names measures: (page_id, label, measure, value), and required labels that are missing.

    `headers` is (text, measure), `required` (label).
    """
    head = cells.where("row = 0").join(headers, "text").select("page_id", "cell", "measure")
    label = cells.where("row > 0 AND cell = 0").select("page_id", "row", F.col("text").alias("label"))
    body = cells.where("row > 0 AND cell > 0").join(head, ["page_id", "cell"]).join(label, ["page_id", "row"])
    out = body.select("page_id", "label", "measure", F.regexp_replace("text", ",", "").try_cast("double").alias("value"))
    wanted = cells.select("page_id").distinct().join(required.withColumn("_k", F.lit(1)), F.lit(1) == F.col("_k")).select("page_id", "label")
    return out, wanted.join(out.select("page_id", "label").distinct(), ["page_id", "label"], "left_anti")


def city_tables(pages: DataFrame, least: int = 60, most: int = 70) -> DataFrame:
    """(page_id, table, nth, city, mom, yoy): rows of tables of index numbers, whatever their headers span.

    A cell that is no number, followed by three numbers of which the first lies within 70 and 130 and the second within 50 and
    150, is a city with its indices on the month and the year before. Of a city the first counts; a table of fewer than `least` is
    none, of a longer one the first `most` count.
    """
    tables = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<table[^>]*>(.*?)</table>"), F.lit(1))).alias("table", "raw"))
    cells = tables.select("page_id", "table", F.posexplode(F.regexp_extract_all("raw", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))).alias("place", "c"))
    text = F.regexp_replace(X.strip_html(F.col("c")), r"\s+", "")
    bare = F.replace(F.col("t"), F.lit(","), F.lit(""))
    cells = cells.select("page_id", "table", "place", text.alias("t")).withColumn("v", F.when(bare.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), bare.cast("double")))
    order = Window.partitionBy("page_id", "table").orderBy("place")
    rows = cells.withColumns({name: F.lead("v", k).over(order) for k, name in ((1, "mom"), (2, "yoy"), (3, "avg"))})
    rows = rows.where((F.col("t") != "") & F.col("v").isNull() & F.col("mom").between(70, 130) & F.col("yoy").between(50, 150) & F.col("avg").isNotNull())
    first = rows.groupBy("page_id", "table", F.col("t").alias("city")).agg(F.min("place").alias("place"), F.min_by(F.struct("mom", "yoy"), "place").alias("e"))
    nth = first.withColumns({"nth": F.row_number().over(order) - 1, "_n": F.count("*").over(Window.partitionBy("page_id", "table"))})
    return nth.where((F.col("_n") >= least) & (F.col("nth") < most)).select("page_id", "table", "nth", "city", "e.mom", "e.yoy")


def places(texts: DataFrame, pattern: str, *keep: str) -> DataFrame:
    """(page_id, *keep, nth, at, match): every match of a pattern in texts (page_id, text, *keep), with where it begins, from 1; page and *keep are unique."""
    zipped = F.arrays_zip(F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("match"))
    rows = texts.select("page_id", *keep, F.posexplode(zipped).alias("nth", "z")).where("z.match IS NOT NULL")
    # The text up to the end of a match is all gaps and matches so far.
    so_far = Window.partitionBy("page_id", *keep).orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.char_length("z.gap") + F.char_length("z.match")).over(so_far)
    return rows.select("page_id", *keep, "nth", (end - F.char_length("z.match") + 1).cast("int").alias("at"), F.col("z.match").alias("match"))


def last_before(hits: DataFrame, marks: DataFrame) -> DataFrame:
    """Hits (page_id, at, ...) with `mark`, the match of the last mark (page_id, at, match) that ends before them: both are sorted together once."""
    ends = marks.select("page_id", (F.col("at") + F.char_length("match")).alias("_at"), F.lit(0).alias("_kind"), F.col("match").alias("_mark"))
    both = hits.withColumns({"_at": F.col("at"), "_kind": F.lit(1)}).unionByName(ends, allowMissingColumns=True)
    so_far = Window.partitionBy("page_id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("mark", F.last("_mark", ignorenulls=True).over(so_far)).where("_kind = 1").select(*hits.columns, "mark")


#: Fixed: what opens a group of sentences on one month, and on the year so far.
MONTH_MARK, YEAR_MARK = r"[0-9]{1,2}月份，", r"1[—\-－~至][0-9]{1,2}月，|上半年，|一季度，|前三季度，|[0-9]{4}年，"


def statistic(label: str, unit: str) -> str:
    """The pattern of a sentence on an amount and its rate: groups are the word for the year so far, the amount, the direction and the rate."""
    aside = r"(?:（[^）]*）)?"
    return rf"其中[，,、]?{label}{aside}(累计)?完成([0-9,.]+){unit}{aside}，同比(增长|下降)([0-9,.]+)%"


def prose(texts: DataFrame, fields: tuple[tuple[str, str], ...]) -> DataFrame:
    """(page_id, field, measure, value, place): amounts and rates of all sentences of texts (page_id, text) on fields (label, unit).

    A sentence is on the year so far if it says so, else on what the last mark before it says, and on nothing known if there is none: then it is
    left out. Of a field and measure the first sentence of a page counts.
    """
    number = lambda c: F.replace(c, F.lit(","), F.lit("")).try_cast("double")
    hits = None
    for label, unit in fields:
        found = places(texts, statistic(label, unit)).withColumn("field", F.lit(label))
        hits = found if hits is None else hits.union(found)
    rows = last_before(hits, places(texts, f"{MONTH_MARK}|{YEAR_MARK}"))
    group = lambda k: F.regexp_extract("match", statistic("[^（，完]+?", "[^（，0-9]+?"), k)
    caliber = F.when(group(1) != "", "ytd").when(F.col("mark").rlike(f"^(?:{MONTH_MARK})$"), "m").when(F.col("mark").isNotNull(), "ytd")
    rows = rows.withColumn("caliber", caliber).where("caliber IS NOT NULL")
    first = rows.groupBy("page_id", "field", "caliber").agg(F.min_by("match", "at").alias("match"), F.min("at").alias("place"))
    sign = F.when(group(3) == "下降", -1.0).otherwise(1.0)
    both = F.array(F.struct(F.col("caliber").alias("measure"), number(group(2)).alias("value")), F.struct(F.concat("caliber", F.lit("_yoy")).alias("measure"), (sign * number(group(4))).alias("value")))
    return first.select("page_id", "field", "place", F.inline(both))


def nearest_marker(texts: DataFrame, target: str, markers: tuple[tuple[str, str], ...]) -> DataFrame:
    """(page_id, nth, kind): of every place of a target the kind of the last marker before it; null if none stands before."""
    quoted = lambda t: "\\Q" + t + "\\E"
    kinds = F.create_map(*(F.lit(x) for m in markers for x in m))
    marks = places(texts, "|".join(quoted(m) for m, _ in sorted(markers, key=lambda m: -len(m[0]))))
    return last_before(places(texts, quoted(target)), marks).select("page_id", "nth", F.try_element_at(kinds, F.col("mark")).alias("kind"))


def links(pages: DataFrame, pattern: str, reject: str, hosts: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, href, title): anchors whose title fits, without those that fit `reject`; an address once a page.

    Addresses are made whole from the page's own (url), if there is one; with `hosts` only those of one of them or below it are taken.
    """
    base = ["url"] if "url" in pages.columns else []
    rows = pages.select("page_id", *base, F.posexplode(F.regexp_extract_all("html", F.lit(r'(?is)<a[^>]*href="([^"]*)"[^>]*>.*?</a>'), F.lit(0))).alias("place", "a"))
    href = F.regexp_extract("a", r'href="([^"]*)"', 1)
    if base:
        site = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
        folder = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "(?<=[^/:])/[^/]*$", "")
        href = F.when(href.rlike("^[a-z]+:"), href).when(href.startswith("//"), F.concat(F.lit("http:"), href)).when(href.startswith("/"), F.concat(site, href)).otherwise(F.concat(folder, F.lit("/"), href))
    rows = rows.select("page_id", "place", href.alias("href"), X.strip_html(F.col("a")).alias("title"))
    if hosts:
        host = F.lower(F.regexp_extract("href", "^https?://([^/:?#]+)", 1))
        near = F.lit(False)
        for h in hosts:
            near = near | (host == h) | host.endswith(f".{h}")
        rows = rows.where(near)
    first = F.row_number().over(Window.partitionBy("page_id", "href").orderBy("place"))
    return rows.where(F.col("title").rlike(pattern) & ~F.col("title").rlike(reject)).withColumn("_n", first).where("_n = 1").select("page_id", "href", "title")


def mirror(rows: DataFrame, source: str = "ytd", target: str = "m") -> DataFrame:
    """Long rows with a `target` row for every merged print's `source` that has none."""
    have = rows.where(F.col("measure") == target).select("series_id", "period")
    add = rows.where((F.col("measure") == source) & (F.col("span") == 2)).join(have, ["series_id", "period"], "left_anti").withColumn("measure", F.lit(target))
    return rows.unionByName(add)
