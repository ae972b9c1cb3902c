"""What is published: entries with latest, previous, direction, streak and a sentence; sections; cards and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P
from ledgerline.functions import text as X

#: Words that a sentence may not have, fixed by the editors' rules.
BANNED = ("受", "因为", "主要是", "由于", "大幅", "显著", "明显")


def verb(value_type: Column) -> Column:
    """Prices rise, everything else grows."""
    return F.when(value_type.isin("index", "mom_pct"), "上涨").otherwise("增长")


def join_text(*parts: Column) -> Column:
    """Fragments put together with a space wherever Chinese meets Latin letters or digits; null fragments are left out."""
    return X.pangu_join(F.concat_ws("", *parts))


#: Fixed: how a run of months ends a sentence, by its kind.
STREAKS = {"negative": "同比下降", "decel": "放缓", "accel": "加快", "up": "上升", "down": "下降"}


def streak_suffix(kind: Column, run: Column) -> Column:
    """，连续 3 个月放缓; nothing for runs of less than two."""
    tail = F.try_element_at(F.create_map(*(F.lit(x) for kv in STREAKS.items() for x in kv)), kind)
    months = F.when(run > 24, "24 个月以上").otherwise(F.concat(run.cast("string"), F.lit(" 个月")))
    return F.when((run >= 2) & tail.isNotNull(), F.concat(F.lit("，连续"), months, tail)).otherwise("")


def reference(shape: Column) -> Column:
    """What a sentence calls the period before."""
    return F.when(shape == "Q", "上季度").when(shape == "A", "上年").otherwise("上月")


def sentence(
    label: Column, name: Column, verb_: Column, y: Column, yp: Column, ref: Column, first_after_break: Column, merged: Column,
    streak: Column | None = None, real: Column | None = None, ytd_month: Column | None = None,
) -> Column:
    """One sentence on a rate `y` against the rate before `yp`, by their signs; `ref` names the period before.

    `streak` ends the sentence; a `real` rate makes it one on nominal and real change; where `ytd_month` isn't null the series
    has the year to date only, and the first such print of a year compares to nothing.
    """
    none = F.lit(None).cast("int")
    month = none if ytd_month is None else ytd_month
    ref = F.when(month > 2, F.concat(F.lit("1-"), (month - 1).cast("string"), F.lit(" 月"))).when(month.isNull(), ref)
    label = F.when(month.isNotNull(), F.concat(F.lit("1-"), month.cast("string"), F.lit(" 月"))).otherwise(label)
    subject = F.concat(name, F.when(month.isNotNull(), "累计").otherwise(""))
    yp = F.when(ref.isNotNull(), yp)
    word = F.when(y > 0, verb_).when(y < 0, "下降")
    said = F.concat(F.lit("同比"), word, N.fmt_pct(y))
    d, price = F.round(y - yp, 6), verb_ == "上涨"
    noun = F.when(y < 0, "降幅").when(price, "涨幅").otherwise("增速")
    more = F.when(y < 0, F.when(d > 0, "收窄").otherwise("扩大")).when(price, F.when(d > 0, "扩大").otherwise("收窄")).otherwise(F.when(d > 0, "加快").otherwise("放缓"))
    trend = F.concat(F.lit("，"), noun, F.lit("较"), ref, more, N.fmt_pp(d))
    body = (
        F.when(y == 0, F.lit("同比持平"))
        .when(yp.isNull() | (yp == 0), said)
        .when((yp > 0) & (y < 0), F.concat(F.lit("同比由升转降，下降"), N.fmt_pct(y)))
        .when((yp < 0) & (y > 0), F.concat(F.lit("同比由降转升，"), verb_, N.fmt_pct(y)))
        .when(d == 0, F.concat(said, F.lit("，与"), ref, F.lit("持平")))
        .otherwise(F.concat(said, trend))
    )
    body = F.concat(body, F.lit("") if streak is None else streak)
    if real is not None:
        way = lambda v: F.when(v >= 0, "增长").otherwise("下降")
        body = F.when(real.isNotNull(), F.concat(F.lit("同比名义"), way(y), N.fmt_pct(y), F.lit("，实际"), way(real), N.fmt_pct(real))).otherwise(body)
    suffix = F.when(merged, "（1-2 月合并统计）").otherwise("")
    first = F.concat(F.lit("口径调整后首期数据："), name, F.when(y == 0, "持平").otherwise(F.concat(word, N.fmt_pct(y))), F.lit("（与旧口径不可比）"))
    return F.when(y.isNotNull(), F.when(first_after_break, join_text(first)).otherwise(join_text(label, subject, body, suffix)))


#: Fixed: steps of a level in one direction from which a sentence counts them.
LEVEL_STREAK = 3


def level_sentence(
    label: Column, name: Column, level: Column, previous: Column, ref: Column, line: float | None = None,
    percent: Column | None = None, rate: Column | None = None, kind: Column | None = None, run: Column | None = None,
) -> Column:
    """One sentence on a level, its change, and whether it lies at a line or has crossed it, or how long it has moved one way.

    Where `percent`, the level is printed in percent. A `rate` falls (下降) by percentage points and has no line, any other level
    recedes (回落) by points. `run` steps in the direction `kind`, up or down, end the sentence from LEVEL_STREAK on.
    """
    percent, rate = (F.lit(False) if c is None else c for c in (percent, rate))
    d = F.round(level - previous, 6)
    way = F.when(d > 0, "上升").otherwise(F.when(rate, "下降").otherwise("回落"))
    change = F.when(d.isNull(), "").when(d == 0, F.concat(F.lit("，与"), ref, F.lit("持平"))).otherwise(F.concat(F.lit("，比"), ref, way, F.when(rate, N.fmt_pp(d)).otherwise(N.fmt_points(d))))
    side = tail = F.lit("")
    if line is not None:
        crossed = F.coalesce((previous >= line) != (level >= line), F.lit(False))
        side = F.when(~rate & (crossed | (F.abs(level - line) <= 0.5)), F.concat(F.lit("，位于荣枯线"), F.when(level >= line, "上方").otherwise("下方"))).otherwise("")
    if run is not None and kind is not None:
        tail = F.when(run >= LEVEL_STREAK, streak_suffix(kind, run)).otherwise("")
    return join_text(label, name, F.lit("为"), F.when(percent, N.fmt_pct(level)).otherwise(N.fmt_magnitude(level)), change, side, tail)


def banned_words(text: Column) -> Column:
    return F.filter(F.array(*map(F.lit, BANNED)), lambda w: F.contains(text, w))


def break_recent(breaks: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    """(series_id): a break took effect within the months up to a date."""
    gap = P.months_between("effective", F.lit(as_of[:7]))
    return breaks.where(gap.between(0, months)).select("series_id").distinct()


def yoy_only_slot(rows: DataFrame, slots: tuple[str, str]) -> DataFrame:
    """(series_id, slot): which of two columns holds the rate, by the last row in which either has a value; the first wins."""
    last = [F.max(F.when(F.col(s).isNotNull(), F.col("period"))).alias(f"_{k}") for k, s in enumerate(slots)]
    pick = F.when(F.col("_0").isNotNull() & (F.col("_1").isNull() | (F.col("_0") >= F.col("_1"))), slots[0]).when(F.col("_1").isNotNull(), slots[1])
    return rows.groupBy("series_id").agg(*last).select("series_id", pick.alias("slot"))


def level_only(rows: DataFrame, series: DataFrame) -> DataFrame:
    """(series_id): no rate anywhere, of a type that may have none."""
    none = rows.groupBy("series_id").agg(F.count(F.coalesce("m_yoy", "ytd_yoy")).alias("_n")).where("_n = 0")
    return none.join(series.where(F.col("value_type").isin("index", "ratio", "rate_pct", "level")), "series_id", "left_semi").select("series_id")


def diary(entries: DataFrame, snapshot: DataFrame, revised: DataFrame | None = None) -> DataFrame:
    """What changed since the run before: (series_id, before, period, kind, line).

    Entries whose period is not that of the snapshot, and periods in which cells (series_id, period, ...) were `revised` since.
    """
    before = snapshot.select("series_id", F.col("period").alias("before"))
    rows = entries.join(before, "series_id", "left").where(~F.col("period").eqNullSafe(F.col("before")))
    kind = F.when(F.col("before").isNull(), "new").otherwise("advanced")
    line = F.concat("series_id", F.lit(": "), F.coalesce(F.concat("before", F.lit(" → ")), F.lit("")), "period")
    out = rows.select("series_id", "before", "period", kind.alias("kind"), line.alias("line"))
    if revised is None:
        return out
    n = revised.groupBy("series_id", "period").agg(F.count("*").cast("string").alias("_n"))
    return out.union(n.select("series_id", "period", "period", F.lit("revised"), F.concat("series_id", F.lit(": "), "period", F.lit(" ("), "_n", F.lit(")"))))


def city_rows(panel: DataFrame, primary: str, secondary: str, many: int = 24) -> DataFrame:
    """(entity, cells, latest, second, points, since): the last `many` periods of one metric, the last values of it and of another."""
    wide = panel.where(F.col("metric").isin(primary, secondary)).groupBy("entity", "period").pivot("metric", [primary, secondary]).agg(F.max("m")).toDF("entity", "period", "_a", "_b")
    rows = wide.withColumn("_n", F.row_number().over(Window.partitionBy("entity").orderBy(F.col("period").desc()))).where(F.col("_n") <= many)
    at_end = lambda c: F.max(F.when(F.col("_n") == 1, F.col(c)))
    cells = F.array_sort(F.collect_list(F.struct("period", F.col("_a").alias("m"))))
    return rows.groupBy("entity").agg(cells.alias("cells"), at_end("_a").alias("latest"), at_end("_b").alias("second"), F.count("_a").alias("points"), F.min("period").alias("since"))


def shared_axis(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, low, high, step): one axis for all members, ends on round marks and zero included."""
    ends = rows.groupBy(group).agg(F.least(F.min(value), F.lit(0.0)).alias("_lo"), F.greatest(F.max(value), F.lit(0.0)).alias("_hi"))
    ends = ends.withColumn("step", N.nice_step(F.col("_lo"), F.col("_hi")))
    return ends.select(group, (F.floor(F.col("_lo") / F.col("step")) * F.col("step")).alias("low"), (F.ceil(F.col("_hi") / F.col("step")) * F.col("step")).alias("high"), "step")


def gap_segments(rows: DataFrame, value: str) -> DataFrame:
    """(series_id, segment, first, last, n): runs of rows with a value; a null ends one."""
    w = Window.partitionBy("series_id").orderBy("period")
    rows = rows.withColumn("_s", F.sum(F.when(F.col(value).isNull(), 1).otherwise(0)).over(w)).where(F.col(value).isNotNull())
    runs = rows.groupBy("series_id", "_s").agg(F.min("period").alias("first"), F.max("period").alias("last"), F.count("*").alias("n"))
    return runs.withColumn("segment", F.row_number().over(Window.partitionBy("series_id").orderBy("first"))).drop("_s")


def footnotes(marks: DataFrame, first: str, last: str) -> DataFrame:
    """Numbers marks (series_id, period, text) within a range in order of time."""
    w = Window.partitionBy("series_id").orderBy("period", "text")
    return marks.where(F.col("period").between(first, last)).withColumn("number", F.row_number().over(w))
