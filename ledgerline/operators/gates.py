"""Checks before data is accepted. Each takes tables and returns findings (check_id, severity, series_id, period).

All work on every series at once; a check of new rows joins them to what it needs of the history, never the history to itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P
from ledgerline.operators import breaks as B
from ledgerline.operators import merge as G
from ledgerline.operators import series as S

FINDING = ["check_id", "severity", "series_id", "period"]


def findings(rows: DataFrame, check: str, severity: Column | str, condition: Column | None = None) -> DataFrame:
    rows = rows if condition is None else rows.where(condition)
    return rows.select(F.lit(check).alias("check_id"), (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), "series_id", "period")


def acknowledged(found: DataFrame, known: tuple[tuple, ...]) -> DataFrame:
    """Blocking findings that a configured exception (series, period, check, note) fits warn instead; null stands for any."""
    rows = G.known_exceptions(found, known)
    return rows.withColumn("severity", F.when(F.col("known"), "WARN").otherwise(F.col("severity"))).select(*FINDING)


def schema_of_lines(lines: DataFrame, required: tuple[str, ...], kinds: dict[str, str], choices: dict[str, tuple], limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Raw objects (series_id, period, line) against their form: one finding `schema.<rule>` for each rule that is broken.

    `kinds` gives the fields there may be, as number or text; null counts as absent. A line that is no object breaks `object`.
    """
    v = F.try_parse_json("line")
    at = {k: F.try_variant_get(v, f"$.{k}", "variant") for k in kinds}
    there = {k: c.isNotNull() & ~F.is_variant_null(c) for k, c in at.items()}
    number = lambda k: F.schema_of_variant(at[k]).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    text = lambda k: F.schema_of_variant(at[k]) == "STRING"
    any_of = lambda tests: sum((F.when(t, 1).otherwise(0) for t in tests), F.lit(0)) > 0
    keys = F.json_object_keys("line")
    rules = {
        "object": keys.isNull(),
        "required": keys.isNotNull() & any_of(~there[k] for k in required),
        "unknown": F.exists(keys, lambda k: ~k.isin(*kinds)),
        "type": any_of(there[k] & ~(number(k) if kind == "number" else text(k)) for k, kind in kinds.items()),
        "choice": any_of(there[k] & ~F.coalesce(F.try_variant_get(v, f"$.{k}", "string").isin(*map(str, c)), F.lit(False)) for k, c in choices.items()),
        "limits": any_of(~F.try_variant_get(v, f"$.{k}", "double").between(*ends) for k, ends in limits.items()),
        "period": there["period"] & text("period") & P.period_shape(F.try_variant_get(v, "$.period", "string")).isNull(),
    }
    broken = F.array_compact(F.array(*(F.when(r, F.lit(f"schema.{name}")) for name, r in rules.items())))
    return lines.select("series_id", "period", F.explode(broken).alias("check_id")).select("check_id", F.lit("BLOCK").alias("severity"), "series_id", "period")


def schema(rows: DataFrame) -> DataFrame:
    """A period of no known form, a span that isn't 1 or 2, or a row without a series."""
    bad = P.period_shape("period").isNull() | ~F.coalesce(F.col("span").isin(1, 2), F.lit(False)) | F.col("series_id").isNull()
    return findings(rows, "schema", "BLOCK", bad)


def allowed_measures(value_type: Column, calibers: Column) -> Column:
    """The measures that a series may carry, by its type and calibers; real_yoy always."""
    single, ytd = F.array_contains(calibers, "single"), F.array_contains(calibers, "ytd")
    parts = F.concat(F.when(single, F.array(F.lit("m"), F.lit("m_yoy"))).otherwise(F.array().cast("array<string>")), F.when(ytd, F.array(F.lit("ytd"), F.lit("ytd_yoy"))).otherwise(F.array().cast("array<string>")))
    return F.array_union(F.array_union(parts, F.array(F.lit("real_yoy"))), F.when(value_type == "index", F.array(F.lit("mom"), F.lit("ytd_yoy"))).otherwise(F.array().cast("array<string>")))


def caliber(cells: DataFrame, series: DataFrame) -> DataFrame:
    """Cells (series_id, period, measure) whose measure the series (value_type, calibers) doesn't declare."""
    rows = cells.join(series.select("series_id", "value_type", "calibers"), "series_id")
    return findings(rows, "caliber", "BLOCK", ~F.array_contains(allowed_measures(F.col("value_type"), F.col("calibers")), F.col("measure")))


def bounds(rows: DataFrame, band: tuple[float, float] = (-80.0, 300.0)) -> DataFrame:
    """Values that their type (`value_type`, level if there is none) can't have.

    Counts are whole and not negative, levels not negative, rates in percent and ratios within 0 and 100, monthly changes
    within 25 either way; rates on the year of indices, levels and ratios lie within the band.
    """
    kind = F.col("value_type") if "value_type" in rows.columns else F.lit("level")
    m = F.col("m")
    share = F.when(kind == "ratio", F.coalesce(m, F.col("ytd") if "ytd" in rows.columns else m)).when(kind == "rate_pct", m)
    rates = [F.coalesce(~F.col(c).between(*band), F.lit(False)) for c in ("m_yoy", "ytd_yoy") if c in rows.columns]
    off = [
        (kind == "count") & ((m < 0) | (F.abs(m - F.round(m)) > 1e-6)), (kind == "level") & (m < 0), ~share.between(0, 100), (kind == "mom_pct") & ~m.between(-25, 25),
        *(kind.isin("index", "level", "ratio") & r for r in rates),
    ]
    wrong = F.lit(False)
    for o in off:
        wrong = wrong | F.coalesce(o, F.lit(False))
    return findings(rows, "bounds", "BLOCK", wrong)


def monotonic(rows: DataFrame, joint_from: str | None = None) -> DataFrame:
    """Periods that don't rise along `place`, stand twice, aren't of the series' own frequency (`freq`, if there is one), or whose span and month don't fit.

    A span of 2 stands at February only; from `joint_from` on, a February has no other and a January none at all.
    """
    last = F.lag("period").over(Window.partitionBy("series_id").orderBy("place"))
    rows = rows.withColumn("_last", last)
    off = (F.col("_last") >= F.col("period")) | ((F.col("span") == 2) & ~F.col("period").endswith("-02"))
    if joint_from is not None:
        off = off | ((F.col("period") >= joint_from) & ((F.col("period").endswith("-02") & (F.col("span") != 2)) | F.col("period").endswith("-01")))
    if "freq" in rows.columns:
        off = off | (P.period_shape("period") != F.col("freq"))
    return findings(rows, "monotonic", "BLOCK", off)


def unit_slip(touched: DataFrame, history: DataFrame, factor: float = 100.0) -> DataFrame:
    """Single-month levels a hundred times above or below the median of the twelve before."""
    rows = S.trailing_median(history).join(touched.select("series_id", "period"), ["series_id", "period"], "left_semi")
    ratio = F.abs(F.col("m")) / F.col("median")
    return findings(rows, "unit_slip", "BLOCK", (F.col("median") > 0) & (F.col("m") != 0) & ((ratio >= factor) | (ratio <= 1 / factor)))


def seasonal_z(
    touched: DataFrame, past: DataFrame, rows: DataFrame, shocks: tuple[str, ...] = (), confirmed: DataFrame | None = None,
    least: dict[str, int] | None = None, warn: float = 4.0, block: float = 7.0,
) -> DataFrame:
    """Touched rows far from what their series did before; only series of `least` rows or more by frequency (24 months, 8 quarters).

    Rates are held against the median of the rates before: `past` has (series_id, at, m_yoy) for each touched period `at`.
    Where there is no such rate, the change on the same season's row before is held against such changes before (`cohort_z`).
    A value that another source confirms (series_id, period) warns at most.
    """
    many = F.lit(None).cast("int")
    for shape, n in (least or {"M": 24, "Q": 8}).items():
        many = F.when(P.period_shape_loose(F.col("_last")) == shape, n).otherwise(many)
    enough = rows.groupBy("series_id").agg(F.count("*").alias("_rows"), F.max("period").alias("_last")).where(F.col("_rows") >= F.coalesce(many, F.lit(0)))
    touched = touched.join(enough.select("series_id"), "series_id", "left_semi")
    mid = past.groupBy("series_id", "at").agg(F.percentile("m_yoy", F.lit(0.5)).alias("_med"))
    mad = past.join(mid, ["series_id", "at"]).groupBy("series_id", "at").agg(F.percentile(F.abs(F.col("m_yoy") - F.col("_med")), F.lit(0.5)).alias("_mad"), F.first("_med").alias("_med"))
    both = touched.join(mad.withColumnRenamed("at", "period"), ["series_id", "period"], "left")
    judged = F.col("m_yoy").isNotNull() & F.col("_med").isNotNull()
    by_rate = both.where(judged).select("series_id", "period", N.robust_z(F.col("m_yoy"), F.col("_med"), F.col("_mad")).alias("z"))
    z = by_rate.union(cohort_z(both.where(~judged), rows.where(~F.col("period").isin(*shocks)) if shocks else rows)).withColumn("z", F.abs("z"))
    top = F.when(F.col("z") >= block, "BLOCK").otherwise("WARN")
    if confirmed is not None:
        z = z.join(confirmed.select("series_id", "period", F.lit(True).alias("_sure")).distinct(), ["series_id", "period"], "left")
        top = F.when(F.col("_sure"), "WARN").otherwise(top)
    return findings(z, "seasonal_z", top, F.col("z") >= warn)


def cohort_z(touched: DataFrame, rows: DataFrame, least: int = 4) -> DataFrame:
    """(series_id, period, z) of the change on the same season before (month, quarter or merged print), among `least` such changes or more.

    Changes are of logarithms for levels, indices and counts that are all positive, else differences. A season of a series
    has one row a year, so that its array stays small.
    """
    kind = F.col("value_type") if "value_type" in rows.columns else F.lit("level")
    level, season = F.coalesce("m", "ytd"), P.cohort_key("period", F.col("span"))
    now = touched.where(level.isNotNull()).select("series_id", "period", season.alias("_season"), level.alias("_now"))
    before = rows.where(level.isNotNull()).select("series_id", season.alias("_season"), F.col("period").alias("_p"), level.alias("_v"), kind.alias("_kind"))
    met = now.where("_season <> 'A'").join(before, ["series_id", "_season"]).where("_p < period")
    runs = met.groupBy("series_id", "period", "_now").agg(F.array_sort(F.collect_list(F.struct("_p", "_v"))).alias("_run"), F.first("_kind").alias("_kind")).where(F.size("_run") > least)
    logs = F.col("_kind").isin("level", "index", "count") & (F.col("_now") > 0) & F.forall("_run", lambda r: r["_v"] > 0)
    scale = lambda v: F.when(F.col("_logs"), F.log(v)).otherwise(v)
    runs = runs.withColumn("_logs", logs).withColumn("_run", F.transform("_run", lambda r: scale(r["_v"]))).withColumn("_change", scale(F.col("_now")) - F.element_at("_run", -1))
    steps = F.zip_with(F.slice("_run", 2, F.size("_run") - 1), F.slice("_run", 1, F.size("_run") - 1), lambda b, a: b - a)
    runs = runs.withColumn("_steps", steps).withColumn("_med", _middle(F.col("_steps")))
    runs = runs.withColumn("_mad", _middle(F.transform("_steps", lambda s: F.abs(s - F.col("_med")))))
    return runs.select("series_id", "period", N.robust_z(F.col("_change"), F.col("_med"), F.col("_mad")).alias("z"))


def _middle(values: Column) -> Column:
    """The median of a small array."""
    v, n = F.array_sort(values), F.size(values)
    at = lambda k: F.element_at(v, k.cast("int"))
    return (at(F.floor((n + 1) / 2)) + at(F.ceil((n + 1) / 2))) / 2


def ytd_arithmetic(rows: DataFrame, batch: DataFrame, decimals: int = 1) -> DataFrame:
    """ytd isn't the ytd before plus the period's own; a merged print isn't its own ytd. BLOCK if the batch has both periods.

    Only levels and counts add up (`value_type`, if there is one); the slack is two units of the last place of the series (`decimals`, if
    there is such a column) or half a percent.
    """
    if "value_type" in rows.columns:
        rows = rows.where("value_type IN ('level', 'count')")
    places = F.col("decimals") if "decimals" in rows.columns else F.lit(decimals)
    mark = batch.select("series_id", "period", F.lit(True).alias("_in"))
    rows = S.prior_period(rows.join(mark, ["series_id", "period"], "left"), {"ytd": "_b", "_in": "_pin"})
    slack = F.greatest(2 * F.pow(F.lit(10.0), -places), F.abs("ytd") * 0.005)
    want = F.when(F.col("span") == 2, F.col("m")).otherwise(F.col("_b") + F.col("m"))
    off = F.abs(F.col("ytd") - want) > slack
    return findings(rows.where("_in"), "ytd_arithmetic", F.when(F.coalesce("_pin", F.lit(False)) | (F.col("span") == 2), "BLOCK").otherwise("WARN"), off)


def yoy_base(rows: DataFrame, breaks: DataFrame, points: float = 3.0, share: float = 50.0) -> DataFrame:
    """Published rates against those that the levels give, for single months and the year to date: WARN beyond some points, BLOCK if the implied base is far off.

    Only levels (`value_type`, if there is one) have such a base; a base of 0 or a rate of -100 blocks.
    """
    if "value_type" in rows.columns:
        rows = rows.where("value_type = 'level'")
    pairs = [(v, r) for v, r in (("m", "m_yoy"), ("ytd", "ytd_yoy")) if {v, r} <= set(rows.columns)]
    rows = S.year_ago(rows, {v: f"_{v}" for v, _ in pairs})
    rows = B.seam_between(rows.withColumn("_ago", P.year_ago_period("period")), breaks, "_ago").where("NOT seam")
    each = F.array(*(F.struct(F.col(v).alias("v"), F.col(f"_{v}").alias("base"), F.col(r).alias("rate")) for v, r in pairs))
    cells = rows.select("series_id", "period", F.inline(each)).where("v IS NOT NULL AND base IS NOT NULL AND rate IS NOT NULL")
    implied = F.try_divide(F.col("v"), 1 + F.col("rate") / 100)
    block = implied.isNull() | (F.col("base") == 0) | (F.abs(implied - F.col("base")) > F.abs("base") * share / 100)
    gap = F.abs(F.col("rate") - (F.try_divide(F.col("v"), F.col("base")) - 1) * 100)
    return findings(cells, "yoy_base", F.when(block, "BLOCK").otherwise("WARN"), block | (gap > points))


def sum_of_parts(totals: DataFrame, summed: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Totals (series_id, period, m) that differ from the sum of their parts (total, period, summed)."""
    rows = totals.join(summed.withColumnRenamed("total", "series_id"), ["series_id", "period"])
    return findings(rows, "sum_of_parts", "WARN", N.rel_diff(F.col("m"), F.col("summed")) > tolerance)


def envelope(heads: DataFrame, items: DataFrame, slack: float = 0.05) -> DataFrame:
    """Headline rates outside the range of their items (head, period, m_yoy), of two items or more."""
    span = items.groupBy(F.col("head").alias("series_id"), "period").agg(F.min("m_yoy").alias("_lo"), F.max("m_yoy").alias("_hi"), F.count("m_yoy").alias("_n")).where("_n >= 2")
    rows = heads.join(span, ["series_id", "period"])
    return findings(rows, "envelope", "WARN", (F.col("m_yoy") < F.col("_lo") - slack) | (F.col("m_yoy") > F.col("_hi") + slack))


def share_bounds(parts: DataFrame, wholes: DataFrame) -> DataFrame:
    """Parts (series_id, period, m) above their whole (period, whole), and published shares (`share`, if there are) outside 0 and 100."""
    rows = parts.join(wholes, "period")
    ratio = F.coalesce(~F.col("share").between(0, 100), F.lit(False)) if "share" in rows.columns else F.lit(False)
    return findings(rows, "share_bounds", "WARN", (F.col("m") > F.col("whole") * 1.001) | ratio)


def calendar_step(new: DataFrame, latest: DataFrame, known: tuple[tuple, ...] = ()) -> DataFrame:
    """How far a new period lies beyond the last on file: one step is right, two WARN, any other BLOCK unless it is known."""
    rows = new.join(latest.withColumnRenamed("period", "_last"), "series_id").withColumn("_n", P.steps_between("_last", "period"))
    return acknowledged(findings(rows, "calendar_step", F.when(F.col("_n") == 2, "WARN").otherwise("BLOCK"), F.col("_n") != 1), known)


def release_window(releases: DataFrame, grace: int = 3) -> DataFrame:
    """Releases (series_id, period, day, low, high) on a day of the month outside their window."""
    return findings(releases, "release_window", "WARN", ~F.col("day").between(F.col("low") - grace, F.col("high") + grace))


def release_calendar(releases: DataFrame, rules: DataFrame, grace: int = 3) -> DataFrame:
    """Releases (series_id, source, period, released) outside the window that the calendar gives their source for that period.

    `rules` are (source, freq, low, high, lag, skips): the days of the month `lag` months after the period's end, cut to that
    month; `skips` are months, as 01, in which a source prints nothing by itself. Sources without a rule, and periods of another frequency or that are
    skipped, have no window.
    """
    rows = releases.join(rules, "source").where(P.period_shape_loose("period") == F.col("freq")).where(~F.array_contains("skips", F.substring("period", 6, 2)))
    first = F.add_months(F.trunc(P.period_end_date("period"), "month"), F.col("lag"))
    cut = lambda d: F.least(F.date_add(first, d - 1), F.last_day(first))
    day = F.col("released").cast("date")
    return findings(rows, "release_window", "WARN", ~day.between(F.date_add(cut(F.col("low")), -grace), F.date_add(cut(F.col("high")), grace)))


def completeness(seen: DataFrame, anchors: DataFrame) -> DataFrame:
    """Groups of anchors (release, group, field) of which a release (release, field) has none: (check_id, severity, release, group)."""
    hits = anchors.join(seen.select("release", "field").distinct().withColumn("_hit", F.lit(1)), ["release", "field"], "left")
    return hits.groupBy("release", "group").agg(F.sum(F.coalesce("_hit", F.lit(0))).alias("_n")).where("_n = 0").select(F.lit("completeness").alias("check_id"), F.lit("BLOCK").alias("severity"), "release", "group")


def release_identity(new: DataFrame, manifests: DataFrame, captures: DataFrame, stale: DataFrame, corroborated: DataFrame | None = None) -> DataFrame:
    """New rows (series_id, period, release) whose release can't be shown, and rows that repeat the one before.

    A release is shown by a manifest (release, capture) all of whose captures are on file (capture). A repeated row of a
    release that is shown passes if every measure of it is confirmed: `corroborated` has (series_id, period, measure, value).
    """
    absent = manifests.join(captures.select("capture"), "capture", "left_anti").select("release").distinct()
    shown = manifests.select("release").distinct().join(absent, "release", "left_anti")
    lost = findings(new.join(shown, "release", "left_anti"), "release_identity", "BLOCK")
    again = new.join(shown, "release", "left_semi").join(stale, ["series_id", "period"]).select("series_id", "period", *(c for c in ("m", "ytd", "m_yoy", "ytd_yoy") if c in stale.columns))
    if corroborated is not None:
        measures = again.columns[2:]
        cells = again.unpivot(["series_id", "period"], measures, "measure", "value").where("value IS NOT NULL")
        doubt = cells.join(corroborated.select("series_id", "period", "measure", "value"), ["series_id", "period", "measure", "value"], "left_anti")
        again = again.join(doubt.select("series_id", "period"), ["series_id", "period"], "left_semi")
    return lost.union(findings(again, "stale_reserve", "BLOCK"))


def revision_flood(revisions: DataFrame, rows: DataFrame, panels: DataFrame, known: tuple[tuple, ...] = (), most: int = 6, share: float = 0.1, periods: int = 3) -> DataFrame:
    """Series that a release revises too much, at their last period: more than `most` cells or a share of their rows; panels (series_id): more than some periods."""
    own = G.flood(revisions.join(panels, "series_id", "left_anti"), rows, most, share).select("series_id")
    wide = revisions.join(panels, "series_id", "left_semi").groupBy("series_id").agg(F.countDistinct("period").alias("_n")).where(F.col("_n") > periods).select("series_id")
    last = rows.groupBy("series_id").agg(F.max("period").alias("period"))
    return acknowledged(findings(own.union(wide).join(last, "series_id"), "revision_flood", "BLOCK"), known)


#: Fixed: restated rows that a window without rates has to hold before rates resume, by frequency.
RESTATED = {"M": 12, "Q": 4, "A": 1}


def break_no_yoy(rows: DataFrame, breaks: DataFrame, restated: dict[str, int] | None = None) -> DataFrame:
    """Rates inside a window without rates; windows that end before they begin; rates at the end of one with fewer restated rows than a year has."""
    inside = findings(B.blocked_by_sweep(rows, breaks), "break_no_yoy", "BLOCK", F.col("blocked") & F.col("m_yoy").isNotNull())
    turned = findings(breaks.withColumn("period", F.col("effective")), "break_window", "BLOCK", F.col("yoy_valid_from") < F.col("effective"))
    ends = breaks.where("no_yoy_across AND yoy_valid_from > effective").select("series_id", "effective", F.col("yoy_valid_from").alias("period"))
    resumed = ends.join(rows.where("m_yoy IS NOT NULL").select("series_id", "period"), ["series_id", "period"], "left_semi")
    need = F.lit(None).cast("int")
    for shape, n in (restated or RESTATED).items():
        need = F.when(P.period_shape_loose(F.col("period")) == shape, n).otherwise(need)
    thin = B.rows_within(resumed, rows, "effective", "period", "_n")
    return inside.union(turned).union(findings(thin, "break_restated", "BLOCK", F.col("_n") < need).distinct())


def catalog(rows: DataFrame, declared: DataFrame, facts: DataFrame | None = None, fields: DataFrame | None = None, orphans: tuple[str, ...] = ()) -> DataFrame:
    """Series without a catalog entry (unless known as orphans) or unlike it, entries without data, and fields that map to no series.

    `facts` has what the series say of themselves, in columns that the catalog has too (value_type, section, ...); `fields` has
    (field, series_id) as a release carries them, series_id null where none fits; such a field is named in `series_id`.
    """
    ids = rows.groupBy("series_id").agg(F.max("period").alias("period"))
    stray = findings(ids.where(~F.col("series_id").isin(*orphans)).join(declared, "series_id", "left_anti"), "catalog", "BLOCK")
    empty = declared.join(ids, "series_id", "left_anti").withColumn("period", F.lit(None).cast("string"))
    found = stray.union(findings(empty, "catalog", "WARN"))
    if facts is not None:
        names = [c for c in facts.columns if c != "series_id" and c in declared.columns]
        both = facts.select("series_id", *(F.col(c).alias(f"_{c}") for c in names)).join(declared, "series_id").join(ids, "series_id", "left")
        off = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"catalog.{c}")) for c in names)))
        unlike = both.select("series_id", "period", F.explode(off).alias("check_id"))
        found = found.union(unlike.select("check_id", F.lit("BLOCK").alias("severity"), "series_id", "period"))
    if fields is not None:
        loose = fields.where("series_id IS NULL").select(F.col("field").alias("series_id"), F.lit(None).cast("string").alias("period")).distinct()
        found = found.union(findings(loose, "catalog.field", "WARN"))
    return found


@dataclass(frozen=True)
class Context:
    """What the checks hold a release against; a check whose table is missing isn't run."""

    #: (series_id, value_type, calibers, section)
    catalog: DataFrame
    breaks: DataFrame
    today: str
    #: Periods whose values are out of the ordinary for all.
    shocks: tuple[str, ...] = ()
    known: tuple[tuple, ...] = ()
    #: (cell, value) of a second source.
    second: DataFrame | None = None
    #: (first_id, second_id, tol); (total, series_id); (head, series_id); (series_id, whole_id).
    pairs: DataFrame | None = None
    parts: DataFrame | None = None
    heads: DataFrame | None = None
    wholes: DataFrame | None = None
    #: (series_id, day, low, high) of the release; (release, group, field) of what it must have, and (release, field) of what it has.
    window: DataFrame | None = None
    anchors: DataFrame | None = None
    fields: DataFrame | None = None
    #: (series_id, release); (release, capture); (capture).
    releases: DataFrame | None = None
    manifests: DataFrame | None = None
    captures: DataFrame | None = None
    #: (series_id): those whose revisions count by period; (series_id, ended).
    panels: DataFrame | None = None
    ended: DataFrame | None = None
    orphans: tuple[str, ...] = ()
    joint_from: str | None = None


MEASURES = ["m", "ytd", "m_yoy", "ytd_yoy"]


def wide(cells: DataFrame) -> DataFrame:
    """(series_id, period, span, m, ytd, m_yoy, ytd_yoy) of cells, of which those of measure `span` give the span, else 1."""
    rows = cells.groupBy("series_id", "period").pivot("measure", ["span", *MEASURES]).agg(F.max("value"))
    return rows.withColumn("span", F.coalesce("span", F.lit(1)).cast("int"))


def all_checks(now: DataFrame, rows: DataFrame, before: DataFrame, log: DataFrame, c: Context, held: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Findings of every check on a release: cells after it, its rows, the cells before it, and its log of changes.

    All checks but those on whole series report only what the release touches. Known exceptions warn.
    """
    kinds = c.catalog.select("series_id", "value_type")
    after, touched = held(wide(now).join(kinds, "series_id", "left")), held(rows.select("series_id", "period").distinct())
    stored = held(before.groupBy("series_id").agg(F.max("period").alias("period")))
    new = held(after.join(touched, ["series_id", "period"], "left_semi"))
    only = lambda found: found.join(touched, ["series_id", "period"], "left_semi").select(*FINDING)
    places = after.withColumn("place", F.row_number().over(Window.partitionBy("series_id").orderBy("period")))
    rates = after.where("m_yoy IS NOT NULL").where(~F.col("period").isin(*c.shocks) if c.shocks else F.lit(True))
    past = B.blocked(rates, c.breaks).where("NOT blocked").select("series_id", F.col("period").alias("_p"), "m_yoy")
    past = new.where("m_yoy IS NOT NULL").select("series_id", F.col("period").alias("at")).join(past, "series_id").where("_p < at")
    cells = rows.where("measure <> 'span'").select(*G.CELL, "value")
    last = cells.groupBy(*G.CELL).agg(F.max("value").alias("value"))
    ahead = touched.join(stored.withColumnRenamed("period", "_last"), "series_id").where("period > _last").groupBy("series_id").agg(F.min("period").alias("period"))
    revised = log.where("measure <> 'span'")
    found = [
        schema(new), caliber(cells, c.catalog), bounds(new), only(monotonic(places, c.joint_from)), unit_slip(new, after), seasonal_z(new, past, after, c.shocks),
        ytd_arithmetic(after, touched), only(yoy_base(after, c.breaks)), calendar_step(ahead, stored), only(break_no_yoy(after, c.breaks)), revision_flood(revised, after, c.panels if c.panels is not None else stored.where("false").select("series_id")),
        findings(G.integrity(revised.withColumn("revised_on", F.lit(c.today)).where("row_no = 1"), before, last, c.today), "revision_integrity", "BLOCK"), catalog(after, c.catalog, orphans=c.orphans).where("severity = 'BLOCK'"),
    ]
    if c.second is not None:
        found.append(findings(G.disagreements(cells, c.second, N.display_tolerance(F.lit(1))), "dg_press", "BLOCK"))
    if c.pairs is not None:
        found.append(only(findings(G.republications(after, c.pairs, "m_yoy").withColumnRenamed("first_id", "series_id"), "pairs", "WARN")))
    if c.parts is not None:
        found.append(only(sum_of_parts(after.select("series_id", "period", "m"), G.sum_parts(after, c.parts))))
    if c.heads is not None:
        items = after.join(c.heads, "series_id").select("head", "period", "m_yoy")
        found.append(only(envelope(after, items)))
    if c.wholes is not None:
        whole = after.select(F.col("series_id").alias("whole_id"), "period", F.col("m").alias("whole"))
        parts = after.join(c.wholes, "series_id").join(whole, ["whole_id", "period"]).select("series_id", "period", F.when(F.col("m") > F.col("whole") * 1.001, 1).alias("_over")).where("_over = 1")
        found.append(only(findings(parts, "share_bounds", "WARN")))
    if c.window is not None:
        found.append(release_window(touched.join(c.window, "series_id")))
    if c.anchors is not None and c.fields is not None:
        found.append(completeness(c.fields, c.anchors).select("check_id", "severity", F.col("group").alias("series_id"), F.col("release").alias("period")))
    if c.manifests is not None and c.captures is not None and c.releases is not None:
        found.append(release_identity(ahead.join(c.releases, "series_id"), c.manifests, c.captures, S.stale(after)))
    if c.ended is not None:
        problems = B.link_problems(c.breaks, c.ended)
        found.append(problems.join(touched.select("series_id").distinct(), "series_id", "left_semi").select(F.lit("break_link").alias("check_id"), "severity", "series_id", F.col("other").alias("period")))
    parts = [f.select(*FINDING) for f in found]
    while len(parts) > 1:  # in pairs, as each union is analysed anew
        parts = [a.union(b) for a, b in zip(parts[::2], parts[1::2], strict=False)] + parts[len(parts) // 2 * 2 :]
    return acknowledged(parts[0], c.known)


def verdict(found: DataFrame) -> DataFrame:
    """One row: findings by severity and the exit code, 2 if any blocks."""
    n = lambda s: F.count(F.when(F.col("severity") == s, 1))
    return found.agg(n("BLOCK").alias("blocks"), n("WARN").alias("warns")).withColumn("exit_code", F.when(F.col("blocks") > 0, 2).otherwise(0))
