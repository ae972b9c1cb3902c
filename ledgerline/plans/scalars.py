"""Queries that apply the scalar functions to whole tables, by family."""

from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions import numbers as N
from ledgerline.functions import periods as P
from ledgerline.functions import text as X
from ledgerline.plans.registry import query


@query("fn_period_steps", """+ p AS (SELECT series_id, period, CASE WHEN length(period) = 4 THEN 'A' WHEN period LIKE '%Q%' THEN 'Q' ELSE 'M' END AS shape, CAST(substr(period, 1, 4) AS INT) AS y FROM mixed),
  q AS (SELECT *, CASE shape WHEN 'A' THEN 12 WHEN 'Q' THEN CAST(substr(period, 7, 1) AS INT) * 3 ELSE CAST(substr(period, 6, 2) AS INT) END AS mo FROM p)
  SELECT series_id, period, shape AS loose, CASE shape WHEN 'M' THEN mo END AS month, y || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') AS ym, 2001 * 12 + 6 - (y * 12 + mo) AS months,
    CASE shape WHEN 'M' THEN 2001 * 12 + 6 - (y * 12 + mo) END AS steps, y * 100 + CASE shape WHEN 'A' THEN 0 WHEN 'Q' THEN mo - 2 ELSE mo END AS sort_key, CASE shape WHEN 'A' THEN 'A' ELSE substr(period, 6, 2) END AS cohort,
    'jan_feb' AS merged, CASE shape WHEN 'A' THEN 'YYYY' WHEN 'Q' THEN 'YYYY-Qn' ELSE 'YYYY-MM' END AS format, CAST((y * 12 + mo + 4) // 12 AS VARCHAR) || '-' || lpad(CAST((y * 12 + mo + 4) % 12 + 1 AS VARCHAR), 2, '0') AS plus5 FROM q""")
def _(x):
    june = F.lit("2001-06")
    return x.mixed.select(
        "series_id", "period", P.period_shape_loose("period").alias("loose"), P.month_num("period").alias("month"), P.to_year_month("period").alias("ym"), P.months_between("period", june).alias("months"),
        P.steps_between("period", june).alias("steps"), P.period_sort_key("period").alias("sort_key"), P.cohort_key("period", F.lit(1)).alias("cohort"), P.cohort_key("period", F.lit(2)).alias("merged"),
        P.period_format("period").alias("format"), L.add_months("period", F.lit(5)).alias("plus5"),
    )


@query("fn_release_windows", """+ o AS (SELECT series_id, period, CAST(period || '-01' AS DATE) + INTERVAL 1 MONTH AS s, CAST(substr(period, 6, 2) AS INT) AS mo FROM obs)
  SELECT series_id, period, CAST(s + INTERVAL 8 DAY AS DATE) AS opens, CAST(CASE WHEN mo > 6 THEN last_day(s) ELSE s + INTERVAL 20 DAY END + INTERVAL 3 DAY AS DATE) AS closes, CAST(substr(period, 1, 4) AS INT) AS starts, 2100 AS open_end, 1990 AS no_start, CAST(substr(period, 1, 4) AS INT) + 1 AS ends, CAST(substr(period, 1, 4) AS INT) AS of_file FROM o""")
def _(x):
    month, year = F.substring("period", 6, 2).cast("int"), F.substring("period", 1, 4)
    window = L.rule_window("period", F.lit(1), F.lit(9), F.when(month > 6, 28).otherwise(21))
    since, until = F.concat(F.lit("total ("), year, F.lit("-)")), F.concat(F.lit("total (-"), (year.cast("int") + 1).cast("string"), F.lit(")"))
    return x.obs.select(
        "series_id", "period", window["opens"].alias("opens"), window["closes"].alias("closes"), L.window_start(since).alias("starts"), L.window_end(since).alias("open_end"), L.window_start(until).alias("no_start"),
        L.window_end(until).alias("ends"), L.file_year(F.col("period")).alias("of_file"),
    )


@query("fn_titles", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS release, strftime(o_orderdate, '%Y-%m') AS part, CASE WHEN month(o_orderdate) IN (3, 6, 9) THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') || '-12' END AS bulletin,
    CASE WHEN month(o_orderdate) IN (3, 6, 9) THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') || '-12' END AS income, CASE WHEN month(o_orderdate) IN (3, 6, 9) THEN strftime(o_orderdate, '%Y-%m') END AS inferred,
    strftime(o_orderdate, '%Y-%m') AS fiscal, CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 09:30:00' AS TIMESTAMP) AS at, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day FROM orders""", pre=False)
def _(x):
    """Titles of releases written from the order's date, and the period read back from them."""
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    part = F.when(m == 3, "一季度").when(m == 6, "上半年").when(m == 9, "前三季度").otherwise("")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    slashed = F.date_format("o_orderdate", "yyyy/MM/dd")
    return x.table("orders").select(
        "o_orderkey", L.title_period_release(text(y, "年", m, "月份社会消费品零售总额")).alias("release"), L.title_period_release(text(y, "年1-", m, "月份投资情况")).alias("part"),
        L.title_period_bulletin(text(y, "年", part, "国民经济公报")).alias("bulletin"), L.title_period_income(text(y, "年", part, "居民收入和消费支出情况")).alias("income"),
        L.title_period_inferred(text(part, "居民收入和消费支出情况"), text(y, "-10-20")).alias("inferred"), L.title_period_fiscal(text(y, "年1-", m, "月财政收支情况")).alias("fiscal"),
        L.published_at(text(slashed, " 09:30")).alias("at"), L.published_at(slashed).alias("day"),
    )


_Y = "m_yoy IS NOT NULL AND ytd_yoy IS NOT NULL"


@query("fn_number_tests", f"""SELECT series_id, period, TRUE AS number, FALSE AS no_number, m_yoy / NULLIF(ytd_yoy, 0) AS div, CASE WHEN m_yoy > ytd_yoy THEN 'inf' WHEN m_yoy < ytd_yoy THEN '-inf' ELSE '0' END AS endless,
    (m_yoy - ytd_yoy) / (2.0 * 1.4826) AS z, 0.05 AS half_unit, ABS(m_yoy - ytd_yoy) <= 0.5 + 1e-9 AS near, m_yoy = ytd_yoy AS equal, TRUE AS zeros, CASE WHEN m_yoy = ROUND(m_yoy, 0) THEN 0 ELSE 1 END AS places,
    CASE WHEN m_yoy < 0 THEN 'down' ELSE 'up' END AS sign_word, m_yoy * CASE WHEN span = 2 THEN 10000.0 ELSE 1.0 END AS yi FROM obs WHERE {_Y}""")
def _(x):
    y, z = F.col("m_yoy"), F.col("ytd_yoy")
    endless = N.robust_z(y, z, F.lit(0.0))
    word = F.when(y < 0, "下降").otherwise("增长")
    return x.obs.where(_Y).select(
        "series_id", "period", N.is_number(y).alias("number"), N.is_number(F.lit(float("nan"))).alias("no_number"), N.safe_div(y, z).alias("div"),
        F.when(endless == float("inf"), "inf").when(endless == float("-inf"), "-inf").otherwise("0").alias("endless"), N.robust_z(y, z, F.lit(2.0)).alias("z"), N.display_tolerance(F.lit(1)).alias("half_unit"),
        N.close_enough(y, z, F.lit(0.5)).alias("near"), N.values_equal(y, z).alias("equal"), (F.signum(F.lit(1.0) / F.when(N.norm_signed_zero(F.lit(-0.0)) == 0, F.lit(1.0))) > 0).alias("zeros"),
        N.decimal_places(y).alias("places"), F.when(N.sign_from_word(word) < 0, "down").otherwise("up").alias("sign_word"), N.yi_yuan(y, F.when(F.col("span") == 2, "万亿元").otherwise("亿元")).alias("yi"),
    )


@query("fn_number_text", """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS numeric, NULL::DOUBLE AS blank, NULL::DOUBLE AS words, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS found, NULL::DOUBLE AS none, -CAST(o_custkey % 90 AS DOUBLE) / 10 AS signed,
    (o_custkey % 90) / 10.0 AS nominal, -(o_custkey % 70) / 10.0 AS real, format('{:.1f}', (o_custkey % 90) / 10.0) AS magnitude, format('{:.1f} 个百分点', (o_custkey % 90) / 10.0) AS pp, format('{:.1f} 个点', (o_custkey % 90) / 10.0) AS points,
    (o_custkey % 90) / 10.0 * 100 + 50 AS scaled, CASE WHEN o_custkey % 3 = 0 THEN 1 WHEN o_custkey % 3 = 1 THEN 2 ELSE 0 END AS step_places, CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS places FROM orders""", pre=False)
def _(x):
    """Numbers printed in the ways of tables and sentences, and read back."""
    price, rate = F.col("o_totalprice").cast("decimal(18,2)").cast("double"), (F.col("o_custkey") % 90) / 10
    text, rate_text, real = F.format_number(price, 2), F.format_string("%.1f", rate), F.format_string("%.1f", (F.col("o_custkey") % 70) / 10)
    pair = L.growth_pair(F.concat(rate_text, F.lit("%（下降"), real, F.lit("%）")))
    third = F.col("o_custkey") % 3
    return x.table("orders").select(
        "o_orderkey", N.numeric(F.concat(F.lit(" "), text)).alias("numeric"), N.numeric(F.lit(" -- ")).alias("blank"), N.numeric(F.concat(F.lit("约"), text)).alias("words"), N.to_number(F.concat(F.lit("约 "), text, F.lit(" 亿元"))).alias("found"),
        N.to_number(F.lit("—")).alias("none"), L.signed_yoy(F.lit("下降"), rate).alias("signed"), pair["nominal"].alias("nominal"), pair["real"].alias("real"), N.fmt_magnitude(-rate).alias("magnitude"), N.fmt_pp(-rate).alias("pp"),
        N.fmt_points(rate).alias("points"), N.linear_scale(rate, F.lit(0.0), F.lit(1.0), 50.0, 150.0).alias("scaled"), L.decimals_for_step(F.when(third == 0, 0.5).when(third == 1, 0.05).otherwise(20.0)).alias("step_places"),
        L.natural_decimals(F.when(third == 0, 1.25).otherwise(1.5)).alias("places"),
    )


@query("fn_ticks", """+ r AS (SELECT series_id, MIN(m_yoy) AS low, MAX(m_yoy) AS high FROM obs WHERE m_yoy IS NOT NULL GROUP BY 1), g AS (SELECT *, CASE WHEN low = high THEN low - 1 ELSE low END AS a, CASE WHEN low = high THEN high + 1 ELSE high END AS b FROM r),
  s AS (SELECT g.*, m * power(10.0, e) AS step FROM g, (VALUES (1), (2), (5)) v(m), range(-4, 8) t(e)), k AS (SELECT *, floor(a / step) AS f, ceil(b / step) AS c FROM s),
  first AS (SELECT series_id, (b - a) / 3 AS raw, power(10.0, floor(log10((b - a) / 3))) AS p FROM g), start AS (SELECT series_id, p * CASE WHEN raw / p < 1.5 THEN 1 WHEN raw / p < 3 THEN 2 WHEN raw / p < 7 THEN 5 ELSE 10 END AS step FROM first),
  best AS (SELECT k.series_id, MIN(k.step) AS step FROM k JOIN start USING (series_id) WHERE k.step >= start.step * 0.999999 AND c - f <= 4 GROUP BY 1)
  SELECT k.series_id, ROUND(k.f * k.step, 9) AS low, ROUND(k.c * k.step, 9) AS high, CAST(k.c - k.f + 1 AS INT) AS marks FROM k JOIN best ON best.series_id = k.series_id AND best.step = k.step""")
def _(x):
    """The axis of every series' rates: its first and last mark, and how many there are."""
    ends = x.obs.where("m_yoy IS NOT NULL").groupBy("series_id").agg(F.min("m_yoy").alias("low"), F.max("m_yoy").alias("high"))
    ticks = ends.select("series_id", N.nice_ticks(F.col("low"), F.col("high")).alias("t"))
    return ticks.select("series_id", F.element_at("t", 1).alias("low"), F.element_at("t", -1).alias("high"), F.size("t").alias("marks"))


@query("fn_text_signs", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN -1 WHEN 1 THEN 1 WHEN 2 THEN -1 END AS direction, o_orderkey % 4 IN (1, 3) AS fits_growth, o_orderkey % 4 <> 1 AS fits_decline, FALSE AS minus_of_growth, TRUE AS minus_of_decline,
    '限额 以上' AS ws, '商品零售' AS row_label, '出口 3 亿元 CPI 上涨' AS spaced, '北京市' AS city, format('{:.2f}', (o_custkey % 90) / 10.0) AS first_rendering FROM orders""", pre=False)
def _(x):
    """The sign that a sentence gives to its number: of negative growth, growth, decline, and none in the clause."""
    case = F.col("o_orderkey") % 4
    before = F.when(case == 0, "进口负增长").when(case == 1, "出口增长").when(case == 2, "增长后，出口下降").otherwise("出口增长，进口为")
    number = F.format_string("%.1f", (F.col("o_custkey") % 90) / 10)
    text, at = F.concat(before, number, F.lit("%")), F.length(before) + 1
    fits = lambda v, candidate=number: X.direction_consistent(F.lit(v), candidate, text, at)
    return x.table("orders").select(
        "o_orderkey", X.direction_before(text, at).alias("direction"), fits(1.0).alias("fits_growth"), fits(-1.0).alias("fits_decline"), fits(1.0, F.concat(F.lit("-"), number)).alias("minus_of_growth"),
        fits(-1.0, F.concat(F.lit("-"), number)).alias("minus_of_decline"), X.normalize_ws(F.lit(" 限额 \n 以上 ")).alias("ws"), X.strip_row_label(F.lit("其中：商品 零售")).alias("row_label"), X.pangu_join(F.lit("出口3亿元CPI上涨")).alias("spaced"),
        L.normalize_city(F.lit(" 北 京 市")).alias("city"), X.number_renderings(-(F.col("o_custkey") % 90) / 10)[0].alias("first_rendering"),
    )


@query("fn_provenance", """+ o AS (SELECT c.series_id, c.name, c.tier, o.period, o.m_yoy, o.ytd FROM catalog c JOIN obs o USING (series_id))
  SELECT series_id, period, CASE tier WHEN 1 THEN 'rel:' || replace(period, '-', '') || '15' WHEN 2 THEN 'natdata:monthly' ELSE 'legacy:' || period END AS src, CASE tier WHEN 1 THEN NULL ELSE 'a' || tier END AS indicator, CASE WHEN series_id LIKE 'nat%' THEN 'new_home' END AS metric,
    CASE WHEN tier = 3 THEN 0 ELSE 2 END AS labels, name AS headline, CASE tier WHEN 3 THEN 'ytd' ELSE 'm' END AS measure, CASE tier WHEN 3 THEN 'ytd' ELSE 'single' END AS caliber, CASE tier WHEN 1 THEN '同比 %' WHEN 2 THEN '环比 %' ELSE '亿元' END AS unit,
    CASE WHEN m_yoy IS NULL THEN '—' ELSE format('{:.1f}%', m_yoy) END AS tip, CASE WHEN tier = 1 THEN name ELSE name || '上涨' END AS title, CASE WHEN tier = 1 THEN '亿元' ELSE name || ' · 亿元' END AS dek,
    '资料来源：官方数据 · 截至 ' || period || ' · ' || CASE tier WHEN 3 THEN '累计口径' ELSE '当月口径' END || CASE tier WHEN 2 THEN ' ※ 历史数据已修订' ELSE '' END AS source,
    CAST(substr(period, 1, 4) AS INT) || ' 年 ' || CAST(substr(period, 6, 2) AS INT) || ' 月 1 日' AS day, CASE WHEN m_yoy IS NULL THEN '—' ELSE format('{:.1f} 个百分点', ABS(m_yoy)) END AS points, format('{:,.1f}', ROUND(ytd / 1000, 0) * 1.0) AS amount FROM o""")
def _(x):
    tier, name = F.col("tier"), F.col("name")
    none = F.lit(None).cast("string")
    both = F.array(F.lit("single"), F.lit("ytd"))
    calibers = F.when(tier == 3, F.array(F.lit("ytd"))).otherwise(both)
    published = F.when(tier == 1, F.concat(F.regexp_replace("period", "-", "/"), F.lit("/15 10:00")))
    source = F.when(tier == 2, "国家数据").otherwise("公报")
    card = L.headline_and_dek(F.when(tier == 1, name).otherwise(F.concat(name, F.lit("上涨"))), name, F.lit("亿元"))
    return x.catalog.join(x.obs, "series_id").select(
        "series_id", "period", L.make_src(published, source, F.col("period")).alias("src"), L.src_indicator_id(F.when(tier == 1, "rel:20010615").otherwise(F.concat(F.lit(" dg:a"), tier.cast("string")))).alias("indicator"),
        L.metric_from_id(F.when(F.col("series_id").like("nat%"), "x-newhome").otherwise("x")).alias("metric"), F.size(L.label_candidates(name, F.array(F.lit("b")), tier == 3)).alias("labels"), L.headline_name(F.when(tier == 2, ""), name).alias("headline"),
        L.level_measure(calibers).alias("measure"), L.resolve_caliber(calibers).alias("caliber"), L.plotted_unit_label(F.when(tier == 1, "yoy").when(tier == 2, "mom"), F.lit("亿元")).alias("unit"), L.tooltip_value(F.col("m_yoy"), F.lit(True), none).alias("tip"),
        card["headline"].alias("title"), card["dek"].alias("dek"), L.source_line(F.lit("官方数据"), F.col("period"), tier == 3, tier == 2).alias("source"), L.format_date(F.to_date(F.concat("period", F.lit("-01")))).alias("day"),
        L.format_pp(F.col("m_yoy")).alias("points"), L.format_number(F.round(F.col("ytd") / 1000, 0)).alias("amount"),
    )
