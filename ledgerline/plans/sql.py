"""The tables of sources.bind in DuckDB's SQL, as common table expressions that the queries' SQL starts from."""

from ledgerline.sources.bind import BREAKS


def values(rows: tuple) -> str:
    one = lambda v: "NULL" if v is None else repr(v).upper() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else repr(v)
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def _levels(name: str, column: str) -> str:
    joint = "period >= '1998' AND substr(period, 6, 2) IN ('01', '02')"
    return f"""{name}_s AS (
  SELECT series_id, CASE WHEN {joint} THEN substr(period, 1, 4) || '-02' ELSE period END AS period, CASE WHEN {joint} THEN 2 ELSE 1 END AS span, SUM({column}) AS v
  FROM raw WHERE {column} IS NOT NULL GROUP BY 1, 2, 3
), {name}_l AS (
  SELECT series_id, period, span, CAST(v AS DOUBLE) AS m, CAST(SUM(v) OVER (PARTITION BY series_id, substr(period, 1, 4) ORDER BY period) AS DOUBLE) AS ytd FROM {name}_s
), {name} AS (
  SELECT a.series_id, a.period, a.span, a.m, a.ytd, ROUND((a.m / b.m - 1) * 100, 1) + 0.0 AS m_yoy, ROUND((a.ytd / b.ytd - 1) * 100, 1) + 0.0 AS ytd_yoy
  FROM {name}_l a LEFT JOIN {name}_l b ON a.series_id = b.series_id AND a.span = b.span AND a.period = CAST(CAST(substr(b.period, 1, 4) AS INT) + 1 AS VARCHAR) || substr(b.period, 5)
)"""


PRE = f"""WITH cells AS (
  SELECT c_mktsegment AS seg, c_nationkey AS nat, o_orderpriority AS pri, strftime(o_orderdate, '%Y-%m') AS period, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v,
    SUM(CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS va, COUNT(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4
), raw AS (
  SELECT series_id, period, SUM(v) AS v, SUM(va) AS va
  FROM (SELECT 'mkt-' || seg AS series_id, period, v, va FROM cells UNION ALL SELECT 'nat-' || nat, period, v, va FROM cells) GROUP BY 1, 2
), {_levels("obs", "v")}, {_levels("old_all", "va")}, old AS (SELECT * FROM old_all WHERE period <= '2001-03'),
long_obs AS (UNPIVOT obs ON m, ytd, m_yoy, ytd_yoy INTO NAME measure VALUE value),
long_old AS (UNPIVOT old ON m, ytd, m_yoy, ytd_yoy INTO NAME measure VALUE value),
release AS (SELECT * FROM long_obs WHERE period >= '2000-06'),
mixed AS (
  SELECT series_id, p AS period, CAST(SUM(v) AS DOUBLE) AS m FROM (
    SELECT series_id, v, unnest([period, substr(period, 1, 4) || '-Q' || CAST(CEIL(CAST(substr(period, 6, 2) AS INT) / 3) AS INT), substr(period, 1, 4)]) AS p FROM raw WHERE series_id LIKE 'mkt-%'
  ) GROUP BY 1, 2
), breaks AS (SELECT * FROM (VALUES {values(BREAKS)}) t(series_id, effective, kind, no_yoy_across, yoy_valid_from, supersedes, superseded_by)),
catalog AS (
  SELECT *, 'level' AS value_type, CASE WHEN tier = 3 THEN 'ytd' ELSE 'single' END AS headline FROM (
    SELECT DISTINCT 'mkt-' || c_mktsegment AS series_id, 'market' AS section, 1 AS section_order, 1 AS tier, c_mktsegment AS name FROM customer
    UNION ALL SELECT 'nat-' || n_nationkey, 'nation', 2, CASE WHEN n_regionkey < 3 THEN 2 ELSE 3 END, n_name FROM nation)
), panel_t AS (SELECT nat AS entity, pri AS metric, period, CAST(SUM(v) AS DOUBLE) AS v FROM cells GROUP BY 1, 2, 3),
panel AS (
  SELECT a.entity, a.metric, a.period, ROUND((a.v / b.v - 1) * 100, 1) + 0.0 AS m FROM panel_t a LEFT JOIN panel_t b
    ON a.entity = b.entity AND a.metric = b.metric AND b.period = strftime(CAST(a.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
), cap_s AS (SELECT 'ind-' || l_returnflag AS indicator, strftime(l_shipdate, '%Y%m') || 'MM' AS code, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1, 2),
captures AS (
  SELECT indicator, code, CAST(v AS VARCHAR) AS v, '2002-01-01' AS fetched FROM cap_s UNION ALL
  SELECT indicator, code, CASE WHEN substr(code, 5, 2) = '03' THEN '' ELSE CAST(v + 1 AS VARCHAR) END, '2002-02-01' FROM cap_s WHERE substr(code, 5, 2) IN ('03', '06')
)"""

#: Whether column p of alias a lies in a window of its series in which no rate may be published; whether a break lies between.
BLOCKED = "EXISTS (SELECT 1 FROM breaks k WHERE k.series_id = {a}.series_id AND k.no_yoy_across AND {a}.{p} >= k.effective AND (k.yoy_valid_from IS NULL OR {a}.{p} < k.yoy_valid_from))"
SEAM = "EXISTS (SELECT 1 FROM breaks k WHERE k.series_id = {a}.series_id AND k.no_yoy_across AND {q} < k.effective AND k.effective <= {a}.{p})"
