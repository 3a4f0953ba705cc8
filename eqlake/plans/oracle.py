"""DuckDB SQL for the oracle side of the query catalogue.

Written independently of the Spark code, from the operator definitions. The
test-data panels are rebuilt as CTEs from the pre-registered tables.
"""

from __future__ import annotations


def panel_ctes(panel: str = "events") -> str:
    """CTEs: daily (raw aggregates), ohlcv, adj, hfq, cal (all days open), calw (weekends closed)."""
    if panel == "events":
        daily = """
daily AS (
  SELECT lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INT, '0') || '.SZ' AS ts_code,
         CAST(ts AS DATE) AS trade_date,
         min_by(value, row(ts, event_id)) AS open,
         max(value) AS high,
         min(value) AS low,
         max_by(value, row(ts, event_id)) AS close,
         CAST(count(*) AS DOUBLE) AS volume,
         round(sum(value), 2) AS amount,
         count(*) FILTER (WHERE event_type = 'error') AS n_flag,
         count(*) FILTER (WHERE event_type = 'signup') AS n_action,
         bool_or(event_type <> 'error') AS has_factor
  FROM events GROUP BY 1, 2)"""
    else:
        daily = """
li AS (SELECT *, l_extendedprice / l_quantity AS price FROM lineitem),
daily AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), greatest(6, length(CAST(l_suppkey AS VARCHAR)))::INT, '0') || '.SH' AS ts_code,
         CAST(l_shipdate AS DATE) AS trade_date,
         min_by(price, row(l_orderkey, l_linenumber, l_partkey, price)) AS open,
         max(price) AS high,
         min(price) AS low,
         max_by(price, row(l_orderkey, l_linenumber, l_partkey, price)) AS close,
         sum(l_quantity) AS volume,
         round(sum(l_extendedprice), 2) AS amount,
         count(*) FILTER (WHERE l_returnflag = 'A') AS n_flag,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_action,
         bool_or(NOT (l_returnflag = 'N' AND l_linestatus = 'O')) AS has_factor
  FROM li GROUP BY 1, 2)"""
    return daily + """,
ohlcv AS (
  SELECT ts_code, trade_date, open, high, low, close,
         CAST(NULL AS DOUBLE) AS pre_close, CAST(NULL AS DOUBLE) AS change, CAST(NULL AS DOUBLE) AS pct_chg,
         volume, amount, FALSE AS is_suspended, n_flag >= 2 AS is_st,
         CAST(CASE WHEN close = low THEN 4 WHEN close = high THEN 2 WHEN close > open THEN 1
                   WHEN close < open THEN 3 ELSE 0 END AS BIGINT) AS limit_status
  FROM daily),
adj_all AS (
  SELECT ts_code, trade_date, has_factor,
         CAST(10 + sum(n_action) OVER (PARTITION BY ts_code ORDER BY trade_date
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(10 AS DOUBLE)
           AS cumulative_factor
  FROM daily),
adj AS (SELECT ts_code, trade_date, cumulative_factor FROM adj_all WHERE has_factor),
hfq AS (
  SELECT o.ts_code, o.trade_date, o.open, o.high, o.low, o.close, a.cumulative_factor,
         o.open * a.cumulative_factor AS hfq_open, o.high * a.cumulative_factor AS hfq_high,
         o.low * a.cumulative_factor AS hfq_low, o.close * a.cumulative_factor AS hfq_close,
         o.volume, o.amount, o.is_suspended, o.is_st, o.limit_status
  FROM ohlcv o LEFT JOIN adj a ON o.ts_code = a.ts_code AND o.trade_date = a.trade_date),
cal_days AS (
  SELECT CAST(unnest(generate_series(min(trade_date), max(trade_date), INTERVAL 1 DAY)) AS DATE) AS cal_date FROM daily),
cal AS (
  SELECT 'SSE' AS exchange, cal_date, TRUE AS is_open,
         max(cal_date) OVER (ORDER BY cal_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pretrade_date
  FROM cal_days),
calw AS (
  SELECT 'SSE' AS exchange, cal_date, isodow(cal_date) < 6 AS is_open,
         max(CASE WHEN isodow(cal_date) < 6 THEN cal_date END)
           OVER (ORDER BY cal_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pretrade_date
  FROM cal_days),
cidx AS (SELECT cal_date AS trade_date, row_number() OVER (ORDER BY cal_date) - 1 AS ci FROM cal WHERE is_open)"""


def with_panel(panel: str, body: str, extra_ctes: str = "") -> str:
    ctes = panel_ctes(panel)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def isfinite(x: str) -> str:
    return f"({x} IS NOT NULL AND NOT isnan({x}) AND NOT isinf({x}))"


def fin(x: str) -> str:
    return f"CASE WHEN {isfinite(x)} THEN {x} END"


def return_5d_cte(src: str = "hfq") -> str:
    return f"""
calc AS (
  SELECT ts_code, trade_date, 'return_5d' AS factor_name, 'v1' AS factor_version,
         hfq_close / lag(hfq_close, 5) OVER w - 1 AS raw_value,
         count(trade_date) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obs
  FROM {src} WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date))"""


def processed_cte(min_periods="6", src: str = "calc") -> str:
    return f"""
qual AS (
  SELECT *, CASE WHEN raw_value IS NULL THEN
                   CASE WHEN obs < {min_periods} THEN 'insufficient_history' ELSE 'missing_input' END
                 WHEN isnan(raw_value) OR isinf(raw_value) THEN 'invalid_value'
                 ELSE 'valid' END AS quality_status
  FROM {src}),
vraw AS (SELECT *, CASE WHEN quality_status = 'valid' THEN raw_value END AS vr FROM qual),
ranked AS (
  SELECT *, CASE WHEN vr IS NOT NULL THEN
             (CAST(rank() OVER (PARTITION BY trade_date, factor_name ORDER BY vr ASC NULLS LAST) AS DOUBLE)
              + CAST(count(*) OVER (PARTITION BY trade_date, factor_name, vr) - 1 AS DOUBLE) / 2.0::DOUBLE)
             / CAST(count(vr) OVER (PARTITION BY trade_date, factor_name) AS DOUBLE) END AS pct
  FROM vraw)"""


def labels_cte(src: str = "hfq", idx: str = "cidx") -> str:
    return f"""
pidx AS (SELECT h.ts_code, h.trade_date, h.hfq_open, c.ci FROM {src} h LEFT JOIN {idx} c ON h.trade_date = c.trade_date),
lab_raw AS (
  SELECT p.ts_code, p.trade_date, CASE WHEN p.ci IS NOT NULL THEN x.hfq_open / e.hfq_open - 1 END AS r
  FROM pidx p
  LEFT JOIN pidx e ON e.ts_code = p.ts_code AND e.ci = p.ci + 1
  LEFT JOIN pidx x ON x.ts_code = p.ts_code AND x.ci = p.ci + 6),
labels AS (SELECT ts_code, trade_date, {fin('r')} AS forward_return_5d FROM lab_raw)"""


def evaluation_ctes(factor_src: str, label_src: str = "labels", higher_is_better=False) -> str:
    """Daily metrics, turnover and autocorrelation CTEs over a factor frame
    (ts_code, trade_date, factor_value) and labels."""
    if higher_is_better is True:
        ls, fav = "q5 - q1", 5
    elif higher_is_better is False:
        ls, fav = "q1 - q5", 1
    else:
        ls, fav = "CAST(NULL AS DOUBLE)", 0
    corr = lambda a, b: f"(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END)"
    return f"""
fc AS (SELECT ts_code, trade_date, {fin('factor_value')} AS fv FROM {factor_src}),
lc AS (SELECT ts_code, trade_date, {fin('forward_return_5d')} AS fr FROM {label_src}),
pairs AS (SELECT f.ts_code, f.trade_date, f.fv, l.fr FROM fc f JOIN lc l USING (ts_code, trade_date)
          WHERE f.fv IS NOT NULL AND l.fr IS NOT NULL),
elig AS (SELECT trade_date FROM pairs GROUP BY trade_date
         HAVING count(*) >= 5 AND count(DISTINCT fv) >= 2 AND count(DISTINCT fr) >= 2),
rk AS (
  SELECT p.*,
    CAST(rank() OVER (PARTITION BY p.trade_date ORDER BY fv) AS DOUBLE)
      + CAST(count(*) OVER (PARTITION BY p.trade_date, fv) - 1 AS DOUBLE) / 2.0::DOUBLE AS rf,
    CAST(rank() OVER (PARTITION BY p.trade_date ORDER BY fr) AS DOUBLE)
      + CAST(count(*) OVER (PARTITION BY p.trade_date, fr) - 1 AS DOUBLE) / 2.0::DOUBLE AS rr,
    CAST(floor(CAST(row_number() OVER (PARTITION BY p.trade_date ORDER BY fv, ts_code) - 1 AS DOUBLE) * 5
               / CAST(count(*) OVER (PARTITION BY p.trade_date) AS DOUBLE)) + 1 AS INTEGER) AS q
  FROM pairs p JOIN elig e ON p.trade_date = e.trade_date),
daily0 AS (
  SELECT trade_date, {corr('fv', 'fr')} AS ic0, {corr('rf', 'rr')} AS ric0, count(*) AS n_pairs,
         avg(CASE WHEN q = 1 THEN fr END) AS q1, avg(CASE WHEN q = 2 THEN fr END) AS q2,
         avg(CASE WHEN q = 3 THEN fr END) AS q3, avg(CASE WHEN q = 4 THEN fr END) AS q4,
         avg(CASE WHEN q = 5 THEN fr END) AS q5
  FROM rk GROUP BY trade_date),
dmet AS (
  SELECT trade_date, {fin('ic0')} AS ic, {fin('ric0')} AS rank_ic, n_pairs, q1, q2, q3, q4, q5, {ls} AS long_short
  FROM daily0 WHERE {isfinite('ic0')} AND {isfinite('ric0')}),
didx AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS k FROM dmet),
mem AS (SELECT r.ts_code, d.k FROM rk r JOIN didx d ON r.trade_date = d.trade_date WHERE r.q = {fav}),
msize AS (SELECT k, count(*) AS sz FROM mem GROUP BY k),
ovl AS (SELECT a.k, count(b.ts_code) AS ov FROM mem a LEFT JOIN mem b ON b.ts_code = a.ts_code AND b.k = a.k - 1 GROUP BY a.k),
turn AS (
  SELECT d.trade_date, 1.0::DOUBLE - CAST(o.ov AS DOUBLE) * least(1.0::DOUBLE / s.sz, 1.0::DOUBLE / p.sz) AS turnover
  FROM ovl o JOIN msize s ON s.k = o.k JOIN msize p ON p.k = o.k - 1 JOIN didx d ON d.k = o.k),
fdates AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS j FROM (SELECT DISTINCT trade_date FROM {factor_src})),
fv_idx AS (SELECT f.ts_code, f.trade_date, f.fv, d.j FROM fc f JOIN fdates d USING (trade_date) WHERE f.fv IS NOT NULL),
apairs AS (SELECT c.trade_date, p.fv AS a, c.fv AS b FROM fv_idx c JOIN fv_idx p ON p.ts_code = c.ts_code AND p.j = c.j - 1),
acorr0 AS (SELECT trade_date, {corr('a', 'b')} AS c0 FROM apairs GROUP BY trade_date
           HAVING count(*) >= 5 AND count(DISTINCT a) >= 2 AND count(DISTINCT b) >= 2),
acorr AS (SELECT trade_date, c0 AS autocorr FROM acorr0 WHERE {isfinite('c0')})"""


def raw_ctes() -> str:
    """Raw vendor-frame aggregates of ``events`` with the venue rule, and the rows
    the research-universe filter keeps."""
    u = "CAST(user_id AS VARCHAR)"
    return f"""
rawd AS (
  SELECT user_id, CAST(ts AS DATE) AS d,
         min_by(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         max_by(value, row(ts, event_id)) AS close, count(*) AS vol, round(sum(value), 2) AS amount,
         count(*) FILTER (WHERE event_type = 'error') AS n_error,
         count(*) FILTER (WHERE event_type = 'signup') AS n_signup,
         count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase
  FROM events GROUP BY 1, 2),
rawc AS (
  SELECT *, CASE WHEN user_id % 10 = 9 THEN '900' || lpad({u}, greatest(4, length({u}))::INT, '0') || '.SH'
                 WHEN user_id % 10 = 8 THEN '200' || lpad({u}, greatest(4, length({u}))::INT, '0') || '.SZ'
                 WHEN user_id % 10 = 7 THEN lpad({u}, greatest(6, length({u}))::INT, '0') || '.BJ'
                 WHEN user_id % 2 = 0 THEN lpad({u}, greatest(6, length({u}))::INT, '0') || '.SZ'
                 ELSE lpad({u}, greatest(6, length({u}))::INT, '0') || '.SH' END AS ts_code
  FROM rawd),
kept AS (
  SELECT * FROM rawc
  WHERE NOT ((starts_with(ts_code, '900') AND ends_with(ts_code, '.SH'))
          OR (starts_with(ts_code, '200') AND ends_with(ts_code, '.SZ'))))"""


def with_raw(body: str, extra: str = "") -> str:
    return "WITH " + raw_ctes() + ("," + extra if extra else "") + "\n" + body


def lineitem_factor_ctes() -> str:
    """Raw values of the five registered factors over the hfq panel, stacked, with
    each factor's minimum observation count (``mp``)."""
    return """
w0 AS (
  SELECT ts_code, trade_date, hfq_close, amount,
         count(trade_date) OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obs,
         lag(hfq_close, 1) OVER (PARTITION BY ts_code ORDER BY trade_date) AS c1,
         lag(hfq_close, 5) OVER (PARTITION BY ts_code ORDER BY trade_date) AS c5,
         lag(hfq_close, 20) OVER (PARTITION BY ts_code ORDER BY trade_date) AS c20,
         CASE WHEN amount > 0 THEN amount END AS amt
  FROM hfq),
w1 AS (SELECT *, ln(hfq_close / c1) AS lr, abs(hfq_close / c1 - 1) / amt AS ill FROM w0),
w2 AS (
  SELECT *,
    CASE WHEN count(lr) OVER r20 = 20 THEN stddev_samp(lr) OVER r20 END AS vol20,
    CASE WHEN count(amt) OVER r20 = 20 THEN ln(avg(amt) OVER r20) END AS lam20,
    CASE WHEN count(ill) OVER r20 = 20 THEN avg(ill) OVER r20 END AS ami20
  FROM w1 WINDOW r20 AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
calc AS (
  SELECT ts_code, trade_date, 'return_5d' AS factor_name, 'v1' AS factor_version, hfq_close / c5 - 1 AS raw_value, obs, 6 AS mp FROM w2
  UNION ALL SELECT ts_code, trade_date, 'momentum_20d', 'v1', hfq_close / c20 - 1, obs, 21 FROM w2
  UNION ALL SELECT ts_code, trade_date, 'volatility_20d', 'v1', vol20, obs, 20 FROM w2
  UNION ALL SELECT ts_code, trade_date, 'log_amount_mean_20d', 'v1', lam20, obs, 20 FROM w2
  UNION ALL SELECT ts_code, trade_date, 'amihud_20d', 'v1', ami20, obs, 20 FROM w2)"""
