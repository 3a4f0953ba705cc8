"""Query catalogue, part 2: views and repository reads, parsing and normalisers,
contracts, logical sinks, status and missing dates, declared factors, the
multi-factor pipeline and notebook time series. Registered into
``catalog.QUERIES`` / ``catalog.ORACLE`` on import.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.functions.parsing import clean_exchange, parse_number, parse_yyyymmdd
from eqlake.operators import contracts as QC
from eqlake.operators import evaluation as EV
from eqlake.operators import factors as FX
from eqlake.operators import labels as LB
from eqlake.operators import normalize as N
from eqlake.operators import processing as PR
from eqlake.operators import repository as Q
from eqlake.operators import status as ST
from eqlake.operators import timeseries as TS
from eqlake.operators import views as V
from eqlake.plans import oracle as O
from eqlake.plans.catalog import _r, register
from eqlake.plans.research import Research
from eqlake.sources import store as SK
from eqlake.sources import testdata as TD

D = _dt.date
# Parameters of the parameterised reads (the events panel spans 2024-01-01..30).
AS_OF = D(2024, 1, 20)
MID = D(2024, 1, 15)
RANGE = (D(2024, 1, 5), D(2024, 1, 25))


# ---------------------------------------------------------------------------
# J4-J7, W5, Q1-Q8
# ---------------------------------------------------------------------------

_QFQ_SQL = """
lf AS (SELECT ts_code, arg_max(cumulative_factor, trade_date) AS latest_cumulative_factor FROM adj GROUP BY ts_code),
qfq AS (
  SELECT o.ts_code, o.trade_date, o.open, o.high, o.low, o.close, a.cumulative_factor, lf.latest_cumulative_factor,
         o.open * a.cumulative_factor / lf.latest_cumulative_factor AS qfq_open,
         o.high * a.cumulative_factor / lf.latest_cumulative_factor AS qfq_high,
         o.low * a.cumulative_factor / lf.latest_cumulative_factor AS qfq_low,
         o.close * a.cumulative_factor / lf.latest_cumulative_factor AS qfq_close,
         o.volume, o.amount, o.is_suspended, o.is_st, o.limit_status
  FROM ohlcv o LEFT JOIN adj a ON o.ts_code = a.ts_code AND o.trade_date = a.trade_date
  LEFT JOIN lf ON o.ts_code = lf.ts_code)"""


@register("qfq_latest_view", O.with_panel("events", "SELECT * FROM qfq", _QFQ_SQL))
def q_qfq_latest_view(spark, sf_dir):
    r = Research(spark, sf_dir)
    return V.qfq_latest_view(r.bars, r.adj)


@register(
    "adj_alias_view",
    O.with_panel(
        "events",
        """SELECT ts_code, trade_date, open, high, low, close, cumulative_factor, qfq_open AS adj_open,
                  qfq_high AS adj_high, qfq_low AS adj_low, qfq_close AS adj_close, volume, amount,
                  is_suspended, is_st, limit_status FROM qfq""",
        _QFQ_SQL,
    ),
)
def q_adj_alias_view(spark, sf_dir):
    r = Research(spark, sf_dir)
    return V.adj_alias_view(r.bars, r.adj)


@register(
    "latest_factors",
    O.with_panel("events", "SELECT ts_code, arg_max(cumulative_factor, trade_date) AS latest_cumulative_factor FROM adj GROUP BY ts_code"),
)
def q_latest_factors(spark, sf_dir):
    return V.latest_factors(Research(spark, sf_dir).adj)


_ASOF_SQL = f"""
af AS (SELECT ts_code, arg_max(cumulative_factor, trade_date) AS asof_cumulative_factor FROM adj
       WHERE trade_date <= DATE '{AS_OF}' GROUP BY ts_code),
qa AS (
  SELECT o.ts_code, o.trade_date, o.open, o.high, o.low, o.close, a.cumulative_factor, af.asof_cumulative_factor,
         o.open * a.cumulative_factor / af.asof_cumulative_factor AS qfq_open,
         o.high * a.cumulative_factor / af.asof_cumulative_factor AS qfq_high,
         o.low * a.cumulative_factor / af.asof_cumulative_factor AS qfq_low,
         o.close * a.cumulative_factor / af.asof_cumulative_factor AS qfq_close,
         o.volume, o.amount, o.is_suspended, o.is_st, o.limit_status
  FROM ohlcv o LEFT JOIN adj a ON o.ts_code = a.ts_code AND o.trade_date = a.trade_date
  LEFT JOIN af ON o.ts_code = af.ts_code
  WHERE o.trade_date BETWEEN DATE '2024-01-01' AND DATE '{AS_OF}')"""


@register("qfq_asof", O.with_panel("events", "SELECT * FROM qa", _ASOF_SQL))
def q_qfq_asof(spark, sf_dir):
    r = Research(spark, sf_dir)
    return V.qfq_asof_view(r.bars, r.adj, D(2024, 1, 1), D(2024, 1, 30), as_of_date=AS_OF)


@register(
    "qfq_ohlcv",
    O.with_panel(
        "events",
        "SELECT ts_code, trade_date, qfq_open AS open, qfq_high AS high, qfq_low AS low, qfq_close AS close, volume, amount FROM qa",
        _ASOF_SQL,
    ),
)
def q_qfq_ohlcv(spark, sf_dir):
    r = Research(spark, sf_dir)
    return V.qfq_ohlcv(r.bars, r.adj, D(2024, 1, 1), D(2024, 1, 30), as_of_date=AS_OF, strict=False)


@register(
    "bars_none",
    O.with_panel("events", f"SELECT {', '.join(S.DAILY_OHLCV_COLUMNS)} FROM ohlcv WHERE trade_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"),
)
def q_bars_none(spark, sf_dir):
    r = Research(spark, sf_dir)
    return Q.daily_bars(r.bars, r.adj, None, *RANGE, adjustment="none")


@register("bars_hfq", O.with_panel("events", f"SELECT * FROM hfq WHERE trade_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"))
def q_bars_hfq(spark, sf_dir):
    r = Research(spark, sf_dir)
    return Q.daily_bars(r.bars, r.adj, None, *RANGE, adjustment="hfq")


@register(
    "bars_qfq",
    O.with_panel("events", "SELECT * FROM qa", _ASOF_SQL.replace("DATE '2024-01-01'", "DATE '2024-01-05'")),
)
def q_bars_qfq(spark, sf_dir):
    r = Research(spark, sf_dir)
    return Q.daily_bars(r.bars, r.adj, None, D(2024, 1, 5), D(2024, 1, 30), adjustment="qfq", as_of_date=AS_OF)


@register(
    "panel_fields",
    O.with_panel("events", f"SELECT ts_code, trade_date, hfq_close, amount, is_st FROM hfq WHERE trade_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"),
)
def q_panel_fields(spark, sf_dir):
    r = Research(spark, sf_dir)
    return Q.daily_panel(r.bars, r.adj, *RANGE, ["trade_date", "hfq_close", "amount", "is_st"], adjustment="hfq")


@register(
    "cross_section",
    O.with_panel("events", f"SELECT {', '.join(S.DEFAULT_CROSS_SECTION_FIELDS)} FROM ohlcv WHERE trade_date = DATE '{MID}' AND is_suspended = FALSE"),
)
def q_cross_section(spark, sf_dir):
    return Q.cross_section(Research(spark, sf_dir).bars, MID, exclude_suspended=True)


def _proc_sql(body):
    return O.with_panel("events", body, O.return_5d_cte() + "," + O.processed_cte())


@register(
    "factors_on_date",
    _proc_sql(f"SELECT ts_code, trade_date, factor_name, round(vr, 9) AS factor_value, factor_version FROM ranked WHERE trade_date = DATE '{MID}' AND factor_name IN ('return_5d') AND factor_version = 'v1'"),
)
def q_factors_on_date(spark, sf_dir):
    return _r(Q.factors_on_date(Research(spark, sf_dir).processed(), MID, ["return_5d"], factor_version="v1"))


@register(
    "factor_panel",
    _proc_sql(f"SELECT ts_code, trade_date, factor_name, round(vr, 9) AS factor_value, factor_version FROM ranked WHERE trade_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND factor_name = 'return_5d' AND factor_version = 'v1'"),
)
def q_factor_panel(spark, sf_dir):
    return _r(Q.factor_panel(Research(spark, sf_dir).processed(), *RANGE, "return_5d", factor_version="v1"))


@register("calendar_rows", O.with_panel("events", "SELECT exchange, cal_date, is_open, pretrade_date FROM calw WHERE exchange = 'SSE' AND cal_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"))
def q_calendar_rows(spark, sf_dir):
    return Q.trade_calendar(Research(spark, sf_dir).calendar_weekdays, D(2024, 1, 1), D(2024, 1, 31))


@register("open_dates", O.with_panel("events", "SELECT cal_date FROM calw WHERE exchange = 'SSE' AND is_open AND cal_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"))
def q_open_dates(spark, sf_dir):
    return Q.open_trade_dates(Research(spark, sf_dir).calendar_weekdays, D(2024, 1, 1), D(2024, 1, 31))


@register("latest_factor_row", O.with_panel("lineitem", "SELECT * FROM adj ORDER BY trade_date DESC, ts_code DESC LIMIT 1"))
def q_latest_factor_row(spark, sf_dir):
    return Q.first_row(Research(spark, sf_dir, "lineitem").adj, ["trade_date", "ts_code"])


# ---------------------------------------------------------------------------
# FN1-FN5, N1-N6, J1, J2, QC2-QC7
# ---------------------------------------------------------------------------


@register(
    "parse_numbers",
    r"SELECT event_id, value AS value_num, CAST(NULL AS DOUBLE) AS props_num, CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) AS k_num FROM events",
)
def q_parse_numbers(spark, sf_dir):
    e = TD.table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        parse_number(F.col("value").cast("string")).alias("value_num"),
        parse_number("props").alias("props_num"),
        parse_number(F.regexp_extract("props", r"(\d+)", 1)).alias("k_num"),
    )


@register("parse_dates", "SELECT event_id, CAST(ts AS DATE) AS trade_date, CAST(NULL AS DATE) AS bad_date FROM events")
def q_parse_dates(spark, sf_dir):
    e = TD.table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        parse_yyyymmdd(F.date_format("ts", "yyyyMMdd")).alias("trade_date"),
        parse_yyyymmdd(F.date_format("ts", "yyyy-MM-dd")).alias("bad_date"),
    )


@register("clean_exchange", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'SSE' ELSE upper(event_type) END AS exchange FROM events")
def q_clean_exchange(spark, sf_dir):
    e = TD.table(spark, sf_dir, "events")
    raw = F.when(F.col("event_type") == "error", F.lit(" NaN ")).otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
    return e.select("event_id", clean_exchange(raw).alias("exchange"))


@register(
    "normalize_calendar",
    "SELECT 'SSE' AS exchange, d AS cal_date, isodow(d) < 6 AS is_open, CAST(NULL AS DATE) AS pretrade_date FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)",
)
def q_normalize_calendar(spark, sf_dir):
    return N.normalize_trade_calendar(TD.raw_trade_calendar(spark, sf_dir))


_BARS_BODY = """
SELECT ts_code, d AS trade_date, open, high, low, close, CAST(NULL AS DOUBLE) AS pre_close, CAST(NULL AS DOUBLE) AS change,
       CAST(NULL AS DOUBLE) AS pct_chg, CAST(vol AS DOUBLE) AS volume, amount, FALSE AS is_suspended, n_error >= 2 AS is_st,
       CAST(CASE WHEN n_purchase > 0 AND abs(close - low) <= 1e-8 THEN 4
                 WHEN n_purchase > 0 AND abs(close - high) <= 1e-8 THEN 2
                 WHEN close > open THEN 1 WHEN close < open THEN 3 ELSE 0 END AS BIGINT) AS limit_status
FROM kept"""


def _norm_bars(spark, sf_dir):
    """Every bar, checked; days that break the contract (a price of zero, say) are reported and stay in the result."""
    return N.normalize_daily_ohlcv(
        TD.raw_daily_ohlcv(spark, sf_dir),
        stock_st=TD.raw_stock_st(spark, sf_dir),
        stk_limit=TD.raw_stk_limit(spark, sf_dir),
        validate="report",
    )


@register("normalize_bars", O.with_raw(_BARS_BODY))
def q_normalize_bars(spark, sf_dir):
    return _norm_bars(spark, sf_dir)


@register("limit_status", O.with_raw("SELECT limit_status, count(*) AS n_rows FROM (" + _BARS_BODY + ") b GROUP BY limit_status"))
def q_limit_status(spark, sf_dir):
    return _norm_bars(spark, sf_dir).groupBy("limit_status").agg(F.count(F.lit(1)).alias("n_rows"))


@register("st_flag", O.with_raw("SELECT ts_code, d AS trade_date FROM kept WHERE n_error >= 2"))
def q_st_flag(spark, sf_dir):
    return N.st_flags(TD.raw_stock_st(spark, sf_dir)).select("ts_code", "trade_date")


@register("universe_filter", O.with_raw("SELECT split_part(ts_code, '.', 2) AS suffix, count(*) AS n_rows FROM kept GROUP BY 1"))
def q_universe_filter(spark, sf_dir):
    kept = N.filter_research_universe(TD.raw_daily_ohlcv(spark, sf_dir))
    return kept.groupBy(F.substring_index("ts_code", ".", -1).alias("suffix")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("normalize_adj", O.with_raw("SELECT ts_code, d AS trade_date, CAST(n_signup + 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS cumulative_factor FROM kept"))
def q_normalize_adj(spark, sf_dir):
    return N.normalize_adj_factor(TD.raw_adj_factor(spark, sf_dir))


_BASIC_BODY = """
SELECT ts_code, d AS trade_date, close, CAST(vol AS DOUBLE) AS turnover_rate, CAST(vol AS DOUBLE) AS turnover_rate_f,
       CASE WHEN n_signup - n_error < 0 THEN 0.0 ELSE CAST(n_signup - n_error AS DOUBLE) END AS volume_ratio,
       CASE WHEN n_purchase > 0 THEN close * n_purchase ELSE -1.0 END AS pe,
       CASE WHEN n_error > 0 OR n_purchase = 0 THEN -1.0 ELSE close * n_purchase END AS pe_ttm,
       high AS pb, low AS ps, CAST(NULL AS DOUBLE) AS ps_ttm,
       CASE WHEN n_signup - n_error < 0 THEN 0.0 ELSE CAST(n_signup - n_error AS DOUBLE) END AS dv_ratio,
       0.0::DOUBLE AS dv_ttm,
       CASE WHEN vol > 1 THEN CAST(vol * 1000 AS DOUBLE) ELSE 0.0 END AS total_share,
       CASE WHEN vol > 1 THEN CAST(vol * 1000 AS DOUBLE) ELSE 0.0 END AS float_share,
       CASE WHEN vol > 1 THEN CAST(vol * 1000 AS DOUBLE) ELSE 0.0 END AS free_share,
       CASE WHEN amount > 0 THEN amount ELSE 0.0 END AS total_mv,
       CASE WHEN amount > 0 THEN amount ELSE 0.0 END AS circ_mv
FROM kept"""


@register("normalize_basic", O.with_raw(_BASIC_BODY))
def q_normalize_basic(spark, sf_dir):
    return N.normalize_daily_basic(TD.raw_daily_basic(spark, sf_dir))


@register(
    "basic_anomalies",
    O.with_raw("""
SELECT field, anomaly_count FROM (
  SELECT count(*) FILTER (WHERE vol <= 0) AS turnover_rate, count(*) FILTER (WHERE vol <= 0) AS turnover_rate_f,
         count(*) FILTER (WHERE vol <= 1) AS total_share, count(*) FILTER (WHERE vol <= 1) AS free_share,
         count(*) FILTER (WHERE vol <= 1) AS float_share, count(*) FILTER (WHERE amount <= 0) AS total_mv,
         count(*) FILTER (WHERE amount <= 0) AS circ_mv FROM kept)
UNPIVOT (anomaly_count FOR field IN (turnover_rate, turnover_rate_f, total_share, free_share, float_share, total_mv, circ_mv))"""),
)
def q_basic_anomalies(spark, sf_dir):
    return N.daily_basic_anomalies(TD.raw_daily_basic(spark, sf_dir))


@register(
    "contract_violations_basic",
    O.with_raw("""
SELECT ts_code, d AS trade_date, 'volume_ratio_negative' AS rule FROM kept WHERE n_signup < n_error
UNION ALL SELECT ts_code, d AS trade_date, 'dv_ratio_negative' AS rule FROM kept WHERE n_signup < n_error"""),
)
def q_contract_violations_basic(spark, sf_dir):
    parsed = N.normalize_daily_basic(TD.raw_daily_basic(spark, sf_dir), validate=False, apply_markers=False)
    return QC.violation_rows(parsed, "daily_basic", ["ts_code", "trade_date"])


@register(
    "contract_violations_ohlcv",
    O.with_panel("lineitem", """
SELECT ts_code, trade_date, 'limit_status_domain' AS rule FROM ohlcv WHERE limit_status NOT IN (-1, 0, 1, 2, 3, 4)
UNION ALL SELECT ts_code, trade_date, 'price_not_positive' FROM ohlcv WHERE least(open, high, low, close) <= 0
UNION ALL SELECT ts_code, trade_date, 'high_below_low' FROM ohlcv WHERE high < low"""),
)
def q_contract_violations_ohlcv(spark, sf_dir):
    return QC.violation_rows(Research(spark, sf_dir, "lineitem").bars, "ohlcv", ["ts_code", "trade_date"])


@register(
    "contract_violations_factor",
    _proc_sql("SELECT ts_code, trade_date, 'factor_value_missing' AS rule FROM ranked WHERE vr IS NULL"),
)
def q_contract_violations_factor(spark, sf_dir):
    return QC.violation_rows(Research(spark, sf_dir).processed(), "factor", ["ts_code", "trade_date"])


@register(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def q_duplicate_keys(spark, sf_dir):
    return QC.duplicate_keys(TD.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------
# SK3/SK4/SK9/SK10 logical results (file effects are tested with temp folders)
# ---------------------------------------------------------------------------

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register(
    "upsert_keep_last",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    + ", ".join(f"{c} DESC" for c in _LI_ORDER)
    + ") AS rn FROM lineitem) WHERE rn = 1",
)
def q_upsert_keep_last(spark, sf_dir):
    li = TD.table(spark, sf_dir, "lineitem").withColumn("_seq", F.struct(*_LI_ORDER))
    out = SK.keep_last(li, ["l_orderkey", "l_linenumber"], "_seq").drop("_seq")
    return out


@register(
    "factor_upsert",
    _proc_sql(f"""
SELECT ts_code, trade_date, factor_name, round(vr, 9) AS factor_value, factor_version, round(raw_value, 9) AS raw_value,
       CAST(NULL AS DOUBLE) AS processed_value, quality_status FROM ranked WHERE trade_date < DATE '{MID}'
UNION ALL
SELECT ts_code, trade_date, factor_name, round(pct, 9), factor_version, round(raw_value, 9), round(pct, 9), quality_status
FROM ranked WHERE trade_date >= DATE '{MID}'"""),
)
def q_factor_upsert(spark, sf_dir):
    r = Research(spark, sf_dir)
    old = r.processed(processor="raw")
    new = r.processed(processor="rank_pct").filter(F.col("trade_date") >= F.lit(MID))
    return _r(SK.upsert_frames(old, new, S.FACTOR_KEY))


@register(
    "range_replace",
    O.with_panel("events", """
SELECT * FROM calw WHERE NOT (cal_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20')
UNION ALL SELECT * FROM cal WHERE cal_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""),
)
def q_range_replace(spark, sf_dir):
    r = Research(spark, sf_dir)
    pred = F.col("cal_date").between(F.lit(D(2024, 1, 10)), F.lit(D(2024, 1, 20)))
    return SK.replace_rows(r.calendar_weekdays, r.calendar.filter(pred), pred)


# ---------------------------------------------------------------------------
# AG1-AG3, S3-S6
# ---------------------------------------------------------------------------


@register(
    "status_calendar",
    O.with_panel("events", "SELECT exchange, min(cal_date) AS start_date, max(cal_date) AS end_date, count(*) AS row_count, count(*) FILTER (WHERE is_open) AS open_count FROM calw GROUP BY exchange"),
)
def q_status_calendar(spark, sf_dir):
    return ST.calendar_status(Research(spark, sf_dir).calendar_weekdays)


@register(
    "status_daily",
    O.with_panel("lineitem", "SELECT min(trade_date) AS start_date, max(trade_date) AS end_date, count(*) AS row_count, count(DISTINCT trade_date) AS trade_date_count, count(DISTINCT ts_code) AS security_count FROM ohlcv"),
)
def q_status_daily(spark, sf_dir):
    return ST.daily_status(Research(spark, sf_dir, "lineitem").bars)


@register(
    "status_security",
    O.with_panel("events", """
SELECT count(*) AS row_count, count(DISTINCT exchange) AS exchange_count,
       count(*) FILTER (WHERE st = 'L') AS listed_count, count(*) FILTER (WHERE st = 'D') AS delisted_count,
       count(*) FILTER (WHERE st = 'P') AS paused_count
FROM (SELECT ts_code, 'SZSE' AS exchange,
             CASE WHEN max(trade_date) = (SELECT max(trade_date) FROM daily) THEN 'L'
                  WHEN count(*) < 10 THEN 'P' ELSE 'D' END AS st
      FROM daily GROUP BY ts_code)"""),
)
def q_status_security(spark, sf_dir):
    return ST.security_status(TD.securities(spark, sf_dir, "events"))


@register(
    "missing_dates",
    O.with_panel("lineitem", "SELECT cal_date FROM calw WHERE is_open AND cal_date NOT IN (SELECT trade_date FROM ohlcv WHERE is_st)"),
)
def q_missing_dates(spark, sf_dir):
    r = Research(spark, sf_dir, "lineitem")
    expected = r.calendar_weekdays.filter("is_open").select("cal_date")
    existing = r.bars.filter("is_st").select(F.col("trade_date").alias("cal_date"))
    return ST.missing_dates(expected, existing)


@register(
    "present_dates",
    O.with_panel("lineitem", "SELECT DISTINCT trade_date AS cal_date FROM ohlcv WHERE is_st AND trade_date IN (SELECT cal_date FROM calw WHERE is_open)"),
)
def q_present_dates(spark, sf_dir):
    r = Research(spark, sf_dir, "lineitem")
    expected = r.calendar_weekdays.filter("is_open").select("cal_date")
    existing = r.bars.filter("is_st").select(F.col("trade_date").alias("cal_date"))
    return ST.present_dates(expected, existing)


@register(
    "calendar_coverage",
    O.with_panel("lineitem", "SELECT cal_date FROM cal WHERE cal_date NOT IN (SELECT cal_date FROM calw WHERE is_open)"),
)
def q_calendar_coverage(spark, sf_dir):
    r = Research(spark, sf_dir, "lineitem")
    return ST.missing_dates(r.calendar.select("cal_date"), r.calendar_weekdays.filter("is_open"))


@register(
    "distinct_dates",
    O.with_panel("lineitem", "SELECT DISTINCT trade_date AS cal_date FROM ohlcv WHERE trade_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"),
)
def q_distinct_dates(spark, sf_dir):
    return ST.distinct_dates(Research(spark, sf_dir, "lineitem").bars, D(1996, 1, 1), D(1996, 12, 31))


# ---------------------------------------------------------------------------
# F5-F8 and the multi-factor pipeline (PL1 core, AG8)
# ---------------------------------------------------------------------------


def _li_factor(name):
    def q(spark, sf_dir):
        m = FX.build_default_registry().get(name)
        return _r(FX.compute_factor(Research(spark, sf_dir, "lineitem").hfq, m))

    return q


for _name in ("momentum_20d", "volatility_20d", "log_amount_mean_20d", "amihud_20d"):
    register(
        _name,
        O.with_panel(
            "lineitem",
            f"SELECT ts_code, trade_date, factor_name, round(raw_value, 9) AS factor_value, factor_version, round(raw_value, 9) AS raw_value FROM calc WHERE factor_name = '{_name}'",
            O.lineitem_factor_ctes(),
        ),
    )(_li_factor(_name))

ALL_FACTORS = (FX.RETURN_5D, FX.MOMENTUM_20D, FX.VOLATILITY_20D, FX.LOG_AMOUNT_MEAN_20D, FX.AMIHUD_20D)


def pipeline_frame(spark, sf_dir, panel="lineitem", processor="rank_pct"):
    """PL1 core without IO: one wide window pass for every factor, stacked, processed."""
    r = Research(spark, sf_dir, panel)
    wide = PR.observation_count(FX.compute_wide(r.hfq_by_security.select("ts_code", "trade_date", "hfq_close", "amount"), ALL_FACTORS))
    return PR.process_wide(wide, ALL_FACTORS, processor, r.largest_date, r.date_tasks)


_PIPE_CTES = O.lineitem_factor_ctes() + "," + O.processed_cte(min_periods="mp")


@register(
    "lineitem_factor_pipeline_wide",
    O.with_panel(
        "lineitem",
        "SELECT ts_code, trade_date, factor_name, round(pct, 9) AS factor_value, factor_version, round(raw_value, 9) AS raw_value, round(pct, 9) AS processed_value, quality_status FROM ranked",
        _PIPE_CTES,
    ),
)
def q_lineitem_factor_pipeline_wide(spark, sf_dir):
    return _r(pipeline_frame(spark, sf_dir))


@register(
    "pipeline_summary",
    O.with_panel(
        "lineitem",
        "SELECT count(*) AS output_row_count, round(count(*) FILTER (WHERE pct IS NULL)::DOUBLE / count(*), 9) AS missing_value_rate, round(count(*) FILTER (WHERE quality_status = 'valid')::DOUBLE / count(*), 9) AS valid_rate FROM ranked",
        _PIPE_CTES,
    ),
)
def q_pipeline_summary(spark, sf_dir):
    from eqlake.plans.jobs import summarize_output

    return _r(summarize_output(pipeline_frame(spark, sf_dir)))


# ---------------------------------------------------------------------------
# W7, W8, AG6/AG7, W9-W11
# ---------------------------------------------------------------------------


@register(
    "calendar_offsets",
    O.with_panel("events", "SELECT cal_date AS trade_date, lead(cal_date, 1) OVER (ORDER BY cal_date) AS t_plus_1, lead(cal_date, 6) OVER (ORDER BY cal_date) AS t_plus_6 FROM calw WHERE is_open"),
)
def q_calendar_offsets(spark, sf_dir):
    r = Research(spark, sf_dir)
    return LB.calendar_offsets(r.calendar_weekdays.filter("is_open").select(F.col("cal_date").alias("trade_date")))


@register(
    "warmup_start",
    O.with_panel("events", """
SELECT max(CASE WHEN k = 5 THEN d END) AS warmup_start, count(*) AS available
FROM (SELECT cal_date AS d, row_number() OVER (ORDER BY cal_date DESC) AS k FROM calw
      WHERE is_open AND cal_date >= DATE '1990-01-01' AND cal_date < DATE '2024-01-22')"""),
)
def q_warmup_start(spark, sf_dir):
    r = Research(spark, sf_dir)
    return LB.warmup_start_frame(r.calendar_weekdays.filter("is_open"), D(2024, 1, 22), 5)


@register(
    "factor_distribution",
    O.with_panel("lineitem", """
SELECT count(*) AS row_count, count(DISTINCT trade_date) AS trade_date_count, count(DISTINCT ts_code) AS security_count,
       round(1 - count(fv)::DOUBLE / count(*)::DOUBLE, 9) AS missing_value_rate, round(avg(fv), 9) AS mean,
       round(stddev_samp(fv), 9) AS std, round(min(fv), 9) AS min,
       round(quantile_cont(fv, 0.25), 9) AS p25, round(quantile_cont(fv, 0.5), 9) AS median,
       round(quantile_cont(fv, 0.75), 9) AS p75, round(max(fv), 9) AS max
FROM (SELECT ts_code, trade_date, CASE WHEN isfinite(raw_value) THEN raw_value END AS fv FROM calc WHERE factor_name = 'amihud_20d')""",
        O.lineitem_factor_ctes()),
)
def q_factor_distribution(spark, sf_dir):
    f = FX.compute_factor(Research(spark, sf_dir, "lineitem").hfq, FX.AMIHUD_20D)
    return _r(EV.factor_distribution(f))


@register(
    "forward_fill",
    O.with_panel("events", "SELECT ts_code, trade_date, last_value(hfq_close IGNORE NULLS) OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hfq_close FROM hfq"),
)
def q_forward_fill(spark, sf_dir):
    return TS.forward_fill(Research(spark, sf_dir).hfq.select("ts_code", "trade_date", "hfq_close"), ["hfq_close"])


@register(
    "rolling_mean_5",
    O.with_panel("events", "SELECT ts_code, trade_date, close, round(CASE WHEN count(close) OVER r = 5 THEN avg(close) OVER r END, 9) AS close_mean_5 FROM ohlcv WINDOW r AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"),
)
def q_rolling_mean_5(spark, sf_dir):
    return _r(TS.rolling_mean(Research(spark, sf_dir).bars.select("ts_code", "trade_date", "close"), "close", 5))


_RESAMPLE_CTES = """
b AS (SELECT h.ts_code, h.trade_date, h.hfq_close AS close, h.volume, f.d0,
             CAST(floor(date_diff('day', f.d0, h.trade_date) / 5) AS INTEGER) AS bin
      FROM hfq h JOIN (SELECT ts_code, min(trade_date) AS d0 FROM hfq GROUP BY ts_code) f ON f.ts_code = h.ts_code),
agg AS (SELECT ts_code, d0, bin, arg_max(close, trade_date) FILTER (WHERE close IS NOT NULL) AS close, sum(volume) AS volume
        FROM b GROUP BY ts_code, d0, bin),
grid AS (SELECT ts_code, d0, unnest(generate_series(0, max(bin))) AS bin FROM agg GROUP BY ts_code, d0)"""


@register(
    "resample_5d",
    O.with_panel(
        "events",
        """SELECT g.ts_code, CAST(g.d0 + INTERVAL 1 DAY * (g.bin * 5) AS DATE) AS bin_start, a.close,
                  coalesce(a.volume, 0.0) AS volume
           FROM grid g LEFT JOIN agg a ON a.ts_code = g.ts_code AND a.bin = g.bin""",
        _RESAMPLE_CTES,
    ),
)
def q_resample_5d(spark, sf_dir):
    h = Research(spark, sf_dir).hfq.select("ts_code", "trade_date", F.col("hfq_close").alias("close"), "volume")
    return TS.resample_days(h, 5)


# ---------------------------------------------------------------------------
# ETL of the test panel from raw rows (not materialised): the cost of building
# the processed bars table itself.
# ---------------------------------------------------------------------------


@register("lineitem_daily_bars_etl", O.with_panel("lineitem", f"SELECT {', '.join(S.DAILY_OHLCV_COLUMNS)} FROM ohlcv"))
def q_lineitem_daily_bars_etl(spark, sf_dir):
    return Research(spark, sf_dir, "lineitem", materialize=False).bars


# ---------------------------------------------------------------------------
# N6 security snapshot, QC5/QC6 contracts on derived frames
# ---------------------------------------------------------------------------

_SEC_SQL = """
sec AS (
  SELECT ts_code, split_part(ts_code, '.', 1) AS symbol, 'security ' || ts_code AS name,
         CAST(NULL AS VARCHAR) AS area, CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS VARCHAR) AS fullname,
         CAST(NULL AS VARCHAR) AS enname, CAST(NULL AS VARCHAR) AS cnspell, 'main' AS market, 'SZSE' AS exchange,
         'CNY' AS curr_type,
         CASE WHEN max(trade_date) = (SELECT max(trade_date) FROM daily) THEN 'L' WHEN count(*) < 10 THEN 'P' ELSE 'D' END AS list_status,
         strftime(min(trade_date), '%Y%m%d') AS list_date,
         CASE WHEN max(trade_date) <> (SELECT max(trade_date) FROM daily) AND count(*) >= 10 THEN strftime(max(trade_date), '%Y%m%d') END AS delist_date,
         'N' AS is_hs, CAST(NULL AS VARCHAR) AS act_name, CAST(NULL AS VARCHAR) AS act_ent_type
  FROM daily GROUP BY ts_code)"""


@register("security_snapshot", O.with_panel("events", "SELECT * FROM sec", _SEC_SQL))
def q_security_snapshot(spark, sf_dir):
    return N.normalize_stock_basic(TD.securities(spark, sf_dir, "events"))


@register(
    "contract_violations_security",
    O.with_panel("events", "SELECT ts_code, 'list_status_domain' AS rule FROM sec WHERE list_status NOT IN ('L', 'D', 'P')", _SEC_SQL),
)
def q_contract_violations_security(spark, sf_dir):
    return QC.violation_rows(TD.securities(spark, sf_dir, "events"), "security", ["ts_code"])


@register(
    "contract_violations_calendar",
    O.with_panel("lineitem", "SELECT cal_date, 'is_open_missing' AS rule FROM calw WHERE is_open IS NULL"),
)
def q_contract_violations_calendar(spark, sf_dir):
    return QC.violation_rows(Research(spark, sf_dir, "lineitem").calendar_weekdays, "calendar", ["cal_date"])


@register(
    "contract_violations_index",
    O.with_panel("lineitem", """
SELECT ts_code, trade_date, 'high_below_low' AS rule FROM ohlcv WHERE high < low
UNION ALL SELECT ts_code, trade_date, 'price_not_positive' FROM ohlcv WHERE least(open, high, low, close) <= 0"""),
)
def q_contract_violations_index(spark, sf_dir):
    # the supplier price series used as index bars (no pre_close)
    bars = Research(spark, sf_dir, "lineitem").bars.select(*S.INDEX_DAILY_COLUMNS)
    return QC.violation_rows(bars, "index_daily", ["ts_code", "trade_date"])


# ---------------------------------------------------------------------------
# E3-E5 per-date slices, QC9/QC10 as queries, SK8 logical merge
# ---------------------------------------------------------------------------

from eqlake.plans.catalog import _eval_inputs, _eval_sql  # noqa: E402


def _daily(spark, sf_dir):
    r, factors = _eval_inputs(spark, sf_dir)
    ranked = EV.ranked_pairs(EV.evaluation_pairs(factors, r.labels))
    return EV.daily_metrics(ranked, FX.RETURN_5D.higher_is_better)


@register("daily_rank_ic", _eval_sql("events", "SELECT trade_date, round(rank_ic, 9) AS rank_ic FROM dmet"))
def q_daily_rank_ic(spark, sf_dir):
    return _r(_daily(spark, sf_dir).select("trade_date", "rank_ic"))


@register(
    "quintile_returns",
    _eval_sql("events", "SELECT trade_date, " + ", ".join(f"round(q{k}, 9) AS q{k}" for k in range(1, 6)) + " FROM dmet"),
)
def q_quintile_returns(spark, sf_dir):
    return _r(_daily(spark, sf_dir).select("trade_date", *[f"q{k}" for k in range(1, 6)]))


@register("long_short", _eval_sql("events", "SELECT trade_date, round(long_short, 9) AS long_short FROM dmet"))
def q_long_short(spark, sf_dir):
    return _r(_daily(spark, sf_dir).select("trade_date", "long_short"))


@register(
    "identity_check",
    O.with_panel("lineitem", "SELECT DISTINCT factor_name, factor_version FROM ranked", _PIPE_CTES),
)
def q_identity_check(spark, sf_dir):
    return pipeline_frame(spark, sf_dir).select("factor_name", "factor_version").distinct()


@register(
    "date_subset",
    O.with_panel(
        "lineitem",
        "SELECT DISTINCT trade_date FROM ranked WHERE trade_date NOT IN (SELECT cal_date FROM calw WHERE is_open)",
        _PIPE_CTES,
    ),
)
def q_date_subset(spark, sf_dir):
    """QC10: factor dates that the weekday calendar does not list as open."""
    r = Research(spark, sf_dir, "lineitem")
    open_days = r.calendar_weekdays.filter("is_open").select(F.col("cal_date").alias("trade_date"))
    return QC.dates_not_in(pipeline_frame(spark, sf_dir), open_days)


@register(
    "archive_merge",
    O.with_panel("lineitem", """
SELECT ts_code, trade_date, close FROM (
  SELECT *, row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY seq DESC) AS rn FROM (
    SELECT ts_code, trade_date, close, 0 AS seq FROM ohlcv WHERE year(trade_date) = 1996
    UNION ALL SELECT ts_code, trade_date, high AS close, 1 AS seq FROM ohlcv WHERE year(trade_date) = 1996 AND is_st))
WHERE rn = 1"""),
)
def q_archive_merge(spark, sf_dir):
    """SK8 logical result: an archived year (older) merged with corrected month rows
    (newer; here the supplier-days flagged ``is_st`` re-issued with close = high)."""
    bars = Research(spark, sf_dir, "lineitem").bars.filter(F.year("trade_date") == 1996)
    old = bars.select("ts_code", "trade_date", "close", F.lit(0).alias("_seq"))
    new = bars.filter("is_st").select("ts_code", "trade_date", F.col("high").alias("close"), F.lit(1).alias("_seq"))
    return SK.keep_last(old.unionByName(new), ["ts_code", "trade_date"], "_seq").drop("_seq")
