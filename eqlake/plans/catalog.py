"""Query catalogue: each entry is a Spark query (spark, sf_dir) -> DataFrame and,
where SQL can express it, the DuckDB oracle SQL of the same result.

Column names match between the two sides. Aggregated doubles are rounded to
``DIGITS`` decimals on both sides, since summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.functions.stats import round_doubles
from eqlake.operators import evaluation as EV
from eqlake.operators import factors as FX
from eqlake.plans import oracle as O
from eqlake.plans.research import Research

DIGITS = 9

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _r(df: DataFrame) -> DataFrame:
    return round_doubles(df, DIGITS)


def _rsql(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"round({c}, {DIGITS}) AS {c}" if c in doubles else c for c in cols)


# ---------------------------------------------------------------------------
# Panel and views
# ---------------------------------------------------------------------------

_OHLCV_COLS = "ts_code, trade_date, open, high, low, close, pre_close, change, pct_chg, volume, amount, is_suspended, is_st, limit_status"


@register("daily_panel", O.with_panel("events", f"SELECT {_OHLCV_COLS} FROM ohlcv"))
def q_daily_panel(spark, sf_dir):
    return Research(spark, sf_dir).bars


@register("adj_factors", O.with_panel("events", "SELECT ts_code, trade_date, cumulative_factor FROM adj"))
def q_adj_factors(spark, sf_dir):
    return Research(spark, sf_dir).adj


@register("hfq_view", O.with_panel("events", "SELECT * FROM hfq"))
def q_hfq_view(spark, sf_dir):
    return Research(spark, sf_dir).hfq


@register("lineitem_hfq_view", O.with_panel("lineitem", "SELECT * FROM hfq"))
def q_lineitem_hfq_view(spark, sf_dir):
    return Research(spark, sf_dir, "lineitem").hfq


# ---------------------------------------------------------------------------
# Factors and processors
# ---------------------------------------------------------------------------

_CALC_COLS = ["ts_code", "trade_date", "factor_name", "factor_value", "factor_version", "raw_value"]


@register(
    "return_5d",
    O.with_panel("events", "SELECT ts_code, trade_date, factor_name, raw_value AS factor_value, factor_version, raw_value FROM calc",
                 O.return_5d_cte()),
)
def q_return_5d(spark, sf_dir):
    return Research(spark, sf_dir).calc()


_PROC_SELECT = (
    "SELECT ts_code, trade_date, factor_name, round({fv}, 9) AS factor_value, factor_version, round(raw_value, 9) AS raw_value, "
    "round({pv}, 9) AS processed_value, quality_status FROM ranked"
)


@register(
    "processor_raw",
    O.with_panel("events", _PROC_SELECT.format(fv="vr", pv="CAST(NULL AS DOUBLE)"), O.return_5d_cte() + "," + O.processed_cte()),
)
def q_processor_raw(spark, sf_dir):
    return _r(Research(spark, sf_dir).processed(processor="raw"))


@register(
    "processor_rank_pct",
    O.with_panel("events", _PROC_SELECT.format(fv="pct", pv="pct"), O.return_5d_cte() + "," + O.processed_cte()),
)
def q_processor_rank_pct(spark, sf_dir):
    return _r(Research(spark, sf_dir).processed(processor="rank_pct"))


@register(
    "quality_status",
    O.with_panel("events", "SELECT quality_status, count(*) AS n_rows FROM qual GROUP BY quality_status",
                 O.return_5d_cte() + "," + O.processed_cte()),
)
def q_quality_status(spark, sf_dir):
    p = Research(spark, sf_dir).processed(processor="raw")
    return p.groupBy("quality_status").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# Labels (L1) and evaluation
# ---------------------------------------------------------------------------


@register("forward_return_5d", O.with_panel("events", "SELECT * FROM labels", O.labels_cte()))
def q_forward_return_5d(spark, sf_dir):
    return Research(spark, sf_dir).labels


@register("lineitem_forward_return_5d", O.with_panel("lineitem", "SELECT * FROM labels", O.labels_cte()))
def q_lineitem_forward_return_5d(spark, sf_dir):
    return Research(spark, sf_dir, "lineitem").labels


def _factor_frame_sql():
    return O.return_5d_cte() + "," + O.processed_cte() + """,
factors AS (SELECT ts_code, trade_date, factor_name, vr AS factor_value, factor_version FROM ranked)"""


def _eval_sql(panel: str, body: str) -> str:
    ctes = O.labels_cte() + "," + _factor_frame_sql() + "," + O.evaluation_ctes("factors", "labels", False)
    return O.with_panel(panel, body, ctes)


def _eval_inputs(spark, sf_dir, panel="events"):
    r = Research(spark, sf_dir, panel)
    factors = r.processed(processor="raw").select(*EV.FACTOR_COLUMNS)
    return r, factors


_DAILY_COLS = ["trade_date", "ic", "rank_ic", "n_pairs", "q1", "q2", "q3", "q4", "q5", "long_short"]


@register("daily_ic", _eval_sql("events", "SELECT " + _rsql(_DAILY_COLS, set(_DAILY_COLS) - {"trade_date", "n_pairs"}) + " FROM dmet"))
def q_daily_ic(spark, sf_dir):
    r, factors = _eval_inputs(spark, sf_dir)
    ranked = EV.ranked_pairs(EV.evaluation_pairs(factors, r.labels))
    return _r(EV.daily_metrics(ranked, FX.RETURN_5D.higher_is_better).select(*_DAILY_COLS))


_SUMMARY_SQL = """
SELECT round(avg(ic), 9) AS ic_5d_mean, round(avg(rank_ic), 9) AS rank_ic_5d_mean,
       round(stddev_samp(rank_ic), 9) AS rank_ic_5d_std, count(rank_ic) AS rank_ic_5d_count,
       round(avg(CASE WHEN rank_ic > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE, 9) AS positive_ic_ratio,
       round(avg(q1), 9) AS q1_return, round(avg(q2), 9) AS q2_return, round(avg(q3), 9) AS q3_return,
       round(avg(q4), 9) AS q4_return, round(avg(q5), 9) AS q5_return, round(avg(long_short), 9) AS long_short_return,
       round(CASE WHEN min(rank_ic) < max(rank_ic) THEN avg(rank_ic) / stddev_samp(rank_ic) END, 9) AS ic_ir
FROM dmet"""


@register("ic_summary", _eval_sql("events", _SUMMARY_SQL))
def q_ic_summary(spark, sf_dir):
    r, factors = _eval_inputs(spark, sf_dir)
    ranked = EV.ranked_pairs(EV.evaluation_pairs(factors, r.labels))
    return _r(EV.ic_summary(EV.daily_metrics(ranked, False)))


@register("turnover", _eval_sql("events", "SELECT trade_date, round(turnover, 9) AS turnover FROM turn"))
def q_turnover(spark, sf_dir):
    r, factors = _eval_inputs(spark, sf_dir)
    ranked = EV.ranked_pairs(EV.evaluation_pairs(factors, r.labels))
    return _r(EV.turnover_by_date(ranked, EV.daily_metrics(ranked, False), False))


@register("factor_autocorr", _eval_sql("events", "SELECT trade_date, round(autocorr, 9) AS autocorr FROM acorr"))
def q_factor_autocorr(spark, sf_dir):
    _, factors = _eval_inputs(spark, sf_dir)
    return _r(EV.autocorr_by_date(factors))


_REPORT_SQL = """
SELECT 'return_5d' AS factor_name, 'v1' AS factor_version,
  (SELECT min(trade_date) FROM hfq) AS start_date, (SELECT max(trade_date) FROM hfq) AS end_date,
  (SELECT count(*) FROM factors) AS row_count,
  (SELECT count(DISTINCT trade_date) FROM factors) AS trade_date_count,
  (SELECT count(DISTINCT ts_code) FROM factors) AS security_count,
  (SELECT round(1 - count(fv)::DOUBLE / count(*)::DOUBLE, 9) FROM fc) AS missing_value_rate,
  (SELECT round(avg(fv), 9) FROM fc) AS mean, (SELECT round(stddev_samp(fv), 9) FROM fc) AS std,
  (SELECT round(min(fv), 9) FROM fc) AS min,
  (SELECT round(quantile_cont(fv, 0.25), 9) FROM fc WHERE fv IS NOT NULL) AS p25,
  (SELECT round(quantile_cont(fv, 0.5), 9) FROM fc WHERE fv IS NOT NULL) AS median,
  (SELECT round(quantile_cont(fv, 0.75), 9) FROM fc WHERE fv IS NOT NULL) AS p75,
  (SELECT round(max(fv), 9) FROM fc) AS max,
  s.*,
  (SELECT round(avg(turnover), 9) FROM turn) AS turnover,
  (SELECT round(avg(autocorr), 9) FROM acorr) AS factor_autocorr_1d
FROM (""" + _SUMMARY_SQL + """) s"""


def _report(spark, sf_dir, panel):
    r, factors = _eval_inputs(spark, sf_dir, panel)
    rep = EV.validate_factor(factors, r.labels, r.universe, FX.RETURN_5D, check_inputs=False, with_coverage=False)
    return _r(rep)


@register("factor_report", _eval_sql("events", _REPORT_SQL))
def q_factor_report(spark, sf_dir):
    return _report(spark, sf_dir, "events")


@register("lineitem_factor_report", _eval_sql("lineitem", _REPORT_SQL))
def q_lineitem_factor_report(spark, sf_dir):
    return _report(spark, sf_dir, "lineitem")


@register(
    "coverage_by_date",
    _eval_sql(
        "events",
        """SELECT u.trade_date, count(*) AS universe_count, count(f.fv) AS valid_count,
                  round(count(f.fv)::DOUBLE / count(*)::DOUBLE, 9) AS coverage
           FROM hfq u LEFT JOIN fc f ON f.ts_code = u.ts_code AND f.trade_date = u.trade_date
           GROUP BY u.trade_date""",
    ),
)
def q_coverage_by_date(spark, sf_dir):
    r, factors = _eval_inputs(spark, sf_dir)
    return _r(EV.coverage_by_date(factors, r.universe))


# Part 2 registers into the same dictionaries.
from eqlake.plans import catalog_more  # noqa: E402,F401
from eqlake.plans import catalog_store  # noqa: E402,F401
