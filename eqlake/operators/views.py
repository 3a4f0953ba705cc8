"""Price views (J3-J7): unadjusted, back-adjusted (hfq) and forward-adjusted (qfq).

All views are lazy DataFrames over the stored bars and factors. Joins are equi
joins on ``(ts_code, trade_date)`` or ``ts_code``; the physical strategy is left
to Catalyst/AQE (AQE turns the per-security "latest factor" side into a
broadcast at run time when its measured size is under the threshold, so no
unchecked broadcast hint is given here).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eqlake import schemas as S

_PRICES = ("open", "high", "low", "close")
_TAIL = ("volume", "amount", "is_suspended", "is_st", "limit_status")


def hfq_view(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """J3 ``v_daily_hfq``: bars left-joined with factors, prices x factor.

    16 columns; ``pre_close``, ``change``, ``pct_chg`` are not carried. A missing
    factor keeps the row with null adjusted prices.
    """
    f = factors.select("ts_code", "trade_date", "cumulative_factor")
    j = bars.join(f, list(S.DAILY_KEY), "left")
    return j.select(
        "ts_code",
        "trade_date",
        *_PRICES,
        "cumulative_factor",
        *[(F.col(p) * F.col("cumulative_factor")).alias(f"hfq_{p}") for p in _PRICES],
        *_TAIL,
    )


def latest_factors(factors: DataFrame) -> DataFrame:
    """Latest cumulative factor per security (``max_by``: partial aggregation, no sort)."""
    return factors.groupBy("ts_code").agg(
        F.max_by("cumulative_factor", "trade_date").alias("latest_cumulative_factor")
    )


def asof_factors(factors: DataFrame, as_of_date) -> DataFrame:
    """Last factor per security with ``trade_date <= as_of_date`` (J6 generalised to all codes)."""
    return (
        factors.filter(F.col("trade_date") <= F.lit(as_of_date))
        .groupBy("ts_code")
        .agg(F.max_by("cumulative_factor", "trade_date").alias("asof_cumulative_factor"))
    )


def _qfq(bars: DataFrame, factors: DataFrame, ref: DataFrame, ref_col: str, prefix: str) -> DataFrame:
    f = factors.select("ts_code", "trade_date", "cumulative_factor")
    j = bars.join(f, list(S.DAILY_KEY), "left").join(ref, "ts_code", "left")
    adj = [
        F.try_divide(F.col(p) * F.col("cumulative_factor"), F.col(ref_col)).alias(f"{prefix}_{p}") for p in _PRICES
    ]
    return j.select("ts_code", "trade_date", *_PRICES, "cumulative_factor", ref_col, *adj, *_TAIL)


def qfq_latest_view(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """J4 ``v_daily_qfq_latest``: price x factor / latest factor of the security."""
    return _qfq(bars, factors, latest_factors(factors), "latest_cumulative_factor", "qfq")


def adj_alias_view(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """J5 ``v_daily_adj``: the latest-qfq view with legacy ``adj_*`` names."""
    q = qfq_latest_view(bars, factors)
    return q.select(
        "ts_code",
        "trade_date",
        *_PRICES,
        "cumulative_factor",
        *[F.col(f"qfq_{p}").alias(f"adj_{p}") for p in _PRICES],
        *_TAIL,
    )


def qfq_asof_view(bars: DataFrame, factors: DataFrame, start, end, as_of_date=None, ts_codes=None) -> DataFrame:
    """J6 as-of forward adjustment.

    The reference factor is the last one on or before ``as_of_date`` (default:
    ``end``); rows run from ``start`` to ``min(end, as_of_date)`` so no later row
    and no later factor is seen. Empty when that end is before ``start``.
    ``ts_codes`` (optional) restricts the securities; default is all of them.
    """
    as_of = as_of_date or end
    eff_end = min(_as_date(end), _as_date(as_of))
    b = bars.filter(F.col("trade_date").between(F.lit(start), F.lit(eff_end)))
    f = factors
    if ts_codes is not None:
        codes = [ts_codes] if isinstance(ts_codes, str) else list(ts_codes)
        b = b.filter(F.col("ts_code").isin(codes))
        f = f.filter(F.col("ts_code").isin(codes))
    if eff_end < _as_date(start):
        b = b.limit(0)
    return _qfq(b, f, asof_factors(f, as_of), "asof_cumulative_factor", "qfq")


def qfq_ohlcv(bars: DataFrame, factors: DataFrame, start, end, as_of_date=None, ts_codes=None, strict: bool = True) -> DataFrame:
    """J7 notebook variant: open/high/low/close replaced in place by their as-of qfq values.

    With ``strict`` a security that has rows but no as-of factor raises (one
    bounded ``limit(1)`` probe).
    """
    q = qfq_asof_view(bars, factors, start, end, as_of_date, ts_codes)
    if strict:
        missing = q.filter(F.col("asof_cumulative_factor").isNull()).select("ts_code").limit(1).collect()
        if missing:
            raise ValueError(f"no adjustment factor on or before the as-of date for {missing[0][0]}")
    return q.select(
        "ts_code",
        "trade_date",
        *[F.col(f"qfq_{p}").alias(p) for p in _PRICES],
        *[c for c in ("volume", "amount") if c in q.columns],
    )


def _as_date(v):
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))
