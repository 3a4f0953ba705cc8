"""Forward-return labels (L1, L2) and calendar offsets.

Label ``forward_return_5d`` = open(T+6) / open(T+1) - 1 where T+k counts open
days of the exchange calendar, not the security's own rows. Instead of two
self joins on (ts_code, T+1) and (ts_code, T+6) the panel gets a calendar index
(broadcast: one row per open day) and reads the two prices with range frames
``rangeBetween(1, 1)`` / ``rangeBetween(6, 6)`` over that index within the
security: a single shuffle by ``ts_code``, and a missing T+k row yields null.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eqlake.functions.stats import finite_or_null
from eqlake.operators.contracts import reject_duplicate_keys, require_columns

# Fixed value: first day of the exchange calendar used for warm-up lookups.
CALENDAR_START = _dt.date(1990, 1, 1)

PRICE_PANEL_COLUMNS = ("ts_code", "trade_date", "hfq_open")
LABEL_COLUMNS = ("ts_code", "trade_date", "forward_return_5d")


def calendar_index(trade_dates: DataFrame, col: str = "trade_date") -> DataFrame:
    """Dense 0-based index of distinct dates in order.

    The input is a calendar (one row per day, about 250 open days a year), so
    the single ordered window is bounded by the date range.
    """
    d = trade_dates.select(F.col(col).alias("trade_date")).distinct()
    return d.withColumn("_cidx", F.row_number().over(Window.orderBy("trade_date")) - 1)


def calendar_offsets(trade_dates: DataFrame, offsets=(1, 6), col: str = "trade_date") -> DataFrame:
    """For each open day the open day ``k`` steps later (null past the end)."""
    d = trade_dates.select(F.col(col).alias("trade_date")).distinct()
    w = Window.orderBy("trade_date")
    out = d
    for k in offsets:
        out = out.withColumn(f"t_plus_{k}", F.lead("trade_date", k).over(w))
    return out


def forward_return_5d(price_panel: DataFrame, trade_dates: DataFrame, *, validate: bool = True, date_col: str = "trade_date") -> DataFrame:
    """L1 with the L2 input checks (columns, unique keys, non-empty unique dates)."""
    require_columns(price_panel, PRICE_PANEL_COLUMNS, "forward-return input")
    if validate:
        reject_duplicate_keys(price_panel, ("ts_code", "trade_date"), "forward-return input")
        stats = trade_dates.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(date_col).alias("nd")).first()
        if stats["n"] == 0:
            raise ValueError("trade_dates must not be empty")
        if stats["n"] != stats["nd"]:
            raise ValueError("trade_dates must be unique")
    cal = calendar_index(trade_dates, date_col)
    p = price_panel.select("ts_code", "trade_date", "hfq_open").join(F.broadcast(cal), "trade_date", "left")
    w = Window.partitionBy("ts_code").orderBy("_cidx")
    entry = F.first("hfq_open").over(w.rangeBetween(1, 1))
    exit_ = F.first("hfq_open").over(w.rangeBetween(6, 6))
    ret = F.when(F.col("_cidx").isNotNull(), finite_or_null(F.try_divide(exit_, entry) - F.lit(1.0)))
    return p.select("ts_code", "trade_date", ret.alias("forward_return_5d"))


def warmup_start_date(open_dates: DataFrame, start_date, lookback_days: int, *, date_col: str = "cal_date"):
    """The ``lookback_days``-th open day before ``start_date`` (``start_date`` for 0).

    Errors when fewer open days exist or ``start_date`` is on/before the calendar
    start. Returns a Python date (a bounded ``limit(n)`` collect).
    """
    if lookback_days == 0:
        return start_date
    if start_date <= CALENDAR_START:
        raise ValueError(f"calendar too short for warm-up: required={lookback_days}, available=0")
    prev = (
        open_dates.filter((F.col(date_col) >= F.lit(CALENDAR_START)) & (F.col(date_col) < F.lit(start_date)))
        .select(date_col)
        .orderBy(F.col(date_col).desc())
        .limit(lookback_days)
        .collect()
    )
    if len(prev) < lookback_days:
        raise ValueError(f"calendar too short for warm-up: required={lookback_days}, available={len(prev)}")
    return prev[-1][0]


def warmup_start_frame(open_dates: DataFrame, start_date, lookback_days: int, *, date_col: str = "cal_date") -> DataFrame:
    """W8 as a one-row DataFrame (``warmup_start``, ``available``) without raising."""
    prev = open_dates.filter(
        (F.col(date_col) >= F.lit(CALENDAR_START)) & (F.col(date_col) < F.lit(start_date))
    ).select(F.col(date_col).alias("d"))
    w = Window.orderBy(F.col("d").desc())
    ranked = prev.withColumn("_k", F.row_number().over(w))
    return ranked.agg(
        F.max(F.when(F.col("_k") == lookback_days, F.col("d"))).alias("warmup_start"),
        F.count(F.lit(1)).alias("available"),
    )
