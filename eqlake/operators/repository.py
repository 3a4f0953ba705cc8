"""Read API (Q1-Q8): projection + filter over the views; ordering only at the edge.

Every function takes the relevant DataFrames (normally the store's views) and
returns a lazy DataFrame. Column names are checked against a whitelist
(QC11) and never spliced into SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.operators import views
from eqlake.operators.contracts import validate_fields, validate_panel_fields

ADJUSTMENTS = ("none", "hfq", "qfq")


def _mode(adjustment: str, adjusted: bool | None) -> str:
    if adjusted is not None:
        adjustment = "qfq" if adjusted else "none"
    if adjustment not in ADJUSTMENTS:
        raise ValueError(f"unsupported adjustment mode: {adjustment}")
    return adjustment


def daily_bars(bars, factors, ts_code, start, end, *, adjustment="none", as_of_date=None, adjusted=None) -> DataFrame:
    """Q1 bars of one security in ``none``/``hfq``/``qfq`` mode (qfq is as-of, J6).

    ``ts_code`` may also be a list of codes, or ``None`` for every security.
    """
    mode = _mode(adjustment, adjusted)
    codes = None if ts_code is None else ([ts_code] if isinstance(ts_code, str) else list(ts_code))
    if mode == "qfq":
        out = views.qfq_asof_view(bars, factors, start, end, as_of_date, ts_codes=codes)
    else:
        src = bars if mode == "none" else views.hfq_view(bars, factors)
        out = src.filter(F.col("trade_date").between(F.lit(start), F.lit(end)))
        if codes is not None:
            out = out.filter(F.col("ts_code").isin(codes))
    return out.orderBy("ts_code", "trade_date")


def daily_panel(bars, factors, start, end, fields: Sequence[str], *, adjustment="hfq", order: bool = False) -> DataFrame:
    """Q2 whole-market panel: keys + requested fields, ``trade_date`` in range.

    Only ``none`` and ``hfq``; qfq is refused because a research panel must not
    look ahead. Keys are always included and never repeated.
    """
    if adjustment not in ("none", "hfq"):
        raise ValueError(f"research panels do not support adjustment={adjustment}")
    requested = validate_panel_fields(fields, adjustment)
    selected = list(dict.fromkeys(["ts_code", "trade_date", *requested]))
    src = bars if adjustment == "none" else views.hfq_view(bars, factors)
    out = src.filter(F.col("trade_date").between(F.lit(start), F.lit(end))).select(*selected)
    return out.orderBy("ts_code", "trade_date") if order else out


def cross_section(bars, trade_date, fields: Sequence[str] = S.DEFAULT_CROSS_SECTION_FIELDS, *, exclude_suspended=False) -> DataFrame:
    """Q3 one date, chosen fields; ``exclude_suspended`` keeps ``is_suspended = false`` only."""
    cols = validate_fields(fields)
    out = bars.filter(F.col("trade_date") == F.lit(trade_date))
    if exclude_suspended:
        out = out.filter(F.col("is_suspended") == F.lit(False))
    return out.select(*cols).orderBy("ts_code")


def factors_on_date(factors, trade_date, factor_names: Sequence[str], *, factor_version=None) -> DataFrame:
    """Q4 factors of one date for a list of names (and optionally one version)."""
    names = list(factor_names)
    if not names:
        raise ValueError("factor_names must not be empty")
    out = factors.filter((F.col("trade_date") == F.lit(trade_date)) & F.col("factor_name").isin(names))
    if factor_version is not None:
        out = out.filter(F.col("factor_version") == factor_version)
    return out.select(*S.FACTOR_COLUMNS).orderBy("ts_code", "factor_name")


def factor_panel(factors, start, end, factor_name, *, factor_version="v1", order: bool = False) -> DataFrame:
    """Q5 one factor (name + version) over a date range, long format."""
    out = factors.filter(
        F.col("trade_date").between(F.lit(start), F.lit(end))
        & (F.col("factor_name") == factor_name)
        & (F.col("factor_version") == factor_version)
    ).select(*S.FACTOR_COLUMNS)
    return out.orderBy("ts_code", "trade_date") if order else out


def trade_calendar(calendar, start, end, *, exchange="SSE") -> DataFrame:
    """Q6 calendar rows of one exchange, by date."""
    return (
        calendar.filter((F.col("exchange") == exchange) & F.col("cal_date").between(F.lit(start), F.lit(end)))
        .select(*S.TRADE_CALENDAR_COLUMNS)
        .orderBy("cal_date")
    )


def open_trade_dates(calendar, start, end, *, exchange="SSE") -> DataFrame:
    """Q7 open days (one column ``cal_date``) of one exchange, by date."""
    return (
        calendar.filter(
            (F.col("exchange") == exchange) & F.col("is_open") & F.col("cal_date").between(F.lit(start), F.lit(end))
        )
        .select("cal_date")
        .orderBy("cal_date")
    )


def open_trade_date_list(calendar, start, end, *, exchange="SSE") -> list:
    """Q7 as a Python list. The calendar has about 250 open days a year, so this
    collect is bounded by the date range, not by data volume."""
    return [r[0] for r in open_trade_dates(calendar, start, end, exchange=exchange).collect()]


def first_row(df: DataFrame, order_cols, *, descending: bool = True) -> DataFrame:
    """Q8 ``ORDER BY ... LIMIT 1`` (a top-1; Spark plans it as TakeOrderedAndProject)."""
    cols = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    return df.orderBy(*cols).limit(1)
