"""Dataset normalisers (N1-N8), ST flag (J1) and limit status.

Each normaliser is one projection over the raw all-string frame plus, for
bars, two left joins against the same-day auxiliary lists (keyed by
``(ts_code, trade_date)`` so that many days go through one job). The checks are
columns of the same projection (``checked_*``): per row the failed checks in
their order (parsing and ranges of every raw row, contracts of the rows that
the research-universe filter N5 keeps), and the anomalies of valuations. So a
load parses its raw rows once: it stages the checked rows, adds up the failures
of what it staged, and publishes nothing if there are any. ``normalize_*`` with
``validate=True`` adds them up in one aggregate of its own.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eqlake import schemas as S
from eqlake.functions.parsing import (
    clean_exchange,
    date_invalid,
    float_equal,
    is_missing_string,
    number_invalid,
    parse_is_open,
    parse_number,
    parse_yyyymmdd,
    trimmed,
)
from eqlake.operators.contracts import RULES, require_columns
from eqlake.sources.raw import ETLTask

log = logging.getLogger("eqlake.normalize")

# First trading day of the Beijing exchange; B-share code prefixes.
BJ_EXCHANGE_OPEN_DATE = _dt.date(2021, 11, 15)
B_SHARE_PREFIXES = (("900", ".SH"), ("200", ".SZ"))
# ST lists exist from this date on; before it price loads do not need one.
STOCK_ST_AVAILABLE_START_DATE = _dt.date(2016, 1, 1)

# Valuation fields by their marker for missing values.
VALUATION_MINUS_ONE = ("pe", "pe_ttm")
VALUATION_ZERO_IF_MISSING_OR_NEGATIVE = ("volume_ratio", "dv_ratio", "dv_ttm")
VALUATION_SIZE_FIELDS = ("turnover_rate", "turnover_rate_f", "total_share", "free_share", "float_share", "total_mv", "circ_mv")


# ---------------------------------------------------------------------------
# checks as columns
# ---------------------------------------------------------------------------

#: Columns that a checked frame has besides the normalised ones.
CHECK_COLUMNS = ("_kept", "_failed", "_anomalies")
_FAILED = "array<struct<no: int, message: string, value: string>>"


def failed_checks(checks: Sequence[tuple[str, Column, Column]], first: int = 0) -> Column:
    """The checks (message, failing-row predicate, value to show) that a row fails, in order."""
    each = [
        F.when(F.coalesce(pred, F.lit(False)), F.struct(F.lit(first + i).alias("no"), F.lit(msg).alias("message"), value.cast("string").alias("value")))
        for i, (msg, pred, value) in enumerate(checks)
    ]
    return F.array_compact(F.array(*each)).cast(_FAILED) if each else F.expr(f"cast(array() as {_FAILED})")


def contract_checks(kind: str, label: str) -> list[tuple[str, Column, Column]]:
    shown = F.concat_ws(", ", F.concat(F.lit("ts_code="), F.col("ts_code")), F.concat(F.lit("trade_date="), F.col("trade_date").cast("string")))
    return [(f"{label} contract check failed: {name}", cond, shown) for name, cond in RULES[kind]()]


@dataclass(frozen=True)
class CheckReport:
    """Failures and anomalies of a checked frame: (message or field, rows, up to three samples) each."""

    rows: int
    failures: tuple[tuple[str, int, tuple[str, ...]], ...]
    anomalies: tuple[tuple[str, int, tuple[str, ...]], ...]

    def raise_failures(self) -> None:
        if self.failures:
            message, n, samples = self.failures[0]
            raise ValueError(f"{message}: {list(samples)} ({n} rows)")


def check_report(checked: DataFrame) -> CheckReport:
    """Count the kept rows, failures and anomalies of a checked frame in one aggregate: as many rows
    as there are checks reach the driver. Samples are the least, the largest and any value."""
    code = F.col("ts_code") if "ts_code" in checked.columns else F.lit(None).cast("string")

    def event(kind: str, no, message, value) -> Column:
        return F.struct(F.lit(kind).alias("kind"), no.alias("no"), message.alias("message"), value.alias("value"))

    kept = F.array(event("kept", F.lit(0), F.lit(""), F.lit(None).cast("string")))
    events = F.concat(
        F.when(F.col("_kept"), kept).otherwise(F.slice(kept, 1, 0)),
        F.transform("_failed", lambda x: event("failed", x["no"], x["message"], x["value"])),
        F.transform("_anomalies", lambda x: event("anomaly", F.lit(0), x, code)),
    )
    each = checked.select(F.explode(events).alias("x")).select("x.*")
    value = F.col("value")
    counts = each.groupBy("kind", "no", "message").agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("v1"), F.any_value(value, True).alias("v2"), F.max(value).alias("v3")
    )
    found = sorted(counts.collect(), key=lambda r: (r["kind"], r["no"], r["message"]))

    def named(kind: str) -> tuple[tuple[str, int, tuple[str, ...]], ...]:
        samples = lambda r: tuple(sorted({v for v in (r["v1"], r["v2"], r["v3"]) if v is not None}))
        return tuple((r["message"], r["n"], samples(r)) for r in found if r["kind"] == kind)

    return CheckReport(sum(r["n"] for r in found if r["kind"] == "kept"), named("failed"), named("anomaly"))


def normalised(checked: DataFrame, validate: bool | str) -> DataFrame:
    """The kept rows of a checked frame; with ``validate`` any failure is an error, with
    ``"report"`` it is logged and the rows stay."""
    if validate:
        report = check_report(checked)
        if validate == "report":
            for message, n, samples in report.failures:
                log.error("%s: %s (%d rows)", message, list(samples), n)
        else:
            report.raise_failures()
    return checked.where("_kept").drop(*CHECK_COLUMNS)


def _no_anomalies() -> Column:
    return F.expr("cast(array() as array<string>)").alias("_anomalies")


def _place(raw: DataFrame) -> list[str]:
    return ["_position"] if "_position" in raw.columns else []


# ---------------------------------------------------------------------------
# N5 research universe
# ---------------------------------------------------------------------------


def _as_date(c: Column, dtype) -> Column:
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    s = trimmed(c)
    return F.coalesce(F.try_to_date(s, "yyyyMMdd"), F.try_to_date(s, "yyyy-MM-dd"))


def research_universe_mask(df: DataFrame, date_column: str = "trade_date") -> Column:
    """True for rows N5 removes: B shares, and BJ codes before the BJ opening day."""
    code = trimmed("ts_code")
    d = _as_date(F.col(date_column), df.schema[date_column].dataType)
    b = F.lit(False)
    for prefix, suffix in B_SHARE_PREFIXES:
        b = b | (code.startswith(prefix) & code.endswith(suffix))
    bj = code.endswith(".BJ") & (d < F.lit(BJ_EXCHANGE_OPEN_DATE))
    return F.coalesce(b, F.lit(False)) | F.coalesce(bj, F.lit(False))


def filter_research_universe(df: DataFrame, date_column: str = "trade_date") -> DataFrame:
    """N5. A frame without ``ts_code`` passes through; a missing date column is an error;
    an unparseable date keeps the row."""
    if "ts_code" not in df.columns:
        return df
    if date_column not in df.columns:
        raise ValueError(f"research-universe filter needs the date column: {date_column}")
    return df.filter(~research_universe_mask(df, date_column))


# ---------------------------------------------------------------------------
# N1 calendar
# ---------------------------------------------------------------------------


def checked_trade_calendar(raw: DataFrame) -> DataFrame:
    require_columns(raw, ["cal_date", "is_open"], "trade-calendar raw")
    exch = clean_exchange("exchange") if "exchange" in raw.columns else F.lit("SSE")
    before = "pretrade_date" in raw.columns
    checks = [
        ("invalid date in cal_date", date_invalid("cal_date"), trimmed("cal_date")),
        ("is_open must not be empty", is_missing_string("is_open"), F.col("is_open")),
        ("is_open must be 0 or 1", ~is_missing_string("is_open") & parse_is_open("is_open").isNull(), trimmed("is_open")),
    ]
    if before:
        checks.append(("invalid date in pretrade_date", date_invalid("pretrade_date", required=False), trimmed("pretrade_date")))
    return raw.select(
        exch.alias("exchange"),
        parse_yyyymmdd("cal_date").alias("cal_date"),
        parse_is_open("is_open").alias("is_open"),
        (parse_yyyymmdd("pretrade_date") if before else F.lit(None).cast("date")).alias("pretrade_date"),
        F.lit(True).alias("_kept"), failed_checks(checks).alias("_failed"), _no_anomalies(),
    )


def normalize_trade_calendar(raw: DataFrame, task: ETLTask | None = None, *, validate: bool = True) -> DataFrame:
    return normalised(checked_trade_calendar(raw), validate)


# ---------------------------------------------------------------------------
# J1 / J2 auxiliary joins
# ---------------------------------------------------------------------------


def st_flags(stock_st: DataFrame | None) -> DataFrame | None:
    """Distinct (ts_code, trade_date) of the ST lists after N5."""
    if stock_st is None or "ts_code" not in stock_st.columns:
        return None
    st = filter_research_universe(stock_st)
    return (
        st.select(trimmed("ts_code").alias("ts_code"), parse_yyyymmdd("trade_date").alias("trade_date"))
        .filter(F.col("ts_code").isNotNull())
        .distinct()
        .withColumn("_st", F.lit(True))
    )


def limit_prices(stk_limit: DataFrame | None) -> DataFrame | None:
    """Limit list after N5; numbers parsed leniently (bad text -> null); the last row per
    (code, day) wins, in the order of the files where the frame carries ``_position``."""
    if stk_limit is None:
        return None
    require_columns(stk_limit, ["ts_code", "up_limit", "down_limit"], "stk-limit raw")
    order = F.col("_position") if _place(stk_limit) else F.monotonically_increasing_id()
    lim = filter_research_universe(stk_limit.withColumn("_seq", order))
    lim = lim.select(
        trimmed("ts_code").alias("ts_code"),
        parse_yyyymmdd("trade_date").alias("trade_date"),
        parse_number("up_limit").alias("up_limit"),
        parse_number("down_limit").alias("down_limit"),
        "_seq",
    )
    # ``_seq`` is unique per row, so both max_by pick the same (last) row.
    return lim.groupBy("ts_code", "trade_date").agg(
        F.max_by("up_limit", "_seq").alias("up_limit"), F.max_by("down_limit", "_seq").alias("down_limit")
    )


def limit_status(open_col: Column, close_col: Column, up: Column | None, down: Column | None) -> Column:
    """0 flat / 1 up / 3 down by close vs open; close at up limit -> 2, at down
    limit -> 4 (down wins when both match)."""
    base = F.when(close_col > open_col, 1).when(close_col < open_col, 3).otherwise(0)
    if up is None:
        return base.cast("long")
    return F.when(float_equal(close_col, down), 4).when(float_equal(close_col, up), 2).otherwise(base).cast("long")


# ---------------------------------------------------------------------------
# N2 bars, N3 factors, N4 valuation
# ---------------------------------------------------------------------------


def _range_check(task: ETLTask | None, label: str):
    if task is None:
        return []
    d = parse_yyyymmdd("trade_date")
    return [(f"{label} raw trade_date outside the task range", (d < F.lit(task.start_date)) | (d > F.lit(task.end_date)), d)]


def checked_daily_ohlcv(raw: DataFrame, task: ETLTask | None = None, *, stock_st: DataFrame | None = None,
                        stk_limit: DataFrame | None = None) -> DataFrame:
    """N2 of every raw row, with its failed checks."""
    require_columns(raw, S.RAW_DAILY_OHLCV_REQUIRED, "daily-ohlcv raw")
    optional = [c for c in ("pre_close", "change", "pct_chg") if c in raw.columns]
    checks = [("invalid date in trade_date", date_invalid("trade_date"), trimmed("trade_date"))]
    checks += _range_check(task, "daily-ohlcv")
    checks += [(f"invalid number in {c}", number_invalid(c), trimmed(c)) for c in ("open", "high", "low", "close", "amount", "vol")]
    checks += [(f"invalid number in {c}", number_invalid(c, required=False), trimmed(c)) for c in optional]
    bars = raw.select(
        trimmed("ts_code").alias("ts_code"),
        parse_yyyymmdd("trade_date").alias("trade_date"),
        *[parse_number(c).alias(c) for c in ("open", "high", "low", "close")],
        *[(parse_number(c) if c in optional else F.lit(None).cast("double")).alias(c) for c in ("pre_close", "change", "pct_chg")],
        parse_number("vol").alias("volume"),
        parse_number("amount").alias("amount"),
        failed_checks(checks).alias("_raw_failed"),
        *_place(raw),
    )
    bars = bars.withColumn("_kept", ~research_universe_mask(bars))
    st = st_flags(stock_st)
    is_st = F.lit(False)
    if st is not None:
        bars = bars.join(st, ["ts_code", "trade_date"], "left")
        is_st = F.coalesce(F.col("_st"), F.lit(False))
    lim = limit_prices(stk_limit)
    status = limit_status(F.col("open"), F.col("close"), None, None)
    if lim is not None:
        bars = bars.join(lim, ["ts_code", "trade_date"], "left")
        status = limit_status(F.col("open"), F.col("close"), F.col("up_limit"), F.col("down_limit"))
    out = bars.select(
        "ts_code", "trade_date", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "volume", "amount",
        F.lit(False).alias("is_suspended"), is_st.alias("is_st"), status.alias("limit_status"), "_kept", "_raw_failed", *_place(raw),
    )
    return _with_contract(out, "ohlcv", "daily bar", len(checks))


def _with_contract(df: DataFrame, kind: str, label: str, first: int, anomalies: Column | None = None) -> DataFrame:
    """Failed checks of the raw row, then of the record's contract if the row is kept."""
    own = F.when(F.col("_kept"), failed_checks(contract_checks(kind, label), first)).otherwise(F.expr(f"cast(array() as {_FAILED})"))
    return df.select("*", F.concat("_raw_failed", own).alias("_failed"), anomalies if anomalies is not None else _no_anomalies()).drop("_raw_failed")


def normalize_daily_ohlcv(raw: DataFrame, task: ETLTask | None = None, *, stock_st: DataFrame | None = None,
                          stk_limit: DataFrame | None = None, validate: bool | str = True) -> DataFrame:
    """N2."""
    return normalised(checked_daily_ohlcv(raw, task, stock_st=stock_st, stk_limit=stk_limit), validate)


def checked_adj_factor(raw: DataFrame, task: ETLTask | None = None) -> DataFrame:
    require_columns(raw, S.RAW_ADJ_FACTOR_COLUMNS, "adj-factor raw")
    checks = [("invalid date in trade_date", date_invalid("trade_date"), trimmed("trade_date"))]
    checks += _range_check(task, "adj-factor")
    checks.append(("invalid number in adj_factor", number_invalid("adj_factor"), trimmed("adj_factor")))
    out = raw.select(
        trimmed("ts_code").alias("ts_code"),
        parse_yyyymmdd("trade_date").alias("trade_date"),
        parse_number("adj_factor").alias("cumulative_factor"),
        failed_checks(checks).alias("_raw_failed"),
        *_place(raw),
    )
    return _with_contract(out.withColumn("_kept", ~research_universe_mask(out)), "adj_factor", "adjustment factor", len(checks))


def normalize_adj_factor(raw: DataFrame, task: ETLTask | None = None, *, validate: bool = True) -> DataFrame:
    """N3."""
    return normalised(checked_adj_factor(raw, task), validate)


def checked_daily_basic(raw: DataFrame, task: ETLTask | None = None, *, apply_markers: bool = True) -> DataFrame:
    """N4 of every raw row, with its failed checks and the size fields that were missing or not above zero."""
    require_columns(raw, S.RAW_DAILY_BASIC_REQUIRED, "daily-basic raw")
    fields = S.DAILY_BASIC_COLUMNS[2:]
    checks = [("invalid date in trade_date", date_invalid("trade_date"), trimmed("trade_date"))]
    checks += _range_check(task, "daily-basic")
    checks += [(f"invalid number in {c}", number_invalid(c, required=False), trimmed(c)) for c in fields if c in raw.columns]
    parsed = raw.select(
        trimmed("ts_code").alias("ts_code"),
        parse_yyyymmdd("trade_date").alias("trade_date"),
        *[(parse_number(c) if c in raw.columns else F.lit(None).cast("double")).alias(c) for c in fields],
        failed_checks(checks).alias("_raw_failed"),
        *_place(raw),
    )
    parsed = parsed.withColumn("_kept", ~research_universe_mask(parsed))
    odd = F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.col(c) <= 0), F.lit(c)) for c in VALUATION_SIZE_FIELDS]))
    parsed = parsed.withColumn("_odd", F.when(F.col("_kept"), odd).otherwise(F.slice(odd, 1, 0)))
    cols = []
    for c in fields if apply_markers else ():
        x = F.col(c)
        if c in VALUATION_MINUS_ONE:
            cols.append(F.coalesce(x, F.lit(-1.0)).alias(c))
        elif c in VALUATION_ZERO_IF_MISSING_OR_NEGATIVE:
            cols.append(F.when(x.isNull() | (x < 0), F.lit(0.0)).otherwise(x).alias(c))
        elif c in VALUATION_SIZE_FIELDS:
            cols.append(F.when(x.isNull() | (x <= 0), F.lit(0.0)).otherwise(x).alias(c))
        else:
            cols.append(x)
    out = parsed.select("ts_code", "trade_date", *(cols or fields), "_kept", "_raw_failed", "_odd", *_place(raw))
    return _with_contract(out, "daily_basic", "daily valuation", len(checks), F.col("_odd").alias("_anomalies")).drop("_odd")


def normalize_daily_basic(raw: DataFrame, task: ETLTask | None = None, *, validate: bool = True, apply_markers: bool = True) -> DataFrame:
    """N4 with the vendor markers: pe/pe_ttm missing -> -1; volume_ratio, dv_ratio,
    dv_ttm missing or negative -> 0; the seven size fields missing or <= 0 -> 0
    (anomalies of the report); close/pb/ps/ps_ttm stay null."""
    return normalised(checked_daily_basic(raw, task, apply_markers=apply_markers), validate)


def daily_basic_anomalies(raw: DataFrame) -> DataFrame:
    """Count of size-field anomalies (missing or <= 0) per field, after N5: one row per field."""
    parsed = raw.select(
        trimmed("ts_code").alias("ts_code"), parse_yyyymmdd("trade_date").alias("trade_date"),
        *[(parse_number(c) if c in raw.columns else F.lit(None).cast("double")).alias(c) for c in VALUATION_SIZE_FIELDS],
    )
    parsed = filter_research_universe(parsed)
    agg = parsed.agg(*[F.count_if(F.col(c).isNull() | (F.col(c) <= 0)).alias(c) for c in VALUATION_SIZE_FIELDS])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("anomaly_count")) for c in VALUATION_SIZE_FIELDS]))
    return agg.select(stacked.alias("_a")).select("_a.field", "_a.anomaly_count")


# ---------------------------------------------------------------------------
# N6 securities, N7 calendar load helpers
# ---------------------------------------------------------------------------


def normalize_stock_basic(raw: DataFrame) -> DataFrame:
    """All 17 columns required, projected as strings; no type parsing."""
    require_columns(raw, S.SECURITY_COLUMNS, "stock-basic raw")
    return raw.select(*[F.col(c).cast("string") for c in S.SECURITY_COLUMNS])


def clip_calendar(cal: DataFrame, task: ETLTask) -> DataFrame:
    """Calendar rows inside the task range."""
    return cal.filter(F.col("cal_date").between(F.lit(task.start_date), F.lit(task.end_date)))
