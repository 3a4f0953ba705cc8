"""Data-quality contracts (QC1-QC11) as column expressions.

Each record contract is an array column of violated rule names, built from
plain ``when`` expressions (no Python per row). ``violations(df, kind)`` adds it;
``enforce`` raises with the first three offending rows (one bounded ``limit(3)``
action). The set-level checks (duplicate keys, identity, date subsets) are
bounded probes (``limit(1)``/``limit(2)``) on a distributed plan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.functions.parsing import ts_code_valid

IDENTIFIER_PATTERN = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


# ---------------------------------------------------------------------------
# QC11 identifier checks
# ---------------------------------------------------------------------------


def validate_identifier(value: str) -> str:
    if not IDENTIFIER_PATTERN.fullmatch(value or ""):
        raise ValueError(f"invalid identifier: {value!r}")
    return value


def validate_fields(fields: Sequence[str]) -> list[str]:
    fields = list(fields)
    if not fields:
        raise ValueError("fields must not be empty")
    bad = [f for f in fields if not IDENTIFIER_PATTERN.fullmatch(f)]
    if bad:
        raise ValueError(f"invalid field names: {bad}")
    return fields


def validate_panel_fields(fields: Sequence[str], adjustment: str) -> list[str]:
    checked = validate_fields(fields)
    allowed = S.DAILY_OHLCV_COLUMNS if adjustment == "none" else S.HFQ_PANEL_FIELDS
    bad = [f for f in checked if f not in allowed]
    if bad:
        raise ValueError(f"panel fields not available for adjustment={adjustment}: {bad}")
    return checked


# ---------------------------------------------------------------------------
# QC1 column presence
# ---------------------------------------------------------------------------


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "frame") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{label} is missing columns: {missing}")


# ---------------------------------------------------------------------------
# QC2-QC6 record contracts
# ---------------------------------------------------------------------------


def _missing(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(F.col(c))


def _present(c: str) -> Column:
    return ~_missing(c)


def _rules_ohlcv() -> list[tuple[str, Column]]:
    susp = F.coalesce(F.col("is_suspended"), F.lit(False))
    ls = F.col("limit_status")
    required = ("open", "high", "low", "close", "volume", "amount")
    any_missing = F.lit(False)
    for c in required:
        any_missing = any_missing | _missing(c)
    active = ~susp
    full = active & ~any_missing
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    rules = [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("trade_date_missing", F.col("trade_date").isNull()),
        ("limit_status_domain", ls.isNull() | ~ls.isin(-1, 0, 1, 2, 3, 4)),
        ("suspended_limit_status", susp & (ls != -1)),
        ("active_limit_status", active & (ls == -1)),
    ]
    rules += [(f"{x}_missing", active & _missing(x)) for x in required]
    rules += [
        ("price_not_positive", full & (F.least(o, h, l, c) <= 0)),
        ("volume_amount_negative", full & ((F.col("volume") < 0) | (F.col("amount") < 0))),
        ("high_below_low", full & (h < l)),
        ("open_outside_range", full & ((o < l) | (o > h))),
        ("close_outside_range", full & ((c < l) | (c > h))),
    ]
    return rules


def _rules_adj_factor() -> list[tuple[str, Column]]:
    cf = F.col("cumulative_factor")
    return [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("trade_date_missing", F.col("trade_date").isNull()),
        ("cumulative_factor_not_positive", cf.isNull() | F.isnan(cf) | (cf <= 0)),
    ]


# Valuation fields that may not be negative.
DAILY_BASIC_NON_NEGATIVE = (
    "close", "turnover_rate", "turnover_rate_f", "volume_ratio", "dv_ratio", "dv_ttm", "total_share",
    "float_share", "free_share", "total_mv", "circ_mv",
)


def _rules_daily_basic() -> list[tuple[str, Column]]:
    rules = [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("trade_date_missing", F.col("trade_date").isNull()),
    ]
    rules += [(f"{c}_negative", _present(c) & (F.col(c) < 0)) for c in DAILY_BASIC_NON_NEGATIVE]
    return rules


def _rules_index_daily() -> list[tuple[str, Column]]:
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    anym = F.lit(False)
    for x in ("open", "high", "low", "close", "volume", "amount"):
        anym = anym | _missing(x)
    return [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("trade_date_missing", F.col("trade_date").isNull()),
        ("required_missing", anym),
        ("price_not_positive", ~anym & (F.least(o, h, l, c) <= 0)),
        ("high_below_low", ~anym & (h < l)),
        ("open_outside_range", ~anym & ((o < l) | (o > h))),
        ("close_outside_range", ~anym & ((c < l) | (c > h))),
        ("pre_close_not_positive", _present("pre_close") & (F.col("pre_close") <= 0)),
        ("volume_amount_negative", ~anym & ((F.col("volume") < 0) | (F.col("amount") < 0))),
    ]


def _rules_security() -> list[tuple[str, Column]]:
    st = F.col("list_status")
    return [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("list_status_domain", st.isNotNull() & ~st.isin("L", "D", "P")),
    ]


def _rules_calendar() -> list[tuple[str, Column]]:
    return [
        ("exchange_missing", F.col("exchange").isNull()),
        ("cal_date_missing", F.col("cal_date").isNull()),
        ("is_open_missing", F.col("is_open").isNull()),
    ]


def _rules_fundamental() -> list[tuple[str, Column]]:
    return [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("ann_date_missing", F.col("ann_date").isNull()),
        ("report_date_missing", F.col("report_date").isNull()),
    ]


def _rules_factor() -> list[tuple[str, Column]]:
    return [
        ("ts_code_format", ~ts_code_valid("ts_code")),
        ("trade_date_missing", F.col("trade_date").isNull()),
        ("factor_name_missing", F.col("factor_name").isNull()),
        ("factor_value_missing", F.col("factor_value").isNull()),
        ("factor_version_missing", F.col("factor_version").isNull()),
    ]


def _rules_manifest() -> list[tuple[str, Column]]:
    return [
        ("dataset_missing", F.col("dataset").isNull()),
        ("source_missing", F.col("source").isNull()),
        ("version_missing", F.col("version").isNull()),
        ("row_count_negative", F.col("row_count").isNull() | (F.col("row_count") < 0)),
        ("loaded_at_missing", F.col("loaded_at").isNull()),
    ]


RULES = {
    "ohlcv": _rules_ohlcv,
    "adj_factor": _rules_adj_factor,
    "daily_basic": _rules_daily_basic,
    "index_daily": _rules_index_daily,
    "security": _rules_security,
    "calendar": _rules_calendar,
    "fundamental": _rules_fundamental,
    "factor": _rules_factor,
    "manifest": _rules_manifest,
}


# Columns that a record may leave out, with the value it then has.
RECORD_DEFAULTS = {"factor": {"factor_version": "default"}, "manifest": {"trade_date": None}}


def with_defaults(df: DataFrame, kind: str) -> DataFrame:
    """Add the columns that records of a kind may leave out; a null in a present column stays null."""
    types = {"factor_version": "string", "trade_date": "date"}
    absent = {c: F.lit(v).cast(types[c]) for c, v in RECORD_DEFAULTS.get(kind, {}).items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def violation_column(kind: str) -> Column:
    """Array of violated rule names for one record (empty when the row is valid)."""
    rules = RULES[kind]()
    arr = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules])
    return F.array_compact(arr)


def violations(df: DataFrame, kind: str, name: str = "_violations") -> DataFrame:
    return df.withColumn(name, violation_column(kind))


def violation_rows(df: DataFrame, kind: str, key_cols: Sequence[str]) -> DataFrame:
    """One row per (key, violated rule); empty for a clean frame."""
    v = violations(df, kind)
    return v.select(*key_cols, F.explode("_violations").alias("rule"))


def enforce(df: DataFrame, kind: str, label: str | None = None) -> DataFrame:
    """Raise with up to three offending rows; return ``df`` unchanged otherwise."""
    v = violations(df, kind)
    keys = [c for c in ("ts_code", "trade_date", "cal_date") if c in df.columns]
    bad = v.filter(F.size("_violations") > 0).select(*keys, "_violations").limit(3).collect()
    if bad:
        detail = "; ".join(", ".join(f"{k}={r[k]}" for k in keys) + f", rules={list(r['_violations'])}" for r in bad)
        raise ValueError(f"{label or kind} contract check failed: {detail}")
    return df


# ---------------------------------------------------------------------------
# QC7-QC10 set-level checks
# ---------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation)."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def reject_duplicate_keys(df: DataFrame, key_cols: Sequence[str], label: str = "frame") -> None:
    if duplicate_keys(df, key_cols).limit(1).count():
        raise ValueError(f"{label} has duplicate keys: key_columns={tuple(key_cols)}")


def identity_conflicts(df: DataFrame, name: str, version: str) -> DataFrame:
    """QC9: the distinct (factor_name, factor_version) that aren't the metadata's."""
    own = F.col("factor_name").eqNullSafe(name) & F.col("factor_version").eqNullSafe(version)
    return df.select("factor_name", "factor_version").where(~own).distinct()


def identity_check(df: DataFrame, name: str, version: str, label: str = "factor result") -> None:
    """QC9: exactly one (factor_name, factor_version) and it equals the metadata."""
    others = [tuple(r) for r in identity_conflicts(df, name, version).limit(2).collect()]
    if others:
        raise ValueError(f"{label} identity mismatch: expected={name}:{version}, also found={sorted(others, key=str)}")
    if not df.limit(1).count():
        raise ValueError(f"{label} identity mismatch: expected={name}:{version}, no rows")


def dates_not_in(left: DataFrame, right: DataFrame, col: str = "trade_date") -> DataFrame:
    """QC10: distinct dates of ``left`` that ``right`` lacks."""
    return left.select(col).distinct().join(right.select(col).distinct(), col, "left_anti")


def require_date_subset(left: DataFrame, right: DataFrame, message: str, col: str = "trade_date") -> None:
    if dates_not_in(left, right, col).limit(1).count():
        raise ValueError(message)


def check_factor_output(df: DataFrame, start, end) -> None:
    """QC8: all processed columns, non-empty, dates inside the request, unique key."""
    require_columns(df, S.PROCESSED_FACTOR_COLUMNS, "pipeline output")
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("trade_date").between(F.lit(start), F.lit(end))).alias("outside"),
    ).first()
    if row["n"] == 0:
        raise ValueError(f"no factor rows in the requested range: start={start}, end={end}")
    if row["outside"]:
        raise ValueError("pipeline output has trade dates outside the request")
    reject_duplicate_keys(df, S.FACTOR_KEY, "pipeline output")
