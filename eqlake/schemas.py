"""Declared schemas, key columns and column comments of every dataset.

Schemas are declared (never inferred). Reads unify files by name
(``unionByName(allowMissingColumns=True)`` / ``mergeSchema``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Dataset column names and order must equal the upstream vendor
# and processed layouts, so they are stated here as plain text.
# ---------------------------------------------------------------------------
RAW_DAILY_OHLCV_COLUMNS = ("ts_code", "trade_date", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "vol", "amount")
RAW_DAILY_OHLCV_REQUIRED = ("ts_code", "trade_date", "open", "high", "low", "close", "vol", "amount")
RAW_ADJ_FACTOR_COLUMNS = ("ts_code", "trade_date", "adj_factor")
RAW_DAILY_BASIC_COLUMNS = (
    "ts_code", "trade_date", "close", "turnover_rate", "turnover_rate_f", "volume_ratio", "pe", "pe_ttm",
    "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm", "total_share", "float_share", "free_share", "total_mv", "circ_mv",
)
RAW_DAILY_BASIC_REQUIRED = ("ts_code", "trade_date")
RAW_STOCK_ST_COLUMNS = ("ts_code", "name", "trade_date", "type", "type_name")
RAW_STK_LIMIT_COLUMNS = ("trade_date", "ts_code", "pre_close", "up_limit", "down_limit")
RAW_SUSPEND_D_COLUMNS = ("ts_code", "trade_date", "suspend_timing", "suspend_type")
SECURITY_COLUMNS = (
    "ts_code", "symbol", "name", "area", "industry", "fullname", "enname", "cnspell", "market", "exchange",
    "curr_type", "list_status", "list_date", "delist_date", "is_hs", "act_name", "act_ent_type",
)
TRADE_CALENDAR_COLUMNS = ("exchange", "cal_date", "is_open", "pretrade_date")
DAILY_OHLCV_COLUMNS = (
    "ts_code", "trade_date", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "volume",
    "amount", "is_suspended", "is_st", "limit_status",
)
ADJ_FACTOR_COLUMNS = ("ts_code", "trade_date", "cumulative_factor")
DAILY_BASIC_COLUMNS = (
    "ts_code", "trade_date", "close", "turnover_rate", "turnover_rate_f", "volume_ratio", "pe", "pe_ttm", "pb",
    "ps", "ps_ttm", "dv_ratio", "dv_ttm", "total_share", "float_share", "free_share", "total_mv", "circ_mv",
)
INDEX_DAILY_COLUMNS = ("ts_code", "trade_date", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "volume", "amount")
FUNDAMENTAL_COLUMNS = (
    "ts_code", "ann_date", "report_date", "report_type", "pe_ttm", "pb", "ps_ttm", "roe", "roa", "gross_margin",
    "netprofit_yoy", "revenue_yoy", "debt_to_assets", "ocf_to_revenue",
)
FACTOR_COLUMNS = ("ts_code", "trade_date", "factor_name", "factor_value", "factor_version")
FACTOR_OPTIONAL_COLUMNS = ("raw_value", "processed_value", "quality_status", "created_at")
FACTOR_STORAGE_COLUMNS = FACTOR_COLUMNS + FACTOR_OPTIONAL_COLUMNS
PROCESSED_FACTOR_COLUMNS = (
    "ts_code", "trade_date", "factor_name", "factor_value", "factor_version", "raw_value", "processed_value",
    "quality_status",
)
CALCULATOR_RESULT_COLUMNS = ("ts_code", "trade_date", "factor_name", "factor_value", "factor_version", "raw_value")
HFQ_PANEL_FIELDS = (
    "ts_code", "trade_date", "open", "high", "low", "close", "cumulative_factor", "hfq_open", "hfq_high",
    "hfq_low", "hfq_close", "volume", "amount", "is_suspended", "is_st", "limit_status",
)
DEFAULT_CROSS_SECTION_FIELDS = ("ts_code", "trade_date", "close", "volume", "amount", "is_suspended", "is_st", "limit_status")

# Keys
DAILY_KEY = ("ts_code", "trade_date")
FACTOR_KEY = ("ts_code", "trade_date", "factor_name", "factor_version")
CALENDAR_KEY = ("exchange", "cal_date")
FUNDAMENTAL_KEY = ("ts_code", "ann_date", "report_date")

# Processed store folder -> view name (fixed layout).
PROCESSED_DATASETS = {
    "ohlcv": "v_daily_ohlcv",
    "adj_factor": "v_adj_factor",
    "daily_basic": "v_daily_basic",
    "index_daily": "v_index_daily",
    "fundamental": "v_fundamental",
    "factors": "v_factors",
}

_D = T.DoubleType()
_S = T.StringType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


OHLCV_SCHEMA = _struct(
    [("ts_code", _S), ("trade_date", T.DateType())]
    + [(c, _D) for c in ("open", "high", "low", "close", "pre_close", "change", "pct_chg", "volume", "amount")]
    + [("is_suspended", T.BooleanType()), ("is_st", T.BooleanType()), ("limit_status", T.LongType())]
)
ADJ_FACTOR_SCHEMA = _struct([("ts_code", _S), ("trade_date", T.DateType()), ("cumulative_factor", _D)])
DAILY_BASIC_SCHEMA = _struct([("ts_code", _S), ("trade_date", T.DateType())] + [(c, _D) for c in DAILY_BASIC_COLUMNS[2:]])
INDEX_DAILY_SCHEMA = _struct([("ts_code", _S), ("trade_date", T.DateType())] + [(c, _D) for c in INDEX_DAILY_COLUMNS[2:]])
FUNDAMENTAL_SCHEMA = _struct(
    [("ts_code", _S), ("ann_date", T.DateType()), ("report_date", T.DateType()), ("report_type", _S)]
    + [(c, _D) for c in FUNDAMENTAL_COLUMNS[4:]]
)
FACTOR_SCHEMA = _struct(
    [("ts_code", _S), ("trade_date", T.DateType()), ("factor_name", _S), ("factor_value", _D), ("factor_version", _S),
     ("raw_value", _D), ("processed_value", _D), ("quality_status", _S), ("created_at", T.TimestampNTZType())]
)
CALENDAR_SCHEMA = _struct(
    [("exchange", _S), ("cal_date", T.DateType()), ("is_open", T.BooleanType()), ("pretrade_date", T.DateType())]
)
SECURITY_SCHEMA = _struct([(c, _S) for c in SECURITY_COLUMNS])

DATASET_SCHEMAS = {
    "ohlcv": OHLCV_SCHEMA,
    "adj_factor": ADJ_FACTOR_SCHEMA,
    "daily_basic": DAILY_BASIC_SCHEMA,
    "index_daily": INDEX_DAILY_SCHEMA,
    "fundamental": FUNDAMENTAL_SCHEMA,
    "factors": FACTOR_SCHEMA,
}

# Column comments (SK11), attached as StructField metadata on write/read.
COLUMN_COMMENTS = {
    "ts_code": "security code with exchange suffix, e.g. 000001.SZ",
    "trade_date": "trade date",
    "open": "open price (unadjusted)",
    "high": "high price (unadjusted)",
    "low": "low price (unadjusted)",
    "close": "close price (unadjusted)",
    "pre_close": "previous close",
    "change": "price change",
    "pct_chg": "percent change",
    "volume": "traded volume",
    "amount": "traded amount",
    "is_suspended": "suspended for the whole day",
    "is_st": "exchange risk-warning flag",
    "limit_status": "-1 suspended, 0 flat, 1 up, 2 up-limit, 3 down, 4 down-limit",
    "cumulative_factor": "cumulative adjustment factor",
    "factor_name": "factor name",
    "factor_value": "consumable factor value",
    "factor_version": "factor definition version",
    "raw_value": "raw calculator output",
    "processed_value": "processor output",
    "quality_status": "valid / missing_input / insufficient_history / invalid_value",
    "exchange": "exchange code",
    "cal_date": "calendar day",
    "is_open": "exchange open on that day",
    "pretrade_date": "previous open day",
}


def with_comments(schema: T.StructType) -> T.StructType:
    """Attach column comments as field metadata (Spark keeps ``comment`` in catalogs)."""
    fields = []
    for f in schema.fields:
        meta = dict(f.metadata or {})
        if f.name in COLUMN_COMMENTS:
            meta["comment"] = COLUMN_COMMENTS[f.name]
        fields.append(T.StructField(f.name, f.dataType, f.nullable, meta))
    return T.StructType(fields)
