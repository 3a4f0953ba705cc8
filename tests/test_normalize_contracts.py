import pytest

from eqlake import schemas as S
from eqlake.operators import contracts as QC
from eqlake.operators import normalize as N
from eqlake.sources.raw import ETLTask
from helpers import D, strings

TASK = ETLTask("daily-ohlcv", "vendor", D(2021, 11, 1), D(2024, 12, 31))


def _bar(code, o="10.0", h="12.0", l="8.0", c="10.0", day="20240102"):
    return (code, day, o, h, l, c, "", "", "", "1000", "10000")


def test_limit_status(spark):
    raw = strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [
        _bar("000001.SZ", c="10.0"), _bar("000002.SZ", c="11.0"), _bar("000003.SZ", c="12.0"),
        _bar("000004.SZ", c="9.0"), _bar("000005.SZ", c="8.0"),
    ])
    lim = strings(spark, S.RAW_STK_LIMIT_COLUMNS, [("20240102", f"00000{i}.SZ", "", "12.0", "8.0") for i in range(1, 6)])
    out = N.normalize_daily_ohlcv(raw, TASK, stk_limit=lim).orderBy("ts_code").collect()
    assert [r.limit_status for r in out] == [0, 1, 2, 3, 4]
    no_lim = N.normalize_daily_ohlcv(raw, TASK).orderBy("ts_code").collect()
    assert [r.limit_status for r in no_lim] == [0, 1, 1, 3, 3]


def test_down_limit_wins_and_st_flag(spark):
    raw = strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", c="10.0", h="10.0", l="10.0", o="10.0")])
    lim = strings(spark, S.RAW_STK_LIMIT_COLUMNS, [("20240102", "000001.SZ", "", "10.0", "10.0")])
    st = strings(spark, S.RAW_STOCK_ST_COLUMNS, [("000001.SZ", "ST x", "20240102", "S", "st")])
    r = N.normalize_daily_ohlcv(raw, TASK, stk_limit=lim, stock_st=st).first()
    assert r.limit_status == 4 and r.is_st is True and r.is_suspended is False


def test_universe_filter(spark):
    raw = strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [
        _bar("000001.SZ"), _bar("200011.SZ"), _bar("900901.SH"), _bar("430476.BJ", day="20211112"),
        _bar("430047.BJ", day="20211115"),
    ])
    out = [r.ts_code for r in N.normalize_daily_ohlcv(raw, TASK).orderBy("ts_code").collect()]
    assert out == ["000001.SZ", "430047.BJ"]


def test_bad_inputs_raise(spark):
    with pytest.raises(ValueError, match="trade_date"):
        N.normalize_daily_ohlcv(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", day="2024-01-02")]), TASK)
    with pytest.raises(ValueError, match="open"):
        N.normalize_daily_ohlcv(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", o="1d")]), TASK)
    with pytest.raises(ValueError, match="outside"):
        N.normalize_daily_ohlcv(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", day="20250102")]), TASK)
    # a bad number in a row the universe filter drops still fails
    with pytest.raises(ValueError, match="close"):
        N.normalize_daily_ohlcv(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("900901.SH", c="x")]), TASK)
    with pytest.raises(ValueError, match="contract"):
        N.normalize_daily_ohlcv(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", h="7.0")]), TASK)
    with pytest.raises(ValueError):
        N.normalize_daily_ohlcv(strings(spark, ["ts_code", "trade_date"], [("a", "b")]), TASK)


def test_valuation_markers_and_anomalies(spark):
    row = {c: "1.0" for c in S.RAW_DAILY_BASIC_COLUMNS}
    row.update(ts_code="000001.SZ", trade_date="20240102", pe="", pe_ttm="nan", volume_ratio="-1", dv_ratio="-1", dv_ttm="",
               turnover_rate="", turnover_rate_f="0", total_share="-5", float_share="None", free_share="",
               total_mv="0", circ_mv="-1", pb="")
    raw = strings(spark, S.RAW_DAILY_BASIC_COLUMNS, [tuple(row[c] for c in S.RAW_DAILY_BASIC_COLUMNS)])
    r = N.normalize_daily_basic(raw, TASK).first()
    assert (r.pe, r.pe_ttm, r.volume_ratio, r.dv_ratio, r.dv_ttm) == (-1.0, -1.0, 0.0, 0.0, 0.0)
    assert all(getattr(r, c) == 0.0 for c in N.VALUATION_SIZE_FIELDS)
    assert r.pb is None and r.close == 1.0
    anomalies = {a.field: a.anomaly_count for a in N.daily_basic_anomalies(raw).collect()}
    assert len(anomalies) == 7 and all(v == 1 for v in anomalies.values())


def test_calendar_normalise(spark):
    raw = strings(spark, ["exchange", "cal_date", "is_open"], [("", "20240101", "0"), (" szse ", "20240102", "1")])
    out = N.normalize_trade_calendar(raw).orderBy("cal_date").collect()
    assert [(r.exchange, r.is_open) for r in out] == [("SSE", False), ("SZSE", True)]
    with pytest.raises(ValueError):
        N.normalize_trade_calendar(strings(spark, ["cal_date", "is_open"], [("20240101", "2")]))
    with pytest.raises(ValueError):
        N.normalize_trade_calendar(strings(spark, ["cal_date", "is_open"], [("20240101", "")]))


def test_contract_rules(spark):
    schema = "ts_code string, trade_date date, open double, high double, low double, close double, volume double, amount double, is_suspended boolean, limit_status long"
    rows = [
        ("000001.SZ", D(2024, 1, 2), 10.0, 11.0, 9.0, 10.0, 1.0, 1.0, False, 0),  # ok
        ("000002.SZ", D(2024, 1, 2), None, None, None, None, None, None, True, -1),  # ok: suspended
        ("000003.SZ", D(2024, 1, 2), None, None, None, None, None, None, True, 0),  # suspended with status
        ("000004.SZ", D(2024, 1, 2), 10.0, 11.0, 9.0, 12.0, 1.0, 1.0, False, 0),  # close above high
        ("000005.XX", D(2024, 1, 2), 10.0, 11.0, 9.0, 10.0, -1.0, 1.0, False, -1),  # code, negative vol, -1 active
    ]
    df = spark.createDataFrame(rows, schema)
    v = {r.ts_code: set(r._violations) for r in QC.violations(df, "ohlcv").collect()}
    assert v["000001.SZ"] == set() and v["000002.SZ"] == set()
    assert v["000003.SZ"] == {"suspended_limit_status"}
    assert v["000004.SZ"] == {"close_outside_range"}
    assert {"ts_code_format", "volume_amount_negative", "active_limit_status"} <= v["000005.XX"]
    with pytest.raises(ValueError):
        QC.enforce(df, "ohlcv")
    adj = spark.createDataFrame([("000001.SZ", D(2024, 1, 2), 0.0)], "ts_code string, trade_date date, cumulative_factor double")
    assert QC.violation_rows(adj, "adj_factor", ["ts_code"]).first().rule == "cumulative_factor_not_positive"
    sec = spark.createDataFrame([("000001.SZ", "X")], "ts_code string, list_status string")
    assert QC.violation_rows(sec, "security", ["ts_code"]).first().rule == "list_status_domain"


def test_set_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert [r.k for r in QC.duplicate_keys(df, ["k"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        QC.reject_duplicate_keys(df, ["k"])
    with pytest.raises(ValueError):
        QC.validate_identifier("a b")
    assert QC.validate_fields(["close"]) == ["close"]
