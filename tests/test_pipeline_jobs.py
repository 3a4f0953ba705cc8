import datetime as dt

import pytest

from conftest import SMALL
from eqlake import schemas as S
from eqlake.plans import jobs as J
from eqlake.plans.research import Research
from eqlake.sources.store import Store
from helpers import D


def _store_with_bars(spark, root, closes_by_code, days):
    st = Store(spark, root)
    bar_rows, adj_rows = [], []
    for code, closes in closes_by_code.items():
        for d, c in zip(days, [float(x) for x in closes]):
            bar_rows.append((code, d, c, c, c, c, None, None, None, 100.0, 1000.0, False, False, 0))
            adj_rows.append((code, d, 1.0))
    bars = spark.createDataFrame(bar_rows, S.OHLCV_SCHEMA)
    adj = spark.createDataFrame(adj_rows, S.ADJ_FACTOR_SCHEMA)
    kw = dict(date_column="trade_date", key_columns=S.DAILY_KEY)
    st.write_daily("ohlcv", bars, columns=S.DAILY_OHLCV_COLUMNS, **kw)
    st.write_daily("adj_factor", adj, columns=S.ADJ_FACTOR_COLUMNS, **kw)
    cal = spark.createDataFrame([("SSE", d, True, None) for d in days], S.CALENDAR_SCHEMA)
    st.replace_dimension("dim_trade_calendar", cal, None, S.TRADE_CALENDAR_COLUMNS)
    return st


DAYS = [D(2024, 1, 2) + dt.timedelta(days=i) for i in range(6)]


def test_pipeline_two_codes_last_day(spark, tmp_root):
    st = _store_with_bars(spark, tmp_root, {"000001.SZ": [10.0, 11, 12, 13, 14, 15], "000002.SZ": [10.0, 11, 12, 13, 14, 20]}, DAYS)
    s = J.run_factor_pipeline(spark, st, ["return_5d"], DAYS[-1], DAYS[-1])
    assert s.warmup_start_date == DAYS[0] and s.input_row_count == 12 and s.output_row_count == 2
    assert s.valid_rate == 1.0 and s.missing_value_rate == 0.0 and s.written_months == ((2024, 1),)
    got = {r.ts_code: r.factor_value for r in st.read("factors").collect()}
    assert got == {"000001.SZ": pytest.approx(0.5), "000002.SZ": pytest.approx(1.0)}
    r = J.run_factor_pipeline(spark, st, ["return_5d"], DAYS[-1], DAYS[-1], processor="rank_pct", dry_run=True)
    assert r.dry_run and r.written_months == ()
    assert {x.ts_code: x.factor_value for x in st.read("factors").collect()}["000001.SZ"] == pytest.approx(0.5)
    J.run_factor_pipeline(spark, st, ["return_5d"], DAYS[-1], DAYS[-1], processor="rank_pct")
    got = {r.ts_code: r.factor_value for r in st.read("factors").collect()}
    assert got == {"000001.SZ": pytest.approx(0.5), "000002.SZ": pytest.approx(1.0)}


def test_pipeline_argument_errors(spark, tmp_root):
    st = _store_with_bars(spark, tmp_root, {"000001.SZ": [10.0, 11, 12, 13, 14, 15]}, DAYS)
    with pytest.raises(ValueError):
        J.run_factor_pipeline(spark, st, "return_5d", DAYS[-1], DAYS[-1])
    with pytest.raises(ValueError):
        J.run_factor_pipeline(spark, st, [], DAYS[-1], DAYS[-1])
    with pytest.raises(ValueError):
        J.run_factor_pipeline(spark, st, ["return_5d", "return_5d"], DAYS[-1], DAYS[-1])
    with pytest.raises(ValueError):
        J.run_factor_pipeline(spark, st, ["return_5d"], DAYS[-1], DAYS[0])
    with pytest.raises(ValueError):
        J.run_factor_pipeline(spark, st, ["return_5d"], DAYS[-1], DAYS[-1], processor="zscore")
    with pytest.raises(KeyError):
        J.run_factor_pipeline(spark, st, ["nope"], DAYS[-1], DAYS[-1])
    with pytest.raises(ValueError):  # warm-up needs 20 open days before the start
        J.run_factor_pipeline(spark, st, ["momentum_20d"], DAYS[-1], DAYS[-1])


def test_pipeline_and_validation_on_events_panel(spark, tmp_root):
    r = Research(spark, SMALL)
    st = Store(spark, tmp_root)
    kw = dict(date_column="trade_date", key_columns=S.DAILY_KEY)
    st.write_daily("ohlcv", r.bars, columns=S.DAILY_OHLCV_COLUMNS, **kw)
    st.write_daily("adj_factor", r.adj, columns=S.ADJ_FACTOR_COLUMNS, **kw)
    st.replace_dimension("dim_trade_calendar", r.calendar, None, S.TRADE_CALENDAR_COLUMNS)
    s = J.run_factor_pipeline(spark, st, ["return_5d"], D(2024, 1, 6), D(2024, 1, 24))
    assert s.warmup_start_date == D(2024, 1, 1) and s.output_row_count > 0
    rep = J.run_factor_validation(spark, st, "return_5d", D(2024, 1, 6), D(2024, 1, 24))
    assert rep["factor_name"] == "return_5d" and rep["row_count"] == s.output_row_count
    assert rep["rank_ic_5d_count"] > 0 and -1.0 <= rep["rank_ic_5d_mean"] <= 1.0
    assert len(rep["coverage_by_date"]) == 19
