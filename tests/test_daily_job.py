from eqlake import schemas as S
from eqlake.plans import jobs as J
from eqlake.sources import raw as R
from eqlake.sources.store import Store
from helpers import D, strings

import pytest

OPEN, CLOSED = D(2024, 1, 2), D(2024, 1, 6)


def _land_common(spark, raw_root):
    cal = strings(spark, ["exchange", "cal_date", "is_open"], [("SSE", f"202401{d:02d}", "0" if d in (6, 7) else "1") for d in range(1, 8)])
    R.land(cal, raw_root, R.ETLTask("trade-calendar", "vendor", D(2024, 1, 1), D(2024, 1, 7)))
    sec = strings(spark, S.SECURITY_COLUMNS, [tuple(["000001.SZ"] + ["x"] * 10 + ["L", "20200101", "", "N", "", ""])])
    R.land(sec, raw_root, R.ETLTask("stock-basic", "vendor", OPEN, OPEN))


def test_daily_job_stops_on_closed_day(spark, tmp_root):
    raw_root, st = f"{tmp_root}/raw", Store(spark, f"{tmp_root}/store")
    _land_common(spark, raw_root)
    run = J.run_daily(spark, st, raw_root, "vendor", CLOSED)
    assert not run.is_open and [(x.action, x.dataset) for x in run.steps] == [("load", "trade-calendar"), ("load", "stock-basic")]
    assert st.read_dim("dim_security").count() == 1


def test_daily_job_open_day(spark, tmp_root):
    raw_root, st = f"{tmp_root}/raw", Store(spark, f"{tmp_root}/store")
    _land_common(spark, raw_root)
    k = OPEN.strftime("%Y%m%d")
    t = lambda ds: R.ETLTask(ds, "vendor", OPEN, OPEN)
    R.land(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [("000001.SZ", k, "10", "12", "8", "12", "", "", "", "100", "1000")]), raw_root, t("daily-ohlcv"))
    R.land(strings(spark, S.RAW_STK_LIMIT_COLUMNS, [(k, "000001.SZ", "", "12", "8")]), raw_root, t("stk-limit"))
    R.land(strings(spark, S.RAW_STOCK_ST_COLUMNS, []), raw_root, t("stock-st"), expected_dates=[OPEN])
    R.land(strings(spark, S.RAW_ADJ_FACTOR_COLUMNS, [("000001.SZ", k, "1.5")]), raw_root, t("adj-factor"))
    basic = {c: "1" for c in S.RAW_DAILY_BASIC_COLUMNS}
    basic.update(ts_code="000001.SZ", trade_date=k)
    R.land(strings(spark, S.RAW_DAILY_BASIC_COLUMNS, [tuple(basic[c] for c in S.RAW_DAILY_BASIC_COLUMNS)]), raw_root, t("daily-basic"))
    run = J.run_daily(spark, st, raw_root, "vendor", OPEN)
    assert run.is_open and [x.dataset for x in run.steps[:5]] == ["trade-calendar", "stock-basic", *J.DAILY_STEPS]
    assert [x.result for x in run.steps[2:5]] == [1, 1, 1]
    checks = {x.dataset: x.result.missing_dates for x in run.steps[5:]}
    # Every check comes after every load; the day of the suspensions was not landed.
    assert all(x.action == "missing" for x in run.steps[5:])
    assert checks == {**dict.fromkeys(J.DAILY_CHECKS, ()), "suspend-d": (OPEN,)}
    bar = st.read("ohlcv").first()
    assert bar.limit_status == 2 and bar.is_st is False
    assert st.read("adj_factor").first().cumulative_factor == 1.5
    assert st.read("daily_basic").count() == 1
    st.register_views()
    assert spark.table("v_daily_hfq").first().hfq_close == pytest.approx(18.0)


def test_daily_job_requires_calendar_row(spark, tmp_root):
    raw_root, st = f"{tmp_root}/raw", Store(spark, f"{tmp_root}/store")
    _land_common(spark, raw_root)
    with pytest.raises(ValueError):
        J.run_daily(spark, st, raw_root, "vendor", D(2024, 2, 1))
