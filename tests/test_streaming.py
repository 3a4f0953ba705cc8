from eqlake import schemas as S
from eqlake.sources import raw as R
from eqlake.sources.store import Store
from eqlake.streaming import start_daily_ingest
from helpers import D, strings


def _bar(code, d, close):
    return (code, d.strftime("%Y%m%d"), "10.0", "12.0", "8.0", close, "", "", "", "100", "1000")


def test_stream_ingest_upserts_new_days(spark, tmp_root):
    raw_root, st = f"{tmp_root}/raw", Store(spark, f"{tmp_root}/store")
    d1, d2 = D(2024, 1, 2), D(2024, 1, 3)
    R.land(strings(spark, S.RAW_STK_LIMIT_COLUMNS, [(d.strftime("%Y%m%d"), "000001.SZ", "", "12.0", "8.0") for d in (d1, d2)]),
           raw_root, R.ETLTask("stk-limit", "vendor", d1, d2))
    R.land(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", d1, "11.0")]), raw_root, R.ETLTask("daily-ohlcv", "vendor", d1, d1))
    ckpt = f"{tmp_root}/ckpt"
    q = start_daily_ingest(spark, st, raw_root, "vendor", "daily-ohlcv", ckpt, available_now=True)
    q.awaitTermination(120)
    assert [r.limit_status for r in st.read("ohlcv").collect()] == [1]
    # a new day and a corrected file for the first day arrive later
    R.land(strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [_bar("000001.SZ", d2, "12.0")]), raw_root, R.ETLTask("daily-ohlcv", "vendor", d2, d2))
    q = start_daily_ingest(spark, st, raw_root, "vendor", "daily-ohlcv", ckpt, available_now=True)
    q.awaitTermination(120)
    rows = {r.trade_date: r for r in st.read("ohlcv").collect()}
    assert set(rows) == {d1, d2} and rows[d2].limit_status == 2
