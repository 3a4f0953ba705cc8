import datetime as dt

import pytest
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.operators import status as ST
from eqlake.plans import jobs as J
from eqlake.sources import raw as R
from eqlake.sources.store import Store, fs_exists, sub_dirs
from helpers import D, strings

FSCHEMA = "ts_code string, trade_date date, factor_name string, factor_value double, factor_version string"


def _factors(spark, rows, schema=FSCHEMA):
    return spark.createDataFrame(rows, schema)


def test_factor_upsert_month_split_and_overwrite(spark, tmp_root):
    st = Store(spark, tmp_root)
    first = _factors(spark, [
        ("000001.SZ", D(2024, 1, 31), "momentum_20d", 0.1, "v1"),
        ("000001.SZ", D(2024, 1, 31), "momentum_20d", 0.2, "v2"),
        ("000001.SZ", D(2024, 2, 1), "volatility_20d", 0.3, "v1"),
    ])
    counts = st.write_factor_results(first)
    assert counts == {(2024, 1): 2, (2024, 2): 1}
    assert sorted(sub_dirs(spark, f"{tmp_root}/processed/factors/year=2024")) == ["month=1", "month=2"]
    st.write_factor_results(_factors(spark, [("000001.SZ", D(2024, 1, 31), "momentum_20d", 0.9, "v1")]))
    got = {(r.factor_name, r.factor_version): r.factor_value for r in st.read("factors").collect()}
    assert got == {("momentum_20d", "v1"): 0.9, ("momentum_20d", "v2"): 0.2, ("volatility_20d", "v1"): 0.3}
    with pytest.raises(ValueError):
        st.write_factor_results(first.withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError):
        st.write_factor_results(first.drop("factor_value"))


def test_factor_partial_overwrite_nulls_optional_columns(spark, tmp_root):
    st = Store(spark, tmp_root)
    full = "ts_code string, trade_date date, factor_name string, factor_value double, factor_version string, raw_value double, quality_status string"
    st.write_factor_results(_factors(spark, [
        ("000001.SZ", D(2024, 1, 2), "return_5d", 0.5, "v1", 0.5, "valid"),
        ("000002.SZ", D(2024, 1, 2), "return_5d", 0.7, "v1", 0.7, "valid"),
    ], full))
    st.write_factor_results(_factors(spark, [("000001.SZ", D(2024, 1, 2), "return_5d", 0.6, "v1")]))
    rows = {r.ts_code: r for r in st.read("factors").collect()}
    assert rows["000001.SZ"].factor_value == 0.6 and rows["000001.SZ"].raw_value is None
    assert rows["000002.SZ"].raw_value == 0.7 and rows["000002.SZ"].quality_status == "valid"


def test_keep_last_within_batch(spark, tmp_root):
    st = Store(spark, tmp_root)
    rows = [("000001.SZ", D(2024, 1, 2), 1.0, 0), ("000001.SZ", D(2024, 1, 2), 2.0, 1)]
    df = spark.createDataFrame(rows, "ts_code string, trade_date date, cumulative_factor double, seq long")
    counts = st.write_daily("adj_factor", df, date_column="trade_date", key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS, order_col="seq")
    assert counts == {(2024, 1): 2}
    assert [r.cumulative_factor for r in st.read("adj_factor").collect()] == [2.0]


def _bars(spark, rows):
    cols = list(S.DAILY_OHLCV_COLUMNS)
    full = [(c, d, None, None, None, close, None, None, None, None, None, False, False, 0) for c, d, close in rows]
    schema = ", ".join(f"{c} {t}" for c, t in zip(cols, ["string", "date"] + ["double"] * 9 + ["boolean", "boolean", "long"]))
    return spark.createDataFrame(full, schema)


def test_archive_year(spark, tmp_root):
    st = Store(spark, tmp_root)
    kw = dict(date_column="trade_date", key_columns=S.DAILY_KEY, columns=S.DAILY_OHLCV_COLUMNS)
    st.write_daily("ohlcv", _bars(spark, [("000001.SZ", D(2023, 1, 3), 8.0)]), **kw)
    J.archive(st, "daily-ohlcv", 2023, today=D(2024, 6, 1))
    st.write_daily("ohlcv", _bars(spark, [("000001.SZ", D(2023, 1, 3), 10.0), ("000001.SZ", D(2023, 2, 1), 20.0)]), **kw)
    # the upsert into an archived year removed the replaced key from the archive
    assert sorted(r.close for r in st.read("ohlcv").collect()) == [10.0, 20.0]
    path = J.archive(st, "daily-ohlcv", 2023, today=D(2024, 6, 1))
    assert path.endswith("year=2023")
    assert sorted(r.close for r in st.read("ohlcv").collect()) == [10.0, 20.0]
    assert not fs_exists(spark, f"{tmp_root}/processed/ohlcv/year=2023")
    with pytest.raises(FileNotFoundError):
        J.archive(st, "daily-ohlcv", 2023, today=D(2024, 6, 1))
    with pytest.raises(ValueError):
        J.archive(st, "daily-ohlcv", 2024, today=D(2024, 6, 1))
    names = st.register_views()
    assert "v_daily_ohlcv" in names and spark.table("v_daily_ohlcv").count() == 2


def test_archive_keeps_foreign_files(spark, tmp_root):
    st = Store(spark, tmp_root)
    kw = dict(date_column="trade_date", key_columns=S.DAILY_KEY, columns=S.DAILY_OHLCV_COLUMNS)
    st.write_daily("ohlcv", _bars(spark, [("000001.SZ", D(2023, 1, 3), 8.0)]), **kw)
    note = f"{tmp_root}/processed/ohlcv/year=2023/_notes.txt"
    with open(note, "w") as f:
        f.write("mine")
    J.archive(st, "daily-ohlcv", 2023, today=D(2024, 6, 1))
    assert fs_exists(spark, note) and [r.close for r in st.read("ohlcv").collect()] == [8.0]


def test_views_without_inputs_are_dropped(spark, tmp_root):
    st = Store(spark, f"{tmp_root}/full")
    kw = dict(date_column="trade_date", key_columns=S.DAILY_KEY)
    st.write_daily("ohlcv", _bars(spark, [("000001.SZ", D(2023, 1, 3), 8.0)]), columns=S.DAILY_OHLCV_COLUMNS, **kw)
    factor = spark.createDataFrame([("000001.SZ", D(2023, 1, 3), 2.0)], "ts_code string, trade_date date, cumulative_factor double")
    st.write_daily("adj_factor", factor, columns=factor.columns, **kw)
    names = st.register_views()
    assert {"v_daily_ohlcv", "v_adj_factor", "v_daily_hfq", "v_daily_qfq_latest", "v_daily_adj"} <= set(names)
    assert Store(spark, f"{tmp_root}/empty").register_views() == []
    assert not any(st.relation_exists(n) for n in names)


def test_replace_dimension(spark, tmp_root):
    st = Store(spark, tmp_root)
    cal = spark.createDataFrame([("SSE", D(2024, 1, d), True, None) for d in range(1, 6)], S.CALENDAR_SCHEMA)
    assert st.replace_dimension("dim_trade_calendar", cal, None, S.TRADE_CALENDAR_COLUMNS) == 5
    new = spark.createDataFrame([("SSE", D(2024, 1, 2), False, None)], S.CALENDAR_SCHEMA)
    pred = F.col("cal_date").between(F.lit(D(2024, 1, 2)), F.lit(D(2024, 1, 3)))
    assert st.replace_dimension("dim_trade_calendar", new, pred, S.TRADE_CALENDAR_COLUMNS) == 1  # inserted rows
    assert st.read_dim("dim_trade_calendar").count() == 4
    empty = spark.createDataFrame([], S.CALENDAR_SCHEMA)
    assert st.replace_dimension("dim_trade_calendar", empty, F.col("cal_date") == F.lit(D(2024, 1, 5)), S.TRADE_CALENDAR_COLUMNS) == 0
    assert st.read_dim("dim_trade_calendar").count() == 3


def test_missing_dates_and_status(spark, tmp_root):
    st = Store(spark, tmp_root)
    cal = spark.createDataFrame([("SSE", D(2024, 1, d), d in (2, 3), None) for d in (1, 2, 3)], S.CALENDAR_SCHEMA)
    st.replace_dimension("dim_trade_calendar", cal, None, S.TRADE_CALENDAR_COLUMNS)
    st.write_daily("ohlcv", _bars(spark, [("000001.SZ", D(2024, 1, 2), 10.0)]), date_column="trade_date",
                   key_columns=S.DAILY_KEY, columns=S.DAILY_OHLCV_COLUMNS)
    res = J.missing(spark, st, R.ETLTask("daily-ohlcv", "vendor", D(2024, 1, 1), D(2024, 1, 3)))
    assert res.missing_dates == (D(2024, 1, 3),) and res.existing_dates == (D(2024, 1, 2),)
    with pytest.raises(ValueError):
        J.missing(spark, st, R.ETLTask("daily-ohlcv", "vendor", D(2024, 1, 1), D(2024, 1, 5)))
    s = J.status(st, "daily-ohlcv")
    assert (s["row_count"], s["trade_date_count"], s["security_count"]) == (1, 1, 1)
    assert J.status(st, "trade-calendar")["open_count"] == 2
    assert J.status(st, "adj-factor")["row_count"] == 0


def test_build_task_rules():
    assert J.build_task("daily-ohlcv", "v", "20240102", "2024-01-05").end_date == D(2024, 1, 5)
    assert J.build_task("stock-basic", "v", None, None, today=D(2024, 3, 1)).start_date == D(2024, 3, 1)
    with pytest.raises(ValueError):
        J.build_task("daily-ohlcv", "v", "20240105", "20240102")
    with pytest.raises(ValueError):
        J.build_task("daily-ohlcv", "v", "2024/01/05", "20240105")


def test_land_and_load_end_to_end(spark, tmp_root):
    raw_root, st = f"{tmp_root}/raw", Store(spark, f"{tmp_root}/store")
    days = [D(2024, 1, 2), D(2024, 1, 3)]

    def bar(code, d, close):
        return (code, d.strftime("%Y%m%d"), "10.0", "12.0", "8.0", close, "", "", "", "100", "1000")

    bars = strings(spark, S.RAW_DAILY_OHLCV_COLUMNS, [bar("000001.SZ", d, c) for d, c in zip(days, ("11.0", "12.0"))])
    lim = strings(spark, S.RAW_STK_LIMIT_COLUMNS, [(d.strftime("%Y%m%d"), "000001.SZ", "", "12.0", "8.0") for d in days])
    stl = strings(spark, S.RAW_STOCK_ST_COLUMNS, [("000001.SZ", "x", days[1].strftime("%Y%m%d"), "S", "st")])
    task = R.ETLTask("daily-ohlcv", "vendor", days[0], days[1])
    R.land(lim, raw_root, R.ETLTask("stk-limit", "vendor", days[0], days[1]))
    R.land(stl, raw_root, R.ETLTask("stock-st", "vendor", days[0], days[1]), expected_dates=days)
    assert R.landed_dates(spark, raw_root, "vendor", "stk-limit") == days
    n = J.backfill(spark, st, raw_root, task, bars)
    assert n == 2
    rows = {r.trade_date: r for r in st.read("ohlcv").collect()}
    assert rows[days[0]].limit_status == 1 and rows[days[1]].limit_status == 2 and rows[days[1]].is_st
    again = R.land(bars, raw_root, task)
    assert again["skipped_dates"] == days
    cal_raw = strings(spark, ["exchange", "cal_date", "is_open"], [("SSE", d.strftime("%Y%m%d"), "1") for d in days])
    R.land(cal_raw, raw_root, R.ETLTask("trade-calendar", "vendor", days[0], days[1]))
    assert J.load(spark, st, raw_root, R.ETLTask("trade-calendar", "vendor", days[0], days[1])) == 2
    assert ST.calendar_status(st.read_dim("dim_trade_calendar")).first().open_count == 2


def test_column_comments_are_stored(spark, tmp_root):
    st = Store(spark, tmp_root)
    df = spark.createDataFrame([("000001.SZ", D(2024, 1, 2), 1.5)], S.ADJ_FACTOR_SCHEMA)
    st.write_daily("adj_factor", df, date_column="trade_date", key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS)
    meta = st.read("adj_factor").schema["cumulative_factor"].metadata
    assert meta.get("comment") == S.COLUMN_COMMENTS["cumulative_factor"]


def test_keep_last_paths_agree(spark):
    from eqlake.sources.store import keep_last

    rows = [("a", 1, 10.0, 0), ("a", 1, 11.0, 5), ("a", 1, 12.0, 3), ("b", 2, 1.0, 1), (None, 3, 7.0, 2), (None, 3, 8.0, 4)]
    df = spark.createDataFrame(rows, "k string, d int, v double, seq long")
    key = lambda t: tuple(str(x) for x in t)
    hashed = sorted((tuple(r) for r in keep_last(df, ["k", "d"], "seq").collect()), key=key)
    structed = sorted((tuple(r) for r in keep_last(df.withColumn("seq", F.struct("seq")), ["k", "d"], "seq")
                       .withColumn("seq", F.col("seq.seq")).collect()), key=key)
    assert hashed == structed == sorted([("a", 1, 11.0, 5), ("b", 2, 1.0, 1), (None, 3, 8.0, 4)], key=key)
