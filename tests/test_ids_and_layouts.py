"""Ids and keys of any size, raw files of any column order, factor runs beside stored rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eqlake.operators import factors as FX
from eqlake.sources import raw as R
from eqlake.sources import testdata as TD

D = dt.date


def test_long_ids_stay_apart(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 2 + d), 1_000_000 + i % 10, "view", float(i), "") for i in range(20) for d in range(3)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    bars = TD.ohlcv(spark, str(tmp_path))
    assert bars.select("ts_code").distinct().count() == 10
    assert bars.count() == bars.select("ts_code", "trade_date").distinct().count() == 30
    assert TD.raw_daily_ohlcv(spark, str(tmp_path)).select("ts_code", "trade_date").distinct().count() == 30


def test_large_order_keys_keep_their_order(spark, tmp_path):
    day = dt.datetime(2024, 1, 2)
    rows = [
        (5_000_000_000, 1, 1, 1_234_567, 1.0, 99.0, "N", "O", day),
        (1, 9, 5, 1_234_567, 1.0, 10.0, "N", "O", day),
        (1, 300_000_000_000, 6, 1_234_567, 1.0, 50.0, "N", "O", day),
    ]
    schema = "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    (bar,) = TD.ohlcv(spark, str(tmp_path), "lineitem").collect()
    assert (bar["open"], bar["close"], bar["ts_code"]) == (10.0, 99.0, "1234567.SH")


def test_raw_files_are_read_by_name(spark, tmp_path):
    task = R.ETLTask("daily-ohlcv", "tushare", D(2024, 1, 2), D(2024, 1, 3), "SSE")
    columns = ["ts_code", "trade_date", "open", "high", "low", "close", "vol", "amount"]
    value = {"ts_code": "000001.SZ", "open": "10", "high": "12", "low": "9", "close": "11", "vol": "1", "amount": "2"}
    for day, order in ((2, columns), (3, ["trade_date", "ts_code", "close", "open", "high", "low", "vol", "amount"])):
        folder = tmp_path / R.dataset_root("", task).strip("/") / f"year=2024/month=01/file_date=2024010{day}"
        folder.mkdir(parents=True)
        line = ",".join((value | {"trade_date": f"2024010{day}"})[c] for c in order)
        (folder / "part.csv").write_text(",".join(order) + "\n" + line + "\n")
    got = R.read_raw(spark, str(tmp_path), task, columns).orderBy("trade_date").collect()
    assert [(r["open"], r["close"], r["trade_date"]) for r in got] == [("10", "11", "20240102"), ("10", "11", "20240103")]
    with pytest.raises(ValueError):
        R.read_raw(spark, str(tmp_path), task, [*columns, "turnover"])


def test_user_calculator_runs(spark):
    meta = FX.FactorMetadata("double_close", "v1", "technical", 0, ("hfq_close",), 1, None, "twice the close")
    registry = FX.build_default_registry().register(meta, lambda panel: (panel, F.col("hfq_close") * 2))
    panel = spark.createDataFrame([("000001.SZ", D(2024, 1, 2), 3.0)], "ts_code string, trade_date date, hfq_close double")
    assert FX.compute_factor(panel, meta, registry).first()["raw_value"] == 6.0
    with pytest.raises(NotImplementedError):
        FX.compute_factor(panel, meta)
