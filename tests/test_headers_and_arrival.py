"""Raw files by their own headers (batch and stream), order of arrival, checks while loading, late lists."""

import gzip
import shutil

import pytest

from eqlake import schemas as S
from eqlake.plans import jobs as J
from eqlake.sources import raw as R
from eqlake.sources.store import Store
from eqlake.streaming import start_daily_ingest
from helpers import D, strings

COLUMNS = list(S.RAW_DAILY_OHLCV_REQUIRED)
VALUE = {"ts_code": "000001.SZ", "open": "10", "high": "12", "low": "9", "close": "11", "vol": "1", "amount": "2"}


def _folder(root, dataset, day):
    return f"{root}/raw/vendor/{dataset}/year={day.year}/month={day.month:02d}/file_date={day:%Y%m%d}"


def _file(root, dataset, day, text, name="part.csv"):
    import os

    folder = _folder(root, dataset, day)
    os.makedirs(folder, exist_ok=True)
    data = text.encode()
    with open(f"{folder}/{name}", "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)


def _csv(order, *rows):
    return "\n".join([",".join(order), *[",".join(r[c] for c in order) for r in rows]]) + "\n"


def _bar(day, **changes):
    return VALUE | {"trade_date": f"{day:%Y%m%d}"} | changes


def _limits(root, *days):
    for day in days:
        _file(root, "stk-limit", day, f"trade_date,ts_code,pre_close,up_limit,down_limit\n{day:%Y%m%d},000001.SZ,10,11,9\n")


DAYS = [D(2015, 12, 30), D(2015, 12, 31)]  # before ST lists
SWAPPED = ["trade_date", "ts_code", "close", "open", "high", "low", "amount", "vol"]
TASK = R.ETLTask("daily-ohlcv", "vendor", *DAYS)


def _prices(store):
    return [(r.trade_date, r.open, r.close, r.limit_status) for r in store.read("ohlcv").orderBy("trade_date").collect()]


WANT = [(DAYS[0], 10.0, 11.0, 2), (DAYS[1], 10.0, 11.0, 2)]


def test_batch_by_header(spark, tmp_root):
    store = Store(spark, f"{tmp_root}/store")
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(COLUMNS, _bar(DAYS[0])))
    # Another order, a byte-order mark, quotes and blanks in the header, compressed.
    text = _csv(SWAPPED, _bar(DAYS[1])).replace("trade_date,ts_code,close", '﻿trade_date,"ts_code", close', 1)
    _file(tmp_root, "daily-ohlcv", DAYS[1], text, "part.csv.gz")
    _limits(tmp_root, *DAYS)
    assert J.load(spark, store, f"{tmp_root}/raw", TASK) == 2
    assert _prices(store) == WANT


def test_a_data_line_is_no_header(spark, tmp_root):
    first = _bar(DAYS[0], ts_code="AAA ts_code")  # less than the header, and it holds a column's name
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(SWAPPED, first))
    (row,) = R.read_raw(spark, f"{tmp_root}/raw", TASK, COLUMNS).collect()
    assert (row.ts_code, row.open, row.close) == ("AAA ts_code", "10", "11")


def test_stream_by_header(spark, tmp_root):
    store = Store(spark, f"{tmp_root}/store")
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(COLUMNS, _bar(DAYS[0])))
    _file(tmp_root, "daily-ohlcv", DAYS[1], _csv(SWAPPED, _bar(DAYS[1])))
    _limits(tmp_root, *DAYS)
    start_daily_ingest(spark, store, f"{tmp_root}/raw", "vendor", "daily-ohlcv", f"{tmp_root}/ckpt", available_now=True).awaitTermination(120)
    assert _prices(store) == WANT


def test_days_wait_for_their_lists(spark, tmp_root):
    store, raw = Store(spark, f"{tmp_root}/store"), f"{tmp_root}/raw"
    run = lambda **kw: start_daily_ingest(spark, store, raw, "vendor", "daily-ohlcv", f"{tmp_root}/ckpt", available_now=True, **kw).awaitTermination(120)
    day, other = D(2024, 1, 2), D(2024, 1, 3)
    for d in (day, other):
        _file(tmp_root, "daily-ohlcv", d, _csv(COLUMNS, _bar(d)))
    _limits(tmp_root, other)
    run()
    assert [r[0] for r in _prices(store)] == [other]  # the first day has no limits yet
    _limits(tmp_root, day)
    run()
    assert [(r[0], r[3]) for r in _prices(store)] == [(day, 2), (other, 2)]
    # An ST list that comes later changes the flag, a corrected limit file the status.
    _file(tmp_root, "stock-st", day, f"ts_code,name,trade_date,type,type_name\n000001.SZ,x,{day:%Y%m%d},S,st\n")
    _file(tmp_root, "stk-limit", other, f"trade_date,ts_code,pre_close,up_limit,down_limit\n{other:%Y%m%d},000001.SZ,10,15,9\n", "part2.csv")
    run()
    rows = {r.trade_date: r for r in store.read("ohlcv").collect()}
    assert (rows[day].is_st, rows[day].limit_status, rows[other].is_st, rows[other].limit_status) == (True, 2, False, 1)


def test_strict_streams_wait_for_both_lists(spark, tmp_root):
    store, raw = Store(spark, f"{tmp_root}/store"), f"{tmp_root}/raw"
    day = D(2024, 1, 2)
    run = lambda: start_daily_ingest(spark, store, raw, "vendor", "daily-ohlcv", f"{tmp_root}/ckpt", available_now=True, wait_for=("stk-limit", "stock-st")).awaitTermination(120)
    _file(tmp_root, "daily-ohlcv", day, _csv(COLUMNS, _bar(day)))
    _limits(tmp_root, day)
    run()
    assert store.read("ohlcv") is None
    _file(tmp_root, "stock-st", day, "ts_code,name,trade_date,type,type_name\n")  # empty lists count
    run()
    assert [(r[0], r[3]) for r in _prices(store)] == [(day, 2)]
    with pytest.raises(ValueError):
        start_daily_ingest(spark, store, raw, "vendor", "adj-factor", f"{tmp_root}/c2", wait_for=("stk-limit",))


def test_last_row_of_a_key_wins_however_files_are_read(spark, tmp_root):
    lines = [_bar(DAYS[0], close=str(10 + i % 7 / 10), amount=str(i)) for i in range(2_000)]
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(COLUMNS, *lines[:1_500]), "part-0.csv")
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(SWAPPED, *lines[1_500:]), "part-1.csv")
    _limits(tmp_root, DAYS[0])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for n, block in enumerate((size, "4096", "10000")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            store = Store(spark, f"{tmp_root}/store{n}")
            task = R.ETLTask("daily-ohlcv", "vendor", DAYS[0], DAYS[0])
            assert J.load(spark, store, f"{tmp_root}/raw", task) == 2_000
            (row,) = store.read("ohlcv").collect()
            assert (row.amount, row.close) == (1_999.0, pytest.approx(10 + 1_999 % 7 / 10))
            raw = R.read_raw(spark, f"{tmp_root}/raw", task, COLUMNS, position=True).repartition(7)
            assert [int(r.amount) for r in raw.orderBy("_position").collect()] == list(range(2_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_landing_keeps_the_order_of_arrival(spark, tmp_root):
    rows = [("000001.SZ", "20240102", str(i)) for i in range(300)] + [("000002.SZ", "20240103", "7")]
    task = R.ETLTask("adj-factor", "vendor", D(2024, 1, 2), D(2024, 1, 3))
    R.land(strings(spark, S.RAW_ADJ_FACTOR_COLUMNS, rows).coalesce(3), f"{tmp_root}/raw", task)
    back = R.read_raw(spark, f"{tmp_root}/raw", task, S.RAW_ADJ_FACTOR_COLUMNS, position=True).orderBy("_position").collect()
    assert [(r.ts_code, r.trade_date, r.adj_factor) for r in back] == rows


class WithoutRaw(Store):
    """The raw files are gone once the rows are staged: whatever reads them again fails."""

    raw = ""

    def _reached(self, step):
        if step == "staged":
            shutil.move(self.raw, f"{self.raw}-gone")


def test_raw_rows_are_read_once(spark, tmp_root):
    store = WithoutRaw(spark, f"{tmp_root}/store")
    store.raw = f"{tmp_root}/raw"
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(COLUMNS, _bar(DAYS[0])))
    _limits(tmp_root, DAYS[0])
    assert J.load(spark, store, f"{tmp_root}/raw", R.ETLTask("daily-ohlcv", "vendor", DAYS[0], DAYS[0])) == 1
    assert _prices(Store(spark, f"{tmp_root}/store")) == WANT[:1]


def test_failed_checks_publish_nothing(spark, tmp_root):
    store = Store(spark, f"{tmp_root}/store")
    good, bad = _bar(DAYS[0]), _bar(DAYS[0], ts_code="000002.SZ", high="1", open="x")
    _file(tmp_root, "daily-ohlcv", DAYS[0], _csv(COLUMNS, good, bad, _bar(DAYS[0], ts_code="000003.SZ", low="11.5")))
    _limits(tmp_root, DAYS[0])
    task = R.ETLTask("daily-ohlcv", "vendor", DAYS[0], DAYS[0])
    with pytest.raises(ValueError, match="invalid number in open.*'x'"):
        J.load(spark, store, f"{tmp_root}/raw", task)
    assert store.read("ohlcv") is None
    refused = {r.ts_code: [(x.message, x.value) for x in r._failed] for r in spark.read.parquet(f"{tmp_root}/store/quarantine/ohlcv").collect()}
    assert set(refused) == {"000002.SZ", "000003.SZ"}
    assert refused["000002.SZ"][0] == ("invalid number in open", "x")
    assert all(m.startswith("daily bar contract check failed: ") for m, _ in refused["000003.SZ"])
    with pytest.raises(ValueError, match="invalid number"):
        J.load(spark, store, f"{tmp_root}/raw", R.ETLTask("daily-ohlcv", "vendor", DAYS[0], DAYS[0], dry_run=True))


def test_load_reports_anomalies(spark, tmp_root):
    store = Store(spark, f"{tmp_root}/store")
    day = D(2024, 1, 2)
    names = list(S.RAW_DAILY_BASIC_COLUMNS)
    base = dict.fromkeys(names, "1") | {"trade_date": f"{day:%Y%m%d}"}
    rows = [base | {"ts_code": f"00000{i}.SZ", "total_mv": "0" if i < 5 else "1", "circ_mv": "" if i == 6 else "2"} for i in range(1, 8)]
    rows.append(base | {"ts_code": "900901.SH", "total_mv": "0"})  # outside the universe
    _file(tmp_root, "daily-basic", day, _csv(names, *rows))
    done = J.load_checked(spark, store, f"{tmp_root}/raw", R.ETLTask("daily-basic", "vendor", day, day))
    assert done.rows == 7 and done.months == ((2024, 1),)
    found = {field: (n, codes) for field, n, codes in done.anomalies}
    assert found["circ_mv"] == (1, ("000006.SZ",)) and found["total_mv"][0] == 4 and set(found) == {"total_mv", "circ_mv"}
    assert 1 <= len(found["total_mv"][1]) <= 3 and set(found["total_mv"][1]) <= {f"00000{i}.SZ" for i in range(1, 5)}
    assert store.read("daily_basic").where("total_mv = 0").count() == 4


def test_white_space_of_any_kind(spark):
    from eqlake.functions.parsing import clean_exchange, is_missing_string, parse_number

    values = ["\tnan\n", " ", "\r\n", " 　None\x1f", "\t szse \n", " 1.5\x0b", "a b"]
    df = strings(spark, ["v"], [(v,) for v in values])
    got = [(r[0], r[1], r[2]) for r in df.select(is_missing_string("v"), clean_exchange("v"), parse_number("v")).collect()]
    assert [g[0] for g in got] == [True] * 4 + [False] * 3
    assert [g[1] for g in got] == ["SSE"] * 4 + ["SZSE", "1.5", "A B"] and got[5][2] == 1.5
