"""Versions of the store: stopped writers, writers at the same time, readers of older versions."""

import os

import pytest
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.sources.snapshots import SnapshotLog, united
from eqlake.sources.store import Store
from helpers import D

ADJ = "ts_code string, trade_date date, cumulative_factor double"
KW = dict(date_column="trade_date", key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS)


class Stopped(Exception):
    pass


class StopsAt(Store):
    """A writer that stops after a step, the n-th time that it gets there."""

    step, times = "", 1

    def _reached(self, step):
        if step == self.step:
            self.times -= 1
            if not self.times:
                raise Stopped(step)


def _adj(spark, rows):
    return spark.createDataFrame(rows, ADJ)


def _stored(store):
    df = store.read("adj_factor")
    return sorted((r.ts_code, r.trade_date, r.cumulative_factor) for r in df.collect()) if df is not None else []


OLD = [("a", D(2023, 1, 3), 1.0), ("b", D(2023, 2, 3), 2.0), ("c", D(2024, 1, 3), 3.0)]
NEW = [("a", D(2023, 1, 3), 9.0), ("d", D(2023, 3, 3), 4.0), ("e", D(2024, 1, 4), 5.0)]
BOTH = [("a", D(2023, 1, 3), 9.0), ("b", D(2023, 2, 3), 2.0), ("c", D(2024, 1, 3), 3.0), ("d", D(2023, 3, 3), 4.0), ("e", D(2024, 1, 4), 5.0)]


@pytest.mark.parametrize("archived", [False, True])
@pytest.mark.parametrize("step", [("staged", 1), ("files", 1), ("files", 2), ("written", 1), ("published", 1)])
def test_upsert_that_stops(spark, tmp_root, step, archived):
    store = Store(spark, tmp_root)
    store.write_daily("adj_factor", _adj(spark, OLD), **KW)
    if archived:
        store.archive_year("adj_factor", 2023, key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS, today=D(2024, 6, 1))
    elif step == ("files", 2):
        pytest.skip("one folder set is written")
    writer = StopsAt(spark, tmp_root)
    writer.step, writer.times = step
    with pytest.raises(Stopped):
        writer.write_daily("adj_factor", _adj(spark, NEW), **KW)
    assert _stored(store) == (BOTH if step[0] == "published" else OLD)
    store.write_daily("adj_factor", _adj(spark, NEW), **KW)  # the retry
    assert _stored(store) == BOTH
    store.sweep("adj_factor", older_than_hours=0)
    assert _stored(store) == BOTH and not store.sweep("adj_factor", older_than_hours=0)


@pytest.mark.parametrize("step", ["files", "written", "published"])
def test_archive_that_stops(spark, tmp_root, step):
    store = Store(spark, tmp_root)
    store.write_daily("adj_factor", _adj(spark, BOTH), **KW)
    writer = StopsAt(spark, tmp_root)
    writer.step = step
    kw = dict(key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS, today=D(2024, 6, 1))
    with pytest.raises(Stopped):
        writer.archive_year("adj_factor", 2023, **kw)
    assert _stored(store) == BOTH
    months = store.read_live("adj_factor").select("year").distinct().count()
    assert months == (1 if step == "published" else 2)
    if step != "published":
        store.archive_year("adj_factor", 2023, **kw)
    assert _stored(store) == BOTH and store.read_archive("adj_factor").count() == 3


@pytest.mark.parametrize("step", ["files", "written", "published"])
def test_dimension_that_stops(spark, tmp_root, step):
    store = Store(spark, tmp_root)
    cal = lambda days, is_open: spark.createDataFrame([("SSE", D(2024, 1, d), is_open, None) for d in days], S.CALENDAR_SCHEMA)
    store.replace_dimension("dim_trade_calendar", cal(range(1, 6), True), None, S.TRADE_CALENDAR_COLUMNS)
    writer = StopsAt(spark, tmp_root)
    writer.step = step
    with pytest.raises(Stopped):
        writer.replace_dimension("dim_trade_calendar", cal([2], False), F.col("cal_date") == F.lit(D(2024, 1, 2)), S.TRADE_CALENDAR_COLUMNS)
    rows = {r.cal_date.day: r.is_open for r in store.read_dim("dim_trade_calendar").collect()}
    assert rows == {d: d != 2 or step != "published" for d in range(1, 6)}


class Meets(Store):
    """A writer that another one overtakes, between its files and its manifest."""

    other = None

    def _reached(self, step):
        if step == "written" and self.other is not None:
            other, self.other = self.other, None
            other()


def test_writers_at_the_same_time(spark, tmp_root):
    store, slow = Store(spark, tmp_root), Meets(spark, tmp_root)
    store.write_daily("adj_factor", _adj(spark, [("a", D(2024, 1, 2), 1.0)]), **KW)
    # Another month: the slow writer's files are good as they are.
    slow.other = lambda: store.write_daily("adj_factor", _adj(spark, [("a", D(2024, 2, 2), 2.0)]), **KW)
    slow.write_daily("adj_factor", _adj(spark, [("b", D(2024, 1, 2), 3.0)]), **KW)
    assert _stored(store) == [("a", D(2024, 1, 2), 1.0), ("a", D(2024, 2, 2), 2.0), ("b", D(2024, 1, 2), 3.0)]
    # The same month: it merges again with what the other one wrote; the last publisher wins its keys.
    slow.other = lambda: store.write_daily("adj_factor", _adj(spark, [("c", D(2024, 1, 2), 4.0), ("b", D(2024, 1, 2), 5.0)]), **KW)
    slow.write_daily("adj_factor", _adj(spark, [("b", D(2024, 1, 2), 6.0)]), **KW)
    assert _stored(store) == [("a", D(2024, 1, 2), 1.0), ("a", D(2024, 2, 2), 2.0), ("b", D(2024, 1, 2), 6.0), ("c", D(2024, 1, 2), 4.0)]
    # A month written while its year is archived stays.
    slow.other = lambda: store.write_daily("adj_factor", _adj(spark, [("d", D(2024, 3, 2), 7.0)]), **KW)
    slow.archive_year("adj_factor", 2024, key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS, today=D(2025, 6, 1))
    assert len(_stored(store)) == 5 and store.read_live("adj_factor") is None


def test_readers_keep_their_version(spark, tmp_root):
    store = Store(spark, tmp_root)
    store.write_daily("adj_factor", _adj(spark, OLD), **KW)
    before = store.read("adj_factor")
    store.write_daily("adj_factor", _adj(spark, NEW), **KW)
    assert before.count() == 3 and store.read("adj_factor").count() == 5
    assert store.read("adj_factor", version=1).count() == 3
    store.keep_versions = 1
    store.write_daily("adj_factor", _adj(spark, NEW), **KW)
    assert _stored(store) == BOTH and store.log("adj_factor").versions() == [3]
    # A number that was used can't be published again.
    assert not store.log("adj_factor").publish(store.log("adj_factor").current().__class__(2, S.ADJ_FACTOR_SCHEMA, {}))


def test_null_keys_are_replaced_too(spark, tmp_root):
    store = Store(spark, tmp_root)
    for value in (1.0, 2.0, 3.0):
        store.write_daily("adj_factor", _adj(spark, [(None, D(2024, 1, 2), value)]), **KW)
    assert [r.cumulative_factor for r in store.read("adj_factor").collect()] == [3.0]
    with pytest.raises(ValueError, match="trade_date"):
        store.write_daily("adj_factor", _adj(spark, [("a", None, 1.0)]), **KW)


def test_columns_unite_by_name(spark, tmp_root):
    store = Store(spark, tmp_root)
    store.write_daily("adj_factor", _adj(spark, OLD), **KW)
    wide = _adj(spark, NEW).withColumn("note", F.lit("x"))
    store.write_daily("adj_factor", wide, date_column="trade_date", key_columns=S.DAILY_KEY, columns=[*S.ADJ_FACTOR_COLUMNS, "note"])
    notes = {(r.ts_code): r.note for r in store.read("adj_factor").collect()}
    assert notes == {"a": "x", "b": None, "c": None, "d": "x", "e": "x"}
    with pytest.raises(ValueError, match="cumulative_factor"):
        united(S.ADJ_FACTOR_SCHEMA, _adj(spark, OLD).withColumn("cumulative_factor", F.lit("x")).schema)


def test_large_months_are_several_sorted_files(spark, tmp_root):
    store = Store(spark, tmp_root)
    store.rows_per_file = 10
    rows = [(f"{i:03d}", D(2024, 1, 1 + i % 5), float(i)) for i in range(95)]
    store.write_daily("adj_factor", _adj(spark, rows), **KW)
    part = store.log("adj_factor").current().parts["2024-01"]
    files = [f for f in os.listdir(f"{tmp_root}/{part.folder}") if f.endswith(".parquet")]
    assert part.rows == 95 and len(part.dates) == 5 and 3 < len(files) <= 10
    one = [(r.trade_date, r.ts_code) for r in spark.read.parquet(f"{tmp_root}/{part.folder}/{files[0]}").collect()]
    assert one == sorted(one)


def test_manifest_survives_a_stopped_publisher(spark, tmp_root):
    log = SnapshotLog(spark, f"{tmp_root}/t")
    first = log.current().changed(S.ADJ_FACTOR_SCHEMA, {})
    assert log.publish(first) and not log.publish(first)
    open(f"{tmp_root}/t/_log/_draft-left", "w").write("{half")
    assert log.versions() == [1] and log.current().version == 1


def test_status_reads_no_rows(spark, tmp_root):
    import glob

    from eqlake.operators import status as ST
    from eqlake.plans import jobs as J
    from eqlake.sources import raw as R

    store = Store(spark, tmp_root)
    rows = [(f"{i % 7:06d}.SZ", D(2023, 1 + i % 12, 1 + i % 20), float(i)) for i in range(300)] + [("x", D(2024, 2, 2), 1.0)]
    store.write_daily("adj_factor", _adj(spark, rows), **KW)
    store.write_daily("adj_factor", _adj(spark, NEW), **KW)
    store.archive_year("adj_factor", 2023, key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS, today=D(2024, 6, 1))
    store.write_daily("adj_factor", _adj(spark, [("000001.SZ", D(2023, 1, 2), 5.0), ("y", D(2023, 5, 5), 6.0)]), **KW)
    want = ST.daily_status(store.read("adj_factor")).first().asDict()
    days = sorted(r[0] for r in store.read("adj_factor").select("trade_date").distinct().collect())
    cal = spark.createDataFrame([("SSE", D(2024, 2, d), True, None) for d in (1, 2, 3)], S.CALENDAR_SCHEMA)
    store.replace_dimension("dim_trade_calendar", cal, None, S.TRADE_CALENDAR_COLUMNS)
    for f in glob.glob(f"{tmp_root}/processed/**/commit=*/*.parquet", recursive=True):
        os.rename(f, f"{f}.away")
    assert ST.dataset_status(store, "adj-factor") == want and list(store.dates("adj_factor")) == days
    missing = J.missing(spark, store, R.ETLTask("adj-factor", "vendor", D(2024, 2, 1), D(2024, 2, 3)))
    assert missing.existing_dates == (D(2024, 2, 2),) and missing.missing_dates == (D(2024, 2, 1), D(2024, 2, 3))
    assert store.statistics("ohlcv") is None and ST.dataset_status(store, "daily-ohlcv")["row_count"] == 0
