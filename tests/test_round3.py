"""Findings of round 3: rows that break a contract, and work that grows with the tables."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from eqlake import schemas as S
from eqlake import session
from eqlake.operators import factors as FX
from eqlake.operators import processing as PR
from eqlake.plans import jobs as J
from eqlake.plans import catalog_store as CS
from eqlake.sources import raw as R
from eqlake.sources import testdata as TD
from eqlake.sources.store import Store

D = dt.date


def _events(spark, folder):
    """Two securities on two days; one day's only price is zero."""
    rows = [
        (1, dt.datetime(2024, 1, 2, 9), 2, "purchase", 5.0), (2, dt.datetime(2024, 1, 2, 10), 2, "error", 6.0), (3, dt.datetime(2024, 1, 2, 11), 2, "error", 7.0),
        (4, dt.datetime(2024, 1, 3, 9), 2, "view", 4.0), (5, dt.datetime(2024, 1, 2, 9), 4, "purchase", 0.0), (6, dt.datetime(2024, 1, 3, 9), 4, "view", 3.0),
    ]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["normalize_bars", "load_bars", "stream_bars"])
def test_bars_with_a_price_of_zero_come_back(spark, tmp_root, name):
    rows = entry.queries()[name](spark, _events(spark, tmp_root)).collect()
    assert sorted((r.ts_code, r.trade_date, r.close, r.is_st, r.limit_status) for r in rows) == [
        ("000002.SZ", D(2024, 1, 2), 7.0, True, 2), ("000002.SZ", D(2024, 1, 3), 4.0, False, 0),
        ("000004.SZ", D(2024, 1, 2), 0.0, False, 4), ("000004.SZ", D(2024, 1, 3), 3.0, False, 0),
    ]


def test_limit_status_with_a_price_of_zero(spark, tmp_root):
    rows = entry.queries()["limit_status"](spark, _events(spark, tmp_root)).collect()
    assert {r.limit_status: r.n_rows for r in rows} == {0: 2, 2: 1, 4: 1}


def test_rows_set_aside_stay_out_of_the_store(spark, tmp_root):
    sf, raw = _events(spark, f"{tmp_root}/sf"), f"{tmp_root}/raw"
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    task = R.ETLTask("daily-ohlcv", "vendor", *days)
    for dataset, frame in (("daily-ohlcv", TD.raw_daily_ohlcv(spark, sf)), ("stk-limit", TD.raw_stk_limit(spark, sf)), ("stock-st", TD.raw_stock_st(spark, sf))):
        R.land(frame, raw, R.ETLTask(dataset, "vendor", *days), expected_dates=days)
    store = Store(spark, f"{tmp_root}/store")
    with pytest.raises(ValueError, match="price_not_positive"):
        J.load_checked(spark, store, raw, task)
    assert store.read("ohlcv") is None
    done = J.load_checked(spark, Store(spark, f"{tmp_root}/other"), raw, task, set_aside=True)
    assert done.rows == 3 and [(m, n) for m, n, _ in done.failures] == [("daily bar contract check failed: price_not_positive", 1)]
    assert Store(spark, f"{tmp_root}/other").read("ohlcv").where("close <= 0").count() == 0


def test_tasks_grow_with_the_source(spark):
    try:
        few, many = session.tasks_for(spark, 1 << 20), session.tasks_for(spark, 4 << 30)
        assert many == 1024 and few <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        session.size_shuffles(spark, 4 << 30)
        assert session.shuffle_partitions(spark) == 1024
    finally:
        session.size_shuffles(spark, 0)
    assert session.shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def _lineitem(spark, folder, sizes):
    """Row i: supplier i % 3, one of two days; the price is extended price over quantity."""
    rows = [(i, i % 5, i % 3, 1, float(1 + i % 2), 10.0 + i, ("A", "N", "R")[i % 3 - i % 2], "OF"[i % 2], dt.datetime(1995, 1, 1 + i % 2)) for i in range(sizes)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_lineitem_bars_are_dealt_by_the_size_of_the_source(spark, tmp_root, monkeypatch):
    sf = _lineitem(spark, tmp_root, 60)
    before = sorted(map(tuple, TD.ohlcv(spark, sf, "lineitem").collect()))
    monkeypatch.setattr(session, "SOURCE_BYTES_PER_TASK", 100)
    n = session.tasks_for(spark, TD.table_bytes(spark, sf, "lineitem"))
    bars = TD.ohlcv(spark, sf, "lineitem")
    assert n > 20 and f", {n})" in bars._jdf.queryExecution().toString() or f", {n}," in bars._jdf.queryExecution().toString()
    assert sorted(map(tuple, bars.collect())) == before and len(before) == 6


def test_factors_count_actions_without_the_prices(spark, tmp_root):
    sf = _lineitem(spark, tmp_root, 60)
    daily = {(r.ts_code, r.trade_date): (r.n_action, r.has_factor) for r in TD._daily(spark, sf, "lineitem").collect()}
    counted = {(r.ts_code, r.trade_date): (r.n_action, r.has_factor) for r in TD._daily_actions(spark, sf, "lineitem").collect()}
    assert counted == daily
    assert "min_by" not in TD.adj_factor(spark, sf, "lineitem")._jdf.queryExecution().toString()


@pytest.mark.parametrize("largest", [1, PR.GROUP_ROWS + 1])
def test_wide_factors_rank_as_long_ones(spark, largest):
    metas = [FX.RETURN_5D, FX.MOMENTUM_20D]
    rows = [(f"{i:06d}.SZ", None if i == 6 else D(2024, 1, 2 + i % 2), 1 + i, v, None if v is None else -v)
            for i, v in enumerate([1.0, 2.0, 1.0, None, -0.0, 0.0, 5.0, float("nan"), 3.0, float("inf"), 1.0, 2.0])]
    wide = spark.createDataFrame(rows, "ts_code string, trade_date date, _obs long, `return_5d@v1` double, `momentum_20d@v1` double")
    found = PR.process_wide(wide, metas, "rank_pct", largest)
    key = lambda r: (r.ts_code, r.factor_name)
    expected = PR.process_long(FX.wide_to_long(wide, metas), metas, "rank_pct")
    assert [str(r) for r in sorted(found.collect(), key=key)] == [str(r) for r in sorted(expected.collect(), key=key)]
    assert found.columns == expected.columns == list(S.PROCESSED_FACTOR_COLUMNS)
    exchanges = PR.process_wide(wide, metas, "rank_pct", largest)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges == 1 if largest == 1 else exchanges > 3, exchanges


def test_upsert_of_single_keys_is_not_shuffled_to_find_last_rows(spark, tmp_root, monkeypatch):
    calls = []
    from eqlake.sources import store as SK

    last = SK.keep_last
    monkeypatch.setattr(SK, "keep_last", lambda *a: calls.append(1) or last(*a))
    store = Store(spark, tmp_root)
    put = lambda rows: store.write_daily("adj_factor", spark.createDataFrame(rows, S.ADJ_FACTOR_SCHEMA), date_column="trade_date",
                                         key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS)
    put([("000001.SZ", D(2024, 1, 2), 1.0), (None, D(2024, 1, 2), 2.0)])
    assert not calls
    put([(None, D(2024, 1, 2), 3.0), (None, D(2024, 1, 2), 4.0)])
    assert calls and sorted(r.cumulative_factor for r in store.read("adj_factor").collect()) == [1.0, 4.0]


def test_numbered_bars_carry_only_what_the_rules_read(spark, tmp_root):
    rows = CS._numbered(spark, _lineitem(spark, tmp_root, 60), 4, "is_suspended")
    assert rows.columns == ["ts_code", "trade_date", "is_suspended", "i"]
    assert [r.i for r in rows.orderBy("ts_code", "trade_date").collect()] == [0, 1, 2, 3, 0, 1]


def test_partitions_of_a_session_that_set_no_number(spark, tmp_root):
    """No panel was read in such a session; the mix asks for the number."""
    new = spark.newSession()
    assert new.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert session.shuffle_partitions(new) == int(new.conf.get("spark.sql.shuffle.partitions"))
    new.createDataFrame([(1, "a b", "x"), (2, "c", None)], "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_root}/documents.parquet")
    assert sorted((r.doc_id, r.size) for r in entry.queries()["op1_mixing"](new, tmp_root).collect()) == [(1, 2), (2, 1)]


def test_every_stored_file_is_sorted_by_a_task_of_its_own(spark, tmp_root, monkeypatch):
    """Hashing the folders into as many tasks as there are files put several of them into one."""
    from pyspark.sql import functions as F

    seen, frame = [], type(spark.range(1))
    plain = frame.sortWithinPartitions

    def spy(df, *columns):
        seen.append([(r.p, r.year, r["month"] if "month" in df.columns else None, r.n) for r in
                     df.groupBy(F.spark_partition_id().alias("p"), *[c for c in ("year", "month") if c in df.columns]).agg(F.count(F.lit(1)).alias("n")).collect()])
        return plain(df, *columns)

    monkeypatch.setattr(frame, "sortWithinPartitions", spy)
    store = Store(spark, tmp_root)
    store.rows_per_file = 40
    rows = [(f"{i:06d}.SZ", D(2019, 1 + i % 12, 1 + i % 28), float(i)) for i in range(960)]
    kw = dict(key_columns=S.DAILY_KEY, columns=S.ADJ_FACTOR_COLUMNS)
    store.write_daily("adj_factor", spark.createDataFrame(rows, S.ADJ_FACTOR_SCHEMA), date_column="trade_date", **kw)
    store.archive_year("adj_factor", 2019, **kw)
    assert [len(x) for x in seen] == [24, 24]
    for parts, n in zip(seen, (24, 24)):
        assert len({p for p, *_ in parts}) == len(parts) == n, parts  # a task has rows of one folder only
        assert max(n for *_, n in parts) <= 80
    assert sorted(map(tuple, store.read("adj_factor").select(*S.ADJ_FACTOR_COLUMNS).collect())) == sorted(rows)


def _nodes(df, name):
    """How often a node stands in a query's plan."""
    return df._jdf.queryExecution().executedPlan().toString().count(name)


def test_factors_of_a_date_are_ranked_by_one_sort(spark):
    """A sort and three windows for every factor each took memory of their own in one task."""
    metas = [FX.RETURN_5D, FX.MOMENTUM_20D, FX.AMIHUD_20D]
    rows = [(f"{i:06d}.SZ", D(2024, 1, 2), 30, float(i // 2), None if i % 3 else -float(i), float("nan")) for i in range(12)]
    wide = spark.createDataFrame(rows, "ts_code string, trade_date date, _obs long, `return_5d@v1` double, `momentum_20d@v1` double, `amihud_20d@v1` double")
    found = PR.process_wide(wide, metas, "rank_pct", 12)
    assert (_nodes(found, " Sort "), _nodes(found, " Window ")) == (1, 1)
    by = {(r.ts_code, r.factor_name): (r.processed_value, r.quality_status) for r in found.collect()}
    assert len(by) == 36 and by["000003.SZ", "return_5d"] == (3.5 / 12, "valid") and by["000003.SZ", "momentum_20d"] == (3 / 4, "valid")
    assert by["000001.SZ", "momentum_20d"] == (None, "missing_input") and by["000001.SZ", "amihud_20d"] == (None, "invalid_value")


def test_windows_of_securities_are_dealt_by_the_size_of_the_source(spark, tmp_root, monkeypatch):
    from eqlake.plans.research import Research

    r = Research(spark, _lineitem(spark, tmp_root, 60), "lineitem")
    monkeypatch.setattr(session, "SOURCE_BYTES_PER_TASK", 100)
    n = session.tasks_for(spark, TD.table_bytes(spark, r.sf_dir, "lineitem"))
    for frame in (r.calc(), r.labels, PR.observation_count(FX.compute_wide(r.hfq_by_security, [FX.RETURN_5D, FX.VOLATILITY_20D]))):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert n > 20 and f", {n}), REPARTITION_BY_NUM" in text and text.count("Exchange hashpartitioning(ts_code") == 1, text
    key = lambda x: (x.ts_code, x.trade_date)
    assert sorted(r.hfq_by_security.collect(), key=key) == sorted(r.hfq.collect(), key=key)


def test_line_items_are_dealt_before_their_actions_are_counted(spark, tmp_root):
    sf = _lineitem(spark, tmp_root, 60)
    plan = TD._daily_actions(spark, sf, "lineitem")
    assert _nodes(plan, "Exchange hashpartitioning") == 1
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.rindex("HashAggregate") < text.index("Exchange hashpartitioning")  # no partial aggregate below it


def test_known_chunks_are_looked_up_once(monkeypatch):
    """The token files' distinct chunks went through two sets and a second look-up."""
    from eqlake.llm import chunks, token_files

    asked = []
    cache = chunks.AgedChunkCache(lambda new: [asked.append(c) or c.encode() for c in new], limit=3, limit_chars=1_000)
    for some in ([], ["a", "b"], ["b", "", "c"], ["d", "a"], ["a", "e", "b"]):
        assert cache.values(some) == [c.encode() for c in some]
    assert asked == ["a", "b", "", "c", "d", "e"] and set(cache.known) == {"d", "a", "e", "b"} and cache.chars == 4
    assert cache.learn([["a", "f"]])["f"] == b"f" and asked[-1] == "f"
    monkeypatch.setattr(cache, "learn", None)
    assert token_files.encode_documents(["x y x", "", " y"], cache) == [b"x y x", b"", b" y"]
