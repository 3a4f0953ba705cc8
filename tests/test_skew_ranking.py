"""The range-partitioned (skew-safe) ranking gives the same answers as the
per-date windows, including a date that holds most of the rows and ties."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from eqlake.functions.ranking import group_positions, ranks_in_group
from eqlake.functions.stats import average_rank, position_quantile
from eqlake.operators import evaluation as EV
from eqlake.operators import factors as FX
from eqlake.operators import processing as PR
from eqlake.plans.research import Research
from helpers import D


def _hot(spark):
    # one hot date with 2000 rows (many ties), two small dates
    rows = [(D(2024, 1, 2), f"{i:06d}.SZ", float(i % 37)) for i in range(2000)]
    rows += [(D(2024, 1, 3), f"{i:06d}.SZ", float(i)) for i in range(7)]
    rows += [(D(2024, 1, 4), f"{i:06d}.SZ", float(-i)) for i in range(3)]
    return spark.createDataFrame(rows, "trade_date date, ts_code string, v double")


def test_positions_are_dense_and_complete(spark):
    df = _hot(spark)
    p = group_positions(df, ["trade_date"], ["v", "ts_code"], num_partitions=16)
    assert p.count() == df.count()
    per = {r.trade_date: (r.lo, r.hi, r.n, r.gn) for r in p.groupBy("trade_date").agg(
        F.min("_pos").alias("lo"), F.max("_pos").alias("hi"), F.count(F.lit(1)).alias("n"), F.max("_gn").alias("gn")).collect()}
    assert per[D(2024, 1, 2)] == (0, 1999, 2000, 2000)
    assert per[D(2024, 1, 4)] == (0, 2, 3, 3)


def test_range_ranks_equal_window_ranks(spark):
    df = _hot(spark)
    got = ranks_in_group(df, ["trade_date"], "v", ["ts_code"], avg_rank="r", quantile="q", num_partitions=16)
    want = df.select("*", average_rank("v", "trade_date").alias("r"), position_quantile(["v", "ts_code"], "trade_date").alias("q"))
    a = sorted(tuple(x) for x in got.select("trade_date", "ts_code", "r", "q").collect())
    b = sorted(tuple(x) for x in want.select("trade_date", "ts_code", "r", "q").collect())
    assert a == b


def test_one_value_may_hold_most_rows(spark):
    # One date, and 1,900 of its 2,000 rows share one value; nulls get no rank.
    rows = [(D(2024, 1, 2), f"{i:06d}.SZ", float(i) if i < 50 else 0.0 if i < 1950 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "trade_date date, ts_code string, v double").withColumn("ok", F.col("v").isNotNull())
    got = ranks_in_group(df, ["trade_date", "ok"], "v", ["ts_code"], avg_rank="r", group_size="n", num_partitions=16)
    want = df.select("*", F.when(F.col("ok"), average_rank("v", ["trade_date", "ok"])).alias("r"),
                     F.count(F.lit(1)).over(Window.partitionBy("trade_date", "ok")).alias("n"))
    a = sorted(got.select("ts_code", "ok", "n", F.coalesce("r", F.lit(-1.0))).collect())
    assert len(a) == 2000
    assert a == sorted(want.select("ts_code", "ok", "n", F.coalesce("r", F.lit(-1.0))).collect())


def test_rank_pct_matches_windows_on_panel(spark):
    calc = Research(spark, SMALL).calc()
    raw = PR.process_factor_result(calc, FX.RETURN_5D, "raw", check_identity=False)
    valid = F.col("factor_value").isNotNull()
    rank = average_rank("factor_value", [F.col("trade_date"), valid])
    n = F.count("factor_value").over(Window.partitionBy("trade_date"))
    want = raw.select("ts_code", "trade_date", F.when(valid, rank / n).alias("processed_value"))
    got = PR.process_factor_result(calc, FX.RETURN_5D, "rank_pct", check_identity=False)
    key = lambda df: sorted((x.ts_code, x.trade_date, None if x.processed_value is None else round(x.processed_value, 12)) for x in df.collect())
    assert key(got) == key(want)


def test_ranked_pairs_match_windows_on_panel(spark):
    r = Research(spark, SMALL)
    pairs = EV.evaluation_pairs(r.processed().select(*EV.FACTOR_COLUMNS), r.labels)
    got = EV.ranked_pairs(pairs)
    windows = pairs.select("ts_code", "trade_date", average_rank("_fv", "trade_date").alias("_rf"),
                           average_rank("_fr", "trade_date").alias("_rr"), position_quantile(["_fv", "ts_code"], "trade_date").alias("_q"))
    want = windows.join(got.select("trade_date").distinct(), "trade_date", "left_semi")
    cols = ["ts_code", "trade_date", "_rf", "_rr", "_q"]
    a = sorted(tuple(x) for x in got.select(*cols).collect())
    assert a and a == sorted(tuple(x) for x in want.select(*cols).collect())


def test_order_buckets_never_fall(spark):
    import math
    import random

    from eqlake.functions.ranking import order_bucket

    rng = random.Random(8)
    values = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.0**-1074 * 3, 1.7e308, -1.7e308]
    values += [s * math.nextafter(2.0**k, up) for k in range(-60, 61, 7) for up in (0.0, math.inf) for s in (1, -1)] + [2.0**k for k in range(-1074, 1024, 31)]
    values += [rng.gauss(0, 10 ** rng.randint(-6, 6)) for _ in range(2_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = sorted((r[0], r[1]) for r in df.select("v", order_bucket(F.col("v"))).collect())
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:]))
    assert len({b for _, b in got}) > 1_000


def test_selected_quantiles_are_exact(spark, monkeypatch):
    import random

    rng = random.Random(9)
    values = [rng.choice([1.5, 2.5, rng.gauss(0, 1), rng.gauss(0, 1e-9) + 3, rng.expovariate(1) * 1e6]) for _ in range(5_001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").cache()
    ranks = [0, 1, 1_250, 2_500, 3_333, 5_000]
    want = {r: sorted(values)[r] for r in ranks}
    for few in (0, 3, 10_000):
        monkeypatch.setattr(EV, "SELECTED_VALUES", few)
        assert EV.order_statistics(df, "v", len(values), ranks) == want
    assert EV.order_statistics(df.where("v > 1e12"), "v", 0, [0, -1]) == {}
    assert tuple(EV.exact_quantiles(df.where("v IS NULL"), "v", {"p": 0.5}).first()) == (None,)
