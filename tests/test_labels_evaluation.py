import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from eqlake.operators import evaluation as EV
from eqlake.operators import factors as FX
from eqlake.operators import labels as LB
from helpers import D, factors_df, labels_df

L = [0.01, 0.02, 0.03, 0.04, 0.05]


def _dates(spark, dates):
    return spark.createDataFrame([(d,) for d in dates], "trade_date date")


def _opens(spark, pairs, code="000001.SZ"):
    return spark.createDataFrame([(code, d, None if o is None else float(o)) for d, o in pairs], "ts_code string, trade_date date, hfq_open double")


def test_label_across_weekend(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 8), D(2024, 1, 9), D(2024, 1, 10)]
    panel = _opens(spark, list(zip(days, [10.0, 11, 12, 13, 14, 15, 16])))
    out = LB.forward_return_5d(panel, _dates(spark, days)).orderBy("trade_date").collect()
    assert out[0].forward_return_5d == pytest.approx(16 / 11 - 1)
    assert [r.forward_return_5d for r in out[1:]] == [None] * 6


def test_label_missing_entry_row(spark):
    days = [D(2024, 1, 2) + dt.timedelta(days=i) for i in range(7)]
    panel = _opens(spark, [(d, 10.0 + i) for i, d in enumerate(days) if i != 1])
    out = LB.forward_return_5d(panel, _dates(spark, days)).orderBy("trade_date").collect()
    assert out[0].forward_return_5d is None


@pytest.mark.parametrize("entry", [None, 0.0])
def test_label_null_or_zero_entry(spark, entry):
    days = [D(2024, 1, 2) + dt.timedelta(days=i) for i in range(7)]
    opens = [10.0, entry, 12, 13, 14, 15, 16]
    panel = _opens(spark, list(zip(days, opens)))
    assert LB.forward_return_5d(panel, _dates(spark, days)).orderBy("trade_date").first().forward_return_5d is None


def test_label_input_checks(spark):
    days = [D(2024, 1, 2)]
    dup = _opens(spark, [(days[0], 1.0), (days[0], 2.0)])
    with pytest.raises(ValueError):
        LB.forward_return_5d(dup, _dates(spark, days))
    with pytest.raises(ValueError):
        LB.forward_return_5d(_opens(spark, [(days[0], 1.0)]), _dates(spark, []))
    with pytest.raises(ValueError):
        LB.forward_return_5d(_opens(spark, [(days[0], 1.0)]), _dates(spark, days + days))


def test_warmup_start(spark):
    cal = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(10)], "cal_date date")
    assert LB.warmup_start_date(cal, D(2024, 1, 6), 5) == D(2024, 1, 1)
    assert LB.warmup_start_date(cal, D(2024, 1, 6), 0) == D(2024, 1, 6)
    with pytest.raises(ValueError):
        LB.warmup_start_date(cal, D(2024, 1, 6), 6)
    with pytest.raises(ValueError):
        LB.warmup_start_date(cal, D(1990, 1, 1), 1)


def _report(spark, factors, labels, universe, meta=FX.RETURN_5D):
    return EV.validate_factor(factors, labels, universe, meta).first().asDict(recursive=True)


def test_report_golden_two_equal_days(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    f = factors_df(spark, days, [[1, 2, 3, 4, 5]] * 2)
    r = _report(spark, f, labels_df(spark, days, [L] * 2), f.select("ts_code", "trade_date"))
    assert (r["start_date"], r["end_date"]) == tuple(days)
    assert (r["row_count"], r["trade_date_count"], r["security_count"]) == (10, 2, 5)
    assert r["missing_value_rate"] == 0.0
    assert [c["coverage"] for c in r["coverage_by_date"]] == [1.0, 1.0]
    assert r["mean"] == pytest.approx(3.0) and r["min"] == 1.0 and r["max"] == 5.0
    assert (r["p25"], r["median"], r["p75"]) == (pytest.approx(2.0), pytest.approx(3.0), pytest.approx(4.0))
    assert r["ic_5d_mean"] == pytest.approx(1.0) and r["rank_ic_5d_mean"] == pytest.approx(1.0)
    assert r["rank_ic_5d_std"] == pytest.approx(0.0) and r["rank_ic_5d_count"] == 2
    assert r["ic_ir"] is None and r["positive_ic_ratio"] == 1.0
    for k, v in enumerate(L, 1):
        assert r[f"q{k}_return"] == pytest.approx(v)
    assert r["long_short_return"] == pytest.approx(-0.04)
    assert r["turnover"] == pytest.approx(0.0)
    assert r["factor_autocorr_1d"] == pytest.approx(1.0)


def test_report_coverage_and_small_cross_section(spark):
    day = D(2024, 1, 2)
    f = factors_df(spark, [day], [[1.0, 2.0, None, float("inf")]])
    uni = f.select("ts_code", "trade_date").unionByName(spark.createDataFrame([("999999.SZ", day)], "ts_code string, trade_date date"))
    r = _report(spark, f, labels_df(spark, [day], [[0.01, 0.02, 0.03, 0.04]]), uni)
    assert r["missing_value_rate"] == pytest.approx(0.5)
    cov = r["coverage_by_date"][0]
    assert (cov["universe_count"], cov["valid_count"]) == (5, 2) and cov["coverage"] == pytest.approx(0.4)
    assert r["rank_ic_5d_count"] == 0
    for k in ("ic_5d_mean", "rank_ic_5d_mean", "q1_return", "long_short_return", "turnover", "factor_autocorr_1d"):
        assert r[k] is None


def test_report_ties_use_average_ranks(spark):
    day = D(2024, 1, 2)
    f = factors_df(spark, [day], [[1, 2, 2, 4, 5]])
    r = _report(spark, f, labels_df(spark, [day], [L]), f.select("ts_code", "trade_date"))
    assert r["rank_ic_5d_count"] == 1
    assert r["rank_ic_5d_mean"] == pytest.approx(0.9746794344808963)
    assert r["rank_ic_5d_std"] is None


def test_report_direction_turnover_autocorr(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    f = factors_df(spark, days, [[1, 2, 3, 4, 5], [5, 2, 3, 4, 1]])
    meta = replace(FX.RETURN_5D, higher_is_better=True)
    r = _report(spark, f, labels_df(spark, days, [L] * 2), f.select("ts_code", "trade_date"), meta)
    assert r["turnover"] == pytest.approx(1.0)
    assert r["long_short_return"] == pytest.approx(0.0)
    assert r["factor_autocorr_1d"] == pytest.approx(-0.6)


def test_report_unknown_direction(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    f = factors_df(spark, days, [[1, 2, 3, 4, 5]] * 2)
    meta = replace(FX.RETURN_5D, higher_is_better=None)
    r = _report(spark, f, labels_df(spark, days, [L] * 2), f.select("ts_code", "trade_date"), meta)
    assert r["long_short_return"] is None and r["turnover"] is None


def test_report_universe_dates(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    f = factors_df(spark, [days[0]], [[1, 2, 3, 4, 5]])
    uni = labels_df(spark, days, [[None] * 5] * 2).select("ts_code", "trade_date")
    r = _report(spark, f, labels_df(spark, [days[0]], [L]), uni)
    assert (r["start_date"], r["end_date"]) == tuple(days)
    assert [c["coverage"] for c in r["coverage_by_date"]] == [1.0, 0.0]


def test_report_empty_middle_date_breaks_autocorr(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 4)]
    f = factors_df(spark, days, [[1, 2, 3, 4, 5], [None] * 5, [1, 2, 3, 4, 5]])
    r = _report(spark, f, labels_df(spark, days, [L] * 3), f.select("ts_code", "trade_date"))
    assert r["factor_autocorr_1d"] is None


def test_report_equal_date_weights(spark):
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    f = factors_df(spark, days, [[1, 2, 3, 4, 5], list(range(1, 11))])
    lab = labels_df(spark, days, [L, [0.10, 0.09, 0.08, 0.07, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]])
    r = _report(spark, f, lab, f.select("ts_code", "trade_date"))
    assert r["ic_5d_mean"] == pytest.approx(0.0, abs=1e-12)
    assert r["rank_ic_5d_mean"] == pytest.approx(0.0, abs=1e-12)
    assert r["q1_return"] == pytest.approx((0.01 + 0.095) / 2)


def test_report_input_checks(spark):
    days = [D(2024, 1, 2)]
    f = factors_df(spark, days, [[1, 2, 3, 4, 5]])
    lab = labels_df(spark, days, [L])
    with pytest.raises(ValueError):
        EV.validate_factor(f, lab, f.select("ts_code", "trade_date"), FX.MOMENTUM_20D)
    with pytest.raises(ValueError):
        EV.validate_factor(f.unionByName(f), lab, f.select("ts_code", "trade_date"), FX.RETURN_5D)
    other = labels_df(spark, [D(2024, 1, 3)], [L])
    with pytest.raises(ValueError):
        EV.validate_factor(f, other, f.select("ts_code", "trade_date"), FX.RETURN_5D)


def test_position_quintiles_differ_from_ntile(spark):
    from pyspark.sql import functions as F
    from eqlake.functions.stats import position_quantile

    df = spark.createDataFrame([(D(2024, 1, 2), float(i), f"{i}") for i in range(7)], "d date, v double, c string")
    q = [r.q for r in df.select("v", position_quantile(["v", "c"], "d").alias("q")).orderBy("v").collect()]
    assert q == [1, 1, 2, 3, 3, 4, 5]
    assert F is not None


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "v double")
    r = EV.exact_quantiles(df, "v", {"p25": 0.25, "p50": 0.5, "p90": 0.9}).first()
    assert r.p25 == pytest.approx(2.0) and r.p50 == pytest.approx(3.0) and r.p90 == pytest.approx(7.6)


def test_distribution_quantiles_match_percentile(spark):
    f = factors_df(spark, [D(2024, 1, 2), D(2024, 1, 3)], [[1, 2, 3, 4, 10, None], [2, 2, 7, float("inf"), 5, 1]])
    a = EV.factor_distribution(f).first().asDict()
    want = EV.clean_factors(f).agg(*[F.percentile("_fv", p).alias(n) for n, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))]).first()
    for k, v in want.asDict().items():
        assert a[k] == pytest.approx(v), k
    assert a["median"] == pytest.approx(2.5) and a["row_count"] == 12
