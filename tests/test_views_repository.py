import pytest

from eqlake.operators import repository as Q
from eqlake.operators import views as V
from helpers import D

BAR_SCHEMA = (
    "ts_code string, trade_date date, open double, high double, low double, close double, pre_close double, "
    "change double, pct_chg double, volume double, amount double, is_suspended boolean, is_st boolean, limit_status long"
)


def _bars(spark):
    rows = [
        ("000001.SZ", D(2024, 1, 2), 10.0, 11.0, 9.0, 10.5, 10.0, 0.5, 5.0, 1000.0, 10500.0, False, False, 1),
        ("000001.SZ", D(2024, 1, 3), 10.5, 12.5, 10.0, 12.0, 10.5, 1.5, 14.0, 1500.0, 18000.0, False, False, 1),
        ("000002.SZ", D(2024, 1, 2), 5.0, 5.2, 4.9, 5.1, 5.0, 0.1, 2.0, 2000.0, 10200.0, True, False, -1),
    ]
    return spark.createDataFrame(rows, BAR_SCHEMA)


def _adj(spark):
    rows = [("000001.SZ", D(2024, 1, 2), 1.5), ("000001.SZ", D(2024, 1, 3), 2.0), ("000002.SZ", D(2024, 1, 2), 1.0)]
    return spark.createDataFrame(rows, "ts_code string, trade_date date, cumulative_factor double")


def test_hfq_bars(spark):
    rows = Q.daily_bars(_bars(spark), _adj(spark), "000001.SZ", D(2024, 1, 1), D(2024, 1, 3), adjustment="hfq").collect()
    assert [r.hfq_close for r in rows] == pytest.approx([15.75, 24.0])
    assert "pre_close" not in rows[0].asDict() and len(rows[0]) == 16


def test_qfq_asof_bars(spark):
    rows = Q.daily_bars(_bars(spark), _adj(spark), "000001.SZ", D(2024, 1, 1), D(2024, 1, 3), adjustment="qfq",
                        as_of_date=D(2024, 1, 3)).collect()
    assert [r.trade_date for r in rows] == [D(2024, 1, 2), D(2024, 1, 3)]
    assert [r.qfq_close for r in rows] == pytest.approx([7.875, 12.0])


def test_qfq_asof_excludes_later_rows_and_factors(spark):
    rows = Q.daily_bars(_bars(spark), _adj(spark), "000001.SZ", D(2024, 1, 1), D(2024, 1, 3), adjusted=True,
                        as_of_date=D(2024, 1, 2)).collect()
    assert len(rows) == 1 and rows[0].qfq_close == pytest.approx(10.5)
    empty = Q.daily_bars(_bars(spark), _adj(spark), "000001.SZ", D(2024, 1, 3), D(2024, 1, 4), adjustment="qfq",
                         as_of_date=D(2024, 1, 2))
    assert empty.count() == 0


def test_latest_views(spark):
    bars = _bars(spark).filter("ts_code = '000001.SZ' and trade_date = date'2024-01-02'")
    adj = spark.createDataFrame([("000001.SZ", D(2024, 1, 2), 2.0)], "ts_code string, trade_date date, cumulative_factor double")
    h = V.hfq_view(bars, adj).first()
    q = V.qfq_latest_view(bars, adj).first()
    a = V.adj_alias_view(bars, adj).first()
    assert h.hfq_close == pytest.approx(21.0) and q.qfq_close == pytest.approx(10.5) and a.adj_close == pytest.approx(10.5)


def test_missing_factor_keeps_row(spark):
    adj = _adj(spark).filter("trade_date = date'2024-01-02'")
    rows = {(r.ts_code, r.trade_date): r for r in V.hfq_view(_bars(spark), adj).collect()}
    assert len(rows) == 3 and rows[("000001.SZ", D(2024, 1, 3))].hfq_close is None


def test_panel(spark):
    p = Q.daily_panel(_bars(spark), _adj(spark), D(2024, 1, 2), D(2024, 1, 3), ["hfq_close", "amount", "ts_code"], order=True)
    assert p.columns == ["ts_code", "trade_date", "hfq_close", "amount"]
    assert [r.hfq_close for r in p.collect()] == pytest.approx([15.75, 24.0, 5.1])
    with pytest.raises(ValueError):
        Q.daily_panel(_bars(spark), _adj(spark), D(2024, 1, 2), D(2024, 1, 3), ["close"], adjustment="qfq")
    with pytest.raises(ValueError):
        Q.daily_panel(_bars(spark), _adj(spark), D(2024, 1, 2), D(2024, 1, 3), ["hfq_close"], adjustment="none")
    with pytest.raises(ValueError):
        Q.daily_panel(_bars(spark), _adj(spark), D(2024, 1, 2), D(2024, 1, 3), ["close; drop"])


def test_cross_section(spark):
    assert Q.cross_section(_bars(spark), D(2024, 1, 2)).count() == 2
    assert Q.cross_section(_bars(spark), D(2024, 1, 2), exclude_suspended=True).count() == 1
    with pytest.raises(ValueError):
        Q.cross_section(_bars(spark), D(2024, 1, 2), [])
    with pytest.raises(ValueError):
        Q.daily_bars(_bars(spark), _adj(spark), "000001.SZ", D(2024, 1, 1), D(2024, 1, 3), adjustment="raw")


def test_factor_reads_and_calendar(spark):
    rows = [("000001.SZ", D(2024, 1, 2), "momentum_20d", 0.1, "v1"), ("000001.SZ", D(2024, 1, 2), "momentum_20d", 0.2, "v2"),
            ("000001.SZ", D(2024, 1, 2), "volatility_20d", 0.3, "v1"), ("000001.SZ", D(2024, 1, 3), "momentum_20d", 0.4, "v1")]
    f = spark.createDataFrame(rows, "ts_code string, trade_date date, factor_name string, factor_value double, factor_version string")
    assert Q.factors_on_date(f, D(2024, 1, 2), ["momentum_20d", "volatility_20d"]).count() == 3
    assert Q.factors_on_date(f, D(2024, 1, 2), ["momentum_20d"], factor_version="v1").count() == 1
    with pytest.raises(ValueError):
        Q.factors_on_date(f, D(2024, 1, 2), [])
    assert Q.factor_panel(f, D(2024, 1, 1), D(2024, 1, 3), "momentum_20d").count() == 2
    cal = spark.createDataFrame([("SSE", D(2024, 1, d), d % 7 not in (6, 0), None) for d in range(1, 15)],
                                "exchange string, cal_date date, is_open boolean, pretrade_date date")
    assert Q.trade_calendar(cal, D(2024, 1, 1), D(2024, 1, 7)).count() == 7
    assert Q.open_trade_date_list(cal, D(2024, 1, 1), D(2024, 1, 7)) == [D(2024, 1, d) for d in (1, 2, 3, 4, 5)]
    assert Q.first_row(_adj(spark), ["trade_date"]).first().cumulative_factor == 2.0
