"""Brute-force check of the evaluation metrics (E1-E7) with per-date Python
loops written from the metric definitions, on the sf0.001 events panel with the
factor rounded to one decimal (forces ties)."""

import math
from itertools import pairwise

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from eqlake.operators import evaluation as EV
from eqlake.operators import factors as FX
from eqlake.plans.research import Research


def _avg_rank(values):
    return pd.Series(values).rank(method="average").to_numpy()


def _corr(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    if a.std() == 0 or b.std() == 0:
        return None
    c = float(np.corrcoef(a, b)[0, 1])
    return c if math.isfinite(c) else None


def _brute(f: pd.DataFrame, lab: pd.DataFrame, higher_is_better: bool | None):
    f = f.assign(fv=f.factor_value.where(np.isfinite(f.factor_value.astype(float))))
    ev = f.merge(lab, on=["ts_code", "trade_date"]).dropna(subset=["fv", "forward_return_5d"])
    ics, rics, qs, ls, fav = [], [], [[] for _ in range(5)], [], []
    for d, g in sorted(ev.groupby("trade_date"), key=lambda x: x[0]):
        if len(g) < 5 or g.fv.nunique() < 2 or g.forward_return_5d.nunique() < 2:
            continue
        ic = _corr(g.fv, g.forward_return_5d)
        ric = _corr(_avg_rank(g.fv), _avg_rank(g.forward_return_5d))
        if ic is None or ric is None:
            continue
        ics.append(ic)
        rics.append(ric)
        s = g.sort_values(["fv", "ts_code"]).reset_index(drop=True)
        s["q"] = (np.arange(len(s)) * 5 // len(s)) + 1
        means = s.groupby("q").forward_return_5d.mean()
        for k in range(5):
            qs[k].append(means[k + 1])
        if higher_is_better is not None:
            ls.append(means[5] - means[1] if higher_is_better else means[1] - means[5])
            fav.append(set(s[s.q == (5 if higher_is_better else 1)].ts_code))
    turn = []
    for a, b in pairwise(fav):
        wa, wb = 1 / len(a), 1 / len(b)
        turn.append(0.5 * sum(abs((wb if c in b else 0) - (wa if c in a else 0)) for c in a | b))
    auto = []
    frames = [g for _, g in sorted(f.groupby("trade_date"), key=lambda x: x[0])]
    for p, c in pairwise(frames):
        m = p.dropna(subset=["fv"])[["ts_code", "fv"]].merge(c.dropna(subset=["fv"])[["ts_code", "fv"]], on="ts_code")
        if len(m) < 5 or m.fv_x.nunique() < 2 or m.fv_y.nunique() < 2:
            continue
        v = _corr(m.fv_x, m.fv_y)
        if v is not None:
            auto.append(v)
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    return {
        "ic_5d_mean": mean(ics), "rank_ic_5d_mean": mean(rics), "rank_ic_5d_count": len(rics),
        "rank_ic_5d_std": float(np.std(rics, ddof=1)) if len(rics) >= 2 else None,
        "positive_ic_ratio": mean([1.0 if x > 0 else 0.0 for x in rics]),
        **{f"q{k + 1}_return": mean(qs[k]) for k in range(5)},
        "long_short_return": mean(ls), "turnover": mean(turn) if len(fav) >= 2 else None,
        "factor_autocorr_1d": mean(auto),
    }


@pytest.mark.parametrize("higher_is_better", [False, True])
def test_evaluation_matches_brute_force(spark, higher_is_better):
    from dataclasses import replace

    r = Research(spark, SMALL)
    factors = r.processed().select("ts_code", "trade_date", "factor_name", F.round("factor_value", 1).alias("factor_value"), "factor_version")
    meta = replace(FX.RETURN_5D, higher_is_better=higher_is_better)
    rep = EV.validate_factor(factors, r.labels, r.universe, meta).first().asDict()
    fp = factors.toPandas()
    lp = r.labels.toPandas()
    want = _brute(fp, lp, higher_is_better)
    assert want["rank_ic_5d_count"] > 5
    for k, v in want.items():
        if v is None:
            assert rep[k] is None, k
        else:
            assert rep[k] == pytest.approx(v, abs=1e-9), k
