"""Factor evaluation (E1-E8) and factor statistics (AG5-AG7).

Every per-date quantity is a grouped aggregate over the ranked pairs. Ranks come from
counts of equal values added up in two levels (``functions.ranking``), so no date and
no tied value has to fit one task, and quantiles from narrowing histograms:

* E1 eligible dates: >= 5 pairs and >= 2 distinct values on both sides (``min < max``);
* E2/E3 Pearson IC on values and Spearman RankIC on average-tie ranks, with a
  correlation that never raises (``safe_corr``);
* E4/E5 quintile by position in (factor, ts_code) order, mean label per quintile,
  long-short by the factor's direction;
* E6 turnover of the favoured quintile between adjacent eligible dates, in
  closed form ``1 - |A ∩ B| * min(1/|A|, 1/|B|)``; membership of the previous
  eligible date is read with a range frame over the eligible-date index
  (one shuffle by ``ts_code``, no self join);
* E7 one-day factor autocorrelation over adjacent factor-panel dates (a date with
  no valid value still breaks adjacency), same range-frame technique.

Per-date and per-pair averages are equal-weight over dates, never pooled.
Dates are calendar-shaped (one row per trade date), so the date-index tables
that get broadcast are bounded by the date range.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eqlake.functions.ranking import materialize as _materialize
from eqlake.functions.ranking import order_bucket, ranks_in_group
from eqlake.functions.stats import finite_or_null, safe_corr
from eqlake.operators.contracts import identity_check, reject_duplicate_keys, require_columns, require_date_subset
from eqlake.operators.factors import FactorMetadata
from eqlake.operators.labels import calendar_index

MIN_CROSS_SECTION_SIZE = 5
QUANTILE_COUNT = 5
FACTOR_COLUMNS = ("ts_code", "trade_date", "factor_name", "factor_value", "factor_version")
LABEL_COLUMNS = ("ts_code", "trade_date", "forward_return_5d")
KEY = ["ts_code", "trade_date"]

REPORT_COLUMNS = (
    "factor_name", "factor_version", "start_date", "end_date", "row_count", "trade_date_count", "security_count",
    "missing_value_rate", "mean", "std", "min", "p25", "median", "p75", "max", "ic_5d_mean", "rank_ic_5d_mean",
    "rank_ic_5d_std", "rank_ic_5d_count", "ic_ir", "positive_ic_ratio", "q1_return", "q2_return", "q3_return",
    "q4_return", "q5_return", "long_short_return", "turnover", "factor_autocorr_1d",
)


def clean_factors(factors: DataFrame) -> DataFrame:
    if "_fv" in factors.columns:
        return factors
    return factors.select("*", finite_or_null("factor_value").alias("_fv"))


def clean_labels(labels: DataFrame) -> DataFrame:
    return labels.select("*", finite_or_null("forward_return_5d").alias("_fr"))


# ---------------------------------------------------------------------------
# AG5-AG7
# ---------------------------------------------------------------------------


def coverage_by_date(factors: DataFrame, universe: DataFrame) -> DataFrame:
    """AG5: per universe date, universe rows, valid factor rows and their ratio."""
    fc = clean_factors(factors).select(*KEY, "_fv")
    j = universe.select(*KEY).join(fc, KEY, "left")
    return (
        j.groupBy("trade_date")
        .agg(F.count(F.lit(1)).alias("universe_count"), F.count("_fv").alias("valid_count"))
        .withColumn("coverage", F.col("valid_count").cast("double") / F.col("universe_count").cast("double"))
    )


#: Values that the selection of an order statistic may bring to the driver in the end, per statistic.
SELECTED_VALUES = 10_000
#: Pieces into which a selection cuts a range of values.
SELECTION_STEPS = 4_096


def order_statistics(values: DataFrame, col: str, n: int, ranks: Sequence[int]) -> dict[int, float]:
    """The values at 0-based ``ranks`` of the ``n`` finite values of a column, by narrowing histograms.

    The first histogram counts value buckets (``order_bucket``); each next one cuts the ranges that
    hold a rank into equal steps, until a range has one value or few rows, which are fetched. A
    round is one partial aggregate; what reaches the driver is bounded whatever ``n`` is."""
    v = values.select(F.col(col).alias("v")).where(F.col("v").isNotNull())
    stats = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    # Every wanted rank: the range that holds it, and its rank within the range.
    whole = v.groupBy(order_bucket(F.col("v")).alias("at")).agg(*stats)
    out: dict[int, float] = {}
    open_ranks = {r: ([(x["n"], x["lo"], x["hi"]) for x in whole.collect()], r) for r in set(ranks) if 0 <= r < n}
    while open_ranks:
        pending: dict[int, tuple[int, float, float, int]] = {}
        for r, (pieces, k) in open_ranks.items():
            for size, lo, hi in sorted(pieces, key=lambda x: x[1]):
                if k < size:
                    break
                k -= size
            if lo == hi:
                out[r] = lo
            else:
                pending[r] = (size, lo, hi, k)
        if not pending:
            break
        small = {r: p for r, p in pending.items() if p[0] <= SELECTED_VALUES}
        within = lambda lo, hi: F.col("v").between(F.lit(lo), F.lit(hi))
        ranges = sorted({(lo, hi) for _, lo, hi, _ in pending.values()})
        kept = v.where(reduce(or_, [within(lo, hi) for lo, hi in ranges]))
        if len(small) == len(pending):
            found = sorted(x["v"] for x in kept.collect())  # a few ranges of few values
            for r, (_, lo, _, k) in small.items():
                out[r] = found[bisect_left(found, lo) + k]
            break
        number = F.coalesce(*[F.when(within(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(ranges)])
        step = F.coalesce(*[F.when(within(lo, hi), F.floor((F.col("v") - lo) / F.lit(hi - lo) * SELECTION_STEPS)) for lo, hi in ranges])
        cut = kept.groupBy(number.alias("range"), step.alias("at")).agg(*stats).collect()
        pieces = {i: [(x["n"], x["lo"], x["hi"]) for x in cut if x["range"] == i] for i in range(len(ranges))}
        open_ranks = {r: (pieces[ranges.index((lo, hi))], k) for r, (_, lo, hi, k) in pending.items()}
    return out


def exact_quantiles(values: DataFrame, col: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolated quantiles of the finite values: one row with a column per entry of
    ``probs`` (null for no values). ``values`` is read a few times: give it stored."""
    n = values.agg(F.count(col)).first()[0]
    at = {name: p * (n - 1) for name, p in probs.items()}
    found = order_statistics(values, col, n, [r for x in at.values() for r in (math.floor(x), math.ceil(x))])
    row = []
    for x in at.values():
        lo, hi = found.get(math.floor(x)), found.get(math.ceil(x))
        row.append(None if lo is None else lo + (hi - lo) * (x - math.floor(x)))
    return values.sparkSession.createDataFrame([tuple(row)], ", ".join(f"{name} double" for name in probs))


_PROBS = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def factor_distribution(factors: DataFrame, *, stored: bool = False) -> DataFrame:
    """AG6 + AG7: counts, missing rate and distribution of valid values (one row)."""
    fc = clean_factors(factors)
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("trade_date").alias("trade_date_count"),
        F.count_distinct("ts_code").alias("security_count"),
        F.count("_fv").alias("_valid"),
        F.avg("_fv").alias("mean"),
        F.stddev_samp("_fv").alias("std"),
        F.min("_fv").alias("min"),
        F.max("_fv").alias("max"),
    ]
    # One narrow column, unless the caller has stored the panel.
    stored = fc if stored else _materialize(fc.select("_fv"))
    base = _one_row_join(fc.agg(*aggs), exact_quantiles(stored, "_fv", _PROBS))
    base = base.select(
        "*", (F.lit(1.0) - F.try_divide(F.col("_valid").cast("double"), F.col("row_count").cast("double"))).alias("missing_value_rate")
    )
    return base.select(
        "row_count", "trade_date_count", "security_count", "missing_value_rate", "mean",
        finite_or_null("std").alias("std"), "min", "p25", "median", "p75", "max",
    )


def _one_row_join(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates side by side (equi join on a constant key)."""
    out = frames[0].select("*", F.lit(1).alias("_one"))
    for f in frames[1:]:
        out = out.join(F.broadcast(f.select("*", F.lit(1).alias("_one"))), "_one")
    return out


# ---------------------------------------------------------------------------
# E1-E5
# ---------------------------------------------------------------------------


def evaluation_pairs(factors: DataFrame, labels: DataFrame) -> DataFrame:
    """Factor x label on the key, both finite."""
    fc = clean_factors(factors).select(*KEY, "_fv")
    lc = clean_labels(labels).select(*KEY, "_fr")
    return fc.join(lc, KEY, "inner").filter(F.col("_fv").isNotNull() & F.col("_fr").isNotNull())


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """E1 eligibility + average-tie ranks of factor and label + position quintile.

    The pairs are written once, as keys and two numbers; the ranks are read from counts of them. A
    rank within a date doesn't depend on other dates, so the dates are chosen at the end."""
    pairs = _materialize(pairs.select(*KEY, "_fv", "_fr"))
    by_factor = ranks_in_group(pairs, ["trade_date"], "_fv", ["ts_code"], avg_rank="_rf", quantile="_q", n_groups=QUANTILE_COUNT)
    ranked = ranks_in_group(by_factor, ["trade_date"], "_fr", ["ts_code"], avg_rank="_rr", stored=pairs)
    dates = pairs.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_fv").alias("_f_lo"), F.max("_fv").alias("_f_hi"),
        F.min("_fr").alias("_r_lo"), F.max("_fr").alias("_r_hi"),
    )
    ok = (F.col("_n") >= MIN_CROSS_SECTION_SIZE) & (F.col("_f_lo") < F.col("_f_hi")) & (F.col("_r_lo") < F.col("_r_hi"))
    # One row per date: calendar-bounded broadcast.
    return ranked.join(F.broadcast(dates.filter(ok).select("trade_date")), "trade_date")


def favoured_quantile(higher_is_better: bool | None) -> int:
    if higher_is_better is True:
        return QUANTILE_COUNT
    if higher_is_better is False:
        return 1
    return 0


def daily_metrics(ranked: DataFrame, higher_is_better: bool | None) -> DataFrame:
    """E2-E5 per eligible date: ic, rank_ic, q1..q5 mean label, long_short.

    Dates whose correlation is null/non-finite are dropped (they are not
    eligible either for quintiles or turnover).
    """
    aggs = [
        safe_corr("_fv", "_fr").alias("ic"),
        safe_corr("_rf", "_rr").alias("rank_ic"),
        F.count(F.lit(1)).alias("n_pairs"),
    ]
    aggs += [F.avg(F.when(F.col("_q") == k, F.col("_fr"))).alias(f"q{k}") for k in range(1, QUANTILE_COUNT + 1)]
    if higher_is_better is True:
        ls = F.col(f"q{QUANTILE_COUNT}") - F.col("q1")
    elif higher_is_better is False:
        ls = F.col("q1") - F.col(f"q{QUANTILE_COUNT}")
    else:
        ls = F.lit(None).cast("double")
    d = ranked.groupBy("trade_date").agg(*aggs)
    return d.filter(F.col("ic").isNotNull() & F.col("rank_ic").isNotNull()).select("*", ls.alias("long_short"))


def ic_summary(daily: DataFrame) -> DataFrame:
    """E2/E3/E4/E5 means over dates (one row)."""
    s = daily.agg(
        F.avg("ic").alias("ic_5d_mean"),
        F.avg("rank_ic").alias("rank_ic_5d_mean"),
        F.stddev_samp("rank_ic").alias("rank_ic_5d_std"),
        F.count("rank_ic").alias("rank_ic_5d_count"),
        # Equal values have no spread, whatever rounding leaves of their variance.
        (F.min("rank_ic") < F.max("rank_ic")).alias("_spread"),
        F.avg(F.when(F.col("rank_ic") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("positive_ic_ratio"),
        *[F.avg(f"q{k}").alias(f"q{k}_return") for k in range(1, QUANTILE_COUNT + 1)],
        F.avg("long_short").alias("long_short_return"),
    )
    std = finite_or_null("rank_ic_5d_std")
    ok = std.isNotNull() & F.col("_spread") & (std != 0)
    return s.withColumns({"rank_ic_5d_std": std, "ic_ir": F.when(ok, F.col("rank_ic_5d_mean") / std)}).drop("_spread")


# ---------------------------------------------------------------------------
# E6 turnover, E7 autocorrelation
# ---------------------------------------------------------------------------


def turnover_by_date(ranked: DataFrame, daily: DataFrame, higher_is_better: bool | None) -> DataFrame:
    """E6 per adjacent eligible-date pair: trade_date (the later date) and turnover."""
    fav = favoured_quantile(higher_is_better)
    spark = ranked.sparkSession
    if not fav:
        return spark.createDataFrame([], "trade_date date, turnover double")
    # One row per eligible date: bounded by the date range.
    idx = daily.select("trade_date", F.row_number().over(Window.orderBy("trade_date")).alias("_k"))
    members = ranked.filter(F.col("_q") == fav).select("ts_code", "trade_date").join(F.broadcast(idx), "trade_date")
    wp = Window.partitionBy("ts_code").orderBy("_k").rangeBetween(-1, -1)
    members = members.select("_k", "trade_date", F.count(F.lit(1)).over(wp).alias("_in_prev"))
    per_k = members.groupBy("_k", "trade_date").agg(
        F.count(F.lit(1)).alias("_size"), F.sum("_in_prev").alias("_overlap")
    )
    w = Window.orderBy("_k")
    per_k = per_k.select("*", F.lag("_size").over(w).alias("_prev_size"))
    t = F.lit(1.0) - F.col("_overlap").cast("double") * F.least(
        F.lit(1.0) / F.col("_size").cast("double"), F.lit(1.0) / F.col("_prev_size").cast("double")
    )
    # Eligible dates with no favoured member cannot occur (>= 5 pairs), so
    # consecutive _k rows are adjacent eligible dates.
    return per_k.filter(F.col("_prev_size").isNotNull()).select("trade_date", t.alias("turnover"))


def autocorr_by_date(factors: DataFrame) -> DataFrame:
    """E7 per adjacent factor-panel date pair: trade_date (later) and correlation."""
    fc = clean_factors(factors)
    didx = calendar_index(fc.select("trade_date"))  # every factor date, valid or not
    v = fc.filter(F.col("_fv").isNotNull()).select("ts_code", "trade_date", "_fv").join(F.broadcast(didx), "trade_date")
    wp = Window.partitionBy("ts_code").orderBy("_cidx").rangeBetween(-1, -1)
    v = v.select("trade_date", "_fv", F.first("_fv").over(wp).alias("_prev")).filter(F.col("_prev").isNotNull())
    g = v.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_prev").alias("_a_lo"), F.max("_prev").alias("_a_hi"),
        F.min("_fv").alias("_b_lo"), F.max("_fv").alias("_b_hi"),
        safe_corr("_prev", "_fv").alias("autocorr"),
    )
    ok = (F.col("_n") >= MIN_CROSS_SECTION_SIZE) & (F.col("_a_lo") < F.col("_a_hi")) & (F.col("_b_lo") < F.col("_b_hi"))
    return g.filter(ok & F.col("autocorr").isNotNull()).select("trade_date", "autocorr")


# ---------------------------------------------------------------------------
# E8 report
# ---------------------------------------------------------------------------


def validate_inputs(factors, labels, universe, metadata: FactorMetadata) -> None:
    """QC1/QC7/QC9/QC10 input checks (bounded probes)."""
    require_columns(factors, FACTOR_COLUMNS, "factor input")
    require_columns(labels, LABEL_COLUMNS, "labels")
    require_columns(universe, KEY, "universe")
    if not factors.limit(1).count():
        raise ValueError("factor input must not be empty")
    if not universe.limit(1).count():
        raise ValueError("universe must not be empty")
    reject_duplicate_keys(factors, KEY, "factor input")
    reject_duplicate_keys(labels, KEY, "labels")
    reject_duplicate_keys(universe, KEY, "universe")
    identity_check(factors, metadata.name, metadata.version, "factor input")
    require_date_subset(factors, universe, "factor dates are not all in the universe")
    require_date_subset(factors, labels, "factor dates are not all in the labels")


def validate_factor(factors: DataFrame, labels: DataFrame, universe: DataFrame, metadata: FactorMetadata, *,
                    check_inputs: bool = True, with_coverage: bool = True, materialize: bool = True) -> DataFrame:
    """One-row report (``REPORT_COLUMNS`` + ``coverage_by_date`` array)."""
    if check_inputs:
        validate_inputs(factors, labels, universe, metadata)
    if materialize:
        # The factor panel feeds four branches (pairs, distribution, autocorrelation,
        # coverage): compute it once into the shared checkpoint folder.
        factors = _materialize(clean_factors(factors).select(*FACTOR_COLUMNS, "_fv"))
    # Read by the daily metrics and the turnover.
    ranked = _materialize(ranked_pairs(evaluation_pairs(factors, labels)))
    daily = daily_metrics(ranked, metadata.higher_is_better)
    summary = ic_summary(daily)
    turnover = turnover_by_date(ranked, daily, metadata.higher_is_better).agg(F.avg("turnover").alias("turnover"))
    autocorr = autocorr_by_date(factors).agg(F.avg("autocorr").alias("factor_autocorr_1d"))
    dist = factor_distribution(factors, stored=materialize)
    span = universe.agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))
    parts = [span, dist, summary, turnover, autocorr]
    if with_coverage:
        cov = coverage_by_date(factors, universe).agg(
            F.array_sort(F.collect_list(F.struct("trade_date", "universe_count", "valid_count", "coverage"))).alias(
                "coverage_by_date"
            )
        )
        parts.append(cov)
    j = _one_row_join(*parts)
    cols = [F.lit(metadata.name).alias("factor_name"), F.lit(metadata.version).alias("factor_version")]
    cols += [F.col(c) for c in REPORT_COLUMNS[2:]]  # drops the join key
    if with_coverage:
        cols.append(F.col("coverage_by_date"))
    return j.select(*cols)
