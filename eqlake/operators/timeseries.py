"""Per-security time-series helpers used in research notebooks.

All are windows or grouped aggregates partitioned by ``ts_code`` (a security's
history is bounded by its trading days), so they scale with the panel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forward_fill(df: DataFrame, columns: Sequence[str], *, key: str = "ts_code", order: str = "trade_date") -> DataFrame:
    """Carry the last non-null value forward within each security."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def rolling_mean(df: DataFrame, column: str, window: int = 5, *, key: str = "ts_code", order: str = "trade_date",
                 name: str | None = None) -> DataFrame:
    """Mean over the last ``window`` rows; null until ``window`` valid values."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(window - 1), 0)
    out = F.when(F.count(column).over(w) == window, F.avg(column).over(w))
    return df.withColumn(name or f"{column}_mean_{window}", out)


def resample_days(df: DataFrame, days: int = 5, *, key: str = "ts_code", order: str = "trade_date",
                  last_cols: Sequence[str] = ("close",), sum_cols: Sequence[str] = ("volume",)) -> DataFrame:
    """Bins of ``days`` natural days from each security's first day.

    Per bin: last non-null value of ``last_cols``, sum of ``sum_cols``. Empty bins
    between the first and last bin appear with null last-values and zero sums.
    Output: key, bin_start, last_cols..., sum_cols...
    """
    first = df.groupBy(key).agg(F.min(order).alias("_d0"))
    b = df.join(first, key).withColumn("_bin", F.floor(F.datediff(F.col(order), F.col("_d0")) / F.lit(days)).cast("int"))
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in last_cols]
    aggs += [F.sum(c).alias(c) for c in sum_cols]
    binned = b.groupBy(key, "_d0", "_bin").agg(*aggs)
    span = binned.groupBy(key, "_d0").agg(F.max("_bin").alias("_last"))
    # One row per (security, bin): bounded by the security's history length / days.
    grid = span.select(key, "_d0", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_bin"))
    out = grid.join(binned, [key, "_d0", "_bin"], "left")
    return out.select(
        key,
        F.date_add(F.col("_d0"), F.col("_bin") * days).alias("bin_start"),
        *[F.col(c) for c in last_cols],
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in sum_cols],
    )
