"""Numeric column expressions: IEEE-safe division, finite guard, ranks, correlation.

Spark runs with ANSI mode on, where ``x / 0`` raises and ``corr`` raises on a
zero-variance group. The helpers here give the answers a float engine gives
(``inf``/``NaN`` where the caller wants them, null where it wants "no value").
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

INF = float("inf")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _finite_sql(name: str) -> str:
    q = f"`{name}`"
    return f"({q} IS NOT NULL AND NOT isnan({q}) AND abs({q}) < double('inf'))"


def is_finite(c) -> Column:
    """Not null, not NaN, not +-inf. (``isnan(null)`` is false, so test null first.)"""
    if isinstance(c, str):  # one SQL expression: fewer driver round trips
        return F.expr(_finite_sql(c))
    x = _col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF))


def finite_or_null(c) -> Column:
    """FN8: keep finite values, everything else becomes null."""
    if isinstance(c, str):
        return F.expr(f"CASE WHEN {_finite_sql(c)} THEN `{c}` END")
    x = _col(c)
    return F.when(is_finite(x), x)


def ieee_divide(n, d) -> Column:
    """``n / d`` with IEEE-754 results for a zero divisor (+-inf, or NaN for 0/0).

    Used where the quality status must tell an infinite ratio (``invalid_value``)
    from a missing input (``missing_input``).
    """
    n, d = _col(n), _col(d)
    return (
        F.when(d.isNull() | n.isNull(), F.lit(None).cast("double"))
        .when(d == 0, F.when((n == 0) | F.isnan(n), F.lit(float("nan"))).otherwise(F.signum(n) * F.lit(INF)))
        .otherwise(F.try_divide(n, d))
    )


def safe_corr(x, y) -> Column:
    """Pearson correlation as an aggregate that never raises.

    ``covar_pop / (stddev_pop * stddev_pop)``; a zero or underflowing variance
    gives null, as does a one-row group.
    """
    x, y = _col(x), _col(y)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(is_finite(r), r)


def average_rank(value, partition_cols) -> Column:
    """Average-tie rank of ``value`` within ``partition_cols`` (1, 2.5, 2.5, 4).

    Apply to rows whose value is not null (filter first, or keep nulls in their
    own partition). Both windows cluster on ``partition_cols`` so one shuffle
    serves both.
    """
    parts = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    v = _col(value)
    by_value = Window.partitionBy(*parts).orderBy(v.asc())
    ties = Window.partitionBy(*parts, v)
    return F.rank().over(by_value).cast("double") + (F.count(F.lit(1)).over(ties) - 1).cast("double") / F.lit(2.0)


def position_quantile(order_cols, partition_cols, n_groups: int = 5) -> Column:
    """Group number ``floor(pos * n_groups / n) + 1`` with ``pos`` counted from 0
    in ``order_cols`` order. Not ``ntile``: for n=7 this gives 1,1,2,3,3,4,5.
    """
    parts = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    w = Window.partitionBy(*parts).orderBy(*[_col(c) for c in order_cols])
    n = F.count(F.lit(1)).over(Window.partitionBy(*parts))
    pos = F.row_number().over(w) - 1
    return (F.floor(pos * F.lit(n_groups) / n) + 1).cast("int")


def round_doubles(df, digits: int = 9, exclude=()):
    """Round every double column (for order-insensitive comparisons of aggregates)."""
    exprs = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and f.name not in exclude:
            exprs.append(f"round(`{f.name}`, {digits}) AS `{f.name}`")
        else:
            exprs.append(f"`{f.name}`")
    return df.selectExpr(*exprs)
