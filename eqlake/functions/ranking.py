"""Within-group positions and ranks that stay parallel when one group is huge.

Ranks (``ranks_in_group``) count equal values first and add the counts up in two levels, without
sorting or writing rows. Positions (``group_positions``) need a place for every row:

A window ``partitionBy(group).orderBy(value)`` puts a whole group in one task. If a
single date (or factor) held a third of all rows, that task would sort a third of
the data. ``group_positions`` instead range-partitions on ``(group, order...)`` —
the ordering ends with a unique tie-breaker, so a hot group is split across many
partitions — sorts within partitions, and derives each row's 0-based position
inside its group from ``monotonically_increasing_id`` (partition index, row
index) plus per-(partition, group) counts. The count table has at most
``partitions + groups`` rows, so it is broadcast with a proven bound.

Requirements: ``order_cols`` must make the order total within a group (end with a
unique key), which also makes the ids deterministic when a task is re-run.

The id'd rows are read by two branches (the count table and the rows). The range
bounds come from a sample, so two executions of the exchange could place rows
differently; the id'd frame is therefore materialised once with a reliable
``checkpoint()`` into the shared ``spark.checkpoint.dir`` before it is reused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eqlake.session import checkpoint_dir, shuffle_partitions

_LOCAL_MASK = (1 << 33) - 1


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never ``localCheckpoint``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def group_positions(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], *, pos: str = "_pos",
                    size: str = "_gn", pid: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``pos`` (0-based position in ``order_cols`` order within the group), ``size``
    (group row count) and, if named, ``pid`` (number of the row's range partition)."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    keys = [*group_cols, *order_cols]
    cols = df.columns
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    ided = ordered.select(*cols, F.shiftright(mid, 33).alias("_pid"), mid.bitwiseAND(F.lit(_LOCAL_MASK)).alias("_local"))
    ided = materialize(ided)
    per = ided.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_c"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid")
    per = per.select(
        "_pid", *group_cols, "_first",
        F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*group_cols)).alias(size),
    )
    keys = ["_pid", *group_cols]
    per = per.withColumnsRenamed({c: f"_per_{c}" for c in keys})
    j = ided.join(F.broadcast(per), [F.col(c).eqNullSafe(F.col(f"_per_{c}")) for c in keys])
    extra = [F.col("_pid").alias(pid)] if pid else []
    return j.select(*cols, (F.col("_off") + F.col("_local") - F.col("_first")).alias(pos), size, *extra)


#: Rows of a group that one task may sort, at most.
GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, group_cols: Sequence[str]) -> int:
    """Rows of the largest group (a job of its own; one number reaches the driver)."""
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def average_rank(group_cols: Sequence[str], value: str) -> tuple[Column, Column]:
    """Average-tie rank of ``value`` and number of values, among a group's rows that have a value, as
    windows of one order: one sort and one buffer of a group, so for groups up to ``GROUP_ROWS``. Null
    for rows without one, and where a group column is null, as in ``ranks_in_group``."""
    known = F.col(value).isNotNull()
    upward = Window.partitionBy(*group_cols, known).orderBy(value)
    # Of a tied run: the first row's place and the last one's (the frame ends with the row's equals).
    first, last = F.rank().over(upward), F.count(F.lit(1)).over(upward)
    size = F.count(F.lit(1)).over(upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    for c in group_cols:
        known = known & F.col(c).isNotNull()
    return F.when(known, (first.cast("double") + last.cast("double")) / F.lit(2.0)), F.when(known, size)


#: Steps of one octave in ``order_bucket``.
OCTAVE_STEPS = 256
#: Parts into which equal values are dealt by their codes, where the order of codes doesn't matter.
TIE_PARTS = 16


def order_bucket(value: Column) -> Column:
    """A whole number that never falls while a finite ``value`` rises: 256 steps an octave, by size
    and sign, so buckets are narrow wherever values lie; null for null."""
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    step = F.floor((F.try_divide(size, F.pow(F.lit(2.0), octave)) - 1.0) * OCTAVE_STEPS)
    step = F.greatest(F.least(step, F.lit(OCTAVE_STEPS - 1)), F.lit(0))  # where log2 was rounded
    place = (octave + 1_100) * OCTAVE_STEPS + step
    return F.when(size == 0, F.lit(0).cast("bigint")).when(value > 0, place).when(value < 0, -place)


def ranks_in_group(df: DataFrame, group_cols: Sequence[str], value: str, unique_cols: Sequence[str], *,
                   avg_rank: str | None = None, quantile: str | None = None, n_groups: int = 5,
                   group_size: str | None = None, num_partitions: int | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Average-tie rank of ``value`` (a finite double or null) and/or position quantile in (``value``,
    ``unique_cols``) order, both within ``group_cols`` (no nulls there). Rows with a null ``value``
    come first and get no rank; put them in a group of their own.

    The rows aren't sorted by value. They are counted in cells of equal value (and, as many rows may
    share a value, of one part of the codes); cells are added up within value buckets, and buckets
    within the group. So the largest sorted pieces are the cells of one bucket of one group and the
    buckets of one group, and the largest joined one is a cell, whatever a group or a value holds.

    * average rank = position of a tied run's first row + (rows of the run + 1) / 2;
    * quantile = floor(position * n_groups / group size) + 1 (not ``ntile``), the position being the
      cell's first one plus the row's place among the cell's codes.

    Lazy: no job runs here. ``df`` is read twice, unless ``stored`` holds the same rows (group, value
    and unique columns at least) for counting.
    """
    # Codes in order where positions need them: parts are first characters, then cells follow the codes.
    code = F.col(unique_cols[0])
    part = F.coalesce(F.substring(code.cast("string"), 1, 4), F.lit("")) if quantile else F.pmod(F.xxhash64(code), F.lit(TIE_PARTS))
    keys = {"_none": F.col(value).isNull(), "_value": F.coalesce(F.col(value), F.lit(0.0)), "_cell": part}
    cell_keys = [*group_cols, *keys]
    keyed = df.withColumns(keys)
    counted = (df if stored is None else stored).select(*group_cols, *[c.alias(k) for k, c in keys.items()], order_bucket(F.col(value)).alias("_bucket"))
    cells = counted.groupBy(*cell_keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))

    in_group = Window.partitionBy(*group_cols)
    upward = in_group.orderBy(F.col("_none").desc(), "_bucket")
    before = Window.unboundedPreceding, -1
    buckets = counted.groupBy(*group_cols, "_none", "_bucket").agg(F.count(F.lit(1)).alias("_in_bucket"))
    buckets = buckets.select(
        *[F.col(c).alias(f"_b_{c}") for c in group_cols], F.col("_none").alias("_b_none"), F.col("_bucket").alias("_b_bucket"),
        F.coalesce(F.sum("_in_bucket").over(upward.rowsBetween(*before)), F.lit(0)).alias("_offset"),
        F.sum("_in_bucket").over(in_group).alias("_size"),
    )
    in_bucket = Window.partitionBy(*group_cols, "_none", "_bucket")
    run = Window.partitionBy(*group_cols, "_none", "_bucket", "_value")
    inner = cells.withColumn("_first", F.coalesce(F.sum("_rows").over(in_bucket.orderBy("_value", "_cell").rowsBetween(*before)), F.lit(0)))
    inner = inner.select("*", F.min("_first").over(run).alias("_run_first"), F.sum("_rows").over(run).alias("_run"))
    same = [F.col(c) == F.col(f"_b_{c}") for c in group_cols] + [F.col("_none") == F.col("_b_none"), F.col("_bucket").eqNullSafe(F.col("_b_bucket"))]
    places = inner.join(buckets, same).select(
        *[F.col(c).alias(f"_k_{c}") for c in cell_keys], "_size",
        (F.col("_offset") + F.col("_first")).alias("_p"), (F.col("_offset") + F.col("_run_first")).alias("_lo"), "_run",
    )
    if num_partitions:
        keyed = keyed.repartition(num_partitions, *cell_keys)
    if quantile:
        keyed = keyed.withColumn("_at", F.row_number().over(Window.partitionBy(*cell_keys).orderBy(*unique_cols)) - 1)
    p = keyed.join(places, [F.col(c) == F.col(f"_k_{c}") for c in cell_keys], "left")
    extra = []
    if group_size:
        extra.append(F.col("_size").alias(group_size))
    if quantile:
        extra.append((F.floor((F.col("_p") + F.col("_at")) * F.lit(n_groups) / F.col("_size")) + 1).cast("int").alias(quantile))
    if avg_rank:
        mean = F.col("_lo").cast("double") + (F.col("_run").cast("double") + F.lit(1.0)) / F.lit(2.0)
        extra.append(F.when(~F.col("_none"), mean).alias(avg_rank))
    return p.select(*df.columns, *extra)
