"""Factor processors (P1-P3): quality status, ``raw`` and ``rank_pct``.

* P1 quality, in this order: raw null and fewer than ``min_periods`` rows of the
  security so far -> ``insufficient_history``; raw null -> ``missing_input``;
  NaN/inf -> ``invalid_value``; else ``valid``. The row count is the security's
  own rows in the given frame (so the warm-up window is what counts).
* P2 ``raw``: factor_value = valid raw value, processed_value null.
* P3 ``rank_pct``: average-tie rank / number of valid values within the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.functions.ranking import GROUP_ROWS, average_rank, ranks_in_group
from eqlake.functions.stats import is_finite
from eqlake.operators.contracts import identity_check, require_columns
from eqlake.operators.factors import FactorMetadata, wide_to_long

PROCESSORS = ("raw", "rank_pct")


def observation_count(df: DataFrame) -> DataFrame:
    """Running count of the security's rows (non-null dates) up to the row."""
    w = Window.partitionBy("ts_code").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.count("trade_date").over(w).alias("_obs"))


def quality_status(raw: str = "raw_value", obs: str = "_obs", min_periods=None):
    mp = F.lit(min_periods) if not hasattr(min_periods, "alias") else min_periods
    r = F.col(raw)
    return (
        F.when(r.isNull(), F.when(F.col(obs) < mp, F.lit("insufficient_history")).otherwise(F.lit("missing_input")))
        .when(~is_finite(r), F.lit("invalid_value"))
        .otherwise(F.lit("valid"))
    )


def _apply_processor(df: DataFrame, processor: str, group_cols) -> DataFrame:
    valid = F.when(F.col("quality_status") == "valid", F.col("raw_value"))
    keep = [c for c in S.PROCESSED_FACTOR_COLUMNS if c not in ("factor_value", "processed_value")]
    if processor == "raw":
        out = df.select(*keep, valid.alias("factor_value"), F.lit(None).cast("double").alias("processed_value"))
        return out.select(*S.PROCESSED_FACTOR_COLUMNS)
    df = df.select(*keep, valid.alias("_valid_raw")).withColumn("_is_valid", F.col("_valid_raw").isNotNull())
    # Valid rows are a group of their own within the date, so its size is their number; a date
    # is split over range partitions however many rows it has.
    ranked = ranks_in_group(df, [*group_cols, "_is_valid"], "_valid_raw", ["ts_code"], avg_rank="_rank", group_size="_n_valid")
    out = ranked.select(*keep, (F.col("_rank") / F.col("_n_valid").cast("double")).alias("processed_value"))
    return out.select("*", F.col("processed_value").alias("factor_value")).select(*S.PROCESSED_FACTOR_COLUMNS)


def process_factor_result(result: DataFrame, metadata: FactorMetadata, processor: str, *, check_identity: bool = True) -> DataFrame:
    """P1 + P2/P3 for one factor's calculator result."""
    if processor not in PROCESSORS:
        raise ValueError(f"unsupported processor: {processor}")
    require_columns(result, S.CALCULATOR_RESULT_COLUMNS, "calculator result")
    if check_identity:
        identity_check(result, metadata.name, metadata.version, "calculator result")
    prepared = observation_count(result)
    prepared = prepared.select("*", quality_status(min_periods=metadata.min_periods).alias("quality_status"))
    return _apply_processor(prepared, processor, ["trade_date"])


def process_wide(wide: DataFrame, metadatas, processor: str, largest_date: int, tasks: int | None = None) -> DataFrame:
    """P1-P3 for the wide raw values of several factors with their ``_obs``; ``largest_date``: rows of the
    largest date, or more; ``tasks``: over how many the dates are dealt. Dates that a task can sort are
    shuffled once, as wide rows, and stacked there into slim rows, which one sort ranks by date and
    factor; larger ones go through ``process_long``, which splits a date."""
    metadatas = list(metadatas)
    if processor != "rank_pct" or largest_date * len(metadatas) > GROUP_ROWS:
        return process_long(wide_to_long(wide, metadatas), metadatas, processor)
    by_date = wide.repartition(*([tasks] if tasks else []), "trade_date")
    stacked = F.posexplode(F.array(*[F.col(f"`{m.name}@{m.version}`") for m in metadatas])).alias("_no", "raw_value")
    long = by_date.select("ts_code", "trade_date", "_obs", stacked)
    long = long.withColumn("_valid", F.when(is_finite(F.col("raw_value")), F.col("raw_value")))
    rank, size = average_rank(["trade_date", "_no"], "_valid")
    long = long.withColumn("processed_value", rank / size.cast("double"))
    of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("_no"))
    return long.select(
        "*", of([m.name for m in metadatas]).alias("factor_name"), of([m.version for m in metadatas]).alias("factor_version"),
        quality_status(min_periods=of([m.min_periods for m in metadatas])).alias("quality_status"), F.col("processed_value").alias("factor_value"),
    ).select(*S.PROCESSED_FACTOR_COLUMNS)


def process_long(long: DataFrame, metadatas, processor: str) -> DataFrame:
    """P1-P3 for a stacked multi-factor result that already carries ``_obs``."""
    if processor not in PROCESSORS:
        raise ValueError(f"unsupported processor: {processor}")
    mins = F.create_map(*[x for m in metadatas for x in (F.lit(f"{m.name}@{m.version}"), F.lit(m.min_periods))])
    key = F.concat_ws("@", "factor_name", "factor_version")
    prepared = long.select("*", quality_status(min_periods=mins[key]).alias("quality_status"))
    return _apply_processor(prepared, processor, ["trade_date", "factor_name", "factor_version"])
