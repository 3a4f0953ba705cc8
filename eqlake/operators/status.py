"""Dataset status (AG1-AG4) and missing-date checks.

Status numbers are single aggregates (partial aggregation, one row out); of a stored
dataset they come from what the store keeps with each version. Date sets are one row per day: expected days come from ``sequence(start, end)`` or
the calendar, existing days from a ``distinct`` of the dataset's dates, and the
set difference is a ``left_anti`` join.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.sources.raw import ETLTask, landed_dates

PROCESSED_DAILY_DATASETS = {
    "daily-ohlcv": ("ohlcv", "v_daily_ohlcv"),
    "adj-factor": ("adj_factor", "v_adj_factor"),
    "daily-basic": ("daily_basic", "v_daily_basic"),
}
RAW_ONLY_DAILY_DATASETS = ("stock-st", "stk-limit", "suspend-d")


def calendar_status(calendar: DataFrame) -> DataFrame:
    """AG1: per exchange first/last day, rows and open days (first row = the
    single-exchange answer of the reference)."""
    return (
        calendar.groupBy(F.coalesce(F.col("exchange"), F.lit("*")).alias("exchange"))
        .agg(
            F.min("cal_date").alias("start_date"),
            F.max("cal_date").alias("end_date"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("is_open")).alias("open_count"),
        )
        .orderBy("exchange")
    )


def daily_status(df: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """AG2: first/last date, rows, distinct dates, distinct securities (zeros when empty)."""
    return df.agg(
        F.min(date_col).alias("start_date"),
        F.max(date_col).alias("end_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(date_col).alias("trade_date_count"),
        F.count_distinct("ts_code").alias("security_count"),
    )


def security_status(securities: DataFrame) -> DataFrame:
    """AG3: rows, distinct exchanges, listed / delisted / paused counts."""
    st = F.col("list_status")
    return securities.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("exchange").alias("exchange_count"),
        F.count_if(st == "L").alias("listed_count"),
        F.count_if(st == "D").alias("delisted_count"),
        F.count_if(st == "P").alias("paused_count"),
    )


def dataset_status(store, dataset: str) -> dict:
    """AG4: status dict of one dataset read from the store."""
    if dataset == "trade-calendar":
        cal = store.read_dim("dim_trade_calendar")
        if cal is None:
            return {"exchange": "-", "start_date": None, "end_date": None, "row_count": 0, "open_count": 0}
        rows = calendar_status(cal).limit(1).collect()
        return rows[0].asDict() if rows else {"exchange": "-", "start_date": None, "end_date": None, "row_count": 0, "open_count": 0}
    if dataset == "stock-basic":
        sec = store.read_dim("dim_security")
        if sec is None:
            return {"row_count": 0, "exchange_count": 0, "listed_count": 0, "delisted_count": 0, "paused_count": 0}
        return security_status(sec).first().asDict()
    if dataset in PROCESSED_DAILY_DATASETS:
        # The store keeps these numbers with every version, so no rows are read.
        none = {"start_date": None, "end_date": None, "row_count": 0, "trade_date_count": 0, "security_count": 0}
        return store.statistics(PROCESSED_DAILY_DATASETS[dataset][0]) or none
    raise NotImplementedError(f"no status for dataset={dataset}")


# ---------------------------------------------------------------------------
# S3-S6
# ---------------------------------------------------------------------------


def calendar_days(spark: SparkSession, start, end) -> DataFrame:
    """S3: one row per natural day in [start, end]."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("cal_date"))


def distinct_dates(df: DataFrame, start, end, date_col: str = "trade_date") -> DataFrame:
    """Distinct dates of a dataset inside the range (column ``cal_date``)."""
    return (
        df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))
        .select(F.col(date_col).alias("cal_date"))
        .distinct()
    )


def missing_dates(expected: DataFrame, existing: DataFrame) -> DataFrame:
    """Expected days without data."""
    return expected.select("cal_date").distinct().join(existing.select("cal_date").distinct(), "cal_date", "left_anti")


def present_dates(expected: DataFrame, existing: DataFrame) -> DataFrame:
    """Existing days that are expected."""
    return existing.select("cal_date").distinct().join(expected.select("cal_date").distinct(), "cal_date", "left_semi")


def calendar_gaps(spark: SparkSession, calendar: DataFrame, start, end, exchange: str = "SSE") -> DataFrame:
    """Natural days in range that the calendar lacks."""
    have = calendar.filter((F.col("exchange") == exchange) & F.col("cal_date").between(F.lit(start), F.lit(end)))
    return missing_dates(calendar_days(spark, start, end), have)


def ensure_calendar_coverage(spark: SparkSession, calendar: DataFrame, start, end, exchange: str = "SSE") -> None:
    gaps = sorted(r[0] for r in calendar_gaps(spark, calendar, start, end, exchange).orderBy("cal_date").limit(11).collect())
    if gaps:
        sample = ", ".join(d.isoformat() for d in gaps[:10])
        suffix = ", ..." if len(gaps) > 10 else ""
        raise ValueError(f"trade calendar does not cover the range; missing=[{sample}{suffix}]")


@dataclass(frozen=True)
class MissingDateResult:
    dataset: str
    source: str
    start_date: _dt.date
    end_date: _dt.date
    expected_dates: tuple[_dt.date, ...]
    existing_dates: tuple[_dt.date, ...]
    missing_dates: tuple[_dt.date, ...]


def find_missing_dates(spark: SparkSession, store, task: ETLTask, raw_root: str | None = None) -> MissingDateResult:
    """S4 job: calendar -> every natural day; processed datasets -> open days vs
    distinct dates in the store; raw-only datasets -> open days vs landed days.
    Date lists are calendar-bounded, so they are collected for the result."""
    cal = store.read_dim("dim_trade_calendar")
    if task.dataset == "stock-basic":
        raise NotImplementedError("stock-basic is a snapshot dataset")
    if task.dataset == "trade-calendar":
        expected = calendar_days(spark, task.start_date, task.end_date)
        existing = (
            cal.filter((F.col("exchange") == task.exchange) & F.col("cal_date").between(F.lit(task.start_date), F.lit(task.end_date))).select("cal_date")
            if cal is not None else spark.createDataFrame([], "cal_date date")
        )
    else:
        if cal is None:
            raise ValueError("trade calendar is empty; load it first")
        ensure_calendar_coverage(spark, cal, task.start_date, task.end_date, task.exchange)
        expected = cal.filter(
            (F.col("exchange") == task.exchange) & F.col("is_open") & F.col("cal_date").between(F.lit(task.start_date), F.lit(task.end_date))
        ).select("cal_date")
        if task.dataset in PROCESSED_DAILY_DATASETS:
            days = [d for d in store.dates(PROCESSED_DAILY_DATASETS[task.dataset][0]) if task.start_date <= d <= task.end_date]
            existing = spark.createDataFrame([(d,) for d in days], "cal_date date")
        elif task.dataset in RAW_ONLY_DAILY_DATASETS:
            days = [d for d in landed_dates(spark, raw_root, task.source, task.dataset) if task.start_date <= d <= task.end_date]
            existing = spark.createDataFrame([(d,) for d in days], "cal_date date")
        else:
            raise NotImplementedError(f"no missing-date check for dataset={task.dataset}")
    exp = tuple(sorted(r[0] for r in expected.collect()))
    if task.dataset != "trade-calendar" and not exp:
        raise ValueError("no open days in the calendar for the range")
    have = tuple(sorted(r[0] for r in present_dates(expected, existing).collect()))
    miss = tuple(sorted(r[0] for r in missing_dates(expected, existing).collect()))
    return MissingDateResult(task.dataset, task.source, task.start_date, task.end_date, exp, have, miss)
