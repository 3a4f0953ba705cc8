"""Batch jobs: factor pipeline (PL1), factor validation (E9), ETL jobs.

Jobs take a ``SparkSession`` and a ``Store`` rooted in a shared folder. Reads
go through the store (partition-pruned on year/month); writes are the store's
staged upserts. A job's result DataFrame is written first and summarised from
the written files, so a lost executor only re-runs the failed tasks and the
summary never recomputes the whole plan.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.functions.ranking import materialize
from eqlake.operators import evaluation as EV
from eqlake.operators import factors as FX
from eqlake.operators import labels as LB
from eqlake.operators import normalize as N
from eqlake.operators import processing as PR
from eqlake.operators import repository as Q
from eqlake.operators import status as ST
from eqlake.operators.contracts import check_factor_output
from eqlake.sources import raw as R
from eqlake.sources.store import Store, prune_months

log = logging.getLogger("eqlake.jobs")


@dataclass(frozen=True)
class FactorRunSummary:
    factor_names: tuple[str, ...]
    factor_version: str
    start_date: _dt.date
    end_date: _dt.date
    warmup_start_date: _dt.date
    input_row_count: int
    output_row_count: int
    written_months: tuple[tuple[int, int], ...]
    missing_value_rate: float
    valid_rate: float
    processor: str
    dry_run: bool


def summarize_output(output: DataFrame) -> DataFrame:
    """AG8: output rows, null share of factor_value, share with status ``valid``."""
    n = F.count(F.lit(1))
    return output.agg(
        n.alias("output_row_count"),
        (F.count_if(F.col("factor_value").isNull()).cast("double") / n.cast("double")).alias("missing_value_rate"),
        (F.count_if(F.col("quality_status") == "valid").cast("double") / n.cast("double")).alias("valid_rate"),
    )


def _validate_task(factor_names, start_date, end_date, processor) -> tuple[str, ...]:
    if isinstance(factor_names, str):
        raise ValueError("factor_names must be a sequence of names, not a string")
    names = tuple(factor_names)
    if not names:
        raise ValueError("factor_names must not be empty")
    if len(set(names)) != len(names):
        raise ValueError("factor_names must be unique")
    if start_date > end_date:
        raise ValueError("start_date must not be after end_date")
    if processor not in PR.PROCESSORS:
        raise ValueError(f"unsupported processor: {processor}")
    return names


def stored_inputs(store: Store):
    """Bars, adjustment factors and calendar; each must have been loaded."""
    bars, adj, cal = store.read("ohlcv"), store.read("adj_factor"), store.read_dim("dim_trade_calendar")
    if bars is None or adj is None:
        raise ValueError("bars and adjustment factors must be loaded first")
    if cal is None:
        raise ValueError("the trade calendar must be loaded first")
    return bars, adj, cal


def factor_frame(bars: DataFrame, adj: DataFrame, metadatas, start, end, warmup_start, processor: str, registry=None) -> DataFrame:
    """Panel (hfq, warm-up included) -> all calculators in one window pass ->
    processor -> clipped to the request. Lazy."""
    fields = list(dict.fromkeys(f for m in metadatas for f in m.required_fields))
    panel = Q.daily_panel(prune_months(bars, warmup_start, end), prune_months(adj, warmup_start, end), warmup_start, end, fields)
    wide = PR.observation_count(FX.compute_wide(panel, metadatas, registry))
    out = PR.process_long(FX.wide_to_long(wide, metadatas), metadatas, processor)
    return out.filter(F.col("trade_date").between(F.lit(start), F.lit(end)))


def run_factor_pipeline(spark: SparkSession, store: Store, factor_names: Sequence[str], start_date, end_date, *,
                        factor_version: str = "v1", processor: str = "raw", dry_run: bool = False,
                        registry: FX.FactorRegistry | None = None) -> FactorRunSummary:
    """PL1: compute, process, check and (unless ``dry_run``) store factors. A ``registry`` with
    factors of its own runs their calculators (F4)."""
    names = _validate_task(factor_names, start_date, end_date, processor)
    registry = registry or FX.build_default_registry()
    metas = []
    for n in names:
        m = registry.get(n, factor_version)
        registry.calculator(m)
        metas.append(m)
    bars, adj, cal = stored_inputs(store)
    open_days = cal.filter((F.col("exchange") == "SSE") & F.col("is_open"))
    warm = LB.warmup_start_date(open_days, start_date, max(m.lookback_days for m in metas))
    input_rows = prune_months(bars, warm, end_date).filter(F.col("trade_date").between(F.lit(warm), F.lit(end_date))).count()
    if input_rows == 0:
        raise ValueError(f"empty input panel: start={warm}, end={end_date}")
    # Computed once into the shared checkpoint folder; checked and summarised before anything is
    # stored, so a bad run leaves the store as it is and older rows never enter the summary.
    out = materialize(factor_frame(bars, adj, metas, start_date, end_date, warm, processor, registry))
    check_factor_output(out, start_date, end_date)
    s = summarize_output(out).first()
    if s["output_row_count"] == 0:
        raise ValueError(f"no factor rows in the requested range: start={start_date}, end={end_date}")
    written = ()
    if not dry_run:
        written = tuple(sorted(store.write_factor_results(out)))
        store.refresh_views()
    return FactorRunSummary(
        names, factor_version, start_date, end_date, warm, input_rows, s["output_row_count"], written,
        s["missing_value_rate"], s["valid_rate"], processor, dry_run,
    )


def run_factor_validation(spark: SparkSession, store: Store, factor_name: str, start_date, end_date, *,
                          factor_version: str = "v1") -> dict:
    """Stored factors + hfq open labels over the calendar extended 6 open days
    past ``end_date`` (as far as known) -> one report row as a dict."""
    if start_date > end_date:
        raise ValueError("start_date must not be after end_date")
    metadata = FX.build_default_registry().get(factor_name, factor_version)
    stored = store.read("factors")
    if stored is None:
        raise ValueError("no stored factors")
    factors = Q.factor_panel(prune_months(stored, start_date, end_date), start_date, end_date, factor_name, factor_version=factor_version)
    if not factors.limit(1).count():
        raise ValueError(f"empty factor input: name={factor_name}, version={factor_version}")
    bars, adj, cal = stored_inputs(store)
    open_days = cal.filter((F.col("exchange") == "SSE") & F.col("is_open") & (F.col("cal_date") >= F.lit(start_date)))
    # Calendar rows: ~250 a year, so the date list is bounded by the range.
    dates = [r[0] for r in open_days.select("cal_date").orderBy("cal_date").collect()]
    idx = [i for i, d in enumerate(dates) if d <= end_date]
    if not idx:
        raise ValueError(f"no open days in the range: start={start_date}, end={end_date}")
    trade_dates = dates[: min(idx[-1] + 6, len(dates) - 1) + 1]
    last = trade_dates[-1]
    panel = Q.daily_panel(prune_months(bars, start_date, last), prune_months(adj, start_date, last), start_date, last, ["hfq_open"])
    td = spark.createDataFrame([(d,) for d in trade_dates], "trade_date date")
    # The labels feed the input checks and the report: compute them once.
    labels = materialize(LB.forward_return_5d(panel, td))
    universe = panel.filter(F.col("trade_date").between(F.lit(start_date), F.lit(end_date))).select("ts_code", "trade_date")
    report = EV.validate_factor(factors, labels, universe, metadata)
    return report.first().asDict(recursive=True)


# ---------------------------------------------------------------------------
# ETL jobs
# ---------------------------------------------------------------------------

DATASET_COLUMNS = {
    "daily-ohlcv": ("ohlcv", S.DAILY_OHLCV_COLUMNS, S.RAW_DAILY_OHLCV_COLUMNS),
    "adj-factor": ("adj_factor", S.ADJ_FACTOR_COLUMNS, S.RAW_ADJ_FACTOR_COLUMNS),
    "daily-basic": ("daily_basic", S.DAILY_BASIC_COLUMNS, S.RAW_DAILY_BASIC_COLUMNS),
}


#: Raw columns that files may lack.
OPTIONAL_RAW = {
    "daily-ohlcv": ("pre_close", "change", "pct_chg"),
    "adj-factor": (),
    "daily-basic": tuple(c for c in S.RAW_DAILY_BASIC_COLUMNS if c not in S.DAILY_KEY),
}


@dataclass(frozen=True)
class LoadResult:
    """What a load did: kept raw rows, the months they went to, the anomalies of valuations as
    (field, rows, up to three codes), and the failed checks of rows that were set aside."""

    dataset: str
    rows: int
    months: tuple[tuple[int, int], ...] = ()
    anomalies: tuple[tuple[str, int, tuple[str, ...]], ...] = ()
    failures: tuple[tuple[str, int, tuple[str, ...]], ...] = ()


def load(spark: SparkSession, store: Store, raw_root: str, task: R.ETLTask) -> int:
    """Normalise the task's raw files and upsert them; returns loaded rows."""
    return load_checked(spark, store, raw_root, task).rows


def load_checked(spark: SparkSession, store: Store, raw_root: str, task: R.ETLTask, *, days: Sequence[_dt.date] | None = None,
                 need_st: bool | None = None, set_aside: bool = False) -> LoadResult:
    """O2 / N8 with its report.

    The raw rows are read and parsed once, into a staged copy that holds every row with its failed
    checks. If any check failed, the failing rows go to the quarantine folder, nothing is published
    and the first failure is raised; with ``set_aside`` (daily loads) the other rows are published
    and the failures are logged and reported instead. Rows of a key keep the order of the files and of their lines.
    ``days`` restricts a daily load to the files of some days; ``need_st`` says whether the ST list
    must be there (default: from the day on that such lists exist)."""
    if task.dataset == "trade-calendar":
        raw = R.read_raw(spark, raw_root, task, ["cal_date", "is_open"])
        if task.dry_run:
            return LoadResult(task.dataset, N.clip_calendar(N.normalize_trade_calendar(raw), task).count())
        # The task's exchange in the task's range, also when no row came.
        pred = (F.col("exchange") == task.exchange) & F.col("cal_date").between(F.lit(task.start_date), F.lit(task.end_date))
        with store.staged(N.checked_trade_calendar(raw)) as staged:
            cal = N.clip_calendar(N.normalised(staged, True), task)
            return LoadResult(task.dataset, store.replace_dimension("dim_trade_calendar", cal, pred, S.TRADE_CALENDAR_COLUMNS))
    if task.dataset == "stock-basic":
        sec = N.normalize_stock_basic(R.read_raw(spark, raw_root, task, S.SECURITY_COLUMNS))
        if task.dry_run:
            return LoadResult(task.dataset, sec.count())
        return LoadResult(task.dataset, store.replace_dimension("dim_security", sec, None, S.SECURITY_COLUMNS))
    if task.dataset not in DATASET_COLUMNS:
        raise NotImplementedError(f"no loader for dataset={task.dataset}")
    target, columns, raw_cols = DATASET_COLUMNS[task.dataset]
    keys = None if days is None else [f"{d:%Y%m%d}" for d in days]

    def of_days(frame: DataFrame | None) -> DataFrame | None:
        if frame is None:
            return None
        return (frame if keys is None else frame.filter(F.col("file_date").isin(keys))).drop("year", "month", "file_date")

    raw = of_days(R.read_raw(spark, raw_root, task, [c for c in raw_cols if c not in OPTIONAL_RAW[task.dataset]], position=True))
    if task.dataset == "daily-ohlcv":
        need = task.end_date >= N.STOCK_ST_AVAILABLE_START_DATE if need_st is None else need_st
        limits = R.read_same_day(spark, raw_root, task, "stk-limit", S.RAW_STK_LIMIT_COLUMNS, position=True, days=days)
        st = R.read_same_day(spark, raw_root, task, "stock-st", S.RAW_STOCK_ST_COLUMNS, required=need, days=days)
        checked = N.checked_daily_ohlcv(raw, task, stock_st=of_days(st), stk_limit=of_days(limits))
    elif task.dataset == "adj-factor":
        checked = N.checked_adj_factor(raw, task)
    else:
        checked = N.checked_daily_basic(raw, task)
    if task.dry_run:
        report = N.check_report(checked)
        report.raise_failures()
        return LoadResult(task.dataset, report.rows, (), report.anomalies)
    with store.staged(checked.withColumn("year", F.year("trade_date")).withColumn("month", F.month("trade_date"))) as staged:
        report = N.check_report(staged)
        if report.failures:
            where = store.quarantine(target, staged.where(F.size("_failed") > 0))
            log.error("%s: %d checks failed, rows in %s", task.dataset, len(report.failures), where)
            if not set_aside:
                report.raise_failures()
        for field, n, codes in report.anomalies:
            log.error("%s: %s missing or not above zero in %d rows, e.g. %s", task.dataset, field, n, ", ".join(codes))
        batch = staged.where(F.col("_kept") & (F.size("_failed") == 0)).drop(*N.CHECK_COLUMNS).withColumnRenamed("_position", "_seq")
        counts = store.upsert_staged(target, batch, date_column="trade_date", key_columns=S.DAILY_KEY, columns=columns)
    return LoadResult(task.dataset, sum(counts.values()), tuple(sorted(counts)), report.anomalies, report.failures)


def backfill(spark: SparkSession, store: Store, raw_root: str, task: R.ETLTask, frame: DataFrame) -> int:
    """O3: land a supplied raw frame (SK2), then load it (O2)."""
    R.land(frame, raw_root, task)
    return load(spark, store, raw_root, task)


def archive(store: Store, dataset: str, year: int, today: _dt.date | None = None) -> str:
    """O4."""
    target, columns, _ = DATASET_COLUMNS[dataset]
    return store.archive_year(target, year, key_columns=S.DAILY_KEY, columns=columns, today=today)


def status(store: Store, dataset: str) -> dict:
    """O5."""
    return ST.dataset_status(store, dataset)


def missing(spark: SparkSession, store: Store, task: R.ETLTask, raw_root: str | None = None) -> ST.MissingDateResult:
    """O6."""
    return ST.find_missing_dates(spark, store, task, raw_root)


DAILY_STEPS = ("daily-ohlcv", "adj-factor", "daily-basic")
#: Checked for the day after every load: what was loaded, then what is only landed.
DAILY_CHECKS = (*DAILY_STEPS, "stock-st", "stk-limit", "suspend-d")


@dataclass(frozen=True)
class DailyStep:
    """One step of the daily job; ``result`` is the loaded rows, or the missing-date result."""

    action: str
    dataset: str
    result: int | ST.MissingDateResult


@dataclass(frozen=True)
class DailyRun:
    source: str
    trade_date: _dt.date
    is_open: bool
    steps: tuple[DailyStep, ...]


def run_daily(spark: SparkSession, store: Store, raw_root: str, source: str, trade_date: _dt.date, *,
              force: bool = False, dry_run: bool = False) -> DailyRun:
    """Calendar + securities first; stop (successfully) on a closed day; then load each
    daily dataset, and check all six for missing dates once everything is loaded. The first
    failure stops; a missing date is a result, not a failure."""
    steps: list[DailyStep] = []

    def run_load(ds: str) -> None:
        task = R.ETLTask(ds, source, trade_date, trade_date, force=force, dry_run=dry_run)
        steps.append(DailyStep("load", ds, load(spark, store, raw_root, task)))

    for ds in ("trade-calendar", "stock-basic"):
        run_load(ds)
    cal = store.read_dim("dim_trade_calendar")
    row = None
    if cal is not None:
        row = cal.filter((F.col("exchange") == "SSE") & (F.col("cal_date") == F.lit(trade_date))).select("is_open").limit(1).collect()
    if not row:
        raise ValueError(f"no calendar row for {trade_date}")
    if row[0][0]:
        for ds in DAILY_STEPS:
            run_load(ds)
        for ds in DAILY_CHECKS:
            steps.append(DailyStep("missing", ds, missing(spark, store, R.ETLTask(ds, source, trade_date, trade_date), raw_root)))
    return DailyRun(source, trade_date, bool(row[0][0]), tuple(steps))


def parse_cli_date(text: str) -> _dt.date:
    """``YYYYMMDD`` or ``YYYY-MM-DD``."""
    for fmt in ("%Y%m%d", "%Y-%m-%d"):
        try:
            return _dt.datetime.strptime(text, fmt).date()
        except ValueError:
            continue
    raise ValueError(f"invalid date: {text!r} (use YYYYMMDD or YYYY-MM-DD)")


def build_task(dataset: str, source: str, start: str | None, end: str | None, *, force=False, dry_run=False,
               today: _dt.date | None = None) -> R.ETLTask:
    """Snapshot datasets default to today; start <= end."""
    today = today or _dt.date.today()
    if dataset in R.SNAPSHOT_DATASETS and start is None and end is None:
        s = e = today
    else:
        if start is None or end is None:
            raise ValueError("start and end dates are required")
        s, e = parse_cli_date(start), parse_cli_date(end)
    return R.ETLTask(dataset, source, s, e, force=force, dry_run=dry_run)


__all__ = ["run_factor_pipeline", "run_factor_validation", "load", "load_checked", "LoadResult", "backfill", "archive", "status", "missing",
           "run_daily", "DailyRun", "DailyStep", "build_task", "summarize_output", "factor_frame"]
