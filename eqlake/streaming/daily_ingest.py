"""Incremental ingest of landed daily raw files into the processed store.

The reference's daily job loads each newly landed day (O7). Here the same work runs as a
Structured Streaming query over the *arrivals* of files: a file stream per dataset gives the
date and dataset of every landed file (their content isn't read), and a streaming aggregate keeps
per date which datasets have landed. In update mode it gives every date that a batch of files
touched; ``foreachBatch`` loads those that are complete through the batch load (files by their
own headers, checks before publishing, upsert).

* A price day waits in the state until the datasets in ``wait_for`` have landed, then loads.
* A corrected price, limit or ST file is a new file of its date: the date is loaded again, with
  all its files in order, and its rows replace the stored ones.
* A batch replayed after a failure gives the same store, as upserts do.

The state is one row per date.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.plans import jobs as J
from eqlake.sources import raw as R
from eqlake.sources.snapshots import fs_path
from eqlake.sources.store import Store

#: Auxiliary datasets that a price day is joined with.
AUXILIARY = ("stk-limit", "stock-st")
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, raw_root: str, source: str, datasets: Sequence[str], *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of (file_date, dataset) of every file that lands; ``datasets`` may be empty yet."""
    out = None
    for dataset in datasets:
        base = R.dataset_root(raw_root, source, dataset)
        jp, fs = fs_path(spark, base)
        fs.mkdirs(jp)
        reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.csv*")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        day = F.regexp_extract("path", r"/file_date=(\d{8})/[^/]*$", 1)
        files = reader.load(base).select(day.alias("file_date"), F.lit(dataset).alias("dataset")).where("file_date <> ''")
        out = files if out is None else out.union(files)
    return out


def landed_by_date(files: DataFrame) -> DataFrame:
    """file_date, landed (the datasets that have a file of that date), files."""
    return files.groupBy("file_date").agg(F.sort_array(F.collect_set("dataset")).alias("landed"), F.count(F.lit(1)).alias("files"))


def complete_days(touched: DataFrame, dataset: str, wait_for: Sequence[str]) -> list[_dt.date]:
    """Dates among ``touched`` whose files are all there (one row per date reaches the driver)."""
    needed = [dataset, *wait_for]
    ready = touched.where(F.size(F.array_except(F.array(*[F.lit(x) for x in needed]), "landed")) == 0)
    return sorted(_dt.datetime.strptime(r["file_date"], "%Y%m%d").date() for r in ready.select("file_date").collect())


def load_days(spark: SparkSession, store: Store, raw_root: str, source: str, dataset: str, days: Sequence[_dt.date], *, need_st: bool = False,
              set_aside: bool = False) -> int:
    """Load the files of some days; returns the number of loaded rows."""
    if not days:
        return 0
    task = R.ETLTask(dataset, source, days[0], days[-1])
    return J.load_checked(spark, store, raw_root, task, days=days, need_st=need_st, set_aside=set_aside).rows


def start_daily_ingest(spark: SparkSession, store: Store, raw_root: str, source: str, dataset: str, checkpoint: str, *,
                       wait_for: Sequence[str] | None = None, available_now: bool = False, processing_time: str | None = None,
                       max_files_per_trigger: int | None = None, set_aside: bool = False):
    """Start the ingest stream for one daily dataset; returns the ``StreamingQuery``.

    ``wait_for``: datasets that a date needs before it loads; for prices the limit list unless given
    (an ST list that lands later loads the date again; name it here to wait for it as well).
    ``checkpoint`` must be a shared folder (offsets and state). ``set_aside``: a row that fails a check
    goes to quarantine and the day's other rows load; without it the stream stops there.
    """
    if dataset not in J.DATASET_COLUMNS:
        raise ValueError(f"no streaming ingest for dataset={dataset}")
    aux = AUXILIARY if dataset == "daily-ohlcv" else ()
    waiting = tuple(wait_for) if wait_for is not None else aux[:1]
    if not set(waiting) <= set(aux):
        raise ValueError(f"{dataset} can't wait for {sorted(set(waiting) - set(aux))}")
    files = arrivals(spark, raw_root, source, (dataset, *aux), max_files_per_trigger=max_files_per_trigger)

    def handle(touched: DataFrame, _epoch: int) -> None:
        days = complete_days(touched, dataset, waiting)
        load_days(touched.sparkSession, store, raw_root, source, dataset, days, need_st="stock-st" in waiting, set_aside=set_aside)

    writer = landed_by_date(files).writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
