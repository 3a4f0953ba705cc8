"""Research frames over a test-data panel (bars -> views -> factors -> labels).

``Research(spark, sf_dir, panel)`` wires the operators the way the batch jobs do.
The processed panel tables (bars, adjustment factors) are built once from the
source tables and kept as written Parquet in the shared checkpoint folder, the
way the ETL layer keeps its processed store; everything downstream is lazy.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import cache, cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.functions.ranking import largest_group
from eqlake.operators import factors as FX
from eqlake.operators import labels as LB
from eqlake.operators import processing as PR
from eqlake.operators import views as V
from eqlake.session import checkpoint_dir, size_shuffles, tasks_for
from eqlake.sources import testdata as TD
from eqlake.sources.store import fs_delete, fs_exists, fs_rename, has_parquet


@cache
def _code_version() -> str:
    """Digest of the code that derives the panels: a panel that other code wrote is not taken."""
    return hashlib.sha1(Path(TD.__file__).read_bytes()).hexdigest()[:16]


def _source_key(spark: SparkSession, sf_dir: str, panel: str) -> str:
    """Identity of a derived panel: source folder, panel, the code that derives it and the source
    file's length/modification time (Hadoop FileSystem, so any shared file system works)."""
    src = "lineitem" if panel == "lineitem" else "events"
    path = f"{sf_dir.rstrip('/')}/{src}.parquet"
    try:
        jp = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
        summary = fs.getContentSummary(jp)
        stamp = f"{summary.getLength()}:{fs.getFileStatus(jp).getModificationTime()}"
    except Exception:  # noqa: BLE001 - missing source: the build itself reports it
        stamp = "na"
    return hashlib.sha1(f"{path}|{panel}|{stamp}|{_code_version()}".encode()).hexdigest()[:16]


def materialized(spark: SparkSession, sf_dir: str, panel: str, name: str, build) -> DataFrame:
    """The panel table ``name`` as a written Parquet table in the shared checkpoint
    folder (``spark.checkpoint.dir``), built once from the source tables.

    This is the ETL step of the test data: later queries read the processed table
    (column pruning + filter pushdown) instead of re-aggregating raw rows in every
    branch of a plan. Written to a unique staging path, then renamed.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/eqlake-panels/{_source_key(spark, sf_dir, panel)}"
    target = f"{root}/{name}"
    if not has_parquet(spark, target):
        staging = f"{root}/_tmp-{name}-{uuid.uuid4().hex}"
        build().write.mode("overwrite").option("compression", "zstd").parquet(staging)
        if not has_parquet(spark, target):
            if fs_exists(spark, target):
                fs_delete(spark, target)
            fs_rename(spark, staging, target)
        else:
            fs_delete(spark, staging)
    return spark.read.parquet(target)


# Read handles of the written panel tables, per (application, source identity, table): the tables
# stay in place for the session, so later queries skip the listing and footer reads.
_TABLES: dict = {}


class Research:
    def __init__(self, spark: SparkSession, sf_dir: str, panel: str = "events", *, materialize: bool = True) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.panel_name = panel
        self.materialize = materialize
        size_shuffles(spark, TD.table_bytes(spark, sf_dir, panel))

    def _table(self, name: str, build) -> DataFrame:
        if not self.materialize:
            return build()
        key = (self.spark.sparkContext.applicationId, _source_key(self.spark, self.sf_dir, self.panel_name), name)
        df = _TABLES.get(key)
        if df is None:
            df = materialized(self.spark, self.sf_dir, self.panel_name, name, build)
            _TABLES[key] = df
        return df

    @cached_property
    def bars(self) -> DataFrame:
        return self._table("ohlcv", lambda: TD.ohlcv(self.spark, self.sf_dir, self.panel_name))

    @cached_property
    def adj(self) -> DataFrame:
        return self._table("adj_factor", lambda: TD.adj_factor(self.spark, self.sf_dir, self.panel_name))

    @property
    def date_tasks(self) -> int:
        """Tasks over which whole dates are dealt: twice as many as the source's size asks for, as some get several."""
        return 2 * tasks_for(self.spark, TD.table_bytes(self.spark, self.sf_dir, self.panel_name))

    @cached_property
    def largest_date(self) -> int:
        """Rows of the date with most bars (reads one column)."""
        return largest_group(self.bars, ["trade_date"])

    @cached_property
    def calendar(self) -> DataFrame:
        return TD.calendar_between(self.bars)

    @cached_property
    def calendar_weekdays(self) -> DataFrame:
        return TD.calendar_between(self.bars, weekends_closed=True)

    @cached_property
    def hfq(self) -> DataFrame:
        return V.hfq_view(self.bars, self.adj)

    @cached_property
    def hfq_by_security(self) -> DataFrame:
        """``hfq`` for windows over a security's rows, dealt by security into tasks by the source's size: the
        windows' own shuffle is joined into few large tasks."""
        return self.hfq.repartition(tasks_for(self.spark, TD.table_bytes(self.spark, self.sf_dir, self.panel_name)), "ts_code")

    @cached_property
    def open_dates(self) -> DataFrame:
        return self.calendar.filter("is_open").select(F.col("cal_date").alias("trade_date"))

    def calc(self, metadata=FX.RETURN_5D) -> DataFrame:
        return FX.compute_factor(self.hfq_by_security, metadata)

    def processed(self, metadata=FX.RETURN_5D, processor: str = "raw") -> DataFrame:
        return PR.process_factor_result(self.calc(metadata), metadata, processor, check_identity=False)

    @cached_property
    def labels(self) -> DataFrame:
        return LB.forward_return_5d(self.hfq_by_security, self.open_dates, validate=False)

    @cached_property
    def universe(self) -> DataFrame:
        return self.hfq.select("ts_code", "trade_date")
