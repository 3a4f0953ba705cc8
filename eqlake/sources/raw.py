"""Raw vendor files: landing (SK1, SK2) and scanning (SC1-SC4).

Layout (Spark partition folders instead of one hand-named file per day)::

    <raw_root>/<source>/<dataset>/year=YYYY/month=MM/file_date=YYYYMMDD/part-*.csv   daily datasets
    <raw_root>/<source>/<dataset>/snapshot/part-*.csv                                 snapshot datasets

Everything is read as strings (no inference). The date range of a daily scan
prunes on the ``year``/``month``/``file_date`` partition columns, so only the
touched folders are listed and read.
"""

from __future__ import annotations

import csv
import datetime as _dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dataset layout classes.
SNAPSHOT_DATASETS = ("trade-calendar", "stock-basic")
DAILY_DATASETS = ("daily-ohlcv", "adj-factor", "daily-basic", "stock-st", "stk-limit", "suspend-d")

#: Rows of a landed file at most.
RECORDS_PER_FILE = 2_000_000
#: Files whose first lines are read at the same time while a scan is planned.
HEADER_READERS = 32


@dataclass(frozen=True)
class ETLTask:
    """O1: one ETL request."""

    dataset: str
    source: str
    start_date: _dt.date
    end_date: _dt.date
    exchange: str = "SSE"
    force: bool = False
    dry_run: bool = False

    def __post_init__(self) -> None:
        if self.start_date > self.end_date:
            raise ValueError("start_date must not be after end_date")


def dataset_root(raw_root: str, task_or_source, dataset: str | None = None) -> str:
    """SC3: base folder of a raw dataset."""
    if isinstance(task_or_source, ETLTask):
        source, dataset = task_or_source.source, task_or_source.dataset
    else:
        source = task_or_source
    base = f"{raw_root.rstrip('/')}/{source}/{dataset}"
    return f"{base}/snapshot" if dataset in SNAPSHOT_DATASETS else base


def raw_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def write_raw_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """SK1: header CSV, strings as given."""
    df.write.mode(mode).option("header", True).csv(path)


def landed_dates(spark: SparkSession, raw_root: str, source: str, dataset: str) -> list[_dt.date]:
    """Dates that already have a landed folder (metadata listing only, no file reads)."""
    jvm = spark._jvm
    base = dataset_root(raw_root, source, dataset)
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/year=*/month=*/file_date=*")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    statuses = fs.globStatus(path) or []
    out = []
    for st in statuses:
        name = st.getPath().getName()
        if name.startswith("file_date="):
            try:
                out.append(_dt.datetime.strptime(name.split("=", 1)[1], "%Y%m%d").date())
            except ValueError:
                continue
    return sorted(out)


def _write_header_only(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(jp, True)
    out.write(bytearray((",".join(columns) + "\n").encode("utf-8")))
    out.close()


def land(df: DataFrame, raw_root: str, task: ETLTask, *, date_column: str = "trade_date",
         expected_dates: Sequence[_dt.date] | None = None) -> dict:
    """SK2: land a raw frame.

    Snapshot datasets are always overwritten. Daily datasets are split by the
    frame's ``date_column`` (``YYYYMMDD`` text); days already landed are skipped
    unless ``task.force`` (then only those days are replaced: dynamic partition
    overwrite). ``dry_run`` counts and writes nothing. ``expected_dates``: days
    that must be present even without rows (an empty vendor answer lands as a
    header-only file, which counts as present).
    """
    spark = df.sparkSession
    if task.dataset in SNAPSHOT_DATASETS:
        n = df.count() if task.dry_run else None
        if not task.dry_run:
            write_raw_csv(df, dataset_root(raw_root, task))
        return {"dataset": task.dataset, "rows": n, "skipped_dates": []}
    d = F.to_date(F.col(date_column), "yyyyMMdd")
    framed = df.withColumn("year", F.year(d)).withColumn("month", F.lpad(F.month(d).cast("string"), 2, "0")).withColumn(
        "file_date", F.col(date_column)
    )
    skipped: list[_dt.date] = []
    if not task.force:
        existing = [x for x in landed_dates(spark, raw_root, task.source, task.dataset)]
        if existing:
            keys = [x.strftime("%Y%m%d") for x in existing]
            skipped = existing
            # The landed-date list is one entry per day (calendar-bounded).
            framed = framed.filter(~F.col("file_date").isin(keys))
    if task.dry_run:
        return {"dataset": task.dataset, "rows": framed.count(), "skipped_dates": skipped}
    # A large day is several tasks and files, whose names keep the order of arrival.
    order = ("file_date", "_arrival")
    (
        framed.withColumn("_arrival", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_arrival")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy("year", "month", "file_date")
        .csv(dataset_root(raw_root, task))
    )
    if expected_dates:
        skip = set(skipped)
        have = set(landed_dates(spark, raw_root, task.source, task.dataset))
        for d in expected_dates:
            if d in have or d in skip:
                continue
            folder = f"{dataset_root(raw_root, task)}/year={d.year}/month={d.month:02d}/file_date={d:%Y%m%d}"
            _write_header_only(spark, f"{folder}/part-empty.csv", [c for c in df.columns])
    return {"dataset": task.dataset, "rows": None, "skipped_dates": skipped}


def _in_range(df: DataFrame, task: ETLTask) -> DataFrame:
    """Rows of the day folders inside the task range (partition pruning)."""
    fd = F.col("file_date").cast("string")
    lo, hi = task.start_date, task.end_date
    days = F.col("year").between(lo.year, hi.year) & (fd >= F.lit(f"{lo:%Y%m%d}")) & (fd <= F.lit(f"{hi:%Y%m%d}"))
    return df.filter(days).withColumn("file_date", fd)


def raw_files(spark: SparkSession, base: str, task: ETLTask) -> list[str]:
    """Raw files of a dataset inside the task's range, in path order (the folders of a day name its
    date, so this is the order of the days too). Lists the folders of the range's months only."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    lo, hi = task.start_date, task.end_date
    if task.dataset in SNAPSHOT_DATASETS:
        patterns = [f"{base}/*"]
    else:
        months = range(lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month)
        patterns = [f"{base}/year={m // 12}/month={name}/file_date=*/*" for m in months for name in sorted({f"{m % 12 + 1:02d}", str(m % 12 + 1)})]
    out = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        for st in path.getFileSystem(conf).globStatus(path) or []:
            p = st.getPath()
            if not st.isFile() or p.getName().startswith(("_", ".")):
                continue
            day = p.getParent().getName().partition("file_date=")[2]
            if task.dataset in SNAPSHOT_DATASETS or f"{lo:%Y%m%d}" <= day <= f"{hi:%Y%m%d}":
                out.append(p.toString())
    return sorted(out)


def _header(spark: SparkSession, file: str) -> str:
    """First line of a file (through its codec, if it is compressed); no more than a block is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def header_names(line: str) -> list[str]:
    """Column names of a header line: the byte-order mark, quotes and outer blanks don't count."""
    return [c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), [])]


def _layouts(spark: SparkSession, base: str, task: ETLTask, required: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(header columns, files) of each column order found. Every file is planned by its own first
    line; a file without all required names is an error."""
    files = raw_files(spark, base, task)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda f: _header(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        names = header_names(line)
        missing = [c for c in required if c not in names]
        if missing:
            raise ValueError(f"raw files lack columns {missing}: {file}")
        out.setdefault(tuple(names), []).append(file)
    return [(list(names), found) for names, found in out.items()]


def read_raw(spark: SparkSession, raw_root: str, task: ETLTask, columns: Sequence[str] | None = None, *, position: bool = False) -> DataFrame:
    """SC1 + SC2: all-string scan of the dataset's files inside the task range.

    With ``columns`` (the required names) every file is read by its own header, so files may
    order their columns differently; files of one order are one scan, and their rows are read once.
    A file that lacks a required column is an error; columns that only some files have are null in
    the others.

    ``position`` adds ``_position`` (path, block, row), which orders all rows as they arrived: by
    file (a correction beside a file of its day has a name after it), then by place in the file. Row numbers are compared within a block only, so the order is
    the same however often a task runs and wherever the blocks are read.
    """
    base = dataset_root(raw_root, task)
    snapshot = task.dataset in SNAPSHOT_DATASETS
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if columns is None:
        frame = reader.csv(base) if snapshot else reader.option("basePath", base).csv(base)
        frame = _positioned(frame) if position else frame
        return frame if snapshot else _in_range(frame, task)
    folders = [] if snapshot else [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("file_date", T.StringType())]
    frames = []
    for names, files in _layouts(spark, base, task, columns):
        schema = T.StructType([*raw_schema(names).fields, *folders])
        # The schema is these files' own header, so it is applied as it stands.
        frame = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", True).schema(schema)
        frame = frame.csv(files) if snapshot else frame.option("basePath", base).csv(files)
        frames.append(_positioned(frame) if position else frame)
    if not frames:
        empty = spark.createDataFrame([], T.StructType([*raw_schema(columns).fields, *folders]))
        none = F.lit(None).cast("struct<path: string, block: bigint, row: bigint>")
        return empty.withColumn("_position", none) if position else empty
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out if snapshot else _in_range(out, task)


def _positioned(frame: DataFrame) -> DataFrame:
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return frame.select("*", place.alias("_position"))


def read_same_day(spark: SparkSession, raw_root: str, task: ETLTask, dataset: str, columns=None, *, required: bool = True,
                  position: bool = False, days: Sequence[_dt.date] | None = None) -> DataFrame | None:
    """SC4: auxiliary dataset (``stock-st`` / ``stk-limit``) over the same range.

    With ``required`` every landed price day (or each of ``days``) must have an auxiliary day.
    """
    aux_task = ETLTask(dataset, task.source, task.start_date, task.end_date, task.exchange)
    have = set(landed_dates(spark, raw_root, task.source, dataset))
    if not have:
        if required:
            raise FileNotFoundError(f"missing auxiliary raw data: dataset={dataset}")
        return None
    if required:
        price_days = days if days is not None else [d for d in landed_dates(spark, raw_root, task.source, task.dataset) if task.start_date <= d <= task.end_date]
        missing = [d for d in price_days if d not in have]
        if missing:
            raise FileNotFoundError(f"missing auxiliary raw files for {dataset}: {[d.isoformat() for d in missing[:3]]}")
    return read_raw(spark, raw_root, aux_task, columns, position=position)
