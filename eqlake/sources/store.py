"""Processed Parquet store: views (SC5-SC7) and sinks (SK3-SK11).

Layout under ``root``::

    processed/<dataset>/year=YYYY/month=M/commit=<id>/part-*.parquet     live months
    processed/<dataset>/_log/<version>.json                              versions (see ``snapshots``)
    processed/_archive/<dataset>/year=YYYY/commit=<id>/part-*.parquet    compacted years
    dims/<name>/commit=<id>/part-*.parquet, dims/<name>/_log             small tables
    _staging/<uuid>/...                                                  incoming batches

Every write makes new ``commit=`` folders and publishes one manifest that names the folders of
the new version; nothing that a version names is written again. An upsert reads only the touched
months, merges (new rows win) and writes them once. Readers resolve one version, so a key is in
exactly one place whenever a writer stops. Writers that touch the same months at the same time
retry on the version that won. The schema is in the manifest, so a read opens no footers.

Folders of versions older than the newest ``keep_versions`` are removed after a commit; an
archived year's months at once. ``sweep`` removes what writers left that stopped on the way.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eqlake import schemas as S
from eqlake.functions.ranking import materialize
from eqlake.operators.contracts import require_columns, validate_identifier
from eqlake.sources.snapshots import Part, Snapshot, SnapshotLog, fs_delete, fs_exists, fs_path, fs_rename, sub_dirs

#: Views derived from bars and adjustment factors.
PRICE_VIEWS = ("v_daily_hfq", "v_daily_qfq_latest", "v_daily_adj")
DIMENSIONS = {"dim_trade_calendar": S.CALENDAR_SCHEMA, "dim_security": S.SECURITY_SCHEMA}


def has_parquet(spark: SparkSession, p: str) -> bool:
    if not fs_exists(spark, p):
        return False
    for pattern in ("/*.parquet", "/*/*.parquet", "/*/*/*.parquet"):
        g, fs2 = fs_path(spark, p.rstrip("/") + pattern)
        st = fs2.globStatus(g)
        if st is not None and len(st) > 0:
            return True
    return False


def keep_last(df: DataFrame, key_columns: Sequence[str], order_col: str) -> DataFrame:
    """SK4: one row per key, the one with the largest ``order_col`` (arrival order).

    * integral ``order_col`` (unique within a key, e.g. a staged arrival sequence or
      a source rank where each source holds a key at most once):
      ``max(order_col)`` per key as a hash aggregate with map-side partial
      aggregation, then an equi join on ``(keys, order_col)``. Because the sequence
      is part of the join key, the rows of a hot key hash across many partitions.
    * any other ordering (e.g. a struct): ``max_by(struct(row), order_col)`` per
      key, a partial aggregate (sort based, spills).
    """
    others = [c for c in df.columns if c not in key_columns]
    dtype = df.schema[order_col].dataType.typeName()
    if dtype in ("long", "integer", "short", "byte"):
        latest = df.groupBy(*key_columns).agg(F.max(order_col).alias("_latest"))
        cond = F.col(f"r.{order_col}") == F.col("l._latest")
        for k in key_columns:  # null-safe: a null key is a group of its own, as in groupBy
            cond = cond & F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}"))
        kept = df.alias("r").join(latest.alias("l"), cond, "left_semi")
        return kept.select(*key_columns, *others)
    packed = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*key_columns).agg(F.max_by(packed, F.col(order_col)).alias("_row"))
    return agg.select(*key_columns, *[F.col(f"_row.{c}").alias(c) for c in others])


def upsert_frames(old: DataFrame, new: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Core of SK3/SK10: stored rows whose key is in ``new`` are replaced."""
    return without_keys(old, new, key_columns).unionByName(new, allowMissingColumns=True)


def without_keys(old: DataFrame, new: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key ``new`` doesn't hold; null keys are keys like others, as in ``keep_last``."""
    keys = new.select(*[F.col(k).alias(f"_new_{k}") for k in key_columns])
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key_columns]
    return old.join(keys, reduce(and_, same), "left_anti")


def replace_rows(old: DataFrame, new: DataFrame, delete_where: Column | None) -> DataFrame:
    """Core of SK9: drop rows matching ``delete_where`` (None = all), add ``new``."""
    if delete_where is None:
        return new
    return old.filter(~F.coalesce(delete_where, F.lit(False))).unionByName(new)


class Store:
    #: Versions whose folders are kept, for readers that resolved one before the last commits.
    keep_versions = 8
    #: Rows of one file of a month, about.
    rows_per_file = 1_000_000
    #: Times that a commit starts again because another writer was first.
    attempts = 20

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- paths and versions --------------------------------------------------
    def path(self, dataset: str) -> str:
        return f"{self.root}/processed/{validate_identifier(dataset)}"

    def archive_path(self, dataset: str) -> str:
        return f"{self.root}/processed/_archive/{validate_identifier(dataset)}"

    def dim_path(self, name: str) -> str:
        return f"{self.root}/dims/{validate_identifier(name)}"

    def _staging(self) -> str:
        return f"{self.root}/_staging/{uuid.uuid4().hex}"

    def log(self, dataset: str) -> SnapshotLog:
        return SnapshotLog(self.spark, self.path(dataset))

    def dim_log(self, name: str) -> SnapshotLog:
        return SnapshotLog(self.spark, self.dim_path(name))

    def _reached(self, step: str) -> None:
        """Called after each step of a write; tests stop a write here."""

    def _commit(self, log: SnapshotLog, reads, build) -> Snapshot:
        """Publish ``build(base)`` = (schema, parts), which depends on the parts ``reads(base)`` names.

        If another writer publishes first, its version is the base, and only if it changed one of
        those parts is the work done again."""
        for _ in range(self.attempts):
            base = log.current()
            depends = reads(base)
            schema, parts = build(base)
            self._reached("written")
            head = base
            while all(head.parts.get(k) == base.parts.get(k) for k in depends):
                done = head.changed(schema, parts)
                if log.publish(done):
                    self._reached("published")
                    return done
                head = log.current()
            for p in parts.values():
                if p is not None:
                    fs_delete(self.spark, f"{self.root}/{p.folder}")
        raise RuntimeError(f"other writers were first {self.attempts} times: {log.folder}")

    def _tidy(self, log: SnapshotLog, keep: int) -> None:
        """Remove the folders that only versions before the newest ``keep`` name."""
        for folder in log.forget(keep):
            path = f"{self.root}/{folder}"
            fs_delete(self.spark, path)
            self._drop_empty(path)

    def _drop_empty(self, path: str) -> None:
        """Remove the partition folders above ``path`` that hold nothing any more."""
        jp, fs = fs_path(self.spark, path)
        parent = jp.getParent()
        while "=" in parent.getName() and fs.exists(parent) and not len(fs.listStatus(parent)):
            fs.delete(parent, False)
            parent = parent.getParent()

    def sweep(self, dataset: str, older_than_hours: float = 168.0) -> list[str]:
        """Remove ``commit=`` folders that no version names and that were made so long ago that no
        writer can still be at work on them; returns them."""
        log = self.log(dataset)
        named = set().union(*[log.read(v).folders() for v in log.versions()])
        before = _dt.datetime.now().timestamp() - older_than_hours * 3600
        gone = []
        patterns = [f"{self.path(dataset)}/year=*/month=*/commit=*", f"{self.archive_path(dataset)}/year=*/commit=*", f"{self.path(dataset)}/_codes/*"]
        for pattern in patterns:
            jp, fs = fs_path(self.spark, pattern)
            for s in fs.globStatus(jp) or []:
                path = s.getPath().toUri().getPath()
                folder = "processed/" + path.rsplit("/processed/", 1)[1]
                used = folder in named or any(f.startswith(f"{folder}/") for f in named)
                if not used and s.getModificationTime() / 1000 <= before:
                    fs.delete(s.getPath(), True)
                    self._drop_empty(path)
                    gone.append(folder)
        return sorted(gone)

    # -- reads (SC5) ---------------------------------------------------------
    def _columns(self, dataset: str) -> list[str]:
        schema = S.DATASET_SCHEMAS.get(dataset)
        return [f.name for f in schema.fields] if schema is not None else []

    def _scan(self, snapshot: Snapshot, base: str, keys: Sequence[str]) -> DataFrame | None:
        """The rows of some parts; their schema is the version's, so no footer is opened."""
        folders = [f"{self.root}/{snapshot.parts[k].folder}" for k in sorted(keys)]
        if not folders:
            return None
        return self.spark.read.schema(snapshot.schema).option("basePath", base).parquet(*folders).drop("commit")

    def read_live(self, dataset: str, snapshot: Snapshot | None = None, months: Sequence[str] | None = None) -> DataFrame | None:
        """Live months (all, or the named ones) of one version."""
        snapshot = snapshot or self.log(dataset).current()
        keys = [k for k in snapshot.parts if _is_month(k) and (months is None or k in months)]
        return self._scan(snapshot, self.path(dataset), keys)

    def read_archive(self, dataset: str, snapshot: Snapshot | None = None, years: Sequence[str] | None = None) -> DataFrame | None:
        snapshot = snapshot or self.log(dataset).current()
        keys = [k for k in snapshot.parts if not _is_month(k) and (years is None or k in years)]
        return self._scan(snapshot, self.archive_path(dataset), keys)

    def read(self, dataset: str, version: int | None = None) -> DataFrame | None:
        """Live months and archived years of one version (the newest, unless one is named), united
        by column name; ``None`` when absent."""
        log = self.log(dataset)
        snapshot = log.current() if version is None else log.read(version)
        frames = [f for f in (self.read_live(dataset, snapshot), self.read_archive(dataset, snapshot)) if f is not None]
        if not frames:
            return None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        cols = [c for c in self._columns(dataset) if c in out.columns] or [c for c in out.columns]
        extra = [c for c in out.columns if c not in cols and c not in ("year", "month")]
        return out.select(*cols, *extra, *[c for c in ("year", "month") if c in out.columns])

    def dates(self, dataset: str) -> tuple[_dt.date, ...]:
        """S6 from the manifest: the distinct dates of a dataset, in order (none where it is absent)."""
        return tuple(sorted({d for p in self.log(dataset).current().parts.values() for d in p.dates}))

    def statistics(self, dataset: str) -> dict | None:
        """AG2 without reading rows: row count and dates from the manifest, securities from the
        stored codes of the parts; ``None`` where the dataset is absent."""
        parts = self.log(dataset).current().parts
        if not parts:
            return None
        dates = sorted({d for p in parts.values() for d in p.dates})
        codes = [f"{self.root}/{p.codes}" for p in parts.values() if p.codes]
        securities = self.spark.read.schema("ts_code string").parquet(*codes).where("ts_code IS NOT NULL").distinct().count() if codes else 0
        return {
            "start_date": dates[0] if dates else None, "end_date": dates[-1] if dates else None, "row_count": sum(p.rows for p in parts.values()),
            "trade_date_count": len(dates), "security_count": securities,
        }

    def read_dim(self, name: str) -> DataFrame | None:
        snapshot = self.dim_log(name).current()
        if not snapshot.parts:
            return None
        return self.spark.read.schema(snapshot.schema).parquet(f"{self.root}/{snapshot.parts[''].folder}")

    def register_views(self) -> list[str]:
        """SC5/SC6: (re)create temp views for every present dataset and the derived
        price views when both bars and factors exist. Views whose inputs are gone are
        dropped. Returns the view names."""
        from eqlake.operators import views as V

        names = []
        for dataset, view in S.PROCESSED_DATASETS.items():
            df = self.read(dataset)
            if df is not None:
                df.createOrReplaceTempView(view)
                names.append(view)
        for dim in DIMENSIONS:
            df = self.read_dim(dim)
            if df is not None:
                df.createOrReplaceTempView(dim)
                names.append(dim)
        if "v_daily_ohlcv" in names and "v_adj_factor" in names:
            bars, adj = self.spark.table("v_daily_ohlcv"), self.spark.table("v_adj_factor")
            V.hfq_view(bars, adj).createOrReplaceTempView("v_daily_hfq")
            V.qfq_latest_view(bars, adj).createOrReplaceTempView("v_daily_qfq_latest")
            V.adj_alias_view(bars, adj).createOrReplaceTempView("v_daily_adj")
            names += PRICE_VIEWS
        for gone in {*S.PROCESSED_DATASETS.values(), *DIMENSIONS, *PRICE_VIEWS} - set(names):
            self.spark.catalog.dropTempView(gone)
        return names

    refresh_views = register_views

    def relation_exists(self, name: str) -> bool:
        """SC7."""
        return bool(self.spark.catalog.tableExists(name))

    def relation_columns(self, name: str) -> list[str]:
        return self.spark.table(name).columns if self.relation_exists(name) else []

    # -- sinks ---------------------------------------------------------------
    def write_daily(
        self,
        dataset: str,
        df: DataFrame,
        *,
        date_column: str,
        key_columns: Sequence[str],
        columns: Sequence[str],
        order_col: str | None = None,
    ) -> dict[tuple[int, int], int]:
        """SK3 monthly upsert. Returns the number of *new* rows per (year, month).

        Within the batch, duplicates keep the last arrival (``order_col``, or
        the frame's current row order). Against the store, new rows win.
        """
        missing = [c for c in [date_column, *key_columns] if c not in columns]
        if missing:
            raise ValueError(f"output columns lack key columns: {missing}")
        require_columns(df, [date_column, *key_columns, *columns], "daily frame")
        seq = order_col or "_seq"
        batch = df if order_col else df.withColumn("_seq", F.monotonically_increasing_id())
        batch = batch.select(*columns, F.col(seq).alias("_seq")).withColumn(date_column, F.to_date(F.col(date_column)))
        batch = batch.withColumn("year", F.year(date_column)).withColumn("month", F.month(date_column))
        # Stage the incoming batch once: the upstream plan (e.g. normalisation) runs a
        # single time, the arrival sequence is fixed, and every later step (counts,
        # dedup, merge, archive rewrite, a retry) reads the staged copy.
        with self.staged(batch) as rows:
            return self.upsert_staged(dataset, rows, date_column=date_column, key_columns=key_columns, columns=columns)

    @contextmanager
    def staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` written to a folder of its own, which goes at the end whatever happens."""
        staging = self._staging()
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{staging}/batch")
            self._reached("staged")
            yield self.spark.read.schema(df.schema).parquet(f"{staging}/batch")
        finally:
            fs_delete(self.spark, staging)

    def quarantine(self, dataset: str, rows: DataFrame) -> str:
        """Keep refused rows for inspection, away from every view; returns their folder."""
        folder = f"{self.root}/quarantine/{validate_identifier(dataset)}/run={uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def quarantined(self, dataset: str) -> DataFrame | None:
        """All rows that loads refused so far; ``None`` where there are none."""
        folder = f"{self.root}/quarantine/{validate_identifier(dataset)}"
        return self.spark.read.parquet(folder).drop("run") if has_parquet(self.spark, folder) else None

    def upsert_staged(self, dataset: str, batch: DataFrame, *, date_column: str, key_columns: Sequence[str],
                      columns: Sequence[str]) -> dict[tuple[int, int], int]:
        """Upsert rows that are written already, with their ``_seq``, ``year`` and ``month``."""
        counts = {
            (r["year"], r["month"]): r["n"]
            for r in batch.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).collect()
        }  # one row per touched month
        if not counts:
            return {}
        if any(y is None for y, _ in counts):
            raise ValueError(f"{counts[(None, None)]} rows have no {date_column}")
        # Most batches hold a key once; only others are shuffled whole to find the last row of a key.
        repeated = batch.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        new = (keep_last(batch, list(key_columns), "_seq") if repeated.limit(1).count() else batch).drop("_seq")
        months = {_month_key(y, m): n for (y, m), n in counts.items()}
        years = sorted({str(y) for y, _ in counts})

        def build(base: Snapshot) -> tuple[T.StructType, dict[str, Part | None]]:
            live = self.read_live(dataset, base, list(months))
            merged = new if live is None else upsert_frames(live, new, key_columns)
            merged = self._conform(merged, columns, date_column, ("year", "month"))
            rows = {k: n + (base.parts[k].rows if k in base.parts else 0) for k, n in months.items()}
            parts = dict(self._write_parts(dataset, merged, rows, date_column, key_columns))
            for y in years:
                if y in base.parts:
                    parts |= self._without_replaced(dataset, base, y, new, date_column, key_columns, columns)
            return self._schema(merged), parts

        self._commit(self.log(dataset), lambda base: [*months, *years], build)
        self._tidy(self.log(dataset), self.keep_versions)
        return counts

    def _without_replaced(self, dataset: str, base: Snapshot, year: str, new: DataFrame, date_column, key_columns, columns) -> dict[str, Part | None]:
        """An archived year without the keys that came again (they are live now); untouched if none did."""
        old = self.read_archive(dataset, base, [year])
        kept = without_keys(old, new, key_columns)
        part = self._write_parts(dataset, self._conform(kept, columns, date_column, ("year",)), {year: base.parts[year].rows}, date_column, key_columns)
        return part or {year: None}

    def _write_parts(self, dataset: str, df: DataFrame, rows: dict[str, int], date_column: str, key_columns: Sequence[str]) -> dict[str, Part]:
        """Write the months (or years) of ``df`` as new folders, about ``rows_per_file`` rows a file,
        and say what is in them. ``rows``: about how many rows each one has. Every file is a task of its
        own, so none sorts several files' rows."""
        monthly = "month" in df.columns
        root = self.path(dataset) if monthly else self.archive_path(dataset)
        by = ["year", "month"] if monthly else ["year"]
        commit = f"c{uuid.uuid4().hex}"
        files = {k: -(-max(n, 1) // self.rows_per_file) for k, n in rows.items()}
        key = F.format_string("%04d-%02d", "year", "month") if monthly else F.col("year").cast("string")
        # Number of files and first task of each folder.
        firsts = accumulate(files.values(), initial=0)
        per = F.element_at(F.create_map(*[x for (k, n), first in zip(files.items(), firsts) for x in (F.lit(k), F.struct(F.lit(n).alias("n"), F.lit(first).alias("first")))]), key)
        task = per["first"] + F.pmod(F.xxhash64(*key_columns), per["n"].cast("bigint")).cast("int")
        dealt = df.withColumn("commit", F.lit(commit)).repartitionById(sum(files.values()), task)
        order = [date_column, *[k for k in key_columns if k != date_column]]
        dealt.sortWithinPartitions(*by, *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "commit").parquet(root)
        self._reached("files")
        written = self.spark.read.schema(df.drop(*by).schema).option("basePath", root)
        folders = {k: f"{root}/{_folder(k)}/commit={commit}" for k in rows}
        present = [f for f in folders.values() if fs_exists(self.spark, f)]
        if not present:
            return {}
        rows = written.parquet(*present)
        found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set(date_column)).alias("dates")).collect()
        codes = None
        if "ts_code" in df.columns:
            codes = f"{self.path(dataset)}/_codes/{commit}"
            rows.select(*by, "ts_code").distinct().repartition(*by).write.partitionBy(*by).parquet(codes)
        out = {}
        for r in found:  # one row per written month, with its dates
            k = _month_key(r["year"], r["month"]) if monthly else str(r["year"])
            below = lambda f: f[len(self.root) + 1 :]
            out[k] = Part(below(folders[k]), r["n"], tuple(r["dates"]), below(f"{codes}/{_folder(k)}") if codes else None)
        return out

    def _conform(self, df: DataFrame, columns, date_column, part_cols) -> DataFrame:
        out = df.withColumn(date_column, F.to_date(F.col(date_column)))
        if "year" not in out.columns:
            out = out.withColumn("year", F.year(date_column))
        if "month" in part_cols and "month" not in out.columns:
            out = out.withColumn("month", F.month(date_column))
        cols = []
        for c in columns:
            meta = {"comment": S.COLUMN_COMMENTS[c]} if c in S.COLUMN_COMMENTS else None
            cols.append(F.col(c).alias(c, metadata=meta) if meta else F.col(c))
        return out.select(*cols, *part_cols)

    @staticmethod
    def _schema(df: DataFrame) -> T.StructType:
        """What a manifest says of the stored columns: all may be null, as in any Parquet read."""
        return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields if f.name not in ("year", "month")])

    def archive_year(self, dataset: str, year: int, *, key_columns: Sequence[str], columns: Sequence[str],
                     date_column: str = "trade_date", today: _dt.date | None = None) -> str:
        """SK8: compact the live months of a finished year into the archive root.

        Archived rows come first, months after (months win on a key). One version replaces the
        months by the year; then older versions' folders are removed. Other files stay."""
        today = today or _dt.date.today()
        if year >= today.year:
            raise ValueError("only finished years can be archived")
        months = [_month_key(year, m) for m in range(1, 13)]

        def build(base: Snapshot) -> tuple[T.StructType, dict[str, Part | None]]:
            live = self.read_live(dataset, base, months)
            if live is None:
                raise FileNotFoundError("no month files to archive")
            merged = live.select(*columns)
            old = self.read_archive(dataset, base, [str(year)])
            if old is not None:
                merged = upsert_frames(old.select(*columns), merged, key_columns)
            merged = self._conform(merged, columns, date_column, ("year",))
            rows = sum(base.parts[k].rows for k in [*months, str(year)] if k in base.parts)
            parts = self._write_parts(dataset, merged, {str(year): rows}, date_column, key_columns)
            return self._schema(merged), {**dict.fromkeys(months), **parts}

        self._commit(self.log(dataset), lambda base: [*months, str(year)], build)
        self._tidy(self.log(dataset), 1)
        return f"{self.archive_path(dataset)}/year={year}"

    def replace_dimension(self, name: str, df: DataFrame, delete_where: Column | None, columns: Sequence[str]) -> int:
        """SK9: delete the rows matching ``delete_where`` (``None`` = all) and insert
        ``df`` as one version; returns the number of inserted rows. An empty ``df`` still
        deletes. On an error the old version stays."""
        validate_identifier(name)
        for c in columns:
            validate_identifier(c)
        require_columns(df, columns, name)
        new = materialize(df.select(*columns))
        n = new.count()

        def build(base: Snapshot) -> tuple[T.StructType, dict[str, Part | None]]:
            out = new
            if base.parts:
                old = self.spark.read.schema(base.schema).parquet(f"{self.root}/{base.parts[''].folder}")
                out = replace_rows(old.select(*columns), new, delete_where)
            folder = f"dims/{name}/commit=c{uuid.uuid4().hex}"
            out.write.parquet(f"{self.root}/{folder}")
            self._reached("files")
            return self._schema(out), {"": Part(folder, self.spark.read.schema(out.schema).parquet(f"{self.root}/{folder}").count())}

        self._commit(self.dim_log(name), lambda base: [""], build)
        self._tidy(self.dim_log(name), self.keep_versions)
        return n

    def write_factor_results(self, df: DataFrame, order_col: str | None = None) -> dict[tuple[int, int], int]:
        """SK10: required 5 columns, no unknown columns, missing optional columns
        added as typed nulls, upsert on the 4-column key."""
        require_columns(df, S.FACTOR_COLUMNS, "factor results")
        allowed = set(S.FACTOR_STORAGE_COLUMNS) | ({order_col} if order_col else set())
        unknown = [c for c in df.columns if c not in allowed]
        if unknown:
            raise ValueError(f"factor results have unsupported columns: {unknown}")
        types = {f.name: f.dataType for f in S.FACTOR_SCHEMA.fields}
        out = df
        for c in S.FACTOR_OPTIONAL_COLUMNS:
            if c not in out.columns:
                out = out.withColumn(c, F.lit(None).cast(types[c]))
        return self.write_daily(
            "factors", out, date_column="trade_date", key_columns=S.FACTOR_KEY, columns=S.FACTOR_STORAGE_COLUMNS,
            order_col=order_col,
        )


def _month_key(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def _is_month(key: str) -> bool:
    return "-" in key


def _folder(key: str) -> str:
    """Partition folder of a part: a month's or a year's."""
    year, _, month = key.partition("-")
    return f"year={int(year)}/month={int(month)}" if month else f"year={int(year)}"


def prune_months(df: DataFrame, start, end) -> DataFrame:
    """Add ``year``/``month`` partition predicates equivalent to a ``trade_date``
    range so that the scan prunes folders, then keep the exact range."""
    s, e = _as_date(start), _as_date(end)
    years = F.col("year").between(s.year, e.year)
    if "month" in df.columns:  # archived rows carry no month: keep them on the year predicate
        ym = (F.col("year") * 100 + F.col("month")).between(s.year * 100 + s.month, e.year * 100 + e.month)
        years = years & (F.col("month").isNull() | ym)
    return df.filter(years & F.col("trade_date").between(F.lit(s), F.lit(e)))


def _as_date(v):
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))


__all__ = ["Store", "keep_last", "prune_months", "upsert_frames", "without_keys", "replace_rows", "has_parquet",
           "fs_delete", "fs_exists", "fs_rename", "sub_dirs"]
