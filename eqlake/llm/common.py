"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: ASCII white space: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def register(name: str, sql: str | None = None):
    """Add a query (and its DuckDB oracle, where SQL can express it) to the catalogue."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; false for a null id."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Plain ``lower`` is the same on ASCII texts and much faster."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, upper, upper.lower()))


def words_of(col: Column) -> Column:
    """The words of a text: maximal runs without ASCII white space."""
    return F.array_remove(F.split(col, GAP, -1), "")


def fix(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so that ids stay as they are and lineage ends."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder: smaller than a checkpoint, and read by column."""
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as a written table of ``row`` (a number of its own for every row) and ``doc`` (a struct of
    all columns, so that no name clashes). Joins on ``row`` do not depend on ids being there or unique."""
    folder = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def on_equal(rows: DataFrame, values: DataFrame, keys: list[str], *, how: str = "left", share: int = 1000, counts: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``values`` (at most one row per key) on ``keys``, nulls equal to nulls.

    Keys that more than one in ``share`` rows have are at most ``share`` keys: their values are
    broadcast, so their rows stay where they are. The other keys' rows are shuffled, and no task
    gets more than that share of one key. ``rows`` is read twice: give it fixed. ``counts``: the
    keys with their number of rows ``n``, where these are known."""
    total = rows.count()
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    hot = counted.where(F.col("n") * share > total)
    hot = fix(hot.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)]))
    others = [F.col(f"`{c}`") for c in values.columns if c not in keys]
    right = values.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)], *others)
    both = [F.col(f"__{i}") for i in range(len(keys))]
    same = [F.col(f"`{k}`").eqNullSafe(c) for k, c in zip(keys, both)]
    few = hot.select(*[c.alias(f"__h{i}") for i, c in enumerate(both)])
    is_few = lambda cols: reduce(and_, [c.eqNullSafe(F.col(f"__h{i}")) for i, c in enumerate(cols)])
    own = [F.col(f"`{k}`") for k in keys]
    hot_values = right.join(F.broadcast(few), is_few(both), "left_semi")
    hot_rows = rows.join(F.broadcast(few), is_few(own), "left_semi").join(F.broadcast(hot_values), reduce(and_, same), how)
    rest = rows.join(F.broadcast(few), is_few(own), "left_anti").join(right, reduce(and_, same), how)
    return hot_rows.drop(*[f"__{i}" for i in range(len(keys))]).unionByName(rest.drop(*[f"__{i}" for i in range(len(keys))]))
