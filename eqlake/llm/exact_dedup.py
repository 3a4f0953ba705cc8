"""Operator 5: exact deduplication by a tree merge of sorted digest runs.

Every partition sorts its digests into a run and merges equal ones. Partitions then
exchange runs in binomial rounds: in a round, the partitions whose numbers differ only in
that round's bits form a group, and each member sends every record to the member whose
bits are the digest's. The receiver merges the sorted runs (Spark's external sort merges
them, so memory stays bounded) and keeps, per digest, the winning identifier and the
number of rows. After the last round partition p holds the digests with prefix p, one
record each: no partition ever holds more than its share, and a text that a third of all
rows carry costs each partition one record a round.

Digests are verified at every level: a record is (SHA-256, byte length, XXH64), and only
records equal in all three are merged.

Defined results: a null text counts as empty; texts are equal when identical after
lower-casing A-Z only; of equal texts the row with the largest doc_id stays
(``keep="max"``; "min" keeps the smallest), null ids lose, and of rows that also share
that id exactly one (any) is kept; an empty table gives no rows; extra columns are
ignored by ``exact_groups`` and kept by ``exact_dedup``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.common import ascii_lower, fix, numbered, register, shuffle_partitions, table, text_of

_RUN = "digest binary, n_bytes bigint, check bigint, best bigint, best_row bigint, n bigint"
_NAMES = [c.split()[0] for c in _RUN.split(", ")]


def _digests(docs: DataFrame, text: str) -> list[Column]:
    normal = ascii_lower(text_of(text))
    return [F.unhex(F.sha2(normal, 256)).alias("digest"), F.octet_length(normal).cast("bigint").alias("n_bytes"), F.xxhash64(normal).alias("check")]


def _merge_runs(keep: str):
    """Merge equal neighbours of a sorted partition; the last record of a batch waits for the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for b in batches:
            out: list[tuple] = []
            for r in zip(*(b.column(i).to_pylist() for i in range(6))):
                if held is not None and held[:3] == r[:3]:
                    held = (*held[:3], *_better(held[3:5], r[3:5], keep), held[5] + r[5])
                else:
                    if held is not None:
                        out.append(held)
                    held = r
            if out:
                yield _batch(out)
        if held is not None:
            yield _batch([held])

    return run


def _better(a: tuple, b: tuple, keep: str) -> tuple:
    """The winner of two (doc_id, row): null ids lose, then the id decides, then the smaller row."""
    if a[0] is None or b[0] is None or a[0] == b[0]:
        if a[0] == b[0]:
            return min(a, b, key=lambda x: x[1])
        return b if a[0] is None else a
    return max(a, b, key=lambda x: x[0]) if keep == "max" else min(a, b, key=lambda x: x[0])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.binary()] + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_NAMES)


def tree_merge(rows: DataFrame, keep: str = "max", rounds: int = 2) -> DataFrame:
    """One record per distinct (digest, n_bytes, check) of ``rows`` (digest, n_bytes, check, doc_id, row)."""
    bits = max(rounds, math.ceil(math.log2(max(2, shuffle_partitions(rows.sparkSession)))))
    size = 1 << bits
    order = ["digest", "n_bytes", "check"]
    merge = _merge_runs(keep)
    runs = rows.select("digest", "n_bytes", "check", F.col("doc_id").cast("bigint").alias("best"), F.col("row").alias("best_row"), F.lit(1).cast("bigint").alias("n"))
    runs = runs.sortWithinPartitions(*order).mapInArrow(merge, _RUN)
    # The first 8 hexadecimal digits of the digest as a number; its lowest `bits` bits name the last partition.
    prefix = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(size - 1))
    done = 0
    for k in range(rounds):
        upto = bits * (k + 1) // rounds
        mask = (1 << upto) - (1 << done)  # this round's bits
        here = F.spark_partition_id().cast("bigint").bitwiseAND(F.lit((size - 1) & ~mask))
        sent = runs.withColumn("to", here.bitwiseOR(prefix.bitwiseAND(F.lit(mask))).cast("int"))
        runs = sent.repartitionById(size, F.col("to")).drop("to").sortWithinPartitions(*order).mapInArrow(merge, _RUN)
        done = upto
    return runs


def exact_groups(docs: DataFrame, *, text: str = "text", keep: str = "max", rounds: int = 2) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = fix(docs.select("doc_id", *_digests(docs, text)).withColumn("row", F.monotonically_increasing_id()))
    groups = tree_merge(rows, keep, rounds)
    joined = rows.join(groups, ["digest", "n_bytes", "check"])
    return joined.select(
        "doc_id",
        F.col("best").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, *, text: str = "text", keep: str = "max") -> DataFrame:
    """``docs`` with one row per distinct normalised text, every column kept. Rows are met by their
    numbers, so null and repeated ids cost no more than others."""
    rows = numbered(docs)
    digests = rows.select(F.col("doc.doc_id").alias("doc_id"), *_digests(rows, f"doc.`{text}`"), "row")
    stays = tree_merge(digests, keep).select(F.col("best_row").alias("row"))
    return rows.join(stays, "row", "left_semi").select("doc.*")


ORACLE_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)
"""


@register("op5_exact_dedup", ORACLE_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
