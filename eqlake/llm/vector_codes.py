"""Operator 11: vector codes by active-entry Lloyd rounds.

Every vector's components become integers, floor(scale * x), and the vector is cut into equal
parts. Each part position has a codebook; a part's code is the index of its nearest entry
(squared Euclidean distance in integers, ties to the lower index). A Lloyd round replaces each
entry by the componentwise floor of its parts' mean; an entry without parts stays.

Per part the assigned entry and its exact distance are stored. After a round, a part whose
entry didn't move compares only the entries that did against the stored distance; a part whose
entry moved scans its whole codebook. Both give what a whole scan gives: entries that didn't
move are as far as they were, and the stored one was the best of them, at the lowest index.

A round's sums leave each task as one row per codebook component, so what is shuffled and what
reaches the driver (entries x components numbers) doesn't grow with the rows. The rows' state
is a checkpoint in the shared folder after every round.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped;
shorter vectors are padded with zeros to the longest one's length, rounded up to whole parts;
with fewer kept rows than entries the codebooks are as short; null ids order last, and rows that
repeat an id order by their vectors; repeated rows get equal codes; equal labels count together,
nulls too; an empty table gives no rows; other columns are ignored. Components beyond +-65,536
(at scale 256) raise an ArithmeticError, as their distances might pass 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eqlake.llm.common import fix, on_equal, register, table

LIMIT = 1 << 24
#: Rows compared with a codebook at once.
ROWS = 4_096


@dataclass(frozen=True)
class Codebooks:
    """``values[p, e]`` is entry e of part p; ``moved`` marks the entries that the last round changed."""

    values: np.ndarray
    moved: np.ndarray

    def text(self) -> str:
        return ",".join(map(str, self.values.reshape(-1).tolist()))

    def replaced(self, cells: dict[int, tuple[int, int]]) -> Codebooks:
        """After a round: ``cells`` has (count, sum) by position in the flattened ``values``."""
        new = self.values.reshape(-1).copy()
        for at, (n, total) in cells.items():
            new[at] = total // n  # whole numbers of any size; floors go down
        new = new.reshape(self.values.shape)
        return Codebooks(new, (new != self.values).any(axis=2))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to ``entries``, exact in 64-bit integers."""
    out = np.zeros((len(x), len(entries)), dtype=np.int64)
    for j in range(x.shape[1]):
        d = x[:, j, None] - entries[None, :, j]
        d *= d
        out += d
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and distance of the nearest entry; ties go to the lower index."""
    code, best = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for k in range(0, len(x), ROWS):
        d = distances(x[k : k + ROWS], entries)
        c = d.argmin(axis=1)
        code[k : k + ROWS], best[k : k + ROWS] = c, d[np.arange(len(c)), c]
    return code, best


def reassigned(x: np.ndarray, code: np.ndarray, best: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and distances after a round, from those before it."""
    code, best = code.copy(), best.copy()
    active = np.flatnonzero(moved)
    if not len(active):
        return code, best
    lost = moved[code]
    stay = np.flatnonzero(~lost)
    c, d = nearest(x[stay], entries[active])
    c = active[c]
    better = (d < best[stay]) | ((d == best[stay]) & (c < code[stay]))
    code[stay[better]], best[stay[better]] = c[better], d[better]
    code[lost], best[lost] = nearest(x[lost], entries)
    return code, best


def _is_whole(vector: Column) -> Column:
    finite = lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _integers(batch: pa.RecordBatch, at: int, dim: int) -> np.ndarray:
    """Matrix of the batch's integer vectors, padded with zeros to ``dim``."""
    lists = batch.column(at)
    starts, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    out = np.zeros((batch.num_rows, dim), dtype=np.int64)
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(batch.num_rows), sizes)
    used = values[starts[0] : starts[-1]]
    if len(used) and np.abs(used).max() > LIMIT:
        raise ArithmeticError(f"a vector component is beyond {LIMIT} after scaling")
    out[owner, np.arange(len(used)) - np.repeat(starts[:-1] - starts[0], sizes)] = used.astype(np.int64)
    return out


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


@dataclass(frozen=True)
class EncodedVectors:
    """``rows``: the id, label, codes (one byte per part) and error; ``codebooks``: the final ones."""

    rows: DataFrame
    codebooks: Codebooks


def encode_vectors(df: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16,
                   entries: int = 64, rounds: int = 2, scale: int = 256) -> EncodedVectors:
    """Codebooks after ``rounds`` Lloyd rounds and every kept row's codes (see the module)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    v = F.col(f"`{vector}`")
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    kept = df.where(_is_whole(v)).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), scaled.alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    dim = width * parts
    first = [r["v"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()]
    start = np.zeros((len(first), dim), dtype=np.int64)
    for i, row in enumerate(first):
        if row and max(map(abs, row)) > LIMIT:
            raise ArithmeticError(f"a vector component is beyond {LIMIT} after scaling")
        start[i, : len(row)] = row
    books = Codebooks(start.reshape(len(first), parts, width).swapaxes(0, 1).copy(), np.ones((parts, len(first)), dtype=bool))

    schema = T.StructType([kept.schema["id"], kept.schema["label"], T.StructField("x", T.BinaryType()), T.StructField("codes", T.BinaryType()),
                           T.StructField("best", T.BinaryType()), T.StructField("error", T.LongType())])

    def emitted(b: pa.RecordBatch, x: np.ndarray, code: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
        pack = lambda m, dtype: pa.array([r.tobytes() for r in m.astype(dtype)], pa.binary())
        arrays = [b.column(0), b.column(1), pack(x, "<i4"), pack(code, "u1"), pack(best, "<i8"), pa.array(best.sum(axis=1), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _integers(b, 2, dim)
                found = [nearest(x[:, p * width : (p + 1) * width], books.values[p]) for p in range(parts)]
                yield emitted(b, x, *(np.stack(m, axis=1) for m in zip(*found)))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts, entries, width), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                x, code = _matrix(b.column(0), "<i4", dim), _matrix(b.column(1), "u1", parts)
                for p in range(parts):
                    n[p] += np.bincount(code[:, p], minlength=entries)
                    np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
        p, e = np.nonzero(n)
        cells = ((p * len(first) + e)[:, None] * width + np.arange(width)).reshape(-1)
        columns = [cells, np.repeat(n[p, e], width), total[p, e].reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cell", "n", "total"])

    state = fix(kept.mapInArrow(assign, schema))
    for _ in range(rounds):
        cells = state.select("x", "codes").mapInArrow(sums, "cell bigint, n bigint, total bigint").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        books = books.replaced({r["cell"]: (r["n"], r["total"]) for r in cells.collect()})  # entries x components rows
        state = fix(state.mapInArrow(_reassign(books, parts, width, emitted), schema))
    return EncodedVectors(state.select(F.col("id").alias(id_col), F.col("label").alias(label), "codes", "error"), books)


def _reassign(books: Codebooks, parts: int, width: int, emitted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(2), "<i4", parts * width).astype(np.int64)
                code, best = _matrix(b.column(3), "u1", parts).astype(np.int64), _matrix(b.column(4), "<i8", parts)
                found = [reassigned(x[:, p * width : (p + 1) * width], code[:, p], best[:, p], books.values[p], books.moved[p]) for p in range(parts)]
                yield emitted(b, x, *(np.stack(m, axis=1) for m in zip(*found)))

    return run


def vector_code_rows(df: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    done = encode_vectors(df, **options)
    id_col, label = done.rows.columns[:2]
    rows = done.rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.lower(F.hex("codes")).alias("code"), "error")
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    sha = hashlib.sha256(done.codebooks.text().encode()).hexdigest()
    return on_equal(rows, by_label, ["label"]).select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def _sql_round(k: int) -> str:
    """One assignment with codebook ``c{k}`` and the codebook after it."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT v.vec_id, v.p, c.e, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{k} c ON c.p = v.p AND c.j = v.j GROUP BY 1, 2, 3) GROUP BY 1, 2
), c{k + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.j, coalesce(m.x, c.x) AS x
  FROM c{k} c LEFT JOIN (
    SELECT v.p, a.e, v.j, CASE WHEN sum(v.x) >= 0 THEN sum(v.x) // count(*) ELSE -((-sum(v.x) + count(*) - 1) // count(*)) END AS x
    FROM v JOIN a{k} a USING (vec_id, p) GROUP BY 1, 2, 3
  ) m USING (p, e, j)
)"""


ORACLE_SQL = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, embedding AS x, len(embedding) // 16 AS w, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT vec_id, i, j // w AS p, j % w AS j, floor(256 * x[j + 1]::DOUBLE)::HUGEINT AS x FROM (SELECT vec_id, i, w, x, unnest(range(len(x))) AS j FROM k)
), c0 AS MATERIALIZED (SELECT p, i AS e, j, x FROM v WHERE i < 64),{_sql_round(0)},{_sql_round(1)},{_sql_round(2)},
s AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM c2),
r AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY 1)
SELECT r.vec_id, r.code, r.error, (sum(r.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, s.codebooks_sha256 FROM r JOIN k USING (vec_id), s
"""


@register("op11_vector_codes", ORACLE_SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_code_rows(table(spark, sf_dir, "embeddings"))
