"""Operator 9: near-duplicate detection with SetSketch registers.

A document's set is its distinct k-word shingles. Every distinct text (a class) gets a
SetSketch: register i is floor(1 - log_b of the least of the set's exponential variables
h_i), truncated to 16 bits, so sketches merge by the register-wise maximum and equal
registers are likelier the more similar two sets are. Bands of registers are hashed to keys;
classes that share a key are candidates. Candidates are estimated by the joint likelihood of
their registers (how many are greater, less and equal), and those that might reach the
threshold are verified on their full sets. Verified links make components.

No bucket is expanded into all its pairs. First each class of a bucket is compared with one
representative, the class that meets most others: a group of copies becomes a star around
what they were copied from. Then only buckets that still hold several components are looked
at again, and only classes outside the representative's component that can link at all: a
shingle that no other class of these buckets has is common to no pair, so ``c`` of ``n``
shingles bound the similarity with a set of size m by c / (n + m - c). Copies with too many
changes of their own fall out here. The rest meet the classes of other components, and a pair
leaves the join only if the sets' bitmaps allow the threshold: a bit that one set has and the
other has not stands for a shingle at least that they don't share. Neither bound loses a link.

With 30 bands of 5 registers a pair at similarity 0.8 shares no band with probability 7e-6,
and one at 0.9 with probability 1e-11.

Defined results: null and empty texts and texts without words have the empty set, are linked
with nothing and are kept; a text with fewer words than a shingle is one shingle; equal texts
are linked; component_id is the smallest doc_id of the component; a null doc_id comes last, and of a
component without any id the rows with the least digest are kept;
repeated rows get equal results; an empty table gives no rows; extra columns are ignored by
``near_groups`` and kept by ``near_dedup``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.chunks import groups_by_size, release_caches
from eqlake.llm.common import fix, numbered, register, table, text_of

BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65_534
#: Estimates this far below the threshold are not verified: over 5 standard deviations at 150 registers.
MARGIN = 0.17
BITS = 2_048
#: Odd multiplier that mixes hashes (2^64 by the golden ratio).
_MIX = np.uint64(0x9E3779B97F4A7C15)


class SetSketch:
    """Registers of sets of 64-bit hashes; ``merge`` gives the sketch of the union."""

    def __init__(self, registers: int = REGISTERS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.times = rng.integers(0, 1 << 63, registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 1 << 63, registers, dtype=np.uint64) * np.uint64(2)

    def minima(self, hashes: np.ndarray, rows: int = 512) -> np.ndarray:
        """Least value of each register's hash function over the set, a few rows at a time."""
        least = np.full(len(self.times), np.iinfo(np.uint64).max, dtype=np.uint64)
        for k in range(0, len(hashes), rows):
            h = hashes[k : k + rows, None] * self.times
            h += self.plus
            np.minimum(least, h.min(axis=0), out=least)
        return least

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(len(self.times), dtype=np.uint16)
        # The least uniform number is the least exponential one, as the quantile function rises.
        u = (self.minima(hashes).astype(np.float64) + 1.0) * 2.0**-64
        h = np.maximum(-np.log1p(-np.minimum(u, 1 - 2.0**-53)), 1e-300) / RATE
        return np.clip(np.floor(1.0 - np.log(h) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(a, b)


def estimate(greater: np.ndarray, less: np.ndarray, registers: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity that makes the register comparison likeliest, given the set sizes.

    With shares u = n_a / (n_a + n_b) and v, P(greater) = p(u - v J), P(less) = p(v - u J) for
    p(x) = -log_b(1 - x (b - 1) / b); the logarithm of the likelihood is concave in J, and a
    golden-section search finds its maximum for all pairs at once."""
    u = n_a / (n_a + n_b)
    v = 1.0 - u
    hi = np.minimum(u / v, v / u)
    lo = np.zeros_like(hi)
    equal = registers - greater - less

    def likelihood(j: np.ndarray) -> np.ndarray:
        p = [np.maximum(-np.log1p(-np.maximum(x, 0.0) * (BASE - 1) / BASE) / math.log(BASE), 1e-12) for x in (u - v * j, v - u * j)]
        return greater * np.log(p[0]) + less * np.log(p[1]) + equal * np.log(np.maximum(1.0 - p[0] - p[1], 1e-12))

    g = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        left = likelihood(a) > likelihood(b)
        hi, lo = np.where(left, b, hi), np.where(left, lo, a)
    return (lo + hi) / 2


def words_in(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased (bytes know no other letters and no other white space)."""
    return text.lower().split()


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Distinct hashes of the k-word shingles, ascending; of the whole sequence if it is shorter."""
    n = len(words)
    if n < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), n)] if n else [], np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    mixed = each[: n - k + 1].copy()
    for i in range(1, k):
        mixed *= _MIX
        mixed += each[i : n - k + 1 + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def sketch_documents(rows: DataFrame, k: int = 4) -> DataFrame:
    """row, doc_id, digest of the words, n_shingles, sketch (little-endian 16-bit registers) of every
    (row, doc_id, t). Words, shingles and registers are made in one place: only texts cross to Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        sketcher = SetSketch()
        for b in batches:
            made: dict[bytes, tuple[int, bytes]] = {}  # copies within the batch
            digests = []
            for t in b.column(2).cast(pa.binary()):
                words = words_in(t.as_py())
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                if digests[-1] not in made:
                    found = shingle_set(words, k)
                    made[digests[-1]] = len(found), sketcher.registers(found).astype("<u2").tobytes()
            sizes, sketches = pa.array([made[d][0] for d in digests], pa.int64()), pa.array([made[d][1] for d in digests], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()), sizes, sketches], names=["row", "doc_id", "digest", "n_shingles", "sketch"])

    return rows.select("row", "doc_id", "t").mapInArrow(run, "row bigint, doc_id bigint, digest binary, n_shingles bigint, sketch binary")


def band_keys(sketch: str = "sketch") -> Column:
    """Array of the hashed band values; the band's number goes into the hash."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col(sketch), i * (2 * ROWS) + 1, F.lit(2 * ROWS))))


def _might_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and registers allow the threshold."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), "<u2").reshape(b.num_rows, -1) for i in (4, 5))
            n_a, n_b = (b.column(i).to_numpy().astype(np.float64) for i in (2, 3))
            j = estimate((x > y).sum(axis=1), (x < y).sum(axis=1), x.shape[1], n_a, n_b)
            keep = pa.array(j >= percent / 100 - MARGIN)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("n")).where(F.col("i") * 100 >= percent * (F.col("n") - F.col("i"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that links reach, for every node with a link.

    Each round takes the least label among a node's neighbours, then the label of that label.
    Labels are minima of grouped rows, so a hub is aggregated before it is shuffled."""
    edges = fix(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = fix(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp")))
    while True:
        near = edges.join(labels, edges["a"] == labels["node"]).groupBy("b").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels["node"] == near["b"]).select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        step = fix(step.join(jump, "comp").select("node", F.least("comp", "root").alias("comp"), "was"))
        labels = step.select("node", "comp")
        if not step.where("comp <> was").take(1):
            return labels


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_groups(docs: DataFrame, *, text: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, n_shingles, component_id, kept."""
    return _groups(numbered(docs.select("doc_id", F.col(f"`{text}`").alias("t"))), "t", k, percent).drop("row")


def _groups(rows: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """``near_groups`` of numbered rows, with their numbers."""
    rows = rows.select("row", F.col("doc.doc_id").cast("bigint").alias("doc_id"), text_of(f"doc.`{text}`").alias("t"))
    sketched = fix(sketch_documents(rows, k))
    classes = sketched.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    classes = fix(classes.withColumn("node", F.monotonically_increasing_id()))

    banded = classes.select("node", F.explode(band_keys()).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = banded.join(shared, "key")
    members = fix(met.join(met.groupBy("node").agg(F.sum("n").alias("meets")), "node").select("key", "node", "meets"))
    heads = members.groupBy("key").agg(F.max(F.struct("meets", "node"))["node"].alias("rep"))
    stars = fix(members.join(heads, "key").where("node <> rep").select(*_ordered("node", "rep")).distinct())
    sets = fix(_sets(rows, members, classes, k))
    first = fix(verified(_might_link(stars, classes, percent), sets, percent))
    found = components(first)

    rest = fix(_open(members, found, sets, percent))
    more = _across(rest, percent).join(stars, ["a", "b"], "left_anti")
    later = fix(verified(_might_link(more, classes, percent), sets, percent))
    if later.take(1):
        found = components(first.unionByName(later))

    ids = classes.select("node", "doc_id", "digest").join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # The smallest doc_id of a component, nulls last; its digest tells rows with that id apart.
    heads = ids.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("head"))
    named = ids.join(heads, "comp").select(F.col("digest").alias("__digest"), F.col("head.doc_id").alias("component_id"), F.col("head.digest").alias("head"))
    out = sketched.join(named, sketched["digest"] == named["__digest"], "left")
    alone = F.col("n_shingles") == 0
    # Of a component without any id, the head's rows are kept.
    named_or_head = F.col("component_id").isNotNull() | (F.col("digest") == F.col("head"))
    return out.select(
        "row", "doc_id", "digest", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(alone | (F.col("doc_id").eqNullSafe(F.col("component_id")) & named_or_head), F.lit(False)).alias("kept"),
        (alone | (F.col("digest") == F.col("head"))).alias("is_head"),
    )


def _sets(rows: DataFrame, members: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the classes that share a band, from the whole text of one of their rows."""
    wanted = members.select("node").distinct().join(classes.select("node", "row"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for some in groups_by_size(texts):
                sets = [shingle_set(words_in(texts[i]), k).view(np.int64) for i in some]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(some[0], len(some)), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return rows.join(wanted, "row").select("node", "t").mapInArrow(run, "node bigint, shingles array<bigint>")


def _open(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows of the buckets that hold several components: key, node, comp, main (the component of the
    class that meets most), n, most (the largest size of a set that the class can link with), bits."""
    labelled = members.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("meets", "node", "comp"))["comp"].alias("main"))
    rest = fix(labelled.join(several.where("lo < hi").select("key", "main"), "key").select("key", "node", "comp", "main"))
    inside = sets.join(rest.select("node").distinct(), "node", "left_semi")
    # Shingles of one class only: counted per shingle first, so that common ones cost little.
    alone = inside.select("node", F.explode("shingles").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node"))
    alone = alone.where("df = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    sizes = inside.mapInArrow(_bitmaps, "node bigint, n bigint, bits array<bigint>").join(alone, "node", "left")
    # J <= c / (n + m - c) reaches p/100 only while p (n + m) <= (100 + p) c.
    most = F.floor((F.lit(100 + percent) * (F.col("n") - F.coalesce("own", F.lit(0)))) / F.lit(percent)) - F.col("n")
    return rest.join(sizes.select("node", "n", most.alias("most"), "bits"), "node")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, size and bitmap of each set."""
    for b in batches:
        sets = b.column(1)
        at, values = sets.offsets.to_numpy(), sets.values.to_numpy(zero_copy_only=False).view(np.uint64)
        marks = np.zeros((b.num_rows, BITS), dtype=bool)
        owner = np.repeat(np.arange(b.num_rows), np.diff(at))
        marks[owner, (values[at[0] : at[-1]] % np.uint64(BITS)).astype(np.int64)] = True
        words = np.packbits(marks, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(at), pa.int64()), pa.array(list(words), pa.list_(pa.int64()))], names=["node", "n", "bits"])


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different components within buckets, one of them outside the main component."""
    least = rest.groupBy("key").agg(F.min("n").alias("least"))
    minor = rest.join(least, "key").where("comp <> main and most >= least")
    side = lambda df, x: df.select("key", *[F.col(c).alias(c + x) for c in ("node", "comp", "n", "most", "bits")])
    both = side(minor, "x").join(side(rest, "y"), "key")
    only = lambda x, y: sum((F.bit_count(F.get(f"bits{x}", i).bitwiseAND(F.bitwise_not(F.get(f"bits{y}", i)))) for i in range(BITS // 64)), F.lit(0))
    needed = F.lit(percent) * (F.col("nx") + F.col("ny"))  # of 100 + percent times the intersection
    fits = (F.col("compx") != F.col("compy")) & (F.col("ny") <= F.col("mostx")) & (F.col("nx") <= F.col("mosty"))
    fits &= F.least("nx", "ny") * (100 + percent) >= needed
    fits &= ((F.col("nx") - only("x", "y")) * (100 + percent) >= needed) & ((F.col("ny") - only("y", "x")) * (100 + percent) >= needed)
    return both.where(fits).select(*_ordered("nodex", "nodey")).distinct()


def near_dedup(docs: DataFrame, *, text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group; all columns stay. Of rows that repeat
    the group's id and text one stays; documents without words all stay. Rows are met by their
    numbers, so null and repeated ids cost no more than others."""
    rows = numbered(docs)
    groups = _groups(rows, text, k, percent).where(F.col("kept") & F.col("is_head"))
    heads = groups.where("n_shingles > 0").groupBy("digest").agg(F.min("row").alias("row")).select("row")
    stays = heads.unionByName(groups.where("n_shingles = 0").select("row"))
    return rows.join(stays, "row", "left_semi").select("doc.*")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: hash(ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]))
                      WHEN len(ws) > 0 THEN [hash(len(ws) || ':' || array_to_string(ws, ' '))] ELSE [] END) AS sh
  FROM w
), e AS (SELECT doc_id, unnest(sh) AS h FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT c.a, c.b FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b
  WHERE 100 * c.i >= 80 * (len(x.sh) + len(y.sh) - c.i)
), g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM s UNION SELECT g.b, r.reached FROM r JOIN g ON g.a = r.doc_id AND r.reached < g.b),
m AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept FROM s JOIN m USING (doc_id)
"""


@register("op9_near_dedup", ORACLE_SQL)
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
