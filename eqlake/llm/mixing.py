"""Operator 1: mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: sources in code-point order (null last) weigh ``weights``, repeating, and share
``share`` times all words; a target stops at ``cap`` times its source's words and the excess
is shared again by weight.

Draw: within a source, documents stand in a hash permutation and are cut into blocks of about
``block_words`` words. The source's quota is its whole permutation once or twice (copies) and
the first blocks of another pass; only the last document of a quota is taken in part, so that
every source gets its target to the word. Output shards have exact capacities in blocks. The
tree splits them: each node holds the capacities that a range of sources fills, its left half
draws its number of blocks from them without replacement (a multivariate hypergeometric draw,
shard by shard, each by inversion), the right half keeps the rest. A leaf is one source with
its exact quota for every shard. The source's blocks, permuted, go to the shards in turn, and
``shuffle_key`` orders each shard's documents at random.

All of it is DataFrame expressions. Prefix sums within a source go through cells of about 256
rows and groups of 256 cells, so a source that holds a third of all rows is many small groups.
Draws depend on hashes of ids and a seed alone, so reruns agree.

Defined results: null and empty texts have size 0 and are not drawn; a null source is a source
(last in order); repeated rows are rows of their own, ordered by id, size and hash; one source
alone gets share (at most cap) times its words; an empty table gives no rows; extra columns
pass through ``draw_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eqlake.functions.ranking import group_positions
from eqlake.llm.common import WORD, fix, register, table, text_of

WEIGHTS, SHARE, CAP = (5.0, 2.0, 1.0), 1.5, 2.0
SHARDS, BLOCK_WORDS, CELL = 16, 50_000, 256


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")


def _uniform(*parts) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source of ``rows`` (source, size): idx (code-point order, null last), source_size, n_rows, target."""
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    ranked = group_positions(sums.withColumn("is_null", F.col("source").isNull()), [], ["is_null", "source"], pos="idx", size="n_sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = fix(ranked.withColumn("weight", F.get(cycle, (F.col("idx") % len(weights)).cast("int"))))
    total, level = ranked.agg(F.sum("source_size")).first()[0] or 0, 0.0
    capped = -1
    while True:
        # One row of three sums per step; the capped set only grows.
        at_cap = F.col("source_size") * cap <= F.lit(level) * F.col("weight")
        n, full, free = ranked.agg(
            F.count_if(at_cap), F.sum(F.when(at_cap, F.col("source_size") * cap)), F.sum(F.when(~at_cap, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, max(level, (share * total - (full or 0.0)) / free)
    target = F.least(F.col("source_size") * cap, F.lit(level) * F.col("weight"))
    if not ranked.take(1):
        return spark.createDataFrame([], "source string, idx bigint, source_size bigint, n_rows bigint, target double")
    return ranked.select("source", "idx", "source_size", "n_rows", target.alias("target"))


def before(df: DataFrame, group: str, n_rows: str, u: str, ties: list[str], value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of ``group`` that come earlier in the order of ``u``
    (uniform in [0, 1)) and ``ties``. ``n_rows`` is the group's number of rows."""
    cells = F.ceil(F.col(n_rows) / F.lit(float(CELL)))
    df = df.withColumn("cell", F.floor(F.col(u) * cells).cast("bigint"))
    up_to = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(group, "cell").agg(F.sum(value).alias("in_cell")).withColumn("band", F.floor(F.col("cell") / CELL))
    bands = sums.groupBy(group, "band").agg(F.sum("in_cell").alias("in_band"))
    bands = bands.select(group, "band", F.coalesce(F.sum("in_band").over(up_to(Window.partitionBy(group).orderBy("band"))), F.lit(0)).alias("band_at"))
    inside = F.coalesce(F.sum("in_cell").over(up_to(Window.partitionBy(group, "band").orderBy("cell"))), F.lit(0))
    starts = sums.withColumn("inside", inside).join(bands, [group, "band"]).select(group, "cell", (F.col("band_at") + F.col("inside")).alias("cell_at"))
    w = up_to(Window.partitionBy(group, "cell").orderBy(u, *ties))
    at = F.col("cell_at") + F.coalesce(F.sum(value).over(w), F.lit(0))
    return df.join(starts, [group, "cell"]).withColumn(out, at).drop("cell", "cell_at")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Good items among ``draws`` without replacement, by inversion of ``u``.

    Probabilities are taken relative to the lowest number considered, 12 standard deviations
    and 20 below the mean; what lies outside has less mass than a double can hold."""

    def drawn(s: Column) -> Column:
        g, b, n, x = (s[k] for k in ("g", "b", "n", "u"))
        all_ = F.greatest(g + b, F.lit(1.0))
        mean = n * g / all_
        wide = F.lit(12.0) * F.sqrt(mean * (b / all_)) + 20.0
        lo = F.greatest(F.lit(0.0), n - b, F.floor(mean - wide).cast("double"))
        hi = F.least(g, n, F.ceil(mean + wide).cast("double"))

        def walk(s2: Column) -> Column:
            lo2, steps = s2["lo"], F.sequence(F.lit(0), (s2["hi"] - s2["lo"]).cast("int"))

            def ratio(k: Column) -> Column:
                # P(k + 1) / P(k); 0 past the end of the support.
                return (g - k) * (n - k) / ((k + 1.0) * F.greatest(b - n + k + 1.0, F.lit(1.0)))

            mass = F.aggregate(steps, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum")), lambda a, i: F.struct((a["p"] * ratio(lo2 + i)).alias("p"), (a["sum"] + a["p"]).alias("sum")))["sum"]

            def find(total: Column) -> Column:
                start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("k"))
                step = lambda a, i: F.struct((a["p"] * ratio(lo2 + i)).alias("p"), (a["sum"] + a["p"]).alias("sum"), F.when(a["sum"] + a["p"] < x * total, i.cast("double") + 1.0).otherwise(a["k"]).alias("k"))
                return F.least(lo2 + F.aggregate(steps, start, step)["k"], s2["hi"])

            return _let(mass, find)

        return _let(F.struct(lo.alias("lo"), F.greatest(lo, hi).alias("hi")), walk)

    return _let(F.struct(good.cast("double").alias("g"), bad.cast("double").alias("b"), draws.cast("double").alias("n"), u.alias("u")), drawn).cast("bigint")


def _split(capacities: Column, draws: Column, seed: int, *place: Column) -> Column:
    """A multivariate hypergeometric draw of ``draws`` blocks from ``capacities`` (one entry per shard)."""
    total = F.aggregate(capacities, F.lit(0).cast("bigint"), lambda a, x: a + x)
    start = F.struct(total.alias("left"), draws.cast("bigint").alias("draws"), F.expr("cast(array() as array<bigint>)").alias("out"))

    def step(a: Column, c: Column) -> Column:
        k = hypergeometric(c, a["left"] - c, a["draws"], _uniform(F.lit(seed), *place, F.size(a["out"])))
        return _let(k, lambda x: F.struct((a["left"] - c).alias("left"), (a["draws"] - x).alias("draws"), F.concat(a["out"], F.array(x)).alias("out")))

    return F.aggregate(capacities, start, step)["out"]


def shard_quotas(quotas: DataFrame, n_sources: int, n_blocks: int, shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """Per source (idx, q): ``per_shard``, how many of its q blocks each shard gets. Row and column sums are exact.

    Every leaf walks from the root to itself; nodes that two leaves share draw from the same hash, so
    they split alike. A row holds ``shards`` numbers and one entry per level, whatever the input."""
    levels = max(1, math.ceil(math.log2(max(2, n_sources))))
    at = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    node = F.expr(f"cast(idx div cast(pow(2, {levels} - level) as bigint) as bigint)")
    totals = quotas.select("idx", "q", at).groupBy("level", node.alias("node")).agg(F.sum("q").alias("total"))
    halves = totals.where("level > 0 and node % 2 = 0").select((F.col("level") - 1).alias("level"), (F.col("node") / 2).cast("bigint").alias("node"), F.col("total").alias("left_total"))
    goes_right = F.expr(f"cast(idx div cast(pow(2, {levels} - level - 1) as bigint) % 2 as int)")
    path = quotas.select("idx", at).where(F.col("level") < levels).withColumn("node", node).withColumn("right", goes_right)
    path = path.join(halves, ["level", "node"], "left").groupBy("idx").agg(
        F.array_sort(F.collect_list(F.struct("level", "node", F.coalesce("left_total", F.lit(0)).alias("draws"), "right"))).alias("path")
    )
    root = F.array(*[F.lit(n_blocks // shards + (k < n_blocks % shards)).cast("bigint") for k in range(shards)])

    def down(capacities: Column, step: Column) -> Column:
        drawn = _split(capacities, step["draws"], seed, step["level"], step["node"])
        return _let(drawn, lambda d: F.when(step["right"] == 0, d).otherwise(F.zip_with(capacities, d, lambda c, x: c - x)))

    return path.select("idx", F.aggregate("path", root, down).alias("per_shard"))


def draws(docs: DataFrame, *, text: str = "text", row: str | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
          shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(rows, draws): rows has row, doc_id, size, source_size, target for every document; draws has
    row, copy, words, shard, shuffle_key for every time that a document is taken. ``row`` names a
    column of row numbers that ``docs`` has already."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select("doc_id", "source", word_count(text).alias("size"), number.alias("row"))
    rows = fix(rows.withColumn("u", _uniform(F.lit(seed), "doc_id", "size")))
    sources = fix(source_targets(rows, weights, share, cap))
    # Passes over the source's permutation: `full` whole ones and `rest` words of one more.
    quota = F.round("target").cast("bigint")
    known = sources.withColumn("full", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)).withColumn(
        "rest", quota - F.col("full") * F.col("source_size")
    )
    placed = rows.join(known.withColumnRenamed("source", "known"), rows["source"].eqNullSafe(F.col("known"))).drop("known")
    placed = fix(before(placed, "idx", "n_rows", "u", ["doc_id", "size", "row"], "size", "at"))
    words = F.when(F.col("copy") < F.col("full"), F.col("size")).when(F.col("copy") == F.col("full"), F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("at")))).otherwise(0)
    passes = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(math.ceil(cap))))).withColumn("words", words).where("words > 0")
    passes = passes.select("row", "doc_id", "idx", "copy", "words", F.floor(F.col("at") / block_words).alias("block"))
    blocks = fix(passes.groupBy("idx", "copy", "block").agg(F.sum("words").alias("block_size")).withColumn("v", _uniform(F.lit(seed + 1), "idx", "copy", "block")))
    quotas = blocks.groupBy("idx").agg(F.count(F.lit(1)).alias("q"))
    n_sources, n_blocks = sources.count(), blocks.count()
    per_shard = fix(quotas.join(shard_quotas(quotas, n_sources, n_blocks, shards, seed), "idx"))
    dealt = before(blocks.join(per_shard, "idx").withColumn("one", F.lit(1)), "idx", "q", "v", ["copy", "block"], "one", "place")
    bounds = F.aggregate("per_shard", F.struct(F.lit(0).cast("bigint").alias("to"), F.lit(0).alias("shard")), lambda a, c: F.struct((a["to"] + c).alias("to"), (a["shard"] + (a["to"] + c <= F.col("place")).cast("int")).alias("shard")))["shard"]
    dealt = dealt.select("idx", "copy", "block", bounds.alias("shard"))
    taken = passes.join(dealt, ["idx", "copy", "block"]).select("row", "copy", "words", "shard", F.xxhash64(F.lit(seed + 2), "doc_id", "row", "copy").alias("shuffle_key"))
    return placed.select("row", "doc_id", "size", "source_size", "target"), taken


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document, from the draws."""
    rows, taken = draws(docs, **options)
    sums = taken.groupBy("row").agg(F.sum("words").alias("taken"))
    return rows.join(sums, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def draw_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: a document once per time it is taken; one taken in part counts
    from half its words. Shards are written in ``shuffle_key`` order."""
    # Rows are numbered once with their texts, as ids may be null or repeat.
    numbered = fix(docs.withColumn("__row", F.monotonically_increasing_id()))
    rows, taken = draws(numbered, row="__row", **options)
    whole = taken.join(rows.select("row", "size"), "row").where("2 * words >= size")
    whole = whole.select(F.col("row").alias("__row"), F.col("shard").alias("__shard"), F.col("shuffle_key").alias("__key"))
    out = numbered.join(whole, "__row")
    return out.sortWithinPartitions("__shard", "__key").select(*[F.col(f"`{c}`") for c in docs.columns])


@register("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
