"""Operator 12: collocations, found by Misra-Gries summaries and counted exactly.

A phrase is a run of words inside one piece of a text; everything counts per language. Phrases
that occur at least ``min_count`` times are found without counting all phrases:

1. Words are counted exactly (few of them are distinct).
2. Phrases are hashed, and the top bits of the hash name one of many hash partitions. A task
   sends each partition its sorted hashes with counts, and the partition merges them into one
   Misra-Gries summary: beyond its capacity all counters lose the largest count that leaves no
   more than the capacity. The capacity exceeds the partition's mass divided by ``min_count``,
   so no counter loses ``min_count`` and every frequent phrase survives (hashes that collide
   only add survivors). Pairs come first, then phrases of 3 to 5 words whose pairs all survived:
   a phrase is never more frequent than a part of it.
3. A second pass counts the survivors' occurrences exactly, by their words.

Survivors reach the tasks as a bitmap over hash prefixes of at most 2^27 bits (16 MB) whatever
the corpus; where it gets crowded more phrases are counted in step 3 than needed, none less.
A task's memory holds one slice of texts and one partition's summary; the number of hash
partitions grows with the number of words.

Defined results: null and empty texts have no words; a null language is ``und``; one longer text
than a slice is a slice of its own; equal texts all count; an empty table gives no rows; ties in
the report end at the phrase's bytes, so ranks are unique; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eqlake.llm.bitmaps import Bitmap, bitmap_of
from eqlake.llm.common import fix, on_equal, register, shuffle_partitions, table

LONGEST = 5
#: Bytes of text looked at together.
SLICE = 4_000_000
#: Hashes that a task gathers before it sends them on; phrases or words that it counts before that.
GATHERED, COUNTED = 2_000_000, 200_000
#: Phrases of one hash partition, about.
MASS = 16_000_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


class MisraGries:
    """Counters of the frequent keys of a stream: a key's true count is at least its counter and
    at most ``error`` more, and ``error`` is less than mass / capacity. Summaries merge by ``add``."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > max(self.capacity, 1 << 20):
            self.fold()

    def fold(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.n_waiting = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            lost = np.partition(counts, at)[at]
            counts = counts - lost
            keys, counts = keys[counts > 0], counts[counts > 0]
            self.error += int(lost)
        self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        """Every key whose true count might be ``least`` or more."""
        self.fold()
        if self.error >= least:
            raise ValueError("the capacity is too small for this threshold")
        return self.keys[self.counts + self.error >= least]


class Slice:
    """The words of some texts: ``codes`` into the distinct (language, word) pairs, and ``piece`` numbers."""

    def __init__(self, langs: list[str | None], texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        raw = np.frombuffer(b"\n".join(texts).translate(_LOWER), dtype=np.uint8)
        kind = _KIND[raw]
        inside = kind == 0
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside].tobytes())]).dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int64)
        # Texts are joined by one byte each, so a text starts where the ones before it end.
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        per_text = np.diff(np.searchsorted(starts, begin))
        self.langs = sorted({x if x is not None else "und" for x in langs})
        number = {x: i for i, x in enumerate(self.langs)}
        lang = np.repeat([number[x if x is not None else "und"] for x in langs], per_text).astype(np.int64) if texts else codes
        size = max(1, len(words.dictionary))
        pairs, self.codes = np.unique(lang * size + codes, return_inverse=True)
        known = words.dictionary.to_pylist()
        self.words = [known[i] for i in (pairs % size).tolist()]
        self.lang_of = pairs // size
        prefix = [x.encode() + b"\0" for x in self.langs]
        hashes = [xxhash.xxh64_intdigest(prefix[g] + w) for g, w in zip(self.lang_of.tolist(), self.words)]
        self.hash_of = np.array(hashes, dtype=np.uint64)

    def phrases(self, lengths: range | tuple, words: Bitmap | None, pairs: Bitmap | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words' positions, hashes) of the phrases whose words and pairs are in the bitmaps."""
        if not len(self.codes):
            return
        one = self.hash_of[self.codes]
        fits = words.has(self.hash_of)[self.codes] if words is not None else np.ones(len(one), dtype=bool)
        at, h = np.flatnonzero(fits), one[fits]
        linked = None
        for k in range(2, max(lengths) + 1):
            ok = at + k - 1 < len(one)
            at, h = at[ok], h[ok]
            last = at + k - 1
            ok = (self.piece[at] == self.piece[last]) & fits[last]
            if linked is not None:
                ok &= linked[last - 1]
            at, h, last = at[ok], h[ok], last[ok]
            h = h * _MIX[0] ^ one[last]
            h ^= h >> np.uint64(32)
            h = h * _MIX[1]
            h ^= h >> np.uint64(29)
            if k == 2 and pairs is not None:
                ok = pairs.has(h)
                at, h = at[ok], h[ok]
                linked = np.zeros(len(one), dtype=bool)
                linked[at] = True
            if k in lengths:
                yield k, at, h

    def counted(self, at: np.ndarray, h: np.ndarray, k: int) -> Iterator[tuple[int, str, bytes, int]]:
        """(hash, language, phrase, count) of the phrases of ``k`` words at ``at``, told apart by their words."""
        ids = self.codes[at]
        for j in range(1, k):
            _, ids = np.unique(ids * len(self.words) + self.codes[at + j], return_inverse=True)
        _, first, n = np.unique(ids, return_index=True, return_counts=True)
        for p, x, c in zip(at[first].tolist(), h[first].tolist(), n.tolist()):
            own = self.codes[p : p + k].tolist()
            yield x, self.langs[self.lang_of[own[0]]], b" ".join([self.words[i] for i in own]), c


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for b in batches:
        texts, langs = b.column(1).to_pylist(), b.column(0).to_pylist()
        at = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t or b"") > SLICE:
                yield Slice(langs[at:i], texts[at:i])
                at, size = i, 0
            size += len(t or b"")
        if at < len(texts):
            yield Slice(langs[at:], texts[at:])


def _sums(counts: Iterator[dict[tuple, int]], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows (key, count) of the counters, added up as far as they fit."""
    total: dict[tuple, int] = {}

    def out() -> pa.RecordBatch:
        columns = [*zip(*total), total.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    for some in counts:
        for key, n in some.items():
            total[key] = total.get(key, 0) + n
        if len(total) > COUNTED:
            yield out()
            total = {}
    if total:
        yield out()


def count_words(texts: DataFrame) -> DataFrame:
    """lang, phrase, h (hash), f of every word of ``texts`` (lang, text as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> Iterator[dict]:
            for s in _slices(batches):
                n = np.bincount(s.codes, minlength=len(s.words)).tolist()
                hashes = s.hash_of.view(np.int64).tolist()
                yield {(s.langs[g], w, h): c for g, w, h, c in zip(s.lang_of.tolist(), s.words, hashes, n)}

        yield from _sums(counts(), ["lang", "phrase", "h", "f"], [pa.string(), pa.binary(), pa.int64(), pa.int64()])

    rows = texts.mapInArrow(run, "lang string, phrase binary, h bigint, f bigint")
    return rows.groupBy("lang", "phrase", "h").agg(F.sum("f").alias("f"))


def hash_partitions(spark: SparkSession, mass: int) -> int:
    """log2 of the number of hash partitions for so many phrases."""
    split = max(shuffle_partitions(spark), mass // MASS, 2)
    return min((split - 1).bit_length(), 20)


def frequent_hashes(texts: DataFrame, lengths: tuple[int, ...], least: int, n_words: int, words, pairs=None) -> DataFrame:
    """Hash prefixes ``h`` of a superset of the phrases that occur ``least`` times, by Misra-Gries summaries.

    ``words`` and ``pairs`` are broadcast (bits, bytes) of bitmaps that a phrase must pass."""
    top = hash_partitions(texts.sparkSession, n_words * len(lengths))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_map, pair_map = Bitmap(*words.value), Bitmap(*pairs.value) if pairs is not None else None
        gathered: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            # The top bits name the partition, the 32 after them are the key within it.
            keys, n = np.unique(np.concatenate(gathered), return_counts=True)
            cuts = np.searchsorted(keys, np.arange((1 << top) + 1, dtype=np.uint64) << np.uint64(32))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                k, c = keys[cuts[p] : cuts[p + 1]].astype("<u4"), n[cuts[p] : cuts[p + 1]]
                once = c == 1
                packed = k[once].tobytes() + k[~once].tobytes() + c[~once].astype("<u4").tobytes()
                columns = [[p, p], [int(c.sum()), None], [None, int(once.sum())], [None, packed]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["part", "mass", "once", "packed"])

        for s in _slices(batches):
            for _, _, h in s.phrases(lengths, word_map, pair_map):
                gathered.append(h >> np.uint64(32 - top))
            if sum(map(len, gathered)) > GATHERED:
                yield from out()
                gathered.clear()
        if sum(map(len, gathered)):
            yield from out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, summary, part = 0, None, 0
        for b in batches:
            for p, m, once, packed in zip(*(b.column(i).to_pylist() for i in range(4))):
                part = p
                if m is not None:  # all masses come before the first counters
                    mass += m
                    continue
                if summary is None:
                    summary = MisraGries(mass // least + 1)
                values = np.frombuffer(packed, "<u4")
                several = (len(values) - once) // 2
                summary.add(values[: once + several].astype(np.uint64), np.r_[np.ones(once, dtype=np.int64), values[once + several :].astype(np.int64)])
        if summary is not None:
            kept = summary.survivors(least) | np.uint64(part << 32)
            yield pa.RecordBatch.from_arrays([pa.array((kept << np.uint64(32 - top)).view(np.int64))], names=["h"])

    sent = texts.mapInArrow(send, "part int, mass bigint, once bigint, packed binary")
    dealt = sent.repartitionById(1 << top, F.col("part")).sortWithinPartitions(F.col("mass").isNull())
    return dealt.mapInArrow(merge, "h bigint")


def count_phrases(texts: DataFrame, least: int, n_words: int, words, pairs, longer) -> DataFrame:
    """lang, phrase, f of the phrases in the bitmaps of pairs and longer phrases that occur ``least`` times.

    A task counts what it holds and sends each hash partition one row of phrases and counts."""
    top = hash_partitions(texts.sparkSession, n_words)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_map, pair_map, long_map = (Bitmap(*x.value) for x in (words, pairs, longer))
        held: dict[int, dict[tuple[str, bytes], int]] = {}
        size = 0

        def out() -> pa.RecordBatch:
            counts = list(held.values())
            columns = [list(held), [[g for g, _ in c] for c in counts], [[w for _, w in c] for c in counts], [list(c.values()) for c in counts]]
            types = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names=["part", "langs", "phrases", "counts"])

        for s in _slices(batches):
            for k, at, h in s.phrases(range(2, LONGEST + 1), word_map, pair_map):
                if k > 2:
                    known = long_map.has(h)
                    at, h = at[known], h[known]
                for x, g, w, n in s.counted(at, h, k):
                    own = held.setdefault(x >> 64 - top, {})
                    size += (g, w) not in own
                    own[g, w] = own.get((g, w), 0) + n
            if size > COUNTED:
                yield out()
                held, size = {}, 0
        if held:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "f"]
        total = pa.table([pa.array([], t) for t in (pa.string(), pa.binary(), pa.int64())], names=names)
        for b in batches:
            new = pa.table([b.column(i).flatten() for i in (1, 2, 3)], names=names)
            total = pa.concat_tables([total, new]).group_by(names[:2]).aggregate([("f", "sum")]).rename_columns(names)
        yield from total.filter(pc.greater_equal(total["f"], least)).to_batches()

    sent = texts.mapInArrow(send, "part int, langs array<string>, phrases array<binary>, counts array<bigint>")
    return sent.repartitionById(1 << top, F.col("part")).mapInArrow(merge, "lang string, phrase binary, f bigint")


def frequent_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", min_count: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words and phrases (lang, phrase, f each) and the number of words by language (lang, n)."""
    if min_count < 2:
        raise ValueError("a frequent phrase occurs twice or more")
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))
    all_words = fix(count_words(texts))
    totals = fix(all_words.groupBy("lang").agg(F.sum("f").alias("n")))
    words = fix(all_words.where(F.col("f") >= min_count))
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    send = spark.sparkContext.broadcast
    word_map = send(bitmap_of(words.select("h")))
    pair_map = send(bitmap_of(fix(frequent_hashes(texts, (2,), min_count, n_words, word_map))))
    long_map = send(bitmap_of(fix(frequent_hashes(texts, tuple(range(3, LONGEST + 1)), min_count, n_words, word_map, pair_map))))
    phrases = fix(count_phrases(texts, min_count, n_words, word_map, pair_map, long_map))
    as_text = lambda df: df.select("lang", F.col("phrase").cast("string").alias("phrase"), "f")
    return as_text(words), as_text(phrases), totals


def _part(first, n) -> F.Column:
    return F.array_join(F.slice("ws", first, n), " ")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", min_count: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to 5 words.

    The score is the lowest over all cuts of floor(1000 a n / (l r)), in whole numbers of up to 38
    digits. Phrases that a longer one contains as often as they occur are dropped."""
    words, phrases, totals = frequent_phrases(docs, text=text, lang=lang, min_count=min_count)
    counts = words.unionByName(phrases)
    # What a longer phrase with the same count contains is contained by one that is a word longer.
    ws = phrases.select("lang", F.split("phrase", " ").alias("ws"), "f").withColumn("k", F.size("ws"))
    inner = ws.where("k > 2").select("lang", F.explode(F.array(_part(1, F.col("k") - 1), _part(2, F.col("k") - 1))).alias("phrase"), "f")
    free = phrases.join(inner, ["lang", "phrase", "f"], "left_anti")
    free = on_equal(fix(free), totals, ["lang"]).withColumn("ws", F.split("phrase", " ")).withColumn("k", F.size("ws"))
    cuts = free.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "n", "cut", _part(1, F.col("cut")).alias("left"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    named = lambda side, f: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    cuts = fix(on_equal(fix(cuts), named("left", "l"), ["lang", "left"]))
    cuts = on_equal(cuts, named("right", "r"), ["lang", "right"])
    wide = lambda c: f"cast({c} as decimal(18, 0))"
    score = F.expr(f"({wide('a')} * {wide('n')} * cast(1000 as decimal(4, 0))) div ({wide('l')} * {wide('r')})")
    cuts = cuts.withColumn("score", score)
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("x")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), lowest).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    # A language's first rows are among the first rows of its hash parts.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = scored.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("at") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
  FROM documents
), p AS (SELECT lang, list_filter(regexp_split_to_array(unnest(ps), '[\x20\x09]+'), lambda x: x <> '') AS ws FROM t),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k))
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100),
inner_ AS (
  SELECT DISTINCT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, f
  FROM (SELECT lang, ws, f, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
), free AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f)),
cuts AS (SELECT *, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS j FROM free)),
s AS (
  SELECT x.lang, x.phrase, x.f AS a, l.f AS l, r.f AS r, n.n, x.j, (1000::HUGEINT * x.f * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.lp JOIN f r ON r.lang = x.lang AND r.phrase = x.rp JOIN n ON n.lang = x.lang
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM b QUALIFY rank <= 2000
"""


@register("op12_collocations", ORACLE_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
