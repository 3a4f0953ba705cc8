"""Operator 13: removal of passages that repeat, by a column-wise Burrows-Wheeler construction.

Every byte goes that is covered by a string of ``length`` bytes which also starts elsewhere.

1. Anchors. Each string of ``length`` bytes has one anchor, the gram of 64 bytes in it with the
   least hash (the leftmost of equals). Equal strings have equal anchors at equal places. The
   strings of one anchor are consecutive and make a window of at most 2 * length - 64 bytes.
   Anchors whose gram occurs once in the collection are done.
2. Windows. The digests of the others are counted. All strings of a window that occurs twice are
   repeated. A task sees at once which windows a text holds twice: it sends each of them on once,
   with their number, and the runs that they cover merged, so a text that repeats a short passage
   over and over (an anchor in every period) gives few rows. Where a gram has several different
   windows, one of each is sent to the gram's partition, aligned at its anchor, so equal strings
   stand in equal columns. The collection's transform is built column by column: a round inserts
   one symbol of every window, sorts the windows stably by it and updates the common prefixes:
   ``order`` is the order by the text read backwards from the column, and ``since`` the column
   since which two neighbours agree. A string is repeated if a neighbour agrees with it for
   ``length`` columns.
3. Documents. Each window's repeated strings are one run, as all of them hold the anchor. The
   runs go back to the documents and are removed.

A gram of more than ``HOT`` different windows doesn't stay in one task: its strings are divided
by their offset from the anchor into halves, whose strings have more bytes in common than the
gram, and these bytes become the new key. After eight halvings the key is the string itself, and
equal strings have been collapsed before they were shuffled.

Which grams occur twice, and which windows are to be sent, the tasks learn from bitmaps of at most
2^27 bits (16 MB) whatever the corpus; where these get crowded more are looked at, none less.

Defined results: null and empty texts have no bytes and nothing to remove; strings never cross
documents or rows; repeated rows repeat each other; texts are bytes, whether or not a cut leaves
valid UTF-8; a text of any length is cut into overlapping slices; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.bitmaps import Bitmap, bitmap_of
from eqlake.llm.common import fix, on_equal, register, table, written

GRAM = 64
#: Bytes looked at together; positions in a slice have 24 bits.
SLICE = 2_000_000
#: Windows of one matrix, about; a gram of more different windows is divided.
CHUNK, HOT = 20_000, 30_000
#: Anchors that a task gathers before it sends them on.
GATHERED = 2_000_000

_RNG = np.random.default_rng(13)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 64 bytes from each position on, by doubling."""
    h = _BYTE[raw]
    for step in (1, 2, 4, 8, 16, 32):
        if len(h) <= step:
            return h[:0]
        h = h[:-step] * _MUL[0] ^ h[step:]
        h ^= h >> np.uint64(32)
        h *= _MUL[1]
    return h


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    m, step = values, 1
    while step * 2 <= width:
        m, step = np.minimum(m[:-step], m[step:]), step * 2
    return np.minimum(m[: len(m) - (width - step)], m[width - step :]) if width > step else m


class Anchors:
    """Anchors of the strings of some pieces of text that are joined in ``raw``: gram hash ``h``, place
    ``at``, and the first and last string (``first``, ``last``) that has the anchor; ``piece`` number."""

    def __init__(self, pieces: list[bytes], length: int):
        self.data = b"".join(pieces)
        raw = np.frombuffer(self.data, dtype=np.uint8)
        self.begin = np.cumsum([0] + [len(p) for p in pieces])
        none = np.zeros(0, dtype=np.int64)
        self.h, self.at, self.first, self.last, self.piece = none.astype(np.uint64), none, none, none, none
        if len(raw) < length:
            return
        h = gram_hashes(raw)
        keys = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_minimum(keys, length - GRAM + 1) & _PLACE).astype(np.int64)
        inside = np.ones(len(anchor) + length, dtype=bool)
        for e in self.begin[1:].tolist():
            inside[max(0, e - length + 1) : e] = False
        starts = np.flatnonzero(inside[: len(anchor)])
        if not len(starts):
            return
        anchor = anchor[starts]
        new = np.flatnonzero(np.r_[True, (np.diff(starts) != 1) | (np.diff(anchor) != 0)])
        self.at, self.first = anchor[new], starts[new]
        self.last = starts[np.r_[new[1:], len(starts)] - 1]
        self.h = h[self.at]
        self.piece = np.searchsorted(self.begin, self.first, side="right") - 1


def _anchored(keys: list, texts: list[bytes | None], length: int) -> Iterator[tuple[list, list[int], Anchors]]:
    """(keys, offsets, anchors) of slices; a long text is cut into pieces that share length - 1 bytes."""
    owners: list = []
    offsets: list[int] = []
    pieces: list[bytes] = []
    size = 0
    for key, t in zip(keys, texts):
        t = t or b""
        for at in range(0, max(1, len(t) - length + 1), SLICE):
            piece = t[at : at + SLICE + length - 1]
            if pieces and size + len(piece) > SLICE:
                yield owners, offsets, Anchors(pieces, length)
                owners, offsets, pieces, size = [], [], [], 0
            owners.append(key)
            offsets.append(at)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield owners, offsets, Anchors(pieces, length)


def repeated_grams(texts: DataFrame, length: int) -> DataFrame:
    """Hashes ``h`` of the anchors' grams that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(gathered), return_counts=True)
            gathered.clear()
            # Two is as good as any number.
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["h", "n"])

        for b in batches:
            for _, _, a in _anchored([None] * b.num_rows, b.column(0).to_pylist(), length):
                gathered.append(a.h)
                if sum(map(len, gathered)) > GATHERED:
                    yield out()
        if gathered:
            yield out()

    return texts.select("body").mapInArrow(run, "h bigint, n int").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def _wanted(b: pa.RecordBatch, length: int, grams: Bitmap) -> Iterator[tuple[bytes, int, int, int, bytes]]:
    """(row key, start in the text, gram hash, anchor's place in the window, window) of the anchors in ``grams``."""
    for keys, offsets, a in _anchored(b.column(0).to_pylist(), b.column(1).to_pylist(), length):
        for i in np.flatnonzero(grams.has(a.h)).tolist():
            p, first = int(a.piece[i]), int(a.first[i])
            start = first - int(a.begin[p]) + offsets[p]
            yield keys[p], start, int(a.h[i]), int(a.at[i]) - first, a.data[first : int(a.last[i]) + length]


def _occurrence(row: bytes, start: int) -> int:
    """64-bit hash of a window's place."""
    return xxhash.xxh64_intdigest(row, seed=start & 0xFFFFFFFFFFFFFFFF)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digest(window: bytes) -> bytes:
    return hashlib.blake2b(window, digest_size=16).digest()


_WINDOW = "wid binary, grp binary, low int, high int, place int, bytes binary, n bigint"
_WINDOW_TYPES = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
_MEMBER = "row binary, start bigint, size int, h bigint, place bigint, wid binary, n bigint"
_MEMBER_TYPES = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]


def _rows(columns, types: list[pa.DataType], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[x.split()[0] for x in names.split(", ")])


def _batches(rows: Iterator[tuple], types: list[pa.DataType], names: str, limit: int = 50_000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, limit)):
        yield _rows(zip(*some), types, names)


def _members(wanted: Iterator[tuple[bytes, int, int, int, bytes]]) -> Iterator[tuple]:
    """The different windows of a text's slice, each where it first stands, and the merged runs of those it holds twice."""
    for (row, _), own in groupby(wanted, key=lambda x: (x[0], x[1] // SLICE)):
        first: dict[bytes, tuple[int, int, int]] = {}
        n: dict[bytes, int] = {}
        runs: list[tuple[int, int]] = []
        for _, start, h, _, w in own:
            wid = _digest(w)
            n[wid] = n.get(wid, 0) + 1
            if n[wid] == 1:
                first[wid] = start, len(w), h
            elif runs and runs[-1][0] <= start <= runs[-1][1]:
                runs[-1] = runs[-1][0], max(start + len(w), runs[-1][1])
            else:
                runs.append((start, start + len(w)))
        for wid, (start, size, h) in first.items():
            if n[wid] > 1:
                runs.append((start, start + size))
            yield row, start, size, _signed(h), _signed(_occurrence(row, start)), wid, n[wid]
        for start, end in merged(runs):
            yield row, start, end - start, None, None, None, None


def members_of(texts: DataFrame, grams, length: int) -> DataFrame:
    """row (key), start, size, h (gram), place (hash of row and start), wid (digest) and n (how often the text's
    slice holds it) of every different window of a slice; rows without wid are runs that are known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bitmap(*grams.value)
        for b in batches:
            yield from _batches(_members(_wanted(b, length, known)), _MEMBER_TYPES, _MEMBER)

    return texts.mapInArrow(run, _MEMBER)


def windows_at(texts: DataFrame, grams, places, length: int) -> DataFrame:
    """Windows whose places are in a bitmap: digest, group (the gram), offsets that the group divides, anchor's place, bytes, 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sent = Bitmap(*grams.value), Bitmap(*places.value)
        for b in batches:
            found = (
                (_digest(w), h.to_bytes(8, "little"), 0, length - GRAM, place, w, 1)
                for key, start, h, place, w in _wanted(b, length, known)
                if sent.holds(_occurrence(key, start))
            )
            yield from _batches(found, _WINDOW_TYPES, _WINDOW, 5_000)

    return texts.mapInArrow(run, _WINDOW)


def _collapsed(windows: DataFrame) -> DataFrame:
    same = [F.any_value(c).alias(c) for c in ("grp", "low", "high", "place", "bytes")]
    return windows.groupBy("wid").agg(*same, F.sum("n").alias("n"))


def repeated_columns(windows: list[bytes], places: list[int], length: int) -> np.ndarray:
    """``out[i, o]``: the string that starts o bytes before window i's anchor is in another window as well.

    Column-wise: a round inserts one symbol of every window; a missing symbol (256) never agrees."""
    left, m = length - GRAM, len(windows)
    width = left + length
    rows = np.full((m, width), 256, dtype=np.uint16)
    for i, (w, place) in enumerate(zip(windows, places)):
        rows[i, left - place : left - place + len(w)] = np.frombuffer(w, dtype=np.uint8)
    columns = np.ascontiguousarray(rows.T)
    del rows
    order, since = np.arange(m), np.zeros(m + 1, dtype=np.int32)
    out = np.zeros((left + 1, m), dtype=bool)
    for c in range(width):
        symbols = columns[c][order]
        to = np.argsort(symbols, kind="stable")
        # Between two rows of one symbol: the latest start of agreement among those they pass.
        latest = np.maximum.reduceat(since, to + 1)
        symbols, order = symbols[to], order[to]
        agree = np.full(m + 1, c + 1, dtype=np.int32)
        same = (symbols[1:] == symbols[:-1]) & (symbols[1:] != 256)
        agree[1:m][same] = latest[:-1][same]
        since = agree
        if c + 1 >= length:
            long = agree <= c + 1 - length
            out[left - (c + 1 - length), order] = long[:-1] | long[1:]
    return out.T


_FOUND = "wid binary, lo int, hi int, grp binary, low int, high int, place int, bytes binary, n bigint"
_FOUND_TYPES = [pa.binary(), pa.int32(), pa.int32(), *_WINDOW_TYPES[1:]]


def _alone(group: list[tuple]) -> list[tuple]:
    """The run of a group's only window, if several windows collapsed into it."""
    return [(r[0], 0, len(r[5])) + (None,) * 6 for r in group if len(group) == 1 and r[6] > 1]


def _search(length: int):
    """Runs (lo, hi) of the windows of a partition in which windows of a group are neighbours; the
    windows of a hot group come back as they are, without a run."""

    def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        several = repeated_columns([r[5] for r in rows], [r[4] for r in rows], length)
        out = []
        for (wid, _, _, _, place, w, n), marks in zip(rows, several):
            if n > 1:
                out.append((wid, 0, len(w)) + (None,) * 6)
            elif marks.any():
                offsets = np.flatnonzero(marks)
                out.append((wid, place - int(offsets[-1]), place - int(offsets[0]) + length) + (None,) * 6)
        if out:
            yield _rows(zip(*out), _FOUND_TYPES, _FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # whole groups
        group: list[tuple] = []
        key, is_hot, last = None, False, None
        for b in batches:
            ready: list[tuple] = []
            for r in zip(*(b.column(i).to_pylist() for i in range(7))):
                if r[0] == last:
                    continue  # sent by two tasks
                last = r[0]
                if r[1] != key:
                    ready += _alone(group)
                    waiting += group if len(group) > 1 else []
                    if len(waiting) >= CHUNK:
                        yield from solved(waiting)
                        waiting = []
                    group, key, is_hot = [], r[1], False
                group.append(r)
                if is_hot or len(group) > HOT:
                    ready += [(x[0], None, None, *x[1:]) for x in group]
                    group, is_hot = [], True
            if ready:
                yield _rows(zip(*ready), _FOUND_TYPES, _FOUND)
        waiting += group if len(group) > 1 else []
        if _alone(group):
            yield _rows(zip(*_alone(group)), _FOUND_TYPES, _FOUND)
        if waiting:
            yield from solved(waiting)

    return run


def _halves(length: int):
    """The windows of hot groups divided at the middle offset: what both halves' strings have in common is the new key."""
    names = "parent binary, shift int, " + _WINDOW
    types = [pa.binary(), pa.int32(), *_WINDOW_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for parent, grp, low, high, place, w, n in zip(*(b.column(i).to_pylist() for i in range(7))):
                middle = (low + high) // 2
                # The window holds the strings that start `place` to `place - (len(w) - length)` bytes before the anchor.
                for lo, hi in ((low, middle), (middle + 1, high)):
                    far, near = min(hi, place), max(lo, place - (len(w) - length))
                    if far < near:
                        continue
                    core = w[place - lo : place - hi + length]
                    sub = w[place - far : place - near + length]
                    key = hashlib.blake2b(grp + core, digest_size=16, salt=lo.to_bytes(2, "little")).digest()
                    wid = hashlib.blake2b(key + far.to_bytes(2, "little") + sub, digest_size=16).digest()
                    out.append((parent, place - far, wid, key, lo, hi, far, sub, n))
            if out:
                yield _rows(zip(*out), types, names)

    return run, names


def repeated_runs(windows: DataFrame, length: int) -> DataFrame:
    """wid, lo, hi: the run of a window's bytes that repeated strings cover, if there is one."""
    dealt = windows.select(*[x.split()[0] for x in _WINDOW.split(", ")]).repartition("grp").sortWithinPartitions("grp", "wid")
    found = fix(dealt.mapInArrow(_search(length), _FOUND))
    runs = found.where(F.col("grp").isNull()).select("wid", "lo", "hi")
    hot = found.where(F.col("grp").isNotNull()).drop("lo", "hi")
    if not hot.take(1):
        return runs
    halves, names = _halves(length)
    parts = fix(hot.mapInArrow(halves, names))
    inner = repeated_runs(_collapsed(parts.drop("parent", "shift")), length)
    back = on_equal(parts.select("parent", "shift", "wid"), inner, ["wid"], how="inner")
    back = back.groupBy("parent").agg(F.min(F.col("lo") + F.col("shift")).alias("lo"), F.max(F.col("hi") + F.col("shift")).alias("hi"))
    return runs.unionByName(back.select(F.col("parent").alias("wid"), "lo", "hi"))


def _row_key(id_col: str, body: Column) -> Column:
    """16 bytes that tell rows apart by id and text; rows equal in both have equal results."""
    own = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")
    known = F.when(F.col(f"`{id_col}`").isNull(), F.lit("n")).otherwise(F.lit("i")).cast("binary")
    return F.unhex(F.substring(F.sha2(F.concat(known, own, F.lit(":").cast("binary"), body), 256), 1, 32))


def spans_of(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """row (key by id and text) and spans (start, end, unordered, they may overlap) of the bytes to remove."""
    if length <= 2 * GRAM or length > 30_000:
        raise ValueError(f"the length must be over {2 * GRAM} and at most 30000")
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    texts = docs.select(_row_key(id_col, body).alias("row"), body.alias("body"))
    send = docs.sparkSession.sparkContext.broadcast
    grams = send(bitmap_of(fix(repeated_grams(texts, length))))
    members = written(members_of(texts, grams, length))
    same = [F.any_value("h").alias("h"), F.any_value("size").alias("size"), F.min("place").alias("place")]
    windows = written(members.where("wid is not null").groupBy("wid").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("single"), *same))
    mixed = windows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    places = send(bitmap_of(fix(on_equal(windows, mixed, ["h"], how="left_semi").select(F.col("place").alias("h")))))
    whole = windows.where("n > 1").select("wid", F.lit(0).alias("lo"), F.col("size").alias("hi"))
    runs = whole.unionByName(repeated_runs(windows_at(texts, grams, places, length), length))
    runs = fix(runs.groupBy("wid").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    once = members.where("n = 1").select("row", "start", "wid")
    met = on_equal(once, runs, ["wid"], how="inner", counts=windows.select("wid", F.col("single").alias("n")))
    met = met.unionByName(members.where("wid is null").select("row", "start", "wid", F.lit(0).alias("lo"), F.col("size").alias("hi")))
    span = F.struct((F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi")).alias("end"))
    return met.groupBy("row").agg(F.collect_set(span).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """doc_id, n_bytes, spans (merged, in order), kept (the remaining bytes) of every row."""
    spans = spans_of(docs, id_col=id_col, text=text, length=length)
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _row_key(id_col, body).alias("row"), body.alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs, kept = [], []
            for t, some in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = merged([(s["start"], s["end"]) for s in some or ()])
                edges = [0, *[x for r in own for x in r], len(t)]
                runs.append([{"start": s, "end": e} for s, e in own])
                kept.append(b"".join([t[x:y] for x, y in zip(edges[::2], edges[1::2])]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            sizes = pa.array([len(t) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(runs, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    joined = rows.join(spans, "row", "left").select("doc_id", "body", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


ORACLE_SQL = """
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS MATERIALIZED (SELECT d, i, md5_number(substr(x, 2 * i + 1, 400)) AS m FROM (SELECT d, x, unnest(range(len(x) // 2 - 199)) AS i FROM t WHERE len(x) >= 400)),
r AS (SELECT d, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
g AS (SELECT d, i, sum(fresh) OVER (PARTITION BY d ORDER BY i) AS run FROM (SELECT d, i, (i - coalesce(lag(i) OVER (PARTITION BY d ORDER BY i), -1000) > 200)::INT AS fresh FROM r)),
s AS (SELECT d, min(i) AS lo, max(i) + 200 AS hi FROM g GROUP BY d, run),
p AS (SELECT d, lo, hi, coalesce(lag(hi) OVER (PARTITION BY d ORDER BY lo), 0) AS since FROM s),
k AS (SELECT p.d, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS hi, string_agg(substr(t.x, (2 * since + 1)::BIGINT, (2 * (lo - since))::BIGINT), '' ORDER BY lo) AS head
      FROM p JOIN t USING (d) GROUP BY p.d)
SELECT t.doc_id, (len(t.x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(t.x, (2 * coalesce(hi, 0) + 1)::BIGINT))) AS kept_sha256
FROM t LEFT JOIN k USING (d)
"""


@register("op13_repeats", ORACLE_SQL)
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
