"""Operator 7: byte-level BPE encoding and decoding with length-bucketed numpy matrices.

``BytePairEncoder`` encodes the pieces of a split pattern by merge ranks. The distinct
pieces of a batch are bucketed by length and laid out as padded id matrices. In every
round each row finds its minimum-rank adjacent pair through a hashed pair table, merges
the leftmost such pair, and rows that have no pair left drop out (compaction). Pieces of
more than ``LONG`` bytes, where a round per merge would be quadratic, are merged one by
one with a heap in the same order (lowest rank, then leftmost).

Defined results: a null text counts as empty (no ids); white space, unpaired or rare
code points and very long texts are ordinary bytes; special-token strings are ordinary
text; repeated rows give repeated results; extra columns pass through unless they carry
the name of a result column, which then wins; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.chunks import ChunkCache, cut, groups_by_size
from eqlake.llm.common import register, table, text_of

#: Rows of more bytes go by the heap; wider matrices would need a round per merge.
LONG = 256
_NONE = np.int64(1) << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: a base64 token and its rank on every line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """Open-addressing hash table (id pair -> merged id), looked up for whole matrices."""

    def __init__(self, ranks: dict[bytes, int]):
        ids = dict(ranks)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ids.get(token[:i]), ids.get(token[i:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    values.append(rank)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 6))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NONE, dtype=np.int64)
        self.probes = 1
        k, v = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int64)
        slot = self._slot(k)
        step = 0
        while len(k):
            # One round of linear probing: the first pending key of each free slot settles there.
            free = self.keys[slot] == -1
            settled = np.zeros(len(k), dtype=bool)
            at, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[at], self.values[at], settled[won] = k[won], v[won], True
            k, v, slot = k[~settled], v[~settled], (slot[~settled] + 1) & ((1 << self.bits) - 1)
            step += 1
            self.probes = max(self.probes, step)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, or a number above every id where the pair has none."""
        keys = (left << 32) | right
        flat = keys.ravel()
        out = np.full(flat.shape, _NONE, dtype=np.int64)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(flat[todo])
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == flat[todo]
            out[todo[hit]] = self.values[slot[hit]]
            more = ~hit & (found != -1)
            todo, slot = todo[more], (slot[more] + 1) & ((1 << self.bits) - 1)
            if not len(todo):
                break
        return out.reshape(keys.shape)


def _take_rows(m: np.ndarray, rows: np.ndarray, out: list[bytes]) -> None:
    """Put the ids of finished rows, without padding, where they belong."""
    used = m >= 0
    raw, start = m[used].astype("<u4").tobytes(), 0
    for row, stop in zip(rows.tolist(), (4 * np.cumsum(used.sum(axis=1))).tolist()):
        out[row] = raw[start:stop]
        start = stop


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pieces = ChunkCache(self.encode_pieces)

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian uint32) of pieces of at most ``width`` bytes, as one padded matrix (padding is -1)."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), width)
        m = np.where(np.arange(width) < lengths[:, None], self.byte_ids[raw], -1)
        out: list[bytes] = [b""] * len(pieces)
        rows = np.arange(len(pieces))
        ranks = self.pairs.ranks(m[:, :-1], m[:, 1:])
        while len(rows):
            every = np.arange(len(rows))
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            best = ranks[every, at] if ranks.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                _take_rows(m[done], rows[done], out)
                keep = ~done
                m, ranks, rows, at, best = m[keep], ranks[keep], rows[keep], at[keep], best[keep]
                if not len(rows):
                    break
                every = np.arange(len(rows))
            width = m.shape[1]
            # Compaction: the columns right of the merged pair move one to the left.
            columns = np.arange(width - 1)
            m = np.take_along_axis(m, columns + (columns > at[:, None]), axis=1)
            m[every, at] = best
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            # Only the two pairs that hold the merged id change.
            r = np.flatnonzero(at < width - 2)
            ranks[r, at[r]] = self.pairs.ranks(m[r, at[r]], m[r, at[r] + 1])
            r = np.flatnonzero(at > 0)
            ranks[r, at[r] - 1] = self.pairs.ranks(m[r, at[r] - 1], m[r, at[r]])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same order of merges for one long piece: a heap of (rank, position) over linked ids."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        first = self.pairs.ranks(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != _NONE)]
        heapq.heapify(heap)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        prev, following = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        end = len(part)
        while heap:
            rank, i = heapq.heappop(heap)
            j = following[i] if part[i] is not None else end
            if j == end or self.ranks.get(part[i] + part[j]) != rank:
                continue  # one of the two has been merged meanwhile
            part[i], part[j] = part[i] + part[j], None
            following[i] = k = following[j]
            if k != end:
                prev[k] = i
                if (r := self.ranks.get(part[i] + part[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := prev[i]) >= 0 and (r := self.ranks.get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [self.ranks[p] for p in part if p is not None]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece (little-endian uint32); pieces of like length share a matrix."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, tuple[list[int], list[bytes]]] = {}
        for i, text in enumerate(pieces):
            p = text.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(p)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > LONG:
                out[i] = np.array(self._merge_long(p), dtype="<u4").tobytes()
            elif p:
                width = len(p) if len(p) <= 16 else (len(p) + 15) // 16 * 16
                at, held = buckets.setdefault(width, ([], []))
                at.append(i)
                held.append(p)
        for width, (at, held) in buckets.items():
            for k in range(0, len(at), 20_000):
                for i, ids in zip(at[k : k + 20_000], self._merge_rows(held[k : k + 20_000], width)):
                    out[i] = ids
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (little-endian uint32); pieces met lately are not merged again."""
        split = list(map(self.pattern.findall, texts))
        get = self.pieces.learn(split).__getitem__
        return [b"".join(map(get, s)) for s in split]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> BytePairEncoder:
    return BytePairEncoder(read_ranks(path), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an ``array<int>`` column of ids. Map-only; texts are never cut short."""
    return _map_texts(docs, text, [(ids, "array<int>", pa.list_(pa.int32()))], ranks_path, pattern, "ids")


def decode(docs: DataFrame, ranks_path: str, pattern: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that an id column stands for (null ids count as none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _encoder(ranks_path, pattern).tokens
        for b in batches:
            rows = b.column(names.index(ids)).to_pylist()
            made = pa.array([b"".join(tokens[i] for i in r or ()) for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(i) for i, n in enumerate(names) if n != out] + [made], names=kept + [out])

    names = docs.columns
    kept = [n for n in names if n != out]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out] + [f"`{out}` binary"])
    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text") -> DataFrame:
    """``docs`` without the text: number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded bytes."""
    added = [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _map_texts(docs, text, added, ranks_path, pattern, "digest")


def _map_texts(docs: DataFrame, text: str, added: list, ranks_path: str, pattern: str, kind: str) -> DataFrame:
    new = {name for name, _, _ in added}
    kept = [c for c in docs.columns if c not in new and not (kind == "digest" and c == text)]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], text_of(f"`{text}`").alias("__text"))
    types = [t for _, _, t in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks_path, pattern)
        cache = ChunkCache(enc.encode_many)
        for b in batches:
            texts = b.column(len(kept)).to_pylist()
            for rows in groups_by_size(texts):
                docs_ = [cut(texts[i]) for i in rows]
                known = cache.learn(docs_)
                columns: list[list] = [[] for _ in added]
                for chunks in docs_:
                    ids = np.frombuffer(b"".join(map(known.__getitem__, chunks)), dtype="<u4")
                    if kind == "ids":
                        columns[0].append(ids.astype(np.int32))
                        continue
                    numbers = ids.tolist()
                    columns[0].append(len(numbers))
                    columns[1].append(hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest())
                    columns[2].append(hashlib.sha256(enc.decode(numbers)).hexdigest())
                part = b.slice(rows[0], len(rows))
                made = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + made, names=kept + [n for n, _, _ in added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text"]
    return source.mapInArrow(run, ", ".join(fields + [f"`{n}` {t}" for n, t, _ in added]))


def multi_ranks() -> tuple[str, str]:
    """Path of the multilingual rank file and the split pattern."""
    import public_tokenizers as P

    return P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


@register("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(docs, *multi_ranks())
