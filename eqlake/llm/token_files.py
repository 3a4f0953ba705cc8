"""Operator 3: token-id files of independent zstandard frames with a trailing seek table.

File format (integers little-endian), a plain sequence of zstandard frames:

* frame 0..n-1: ids of consecutive documents as unsigned 32-bit integers, one
  independent frame per about ``FRAME_IDS`` ids; a document never spans two frames;
* index frame: a zstandard frame of the documents' entries, 24 bytes each: doc_id
  (int64, ``NULL_ID`` for null), frame number (uint32), first id in the frame (uint32),
  number of ids (uint64);
* seek table: a skippable frame of the public seekable format (magic 0x184D2A5E): per
  frame, the index frame included, compressed size, decompressed size and checksum (low
  32 bits of the XXH64 of the decompressed bytes), then number of frames, descriptor
  0x80 and magic 0x8F92EAB1.

A reader takes the last 9 bytes, the seek table and the index, and then decompresses
only the frames that hold the requested documents; every frame read is checked.

Documents are range-partitioned by id, so file k holds smaller ids than file k+1 and each
task writes one file under a name of its own, then renames it: a lost or repeated task
leaves no half file, and another attempt writes the same bytes.

Defined results: null texts are empty (only the end id); a null doc_id sorts first;
equal ids are ordered by the text's hash; an empty table gives no rows; extra columns
are ignored; special-token strings are ordinary text.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eqlake.llm.chunks import AgedChunkCache, cut_all, groups_by_size, may_split, parts
from eqlake.llm.common import fix, register, shuffle_partitions, table, text_of
from eqlake.session import checkpoint_dir

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_IDS = 262_144
NULL_ID = -(1 << 63)
_ENTRY = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("n", "<u8")])


class CorruptFile(ValueError):
    pass


class FrameWriter:
    """Writes one token-id file to an open binary sink, holding one frame at a time."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = 3):
        self.sink, self.frame_ids = sink, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.filled = 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[bytes] = []
        self.total = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document's ids as little-endian uint32 bytes."""
        n = len(ids) // 4
        if self.filled and self.filled + n > self.frame_ids:
            self._flush()
        entry = np.array([(NULL_ID if doc_id is None else doc_id, len(self.frames), self.filled, n)], dtype=_ENTRY)
        self.index.append(entry.tobytes())
        self.pending.append(ids)
        self.filled += n
        self.total += n

    def _frame(self, raw: bytes) -> None:
        packed = self.zstd.compress(raw)
        self.sink.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _flush(self) -> None:
        self._frame(b"".join(self.pending))
        self.pending, self.filled = [], 0

    def close(self) -> None:
        if self.pending:
            self._flush()
        self._frame(b"".join(self.index))
        table_ = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table_)) + table_)


class FrameReader:
    """Reads a token-id file through its seek table; ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, os.SEEK_END)
        size = source.tell()
        if size < 17:
            raise CorruptFile("too short")
        source.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or descriptor != 0x80 or size < 17 + 12 * n:
            raise CorruptFile("no seek table")
        source.seek(size - 17 - 12 * n)
        head = struct.unpack("<II", source.read(8))
        if head != (SKIPPABLE, 12 * n + 9):
            raise CorruptFile("bad seek table")
        self.frames = np.frombuffer(source.read(12 * n), dtype="<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0].astype(np.int64))])
        self.index = np.frombuffer(self.frame(n - 1), dtype=_ENTRY)

    def frame(self, k: int) -> bytes:
        packed, raw, check = (int(x) for x in self.frames[k])
        self.source.seek(int(self.starts[k]))
        data = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=max(raw, 1))
        if len(data) != raw or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise CorruptFile(f"frame {k}")
        return data

    def documents(self, rows: Iterable[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids as bytes) of the given index rows, or of all; each frame is read once if rows ascend."""
        at, data = -1, b""
        for k in range(len(self.index)) if rows is None else rows:
            doc_id, frame, first, n = (int(x) for x in self.index[k])
            if frame != at:
                at, data = frame, self.frame(frame)
            yield (None if doc_id == NULL_ID else doc_id), data[4 * first : 4 * (first + n)]

    def lookup(self, doc_ids: Iterable[int]) -> Iterator[tuple[int | None, bytes]]:
        """Only the requested documents; only their frames are decompressed."""
        return self.documents(np.flatnonzero(np.isin(self.index["doc_id"], list(doc_ids))))


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that driver and executors share (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri else pafs.FileSystem.from_uri(f"file://{os.path.abspath(uri.removeprefix('file:'))}")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray:
    """Bytes that each id stands for: a byte-level token has one character per byte."""
    vocab = _tokenizer(path).get_vocab(with_added_tokens=False)
    out = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
    out[list(vocab.values())] = list(map(len, vocab))
    return out


def encode_ids(chunks: list[str], path: str, join: int = 400) -> Iterator[bytes]:
    """Ids of each chunk, as bytes. Two kinds can follow each other without changing their ids, so
    hundreds of them go to the library as one text, and the ids are dealt back by the bytes they
    stand for: a space and non-spaces; non-spaces, each behind a newline that is a token of its own."""
    t, widths = _tokenizer(path), _token_bytes(path)
    kinds: tuple[list[str], list[str], list[str]] = [], [], []
    for c in chunks:
        words = c.split()
        extra = len(c) - len(words[0]) if len(words) == 1 else 2
        kinds[0 if extra == 1 and c[0] == " " else 1 if extra == 0 else 2].append(c)
    runs = [(kind[k : k + join], lead) for kind, lead in zip(kinds, ("", "\n")) for k in range(0, len(kind), join)]
    runs += [([c], "") for c in kinds[2]]
    out: dict[str, bytes] = {}
    for k in range(0, len(runs), 64):
        part = runs[k : k + 64]
        texts = [lead + lead.join(run) for run, lead in part]
        for (run, lead), e in zip(part, t.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            sizes = np.fromiter(map(len, map(str.encode, run)), np.int64, len(run)) + len(lead)
            stops = np.searchsorted(np.cumsum(widths[ids]), np.cumsum(sizes)) + 1
            starts = np.concatenate([[0], stops[:-1]]) + len(lead)
            raw = ids.tobytes()
            out.update(zip(run, [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * stops).tolist())]))
    return map(out.__getitem__, chunks)


@lru_cache(maxsize=2)
def _chunks(path: str) -> AgedChunkCache:
    """One cache per worker process, so that its tasks share what they learn. The pieces of
    unknown chunks have a cache of their own: words come with many signs behind them."""
    pieces = AgedChunkCache(lambda new: encode_ids(new, path), limit=400_000, limit_chars=11_000_000)

    def encode(chunks: list[str]) -> list[bytes]:
        split = [parts(c) if may_split(c) else None for c in chunks]
        known = pieces.learn([[c for c, p in zip(chunks, split) if p is None], *filter(None, split)])
        return [known[c] if p is None else b"".join(map(known.__getitem__, p)) for c, p in zip(chunks, split)]

    return AgedChunkCache(encode, limit=400_000, limit_chars=11_000_000)


def encode_documents(texts: list[str], cache: AgedChunkCache) -> list[bytes]:
    """Ids of each text, as bytes. Arrow cuts the texts, tells equal chunks and deals their ids out
    again; Python meets each distinct chunk once."""
    chunks = cut_all(texts)
    coded = chunks.values.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    dealt = pa.array(cache.values(distinct), pa.large_binary()).take(coded.indices)
    starts = np.frombuffer(dealt.buffers()[1], np.int64)[chunks.offsets.to_numpy()].tolist()
    data = memoryview(dealt.buffers()[2] or b"")
    return [bytes(data[a:b]) for a, b in zip(starts, starts[1:])]


_MANIFEST = "file int, path string, n_docs bigint, n_tokens bigint, n_bytes bigint"


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = 0, frame_ids: int = FRAME_IDS,
                      num_files: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files under ``folder``; returns the manifest (one row per file)."""
    n = num_files or shuffle_partitions(docs.sparkSession)
    source = docs.select("doc_id", text_of().alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = source.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("file"))
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _chunks(tokenizer_path)
        store, root = open_store(folder)
        writer = sink = file = None
        done = 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            if writer is None:
                file = b.column(2)[0].as_py()
                store.create_dir(root, recursive=True)
                partial, path = f"{root}/.{file:06d}-{uuid.uuid4().hex}", f"{root}/ids-{file:06d}.zst"
                sink = store.open_output_stream(partial)
                writer = FrameWriter(sink, frame_ids)
            for rows in groups_by_size(texts, 8_000_000):
                for i, encoded in zip(rows, encode_documents([texts[i] for i in rows], cache)):
                    writer.add(ids[i], encoded + end)
                    done += 1
        if writer is not None:
            writer.close()
            sink.close()
            store.move(partial, path)
            size = store.get_file_info(path).size
            yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "path": [path], "n_docs": [done], "n_tokens": [writer.total], "n_bytes": [size]})

    return ordered.mapInArrow(run, _MANIFEST)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the written files: doc_id, start, n_tokens (end id included), ids_crc32."""
    n = shuffle_partitions(manifest.sparkSession)
    # One row per file: the window sees as many rows as there are files.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("file", "path", before.alias("before")).repartitionById(n, F.col("file") % n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for b in batches:
            for path, start in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                out: list[tuple] = []
                with store.open_input_file(path) as f:
                    for doc_id, ids in FrameReader(f).documents():
                        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
                        start += len(ids) // 4
                        if len(out) == 50_000:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*out)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


@register("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    manifest = fix(write_token_files(table(spark, sf_dir, "documents"), folder, P.path("byte_bpe_50k.json")))
    return read_token_files(manifest, folder)
