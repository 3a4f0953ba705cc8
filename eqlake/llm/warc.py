"""Operator 6: derivative builder for web archives.

Each response becomes two linked records: a ``metadata`` record with title, out-links, source
headers and the ids and digests of its relatives, and a ``conversion`` record with the plain
text. Both refer to the response by WARC-Refers-To and keep its target URI and date; digests
are SHA-1 in base 32, as web archives write them. ``write_files`` stores records as one gzip
member each, in one file per task (written under a name of its own, then renamed), and
``read_files`` reads them back.

Record ids are name-based UUIDs of the response, so a repeated task writes the same records.

Defined results: a null URL or payload counts as empty; unfinished tags and comments are
dropped, unfinished scripts as well; a lone ``<`` is text; repeated rows give repeated records;
an empty table gives no records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.common import fix, register, shuffle_partitions, table
from eqlake.llm.token_files import open_store
from eqlake.session import checkpoint_dir

#: Elements without readable text, and elements that end a line.
HIDDEN = {"script", "style", "noscript", "template"}
BLOCK = set("address article aside blockquote body br dd div dl dt fieldset footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table td th title tr ul".split())
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_END = {name: re.compile(rf"</{name}", re.I) for name in HIDDEN}
DATE = "1970-01-01T00:00:00Z"


def convert(page: str) -> tuple[str, str, list[str]]:
    """(plain text, title, out-links) in one pass over the page."""
    parts: list[str] = []
    links: list[str] = []
    title, title_at = "", -1
    i, n = 0, len(page)
    while i < n:
        j = page.find("<", i)
        if j < 0:
            parts.append(page[i:])
            break
        parts.append(page[i:j])
        if page.startswith("<!--", j):
            i = page.find("-->", j + 4) + 3
            if i < 3:
                break
            continue
        name = _NAME.match(page, j + 1)
        if name is None and page[j + 1 : j + 2] not in ("!", "?", "/"):
            parts.append("<")
            i = j + 1
            continue
        end = page.find(">", j)
        if end < 0:
            break
        i = end + 1
        if name is None:
            continue
        tag, closing = name[1].lower(), page[j + 1] == "/"
        if tag in HIDDEN and not closing:
            close = _END[tag].search(page, i)
            if close is None:
                break
            i = page.find(">", close.end()) + 1 or n
            continue
        if tag == "title":
            if not closing:
                title_at = len(parts)
            elif title_at >= 0 and not title:
                title = " ".join(entities.unescape("".join(parts[title_at:])).split())
        elif tag == "a" and not closing and (href := _HREF.search(page, j, end)):
            links.append(entities.unescape(next(x for x in href.groups() if x is not None)))
        if tag in BLOCK:
            parts.append("\n")
    lines = (" ".join(line.split()) for line in entities.unescape("".join(parts)).split("\n"))
    return "\n".join(line for line in lines if line), title, links


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _named(kind: str, response: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {response}')}>"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def derive(response: str, uri: str, date: str, headers: list[tuple[str, str]], page: str) -> list[dict]:
    """The metadata and the conversion record of one response."""
    payload = page.encode("utf-8", "surrogatepass")
    text, title, links = convert(page)
    plain = text.encode("utf-8", "surrogatepass")
    metadata, conversion = _named("metadata", response), _named("conversion", response)
    source = sha1_label(payload)
    fields = [("title", title), ("source-payload-digest", source), ("source-payload-length", str(len(payload))), ("conversion-record-id", conversion), ("conversion-block-digest", sha1_label(plain))]
    fields += [(f"source-header-{k.lower()}", v) for k, v in headers] + [("outlink", x) for x in links]
    block = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    shared = {"refers_to": response, "target_uri": uri, "date": date, "source_digest": source}
    return [
        shared | {"type": "metadata", "record_id": metadata, "concurrent_to": conversion, "content_type": "application/warc-fields", "block_digest": sha1_label(block), "n_links": len(links), "block": block},
        shared | {"type": "conversion", "record_id": conversion, "concurrent_to": metadata, "content_type": "text/plain; charset=UTF-8", "block_digest": sha1_label(plain), "n_links": len(links), "block": plain},
    ]


_FIELDS = (("refers_to", "string"), ("target_uri", "string"), ("date", "string"), ("source_digest", "string"), ("type", "string"), ("record_id", "string"), ("concurrent_to", "string"), ("content_type", "string"), ("block_digest", "string"), ("n_links", "int"), ("block", "binary"))
_ARROW = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64()}


def build(responses: DataFrame) -> DataFrame:
    """Two records per row of ``responses``: key (long), record_id, target_uri, date, headers
    (array of name, value) and payload (string). Map-only."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    source = responses.select("key", "record_id", text("target_uri").alias("target_uri"), text("date").alias("date"), "headers", text("payload").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 200):
                keys, records = [], []
                for key, rid, uri, date, headers, page in zip(*(c.to_pylist() for c in b.slice(k, 200).columns)):
                    records += derive(rid, uri, date, [(h["name"], h["value"]) for h in headers or ()], page)
                    keys += [key, key]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())] + [pa.array([r[n] for r in records], _ARROW[t]) for n, t in _FIELDS], names=["key"] + [n for n, _ in _FIELDS])

    return source.mapInArrow(run, ", ".join(["key bigint"] + [f"{n} {t}" for n, t in _FIELDS]))


def record_bytes(r: dict) -> bytes:
    """A record in WARC/1.1 form."""
    head = [("WARC-Type", r["type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"]), ("WARC-Target-URI", _one_line(r["target_uri"])), ("WARC-Refers-To", r["refers_to"]), ("WARC-Refers-To-Target-URI", _one_line(r["target_uri"])), ("WARC-Refers-To-Date", r["date"]), ("WARC-Concurrent-To", r["concurrent_to"]), ("WARC-Block-Digest", r["block_digest"]), ("X-Source-Payload-Digest", r["source_digest"]), ("X-Key", str(r["key"])), ("Content-Type", r["content_type"]), ("Content-Length", str(len(r["block"])))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") + b"\r\n" + r["block"] + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(source: io.IOBase, size: int = 1 << 20) -> Iterable[bytes]:
    """The decompressed gzip members of a file, one at a time."""
    rest = source.read(size)
    while rest:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            out.append(z.decompress(rest))
            rest = z.unused_data if z.eof else source.read(size)
            if not z.eof and not rest:
                raise ValueError("unfinished member")
        yield b"".join(out)
        rest = rest or source.read(size)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; the block's length and digest are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if len(rest) != len(block) + 4 or sha1_label(block) != headers["WARC-Block-Digest"]:
        raise ValueError("damaged block")
    return headers, block


def write_files(records: DataFrame, folder: str) -> DataFrame:
    """Write the records of each partition to a file under ``folder``; returns path, n_records, n_bytes."""
    names = ["key"] + [n for n, _ in _FIELDS]
    source = records.select(*names, F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        sink = None
        n = size = 0
        for b in batches:
            for row in b.to_pylist():
                if sink is None:
                    store.create_dir(root, recursive=True)
                    partial, path = f"{root}/.{uuid.uuid4().hex}", f"{root}/derived-{row['part']:06d}.warc.gz"
                    sink = store.open_output_stream(partial)
                data = gzip_member(record_bytes(row))
                sink.write(data)
                n, size = n + 1, size + len(data)
        if sink is not None:
            sink.close()
            store.move(partial, path)
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

    return source.mapInArrow(run, "path string, n_records bigint, n_bytes bigint")


_READ = (("key", "bigint"), ("type", "string"), ("record_id", "string"), ("refers_to", "string"), ("target_uri", "string"), ("concurrent_to", "string"), ("source_digest", "string"), ("block_digest", "string"), ("block", "binary"))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the written files, checked."""
    files = manifest.select("path").repartition(shuffle_partitions(manifest.sparkSession), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                out: list[tuple] = []
                with store.open_input_stream(path, compression=None) as f:
                    for member in members(f):
                        h, block = parse_record(member)
                        out.append((int(h["X-Key"]) if h["X-Key"] != "None" else None, h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], h["WARC-Concurrent-To"], h["X-Source-Payload-Digest"], h["WARC-Block-Digest"], block))
                        if len(out) == 500:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    return files.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _READ))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*out), _READ)], names=[n for n, _ in _READ])


def responses_of(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``pages`` (page_id, url, html) as responses. The table has no dates; ``date`` stands for all.
    The record id is a version-5-shaped UUID of the row."""
    h = F.sha2(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))), 256)
    part = lambda a, n: F.substring(h, a, n)
    rid = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    header = lambda k, v: F.struct(F.lit(k).alias("name"), v.alias("value"))
    headers = F.array(header("Content-Type", F.lit("text/html; charset=utf-8")), header("Content-Length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string")))
    return pages.select(F.col("page_id").cast("bigint").alias("key"), rid.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), headers.alias("headers"), F.col("html").alias("payload"))


@register("op6_warc_derivatives")
def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the derivative files of all pages and returns their records, read back: page_id, type,
    record_id, refers_to, concurrent_to, target_uri, source_digest, block_digest, n_bytes, text
    (of conversion records)."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    manifest = fix(write_files(build(responses_of(table(spark, sf_dir, "pages"))), folder))
    r = read_files(manifest, folder)
    return r.select(
        F.col("key").alias("page_id"), "type", "record_id", "refers_to", "concurrent_to", "target_uri", "source_digest", "block_digest",
        F.octet_length("block").cast("bigint").alias("n_bytes"), F.when(F.col("type") == "conversion", F.decode("block", "UTF-8")).alias("text"),
    )
