"""Web archives (WARC 1.1) as a Spark data source.

``spark.read.format("warc").load(folder)`` plans one partition per run of whole files, hands equality filters on headers
and record type to the readers, parses each record's headers first and neither decompresses nor decodes payloads of
records that are filtered out or whose payload column is not asked for (option ``payload`` = false).
``df.write.format("warc").mode("append").save(folder)`` writes them: one gzip member per record, so that records can be
skipped by their compressed length, which the reader learns from the ``sl`` extra field of the member. Paths without a
scheme belong to the session's default file system, as ``register`` finds it, on the driver and in the tasks alike.

Tasks write files under their final names, which carry the write's id; the commit is one manifest file that lists those of
the tasks that succeeded, so nothing is moved. Readers leave out files of a write that has no manifest, or that are not in
it (tasks that failed or ran twice), and read archives of other makers as they are.

Defined cases: null payloads are empty; a null record id, uri or date leaves its header out and is read back as null;
an unreadable file, or a payload that differs from its digest, fails the query; a folder without archives gives no rows; columns that are not of the schema are
refused by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import os
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from granary.session import fresh_path

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, payload binary"
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
#: Record types of the format (fixed values).
KINDS = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A file is closed when it grows beyond this; files are planned into partitions of this size.
FILE_BYTES = 64 << 20
#: A write's list of its files, and what these are called.
MANIFEST = "_manifest-"
OWN_FILE = re.compile(r"[0-9a-f]{32}-[0-9a-f]{32}\.warc\.gz")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str, default: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path or URI, and the path in it; ``default`` is the file system of paths without a scheme."""
    if ":" not in path.split("/")[0]:
        if default.startswith("file:"):
            return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)
        path = f"{default.rstrip('/')}/{path.lstrip('/')}"
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def clean(value: str) -> str:
    """A header value on one line: control characters and % percent-coded."""
    return "".join(c if c >= " " and c not in "%\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def unclean(value: str) -> str:
    from urllib.parse import unquote

    return unquote(value) if "%" in value else value


def record(row: dict) -> bytes:
    """One archive record; a revisit carries the HTTP headers, with the payload's length, but no payload."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1"]
    values = row | {"payload_digest": base32_sha1(payload)}
    for column, name in HEADERS.items():
        if values.get(column) is not None:
            v = clean(values[column])
            head.append(f"{name}: {'sha1:' + v if column == 'payload_digest' else '<' + v + '>' if name.endswith(('-ID', '-To')) else v}")
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
    body = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` holds its own length and that of its content."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    packed = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def header_end(data: bytes) -> int:
    return data.find(b"\r\n\r\n")


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def fields(found: dict[str, str]) -> dict[str, str | None]:
    out: dict[str, str | None] = {}
    for column, name in HEADERS.items():
        v = found.get(name.lower())
        if v is not None:
            v = v.removeprefix("sha1:") if column == "payload_digest" else v[1:-1] if v.startswith("<") and v.endswith(">") and name.endswith(("-ID", "-To")) else v
            v = unclean(v)
        out[column] = v
    return out


def start_of(stream) -> tuple[bytes, object]:
    """The first bytes of a member's content, up to the end of its headers, and the decompressor that stands behind them."""
    inflate = zlib.decompressobj(31)
    data = b""
    while header_end(data) < 0:
        chunk = stream.read(2048)
        if not chunk:
            break
        data += inflate.decompress(chunk, 4096) if not inflate.unconsumed_tail else inflate.decompress(inflate.unconsumed_tail + chunk, 4096)
        while inflate.unconsumed_tail and header_end(data) < 0:
            data += inflate.decompress(inflate.unconsumed_tail, 4096)
    return data, inflate


def read_file(store: pyarrow.fs.FileSystem, path: str, wanted: list[tuple[str, tuple]], payload: bool) -> Iterator[dict]:
    """Records of a file that pass ``wanted`` (header column, allowed values)."""
    with store.open_input_file(path) as f:
        size, at = f.size(), 0
        while at < size:
            f.seek(at)
            fixed = f.read(24)
            if fixed[:4] != b"\x1f\x8b\x08\x04" or fixed[12:14] != b"sl":
                raise ValueError(f"{path}: no record of an archive at byte {at}")
            length = struct.unpack_from("<I", fixed, 16)[0]
            f.seek(at)
            data, inflate = start_of(f)
            end = header_end(data)
            if end < 0:
                raise ValueError(f"{path}: record without headers at byte {at}")
            found = headers(data[:end])
            row = fields(found)
            if all(row[c] in values for c, values in wanted):
                block = data[end + 4 :]
                while header_end(block) < 0 and inflate.unconsumed_tail:  # the HTTP headers give the payload's length
                    block += inflate.decompress(inflate.unconsumed_tail, 4096)
                if payload and row["record_type"] != "revisit":
                    f.seek(at)
                    whole = zlib.decompress(f.read(length), 31)
                    block = whole[end + 4 : end + 4 + int(found["content-length"])]
                split = header_end(block)
                row["payload_bytes"] = int(headers(block[:split])["content-length"])
                row["payload"] = block[split + 4 :] if payload and row["record_type"] != "revisit" else None
                if row["payload"] is not None and row["payload_digest"] not in (None, base32_sha1(row["payload"])):
                    raise ValueError(f"{path}: the payload at byte {at} differs from its digest")
                yield row
            at += length


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, default: str, payload: bool):
        self.folder, self.default, self.payload, self.wanted = folder, default, payload, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((name, (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.wanted.append((name, tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = filesystem(self.folder, self.default)
        listed = {posixpath.basename(x.path): x for x in store.get_file_info(pyarrow.fs.FileSelector(root)) if x.is_file}
        committed: set[str] = set()
        for name in (n for n in listed if n.startswith(MANIFEST) and not n.endswith(".tmp")):
            with store.open_input_file(posixpath.join(root, name)) as f:
                committed.update(f.read().decode().split("\n"))
        files = [x for n, x in listed.items() if n.endswith(".warc.gz") and n[0] not in "._" and (n in committed or not OWN_FILE.fullmatch(n))]
        out: list[Files] = []
        held = FILE_BYTES
        for x in sorted(files, key=lambda x: x.path):
            if held + x.size > FILE_BYTES:
                out.append(Files([]))
                held = 0
            out[-1].paths.append(x.path)
            held += x.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.folder, self.default)
        kinds = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for path in partition.paths:
            for row in read_file(store, path, self.wanted, self.payload):
                rows.append(row)
                held += 200 + len(row["payload"] or b"")
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, kinds)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, default: str, overwrite: bool):
        self.folder, self.default, self.overwrite, self.id = folder, default, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = filesystem(self.folder, self.default)
        names, out, size = [], None, 0
        store.create_dir(root)
        for batch in iterator:
            columns = [c for c in batch.schema.names if c in HEADERS or c == "payload"]
            for values in zip(*(batch.column(batch.schema.get_field_index(c)) for c in columns), strict=True):
                if out is None:
                    names.append(f"{self.id}-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(posixpath.join(root, names[-1]), compression=None), 0
                data = member(record({c: v.as_py() for c, v in zip(columns, values, strict=True)}))
                out.write(data)
                size += len(data)
                if size > FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.folder, self.default)
        store.create_dir(root)
        if self.overwrite:
            for x in store.get_file_info(pyarrow.fs.FileSelector(root)):
                old = x.base_name.endswith(".warc.gz") and not x.base_name.startswith(self.id) or x.base_name.startswith(MANIFEST)
                if x.is_file and old:
                    store.delete_file(x.path)
        manifest = posixpath.join(root, f"{MANIFEST}{self.id}")
        with store.open_output_stream(f"{manifest}.tmp", compression=None) as out:
            out.write("\n".join(n for m in messages if m for n in m.names).encode())
        store.move(f"{manifest}.tmp", manifest)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.folder, self.default)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(posixpath.join(root, name))


class WarcSource(DataSource):
    default = "file:///"  # file system of paths without a scheme; ``register`` sets the session's

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.default, self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], self.default, overwrite)


def register(spark) -> None:
    """Make the source known to the session, with the file system that the session takes paths without a scheme from."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    spark.dataSource.register(type("WarcSource", (WarcSource,), {"default": default}))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_split(spark, folder: str) -> DataFrame:
    """All records: responses with their payloads, other kinds by their headers alone, each read by a pushed-down filter."""
    register(spark)
    whole = spark.read.format("warc").load(folder).where(F.col("record_type") == "response")
    rest = spark.read.format("warc").option("payload", "false").load(folder)
    kinds = [k for k in KINDS if k != "response"]
    return whole.unionByName(rest.where(F.col("record_type").isin(kinds)))


def with_revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """``records`` (record_id, order, target_uri, payload, ...) with record_type and refers_to: of equal payloads of at
    least ``least`` bytes the one with the largest ``order`` is the response, the others revisit it."""
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    marked = records.withColumn("_digest", F.when(size >= least, F.sha1(F.coalesce("payload", F.lit(b"")))))
    # one row per digest and task before the shuffle; only payloads that occur again come to the join
    groups = marked.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.max(F.struct("order", "record_id")).alias("last"), F.count("*").alias("n"))
    again = groups.where("n > 1").select("_digest", F.col("last.order").alias("_order"), F.col("last.record_id").alias("_first"))
    joined = marked.join(again, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("order").eqNullSafe(F.col("_order"))
    return joined.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("_first"))}).drop("_digest", "_order", "_first")


def archive_pages(pages: DataFrame, folder: str | None = None, least: int = 0) -> str:
    """Write a record per page (page_id, url, html) and return the folder."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or fresh_path(spark, "warc")
    rows = pages.select(
        F.concat(F.lit("urn:page:"), F.col("page_id").cast("string")).alias("record_id"), F.col("page_id").alias("order"),
        F.col("url").alias("target_uri"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    done = with_revisits(rows, least)
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    blank = {"date": F.lit("1970-01-01T00:00:00Z"), "payload_digest": F.lit(None).cast("string"), "payload_bytes": F.lit(None).cast("long")}
    done.withColumns(blank).select(*names).write.format("warc").mode("append").save(folder)
    return folder
