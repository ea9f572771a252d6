"""WARC 1.1 archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading.  Files are planned into partitions by size; archives written here are split inside
files too, at record offsets their manifest keeps.  Each record's headers are parsed first:
its gzip member is inflated only as far as they reach.  Predicates on header columns are
pushed down and decided there, and a record that fails them, or whose payload no column
asks for, is skipped without inflating the rest: archives written here carry each member's
length in its gzip header (the ``sl`` extra field), plain archives have ``Content-Length``.
Only compressed foreign archives without ``sl`` are inflated to find the next record.

Writing.  Each task streams its records into files of its own, a gzip member each; files are
rolled over at ``maxFileBytes``.  The driver's commit writes the manifest that names the
files of successful attempts.  Readers follow it, so what lost or repeated attempts leave is never read.

Folders may be on any store pyarrow opens by URI (``file:``, ``hdfs:``, ``s3:``, ``gs:`` ...).

Defined results: a null payload is written as an empty one; a null header is left out and
reads as null; an empty table writes an archive without files, which reads as no rows; records
keep repeats.  Columns other than those of ``SCHEMA`` can't be written (an error names them).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import datasource as ds

SCHEMA = T.StructType([
    T.StructField("warc_type", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("warc_date", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_length", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])

# Fixed names of the WARC format.
HEADERS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "_manifest.json"
MAX_FILE_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
READ_BYTES = 64 << 10
HEAD_BYTES = 2 << 10  # read and inflated at once while headers are looked for


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _member(raw: list[bytes], level: int = 6) -> bytes:
    """A gzip member whose extra field holds its compressed and uncompressed length."""
    deflate, crc, size, body = zlib.compressobj(level, zlib.DEFLATED, -15), 0, 0, []
    for part in raw:
        crc, size = zlib.crc32(part, crc), size + len(part)
        body.append(deflate.compress(part))
    body.append(deflate.flush())
    packed = b"".join(body)
    total = 10 + 2 + 12 + len(packed) + 8
    if max(total, size) < 1 << 32:
        head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, size)
    else:
        head = b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff"
    return head + packed + struct.pack("<II", crc, size & 0xFFFFFFFF)


def _record(row: dict) -> list[bytes]:
    payload = row.get("payload") or b""
    kind = row.get("warc_type") or "resource"
    block = []
    if kind in ("response", "revisit"):
        length = len(payload) if kind == "response" else row.get("payload_length") or 0
        block.append(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode())
    if kind != "revisit":
        block.append(payload)
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    for column, name in HEADERS.items():
        value = row.get(column)
        if value is not None and column != "warc_type":
            clean = value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\n" in value or "\r" in value else value
            lines.append(f"{name}: {clean}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    if kind in ("response", "revisit"):
        lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {sum(map(len, block))}")
    return ["\r\n".join([*lines, "", ""]).encode(), *block, b"\r\n\r\n"]


class Commit(ds.WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        unknown = [f.name for f in schema.fields if f.name not in SCHEMA.names]
        if unknown:
            raise ValueError(f"not columns of a WARC record: {', '.join(unknown)}")
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.most = int(options.get("maxFileBytes", MAX_FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Commit:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files: list[dict] = []
        out = None
        try:
            for batch in iterator:
                columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                for i in range(batch.num_rows):
                    if out is not None and files[-1]["bytes"] >= self.most:
                        out.close()
                        out = None
                    if out is None:
                        files.append({"name": f"part-{uuid.uuid4().hex}.warc.gz", "bytes": 0, "records": 0, "splits": [0]})
                        out = store.open_output_stream(f"{root}/{files[-1]['name']}", compression=None)
                    own = files[-1]
                    if own["bytes"] - own["splits"][-1] >= SPLIT_BYTES:
                        own["splits"].append(own["bytes"])
                    member = _member(_record({n: c[i].as_py() for n, c in columns.items()}))
                    out.write(member)
                    own["bytes"] += len(member)
                    own["records"] += 1
        finally:
            if out is not None:
                out.close()
        return Commit(files)

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            files = _manifest(store, root).get("files", []) + files
        # One object written whole names the new state; before it appears readers see the old one.
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list) -> None:
        store, root = _store(self.path)
        for f in (f for m in messages if m is not None for f in m.files):
            if store.get_file_info(f"{root}/{f['name']}").type != pafs.FileType.NotFound:
                store.delete_file(f"{root}/{f['name']}")


def _manifest(store: pafs.FileSystem, root: str) -> dict:
    if store.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.NotFound:
        return {}
    with store.open_input_stream(f"{root}/{MANIFEST}", compression=None) as f:
        return json.loads(f.read())


class Part(ds.InputPartition):
    """Byte ranges ``(file, first, end)`` that one task reads."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        super().__init__(ranges)
        self.ranges = ranges


def _holds(kept, value) -> bool:
    """Whether a pushed filter holds for a header's value; null comparisons don't, as in SQL."""
    if isinstance(kept, ds.IsNull):
        return value is None
    if isinstance(kept, ds.IsNotNull):
        return value is not None
    if isinstance(kept, ds.EqualNullSafe):
        return value == kept.value
    if value is None:
        return False
    if isinstance(kept, ds.EqualTo):
        return value == kept.value
    if isinstance(kept, ds.In):
        return value in kept.value
    if isinstance(kept, ds.StringStartsWith):
        return value.startswith(kept.value)
    if isinstance(kept, ds.GreaterThan):
        return value > kept.value
    if isinstance(kept, ds.GreaterThanOrEqual):
        return value >= kept.value
    if isinstance(kept, ds.LessThan):
        return value < kept.value
    return value <= kept.value


PUSHED = (ds.EqualTo, ds.EqualNullSafe, ds.In, ds.IsNull, ds.IsNotNull, ds.StringStartsWith,
          ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)


class _Member:
    """A record that is inflated from ``at`` on only as far as it is read."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data, self.next_read = file, at, b"", at
        head = self._raw(24)
        self.zipped = head[:2] == b"\x1f\x8b"
        self.total = None
        self.inflate = zlib.decompressobj(31) if self.zipped else None
        self.pending = head
        if self.zipped and len(head) == 24 and head[3] & 4 and head[12:14] == b"sl":
            self.total = struct.unpack("<I", head[16:20])[0]
        self.ended = not head

    def _raw(self, n: int) -> bytes:
        self.file.seek(self.next_read)
        got = self.file.read(n)
        self.next_read += len(got)
        return got

    def _more(self, step: int = READ_BYTES) -> bool:
        if self.ended:
            return False
        raw, self.pending = self.pending or self._raw(step), b""
        if not raw:
            self.ended = True
        elif not self.zipped:
            self.data += raw
        else:
            self.data += self.inflate.decompress(raw, step)
            self.pending = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.ended = True
                self.total = self.total or self.next_read - self.at - len(self.inflate.unused_data)
        return True

    def until(self, mark: bytes, first: int) -> int:
        """The end of the first ``mark`` at or after ``first``; -1 if there is none."""
        while (i := self.data.find(mark, first)) < 0:
            if not self._more(HEAD_BYTES):
                return -1
        return i + len(mark)

    def bytes(self, first: int, end: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < end and not self.ended:
            self.data = b""
            self._more()
            parts.append(self.data)
            have += len(self.data)
        self.data = b"".join(parts)
        return self.data[first:end]

    def after(self, length: int) -> int:
        """Where the next record begins; ``length`` is this one's, inflated."""
        if not self.zipped:
            return self.at + length
        while self.total is None and not self.ended:  # no length was given: inflate to the end, keeping nothing
            self.data = b""
            self._more()
        return self.at + (self.total or self.next_read - self.at)


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _parse(member: _Member):
    """``(columns but the payload, where the payload begins, where the block ends)``; None at the end of a file."""
    end = member.until(b"\r\n\r\n", 0)
    if end < 0:
        return None
    if not member.data.startswith(b"WARC/"):
        raise ValueError(f"no WARC record at byte {member.at}")
    named = _headers(member.data[:end - 4])
    row = {c: named.get(n.lower()) for c, n in HEADERS.items()}
    stop = end + int(named.get("content-length", 0))
    begin = end
    row["payload_length"] = stop - end
    if named.get("content-type", "").startswith("application/http"):
        head = member.until(b"\r\n\r\n", end)
        if 0 <= head <= stop:
            begin = head
            http = _headers(member.data[end:head - 4])
            row["payload_length"] = int(http.get("content-length", 0)) if row["warc_type"] == "revisit" else stop - head
    return row, begin, stop


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"].rstrip("/"), schema
        self.size = int(options.get("maxPartitionBytes", 4 * SPLIT_BYTES))
        self.filters: list = []

    def pushFilters(self, filters: list) -> Iterator:
        for one in filters:
            if isinstance(one, PUSHED) and len(one.attribute) == 1 and one.attribute[0] in SCHEMA.names and one.attribute[0] != "payload":
                self.filters.append(one)
            else:
                yield one

    def partitions(self) -> list[Part]:
        store, root = _store(self.path)
        manifest = _manifest(store, root)
        ranges = []
        if manifest:
            for f in manifest["files"]:
                ends = [*f["splits"][1:], f["bytes"]]
                ranges += [(f"{root}/{f['name']}", a, b) for a, b in zip(f["splits"], ends, strict=True)]
        else:
            info = store.get_file_info(root)
            found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(root, recursive=True))
            ranges = [(f.path, 0, f.size) for f in sorted(found, key=lambda f: f.path) if f.path.endswith((".warc", ".warc.gz"))]
        parts, own, size = [], [], 0
        for r in ranges:
            if own and size + r[2] - r[1] > self.size:
                parts.append(Part(own))
                own, size = [], 0
            own.append(r)
            size += r[2] - r[1]
        return [*parts, Part(own)] if own else parts or [Part([])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        names = self.schema.names
        arrow = pa.schema([(f.name, {"payload_length": pa.int64(), "payload": pa.binary()}.get(f.name, pa.string())) for f in self.schema.fields])
        wants = "payload" in names
        rows, held = [], 0
        for path, at, end in partition.ranges:
            with store.open_input_file(path) as file:
                while at < end:
                    member = _Member(file, at)
                    found = _parse(member)
                    if found is None:
                        break
                    row, begin, stop = found
                    if all(_holds(f, row[f.attribute[0]]) for f in self.filters):
                        row["payload"] = member.bytes(begin, stop) if wants else None
                        rows.append([row[n] for n in names])
                        held += 200 + len(row["payload"] or b"")
                        if held >= 8 << 20:
                            yield self._batch(rows, arrow)
                            rows, held = [], 0
                    at = member.after(stop + 4)
        if rows:
            yield self._batch(rows, arrow)

    @staticmethod
    def _batch(rows: list[list], arrow: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), schema, overwrite)


def write_warc(records: DataFrame, path: str, mode: str = "append") -> None:
    """Writes rows with columns of ``SCHEMA`` (any of them) as an archive folder."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode(mode).save(path)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """The records of a folder or file; without ``payload`` among ``columns`` no payload is inflated.

    Switches Python filter push-down on for the session, which is off by default in Spark.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    schema = T.StructType([f for f in SCHEMA.fields if columns is None or f.name in columns])
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def deduplicated_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                         least: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """A record for each page: of equal payloads of ``least`` bytes or more the page with the largest id is the
    response and the others revisit it; smaller payloads are all responses.

    A null page text is an empty payload.  Rows that repeat the largest id are each a response; a row without an
    id revisits a payload that a page with an id holds, else it is a response.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    # Only digests and ids are grouped and joined on digests; payloads move once, on the page's id.
    large = rows.where(F.col("payload_length") >= least).select("page_id", "sha1", "payload_length")
    first = large.groupBy("sha1", "payload_length").agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = large.join(first, ["sha1", "payload_length"]).where("kept_id IS NOT NULL AND NOT (page_id <=> kept_id)")
    again = again.select(F.col("page_id").alias("id"), F.col("sha1").alias("digest"), "kept_id").distinct()
    found = rows.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha1") == F.col("digest")), "left")
    revisit = F.col("kept_id").isNotNull()

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    return found.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"), urn(F.col("page_id")).alias("record_id"),
        "target_uri", F.lit(date).alias("warc_date"), F.when(revisit, urn(F.col("kept_id"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), "sha1").alias("payload_digest"), "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"))
