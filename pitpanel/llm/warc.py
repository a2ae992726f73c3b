"""WARC archives as a PySpark Python data source, ``warc``.

Reading plans groups of files as partitions and parses each record's headers first.  Filters on record type and other
header columns are pushed down and decided on the headers; the payload of a record that they refuse, or that the asked
schema does not need, is never decompressed: gzip members that this writer made carry their length in an extra field,
so the reader goes on behind them (other archives' members are inflated to find their end, but not kept).

Writing makes ``.warc.gz`` files of bounded size, one gzip member a record, named by task attempt; ``commit`` lists the
files of successful attempts, and only listed files are read back (folders without a list are read whole).

``response`` records hold an HTTP message with the payload, ``revisit`` records its headers alone
(``WARC-Refers-To`` names the record with the payload).  All file access goes through Arrow file systems.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from pitpanel.llm.text import file_system, fresh_folder, stored

#: Header of each string column.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes long, payload_sha1 string, payload binary, file string, offset long"
#: Of the columns, those that need the whole payload.
WHOLE = {"payload_sha1", "payload"}
FILE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
LIST = "_committed-"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(raw: bytes, level: int) -> bytes:
    """A gzip member whose extra field SL has its whole length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(6)
    length = len(head) + 2 + 12 + len(body) + 8
    return head + (12).to_bytes(2, "little") + b"SL" + (8).to_bytes(2, "little") + length.to_bytes(8, "little") + body + zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")


def record(kind: str, record_id: str, uri: str | None, date: str, payload: bytes, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcSource(DataSource):
    """Options: ``path`` (a folder or a file), ``level`` (gzip level of writing, default 2)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"], int(self.options.get("level", 2)))


class WarcWriter(DataSourceArrowWriter):
    """Takes rows ``record_type, record_id, target_uri, date, refers_to, payload``."""

    def __init__(self, folder: str, level: int):
        self.folder, self.level = folder.rstrip("/"), level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        from pyspark import TaskContext

        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        system, place = file_system(self.folder)
        system.create_dir(place, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("record_type", "record_id", "target_uri", "date", "payload", "refers_to")]
            for row in zip(*columns, strict=True):
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"{stem}-{len(names):04d}.warc.gz")
                    out, size = system.open_output_stream(f"{place}/{names[-1]}", compression=None), 0
                raw = member(record(*row), self.level)
                out.write(raw)
                size += len(raw)
        if out is not None:
            out.close()
        return Files(names)

    def commit(self, messages: list) -> None:
        system, place = file_system(self.folder)
        system.create_dir(place, recursive=True)
        with system.open_output_stream(f"{place}/{LIST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(sorted(n for m in messages if m for n in m.names)).encode())

    def abort(self, messages: list) -> None:
        """Nothing to undo: files that no list names are not read."""


class Files(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class Span(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def _test(f) -> tuple[str, object] | None:
    """(column, test of the header's value) of a filter on a header column, if it is one."""
    if isinstance(f, Not):
        inner = _test(f.child)
        return inner and (inner[0], lambda v: v is not None and not inner[1](v))
    kinds = {
        EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, IsNotNull: lambda v, x: True,
        StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v,
    }
    if type(f) not in kinds or len(f.attribute) != 1 or f.attribute[0] not in HEADERS:
        return None
    value, kind = getattr(f, "value", None), kinds[type(f)]
    return f.attribute[0], lambda v: v is not None and kind(v, value)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.columns, self.tests = path.rstrip("/"), schema.names, []
        self.schema = schema

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            test = _test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[Span]:
        from pyarrow import fs

        system, place = file_system(self.path)
        if system.get_file_info(place).type == fs.FileType.File:
            return [Span([self.path])]
        found = [f for f in system.get_file_info(fs.FileSelector(place, allow_not_found=True)) if f.type == fs.FileType.File]
        listed = [f for f in found if f.base_name.startswith(LIST)]
        if listed:
            names = set()
            for f in listed:
                with system.open_input_stream(f.path) as stream:
                    names |= set(json.loads(stream.read()))
            found = [f for f in found if f.base_name in names]
        found = [f for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
        groups, total = [[]], 0
        for f in sorted(found, key=lambda f: f.base_name):
            if groups[-1] and total + f.size > FILE_BYTES:
                groups.append([])
                total = 0
            groups[-1].append(f"{self.path}/{f.base_name}")
            total += f.size
        return [Span(g) for g in groups if g] or [Span([])]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        whole = bool(WHOLE & set(self.columns))
        rows, size = [], 0
        for path in partition.files:
            for row in records(path, self.tests, whole, "payload_bytes" in self.columns):
                rows.append(row)
                size += 200 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield self._batch(rows, target)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows, target)

    def _batch(self, rows: list[dict], target: pa.Schema) -> pa.RecordBatch:
        values = {c: [r[c] for r in rows] for c in self.columns if c != "payload_sha1"}
        if "payload_sha1" in self.columns:
            values["payload_sha1"] = [None if r["payload"] is None else digest(r["payload"]) for r in rows]
        return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in target], schema=target)


class _Member:
    """One record's bytes, inflated only as far as they are asked for; plain archives as they are."""

    WINDOW = 1 << 15

    def __init__(self, file, at: int, packed: bool):
        self.file, self.at, self.next, self.packed, self.length = file, at, at, packed, None
        self.raw, self.ended = b"", False
        if packed:
            self.unpack = zlib.decompressobj(31)
            head = file.read_at(24, at)
            if len(head) == 24 and head[3] & 4 and head[12:14] == b"SL":
                self.length = int.from_bytes(head[16:24], "little")

    def more(self, most: int = 0) -> bool:
        """Reads on; ``most``: bytes wanted now (0: any number)."""
        if self.ended:
            return False
        if not self.packed:
            got = self.file.read_at(max(most, self.WINDOW), self.next)
            self.next += len(got)
            self.raw += got
            self.ended = not got
            return bool(got)
        tail = self.unpack.unconsumed_tail
        if not tail:
            tail = self.file.read_at(self.WINDOW if self.length is None or not most else max(1, min(self.length - (self.next - self.at), 8 << 20)), self.next)
            self.next += len(tail)
        got = self.unpack.decompress(tail, most or self.WINDOW)
        self.raw += got
        if self.unpack.eof:
            self.ended = True
            self.length = self.next - self.at - len(self.unpack.unused_data)
        elif not tail and not got:
            self.ended = True  # a cut file
        return True

    def until(self, sign: bytes, start: int = 0) -> int:
        """The end of the first ``sign``, or -1."""
        while (k := self.raw.find(sign, start)) < 0:
            if not self.more():
                return -1
        return k + len(sign)

    def whole(self, n: int) -> None:
        parts, have = [self.raw], len(self.raw)
        while have < n and not self.ended:
            self.raw = b""
            self.more(n - have)
            parts.append(self.raw)
            have += len(self.raw)
        self.raw = b"".join(parts)


def records(path: str, tests: list, whole: bool, sizes: bool) -> Iterator[dict]:
    """The records of an archive that pass the tests of their headers."""
    system, place = file_system(path)
    with system.open_input_file(place) as file:
        end, at = file.size(), 0
        packed = file.read_at(2, 0) == b"\x1f\x8b"
        while at < end:
            m = _Member(file, at, packed)
            start = m.until(b"\r\n\r\n")
            if start < 0 or not m.raw.lstrip(b"\r\n").startswith(b"WARC/"):
                if m.raw.strip(b"\r\n"):
                    raise ValueError(f"not a WARC record at byte {at} of {path}")
                return
            lines = m.raw[:start].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if _}
            length = int(head.get("content-length", 0))
            row = {c: head.get(h) for c, h in HEADERS.items()}
            if row["payload_digest"] and row["payload_digest"].startswith("sha1:"):
                row["payload_digest"] = row["payload_digest"][5:]
            if all(test(row[c]) for c, test in tests):
                row |= {"file": path, "offset": at, "payload": None, "payload_bytes": None}
                http = row["content_type"] is not None and row["content_type"].startswith("application/http")
                body = start
                if http and (whole or sizes):
                    body = m.until(b"\r\n\r\n", start)
                    body = start + length if body < 0 else min(body, start + length)
                    for line in m.raw[start:body].lower().split(b"\r\n"):
                        if line.startswith(b"content-length:"):
                            row["payload_bytes"] = int(line[15:])
                if whole and row["record_type"] != "revisit":
                    m.whole(start + length)
                    row["payload"] = m.raw[body : start + length]
                    row["payload_bytes"] = len(row["payload"])
                elif row["payload_bytes"] is None:
                    row["payload_bytes"] = start + length - body
                yield row
            if packed:
                while m.length is None:  # no extra field: inflate to the end
                    m.raw = b""
                    if not m.more():
                        return
                at += m.length
            else:
                at += start + length + 4


def enable(spark: SparkSession) -> None:
    """Registers the source and lets Spark push filters into Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def as_records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A record for each page: of equal payloads of at least ``min_bytes`` bytes the largest id is the response, the others revisit it.

    Null html is an empty payload; a null id is smaller than any id; rows that repeat the largest id are all responses,
    and so are all rows of a payload without ids; other columns are ignored.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).alias("target_uri"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")).withColumn("hash", F.sha1("payload"))
    # stored, so that both sides of the join are exchanges and a hot payload can be split
    repeated = stored(rows.where(F.octet_length("payload") >= min_bytes).groupBy("hash").agg(F.max("page").alias("kept"), F.count("*").alias("n")).where("n > 1 AND kept IS NOT NULL").select("hash", "kept"), "repeated")
    revisit = F.col("kept").isNotNull() & ~F.col("page").eqNullSafe(F.col("kept"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return rows.join(repeated, "hash", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name(F.col("page")).alias("record_id"), "target_uri", F.lit(date).alias("date"),
        F.when(revisit, name(F.col("kept"))).alias("refers_to"), "payload",
    )


def page_of(record_id) -> F.Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the pages' records under ``spark.checkpoint.dir`` and reads the archives back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    spark = pages.sparkSession
    enable(spark)
    folder = fresh_folder(spark, "warc")
    as_records(pages, **options).write.format("warc").mode("append").save(folder)
    back = spark.read.format("warc").schema("record_type string, record_id string, refers_to string, payload_digest string, payload_bytes long, payload_sha1 string").load(folder)
    back = back.where(F.col("record_type").isin("response", "revisit"))
    return back.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", F.coalesce("payload_sha1", "payload_digest").alias("payload_digest"), "record_type", page_of(F.col("refers_to")).alias("refers_to"))
