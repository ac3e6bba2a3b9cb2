"""WARC archives as a Spark data source, and duplicate-aware writing of pages.

``format("warc")`` is a Python data source. The writer makes one uncompressed file a task under a
name of its own and, on commit, an index of file sizes, true record boundaries about every
``SPLIT`` bytes and record types between them; a file of an attempt that did not commit is in no
index. The reader plans partitions from the boundaries, leaves out splits without a wanted record
type, parses each record's headers first and seeks past the block if a pushed-down predicate
rejects the record or nobody asked for the payload. Archives without an index are read a file a
partition, ``.warc.gz`` too (there a skipped block is inflated, but not kept).

Paths go through ``pyarrow.fs``, so local and shared folders, HDFS and object stores work alike.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
                                    Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes between recorded boundaries, bytes of one read partition, bytes of one Arrow batch.
SPLIT, PARTITION, BATCH = 8 << 20, 32 << 20, 4 << 20
SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, http_status int, "
          "payload_length long, headers map<string,string>, payload binary")
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload binary, payload_length long, payload_sha1 binary"
#: Fixed values of the format: header names of the columns that predicates may name, and the revisit profile.
HEADER_OF = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to",
             "payload_digest": "warc-payload-digest"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1 (32 characters)."""
    return _base32(hashlib.sha1(payload).digest())


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _header_value(text: str) -> str:
    """No line break may end a header early: they and percent signs before them are percent-encoded."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


# ---------------------------------------------------------------- writing

@dataclass
class _Written(WriterCommitMessage):
    files: list


class _WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        missing = [c.split()[0] for c in WRITE_SCHEMA.split(", ") if c.split()[0] not in schema.names]
        if missing:
            raise ValueError(f"missing columns {missing}: a WARC table has {WRITE_SCHEMA}")
        if not overwrite:
            return
        fs, root = _open_fs(path)
        infos = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        self.old = [i.path for i in infos if i.base_name.startswith("_index-") or i.base_name.endswith(".warc")]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, root = _open_fs(self.path)
        batch = next((b for b in iterator if b.num_rows), None)
        if batch is None:
            return _Written([])
        fs.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc"
        splits: list[dict] = []
        at = 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            info = _record("warcinfo", [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            kinds = Counter(warcinfo=1)
            out.write(info)
            start, at = 0, len(info)
            while batch is not None:
                for row in batch.to_pylist():
                    if at - start >= SPLIT:
                        splits.append({"start": start, "end": at, "types": dict(kinds)})
                        start, kinds = at, Counter()
                    data = _page_record(row)
                    out.write(data)
                    kinds[row["record_type"]] += 1
                    at += len(data)
                batch = next((b for b in iterator if b.num_rows), None)
            splits.append({"start": start, "end": at, "types": dict(kinds)})
        return _Written([{"file": name, "splits": splits}])

    def commit(self, messages: list) -> None:
        fs, root = _open_fs(self.path)
        fs.create_dir(root, recursive=True)
        files = [f for m in messages if m for f in m.files]
        with fs.open_output_stream(f"{root}/_index-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"files": files}).encode())
        for old in self.old if self.overwrite else []:
            fs.delete_file(old)

    def abort(self, messages: list) -> None:
        fs, root = _open_fs(self.path)
        for f in [f for m in messages if m for f in m.files]:
            fs.delete_file(f"{root}/{f['file']}")


def _record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {_header_value(v)}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page_record(row: dict) -> bytes:
    """A response with its payload, or a revisit with the HTTP headers only."""
    payload, revisit = row["payload"] or b"", row["record_type"] == "revisit"
    length = row["payload_length"] if revisit else len(payload)
    digest = _base32(row["payload_sha1"]) if revisit else payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["target_uri"]),
               ("WARC-Refers-To", row["refers_to"] if revisit else None), ("WARC-Profile", REVISIT if revisit else None),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    return _record(row["record_type"], headers, http if revisit else http + payload)


# ---------------------------------------------------------------- reading

@dataclass
class _Part(InputPartition):
    spans: list  # (file, start, end); end None: to the end of the file


def _headers_of(stream) -> dict[str, str] | None:
    """Headers up to the blank line, names in lower case; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one begins: {line[:40]!r}")
    out: dict[str, str] = {}
    last = None
    while (line := stream.readline()).strip(b"\r\n"):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[0] in " \t" and last:
            out[last] += " " + text.strip()
        else:
            last, _, value = text.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def _http(block: bytes) -> tuple[int | None, int | None, bytes]:
    """``(status, Content-Length header, payload)`` of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    parts = lines[0].split(" ", 2)
    status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else None
    length = next((v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k.strip().lower() == "content-length"), "")
    return status, int(length) if length.isdigit() else None, payload


class _Predicate:
    """One pushed-down filter on a header column; null compares as in SQL (never true)."""

    def __init__(self, f: Filter):
        self.negated = isinstance(f, Not)
        f = f.child if self.negated else f
        self.kind, self.column, self.value = type(f), f.attribute[0], getattr(f, "value", None)

    @staticmethod
    def takes(f: Filter) -> bool:
        inner = f.child if isinstance(f, Not) else f
        kinds = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
        return isinstance(inner, kinds) and inner.attribute[0] in HEADER_OF and len(inner.attribute) == 1

    def __call__(self, value: str | None) -> bool:
        if self.kind is IsNull or self.kind is IsNotNull:
            return ((value is None) == (self.kind is IsNull)) != self.negated
        if self.kind is EqualNullSafe:
            return (value == self.value) != self.negated
        if value is None or self.value is None:
            return False
        found = {EqualTo: lambda: value == self.value, In: lambda: value in self.value, StringStartsWith: lambda: value.startswith(self.value),
                 StringEndsWith: lambda: value.endswith(self.value), StringContains: lambda: self.value in value}[self.kind]()
        if self.kind is In and not found and None in self.value:
            return False
        return found != self.negated


class _WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, verify: bool, partition_bytes: int):
        self.path, self.names, self.arrow = path, schema.names, to_arrow_schema(schema)
        unknown = set(self.names) - {c.split()[0] for c in SCHEMA.split(", ")}
        if unknown:
            raise ValueError(f"unknown columns {sorted(unknown)}")
        self.verify, self.partition_bytes = verify, partition_bytes
        self.predicates: list[_Predicate] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _Predicate.takes(f):
                self.predicates.append(_Predicate(f))
            else:
                yield f

    def _wanted(self, headers: dict[str, str]) -> bool:
        return all(p(_column(headers, p.column)) for p in self.predicates)

    def partitions(self) -> list[_Part]:
        fs, root = _open_fs(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root)) if fs.get_file_info(root).type == pafs.FileType.Directory else [fs.get_file_info(root)]
        indexes = [i for i in infos if i.base_name.startswith("_index-")]
        if not indexes:
            return [_Part([(i.path, 0, None)]) for i in infos if i.base_name.endswith((".warc", ".warc.gz"))] or [_Part([])]
        kind = [p for p in self.predicates if p.column == "record_type"]
        parts, held, size = [], [], 0
        for index in indexes:
            for file in json.loads(fs.open_input_file(index.path).read())["files"]:
                for s in file["splits"]:
                    if any(all(p(t) for p in kind) for t in s["types"]):
                        held.append((f"{root}/{file['file']}", s["start"], s["end"]))
                        size += s["end"] - s["start"]
                        if size >= self.partition_bytes:
                            parts.append(_Part(held))
                            held, size = [], 0
        return [*parts, _Part(held)] if held or not parts else parts

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path, start, end in partition.spans:
            for row in self._records(path, start, end):
                rows.append(row)
                size += len(row.get("payload") or b"") + 500
                if size >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=self.arrow)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=self.arrow)

    def _records(self, path: str, start: int, end: int | None) -> Iterator[dict]:
        fs, path = _open_fs(path) if "://" in path else (_open_fs(self.path)[0], path)
        with fs.open_input_file(path) as raw:
            stream = io.BufferedReader(raw, 1 << 20)
            if path.endswith(".gz"):
                stream = gzip.GzipFile(fileobj=stream)
            stream.seek(start)
            while end is None or stream.tell() < end - 4:  # the two line breaks that end a record
                headers = _headers_of(stream)
                if headers is None:
                    return
                length = int(headers["content-length"])
                if not self._wanted(headers):
                    stream.seek(length, io.SEEK_CUR)
                    continue
                http = headers.get("content-type", "").startswith("application/http")
                row = {n: _column(headers, n) for n in self.names if n in HEADER_OF}
                if "headers" in self.names:
                    row["headers"] = list(headers.items())
                if "payload" in self.names or self.verify:
                    block = stream.read(length)
                    if len(block) < length:
                        raise ValueError(f"{path}: a record ends early")
                    status, stated, payload = _http(block) if http else (None, None, block)
                    if self.verify and headers.get("warc-type") == "response" and _column(headers, "payload_digest") != payload_digest(payload):
                        raise ValueError(f"{path}: payload digest of {headers.get('warc-record-id')} differs")
                elif http and ("http_status" in self.names or "payload_length" in self.names):
                    # the HTTP head alone; what is left of the block is skipped
                    seen = b""
                    while len(seen) < length and b"\r\n\r\n" not in seen:
                        seen += stream.readline(length - len(seen))
                    stream.seek(length - len(seen), io.SEEK_CUR)
                    status, stated, payload = _http(seen)
                else:
                    stream.seek(length, io.SEEK_CUR)
                    status = stated = payload = None
                row |= {"http_status": status, "payload_length": length if not http else stated, "payload": payload}
                yield {n: row[n] for n in self.names}


def _column(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(HEADER_OF[name])
    return value.removeprefix("sha1:") if value and name == "payload_digest" else value


class WarcSource(DataSource):
    """``spark.read.format("warc")`` with options ``path``, ``verify`` (check digests of payloads) and ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> _WarcReader:
        return _WarcReader(self.options["path"], schema, self.options.get("verify", "false").lower() == "true",
                           int(self.options.get("partition_bytes", PARTITION)))

    def writer(self, schema: StructType, overwrite: bool) -> _WarcWriter:
        return _WarcWriter(self.options["path"], schema, overwrite)


def read_warc(spark: SparkSession, path: str, columns: str | None = None, verify: bool = False) -> DataFrame:
    """Records of the archives at ``path`` (``SCHEMA``); ``columns`` names a part of it.

    Comparisons of ``HEADER_OF`` columns with constants (equal, in, null, starts, ends, contains and
    their negations) run on the headers, before a block is read; without ``payload`` among the
    columns no payload is read. ``verify`` fails on a payload that its digest does not fit.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc").option("verify", str(verify).lower())
    if columns:
        kept = {c.split()[0]: c for c in SCHEMA.split(", ")}
        reader = reader.schema(", ".join(kept[c.strip()] for c in columns.split(",")))
    return reader.load(path)


# ---------------------------------------------------------------- pages

#: Duplicate groups whose list may be broadcast (about 150 bytes each).
BROADCAST_GROUPS = 200_000


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0,
               date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A WARC row per page (``WRITE_SCHEMA``): of equal payloads of at least ``least`` bytes one response, the rest revisits.

    The response is the page with the smallest id (no id: last; then the smallest url); of rows that
    are equal in all three columns one is. Record ids are ``<urn:page:ID>``, ``<urn:page:>`` without
    an id, so they are as unique as the ids given. A null payload is empty; line breaks in urls are
    percent-encoded; extra columns are not read; an empty table gives no record.

    Digests are counted without the payloads. Only digests that occur twice are joined back, by
    broadcast while they are few (counted) and else by a shuffle, where AQE splits a hot one; a
    revisit needs no payload. Equal rows that would be responses are first added up.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    base = base.withColumn("length", F.octet_length("payload").cast("long"))
    base = base.withColumn("key", F.when(F.col("length") >= least, F.unhex(F.sha2("payload", 256))))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("url").isNotNull().alias("has_url"), F.col("url").alias("url"))
    same = base.where("key is not null").groupBy("key", "id", "url").agg(F.count("*").alias("n"))
    groups = same.groupBy("key").agg(F.sum("n").alias("n"), F.min(order).alias("first"), F.min_by("n", order).alias("copies")).where("n > 1")
    groups = groups.select("key", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"), "copies").checkpoint()
    groups = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
    found = base.join(groups, "key", "left")
    is_first = F.col("copies").isNull() | (F.col("id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url")))
    found = found.withColumn("first", is_first)
    tied = found.where("first and copies > 1").groupBy("key", "id", "url").agg(F.first("payload").alias("payload"), F.first("length").alias("length"),
                                                                               F.count("*").alias("n"))
    tied = tied.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    cols = ["id", "url", "payload", "length"]
    plain = found.where("not (first and copies > 1) or copies is null").select(*cols, (~F.col("first")).alias("again"), "first_id")
    rows = plain.unionByName(tied.select(*cols, (F.col("k") > 1).alias("again"), F.col("id").alias("first_id")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    again = F.col("again")
    return rows.select(urn("id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
                       F.lit(date).alias("date"), F.when(again, urn("first_id")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload"),
                       F.col("length").alias("payload_length"), F.when(again, F.unhex(F.sha1("payload"))).alias("payload_sha1"))


def write_warc(records: DataFrame, path: str, overwrite: bool = False) -> str:
    """Writes rows of ``WRITE_SCHEMA`` as archives under ``path`` (added to what is there unless ``overwrite``)."""
    records.sparkSession.dataSource.register(WarcSource)
    names = [c.split()[0] for c in WRITE_SCHEMA.split(", ")]
    records.select(*names).write.format("warc").mode("overwrite" if overwrite else "append").save(path)
    return path


def pages_in(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` read back: responses with verified payloads, revisits by headers alone."""
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c)).cast("long")
    full = read_warc(spark, path, "record_id, record_type, payload_digest, payload", verify=True).where("record_type = 'response'")
    full = full.select(as_id("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type",
                       F.lit(None).cast("long").alias("refers_to"))
    again = read_warc(spark, path, "record_id, record_type, refers_to, payload_digest, payload_length").where("record_type = 'revisit'")
    again = again.select(as_id("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
                         as_id("refers_to").alias("refers_to"))
    return full.unionByName(again)
