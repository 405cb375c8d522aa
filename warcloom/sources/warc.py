"""WARC files as a data source: byte ranges of files, one row per record.

A gzip file is cut into ranges of bytes, one partition each. A record belongs to
the range that its first byte lies in. A range other than the first looks for the
next gzip member that holds a WARC record. Such a member may also lie inside a
record, if an archive was archived; but what cannot be compressed is stored in
blocks of at most 64 KB with headers in between, so a chain of whole records that
runs on for longer than that is no part of another record. Until then rows wait;
if the chain breaks before, the true start is found by walking the file from its
beginning. A plain file is one partition, as nothing tells its records from those
of an archive inside it.

Payloads are streamed past unless they are asked for. After a broken record the
reader goes on at the next one; each gap becomes one row with ``warc_error``.
"""

from __future__ import annotations

import base64
import fnmatch
import gzip
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from email import message_from_bytes
from urllib.parse import quote, unquote_plus, urlencode

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..constants import INDEXED_RECORD_TYPES
from ..schemas import WARC_RECORD

_CHUNK = 1 << 20
_MOST_HEADER = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
#: Longer than two stored blocks of a gzip member.
_PROBATION = 1 << 17
#: Contents that are read whatever the options: outlinks, and the arguments of a POST.
_SHORT_KINDS = ("metadata", "request")

WRITTEN = "rec_type string, target_uri string, warc_date string, content_type string, record_id string, concurrent_to string, digest string, content binary"


def file_system(path: str):
    """(file system, path in it) of a path that driver and executors share."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class _Raw:
    """A file from some place on; bytes may be handed back."""

    def __init__(self, file, at: int = 0):
        self.file, self.held, self.at = file, b"", at
        file.seek(at)

    def read(self) -> bytes:
        out, self.held = self.held or self.file.read(_CHUNK), b""
        self.at += len(out)
        return out

    def back(self, rest: bytes) -> None:
        self.held, self.at = rest + self.held, self.at - len(rest)

    def go(self, at: int) -> None:
        self.file.seek(at)
        self.held, self.at = b"", at

    def find(self, pattern: re.Pattern[bytes], width: int) -> bool:
        """Moves to the next match, of at most ``width`` bytes; False at the end."""
        held = b""
        while piece := self.read():
            held += piece
            if match := pattern.search(held):
                self.back(held[match.start():])
                return True
            held = held[-(width - 1):]
        return False


class _Member:
    """The content of the gzip member at the place of ``raw``."""

    def __init__(self, raw: _Raw):
        self.raw, self.inflate = raw, zlib.decompressobj(31)

    def read(self) -> bytes:
        """Some content; empty at the member's end."""
        while not self.inflate.eof:
            piece = self.inflate.unconsumed_tail or self.raw.read()
            if not piece:
                raise EOFError("file ends inside a record")
            out = self.inflate.decompress(piece, 4 * _CHUNK)
            if self.inflate.eof:
                self.raw.back(self.inflate.unused_data)
            if out:
                return out
        return b""


class _Content:
    """Pieces of content in parts of wanted sizes."""

    def __init__(self, source):
        self.source, self.held = source, b""

    def until(self, mark: bytes) -> bytes:
        """Everything up to and with the mark."""
        while mark not in self.held:
            if len(self.held) > _MOST_HEADER:
                raise ValueError("a header does not end")
            piece = self.source.read()
            if not piece:
                raise EOFError("file ends inside a header")
            self.held += piece
        head, _, self.held = self.held.partition(mark)
        return head + mark

    def parts(self, size: int) -> Iterator[bytes]:
        while size:
            piece = self.held or self.source.read()
            if not piece:
                raise EOFError("file ends inside a record")
            self.held = piece[size:]
            yield piece[:size]
            size -= min(size, len(piece))


def _headers(block: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _flat(value, name: str = "") -> Iterator[tuple[str, str]]:
    """Leaves of a JSON value as arguments, named by their own key."""
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from _flat(inner, key)
    elif isinstance(value, list):
        for inner in value:
            yield from _flat(inner, name)
    elif name:
        yield name, json.dumps(value) if not isinstance(value, str) else value


def post_query(method: str, content_type: str, body: bytes) -> str:
    """Arguments that stand for a request body in an index key.

    Form fields as they are, multipart fields and JSON leaves as fields, anything
    else in base64.
    """
    kind = content_type.lower()
    query = None
    try:
        if kind.startswith("application/x-www-form-urlencoded"):
            query = unquote_plus(body.decode())
        elif kind.startswith("multipart/"):
            parts = message_from_bytes(f"Content-Type: {content_type}\r\n\r\n".encode() + body).get_payload()
            if isinstance(parts, list):
                query = urlencode([(p.get_param("name", header="content-disposition") or "", p.get_payload(decode=True) or b"") for p in parts])
        elif kind.startswith(("application/json", "text/plain")):
            query = urlencode(list(_flat(json.loads(body.decode()))))
    except ValueError:
        query = None  # not what it says it is: taken as bytes
    if query is None:
        query = "__wb_post_data=" + base64.b64encode(body).decode()
    return f"__wb_method={quote(method)}&{query}"


def _record(content: _Content, keep: bool) -> dict:
    """Reads one record; what its block holds is streamed past if nobody asks for it."""
    head = content.until(b"\r\n\r\n").lstrip(b"\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record begins here")
    warc = _headers(head)
    size = _number(warc.get("content-length"))
    if size is None:
        raise ValueError("a record without a length")
    kind, content_type = warc.get("warc-type"), warc.get("content-type") or ""
    row = {
        "rec_type": kind, "record_id": warc.get("warc-record-id"), "concurrent_to": warc.get("warc-concurrent-to"),
        "target_uri": warc.get("warc-target-uri", "").strip("<>") or None, "warc_date": warc.get("warc-date"), "content_type": content_type or None,
        "mime": content_type.split(";")[0].strip() or None,
        "digest": (warc.get("warc-payload-digest") or warc.get("warc-block-digest") or "").removeprefix("sha1:") or None,
    }
    http = "application/http" in content_type
    needed = keep or (kind in _SHORT_KINDS)
    kept: list[bytes] = []
    http_head, waiting = None, b""
    for part in content.parts(size):
        if http and http_head is None:
            waiting += part
            first, mark, rest = waiting.partition(b"\r\n\r\n")
            if not mark and len(waiting) < _MOST_HEADER:
                continue
            http_head, part = (first, rest) if mark else (b"", waiting)
        if needed:
            kept.append(part)
    if http and http_head is None:
        http_head = waiting
    body = b"".join(kept)
    if kind in ("response", "revisit") and http:
        parts = http_head.split(b"\r\n", 1)[0].split(None, 2)
        fields = _headers(http_head)
        row["http_status"] = _number(parts[1].decode("ascii", "replace")) if len(parts) > 1 else None
        row["location"] = fields.get("location")
        row["mime"] = fields.get("content-type", "").split(";")[0].strip() or None
    elif kind == "request" and http:
        row["http_method"] = http_head.split(b" ", 1)[0].decode("ascii", "replace")
        if row["http_method"] not in ("GET", "HEAD"):
            row["post_query"] = post_query(row["http_method"], _headers(http_head).get("content-type", ""), body)
    elif kind == "metadata":
        row["outlinks"] = [x.split()[1] for x in body.decode("utf-8", "replace").splitlines() if x.startswith("outlink: ") and len(x.split()) > 1]
    row["content"] = body if keep else None
    return row


class _Gzip:
    start = re.compile(re.escape(_MAGIC))
    width = len(_MAGIC)

    @staticmethod
    def read(raw: _Raw, keep: bool) -> tuple[dict, str | None]:
        member = _Member(raw)
        content = _Content(member)
        row = _record(content, keep)
        more = content.held
        extra = bool(more.strip(b"\r\n"))
        while more := member.read():
            extra |= bool(more.strip(b"\r\n"))
        return row, "the gzip member goes on after its record" if extra else None


class _Plain:
    start = re.compile(rb"WARC/[0-9.]+\r\n")
    width = 16

    @staticmethod
    def read(raw: _Raw, keep: bool) -> tuple[dict, str | None]:
        content = _Content(raw)
        row = _record(content, keep)
        raw.back(content.held)
        while (piece := raw.read()) and not (rest := piece.lstrip(b"\r\n")):
            pass
        if piece:
            raw.back(rest)
        return row, None


_BROKEN = (EOFError, ValueError, zlib.error)


def _true_start(path: str, start: int) -> int:
    """Where the first record at or after ``start`` begins, found from the beginning of the file."""
    system, inner = file_system(path)
    with system.open_input_file(inner) as file:
        raw = _Raw(file)
        while raw.at < start:
            at = raw.at
            try:
                _Gzip.read(raw, False)
            except _BROKEN:
                raw.go(at + 1)
                if not raw.find(_Gzip.start, _Gzip.width):
                    break
        return raw.at


def _error(path: str, offset: int, reason: str) -> dict:
    return {"filename": path, "offset": offset, "warc_error": reason}


def _known(path: str, raw: _Raw, form, stop: int | None, keep: bool) -> Iterator[dict]:
    """Rows from a place where a record is known to begin; gaps become error rows.

    What follows the last record may lie in the next range, which cannot tell a
    broken record at its start from the inside of one; so it is tried here.
    """
    gap = False
    while True:
        offset = raw.at
        inside = stop is None or offset < stop
        if not inside and gap:
            return
        piece = raw.read()
        if not piece:
            return
        raw.back(piece)
        try:
            row, more = form.read(raw, keep and inside)
        except _BROKEN as error:
            if not gap:
                yield _error(path, offset, f"{type(error).__name__}: {error}")
            gap = True
            raw.go(offset + 1)
            if not inside or not raw.find(form.start, form.width):
                return
            continue
        if not inside:
            return
        gap = False
        yield row | {"filename": path, "offset": offset, "length": raw.at - offset}
        if more:
            yield _error(path, offset, more)


def read_range(path: str, start: int, stop: int | None, keep: bool = False) -> Iterator[dict]:
    """Records that begin in [start, stop) of a file; the whole of it without ``stop``."""
    form = _Gzip if path.endswith(".gz") else _Plain
    system, inner = file_system(path)
    with system.open_input_file(inner) as file:
        raw = _Raw(file, start)
        if not start:
            yield from _known(path, raw, form, stop, keep)
            return
        found = _first(raw, form, stop)
        if found is None:
            return
        rows, waiting = _known(path, raw, form, stop, keep), []
        for row in rows:
            if "warc_error" in row:
                # The chain broke early, so its start may lie inside a record.
                raw.go(_true_start(path, start))
                found = _first(raw, form, stop)
                rows, waiting = (_known(path, raw, form, stop, keep) if found is not None else iter(())), []
                break
            waiting.append(row)
            if raw.at - found > _PROBATION:
                break
        yield from waiting
        yield from rows


def _first(raw: _Raw, form, stop: int | None) -> int | None:
    """Moves to the first place before ``stop`` at which a whole record is read."""
    while raw.find(form.start, form.width) and (stop is None or raw.at < stop):
        at = raw.at
        try:
            form.read(raw, False)
        except _BROKEN:
            raw.go(at + 1)
            continue
        raw.go(at)
        return at
    return None


def listed(path: str) -> list[tuple[str, int]]:
    """(path, length) of the files under a folder, of a glob, or of the one file; hidden ones left out."""
    from pyarrow import fs

    system, inner = file_system(path)
    fixed = re.split(r"[*?\[]", inner, maxsplit=1)[0]
    if fixed == inner:
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [(inner, info.size)]
        base, wanted = inner, None
    else:
        base, wanted = fixed.rsplit("/", 1)[0] or "/", inner
    found = system.get_file_info(fs.FileSelector(base, recursive=True))
    visible = (i for i in found if i.type == fs.FileType.File and not re.search(r"/[._]", i.path[len(base.rstrip("/")):]))
    return sorted((i.path, i.size) for i in visible if wanted is None or fnmatch.fnmatch(i.path, wanted))


def _prefix(path: str) -> str:
    """What stands before a path of the file system in a full path."""
    return "" if path.startswith(("/", "file:")) else path.split("://", 1)[0] + "://"


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: pa.Schema):
        self.path, self.schema = options["path"], schema
        self.range_bytes = int(options.get("rangebytes", str(128 << 20)))

    def partitions(self) -> list[InputPartition]:
        out, prefix = [], _prefix(self.path)
        for path, size in listed(self.path):
            step = self.range_bytes if path.endswith(".gz") else max(size, 1)
            out += [InputPartition((prefix + path, at, at + step)) for at in range(0, max(size, 1), step)]
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, start, stop = partition.value
        keep = "content" in self.schema.names
        rows: list[dict] = []
        size = 0
        for row in read_range(path, start, stop, keep):
            rows.append(row)
            size += len(row.get("content") or b"")
            if len(rows) >= 2000 or size > 8 * _CHUNK:
                yield pa.RecordBatch.from_pylist(rows, self.schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    """Each task writes one file under a hidden name; the driver gives it its own when all have ended."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out = None
        for batch in iterator:
            for row in batch.to_pylist():
                out = out or system.open_output_stream(f"{folder}/.{name}", compression=None)
                out.write(gzip.compress(_serialised(row)))
        if out is not None:
            out.close()
        return _Written([name] if out is not None else [])

    def commit(self, messages: list[_Written | None]) -> None:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        for name in (n for m in messages if m is not None for n in m.names):
            system.move(f"{folder}/.{name}", f"{folder}/{name}")

    def abort(self, messages: list[_Written | None]) -> None:
        """Hidden files are never read."""


def _serialised(row: dict) -> bytes:
    fields = {
        "WARC-Type": row["rec_type"], "WARC-Record-ID": row["record_id"], "WARC-Concurrent-To": row["concurrent_to"], "WARC-Target-URI": row["target_uri"],
        "WARC-Date": row["warc_date"], "WARC-Payload-Digest": row["digest"] and f"sha1:{row['digest']}", "Content-Type": row["content_type"],
    }
    content = row["content"] or b""
    lines = [f"{k}: {re.sub('[\r\n]', ' ', v)}" for k, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.0", *lines, f"Content-Length: {len(content)}"]).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


class WarcFiles(DataSource):
    """Options: path; rangeBytes and content (true or false) for reading."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        keep = self.options.get("content", "false").lower() == "true"
        return T.StructType([*WARC_RECORD.fields, *([T.StructField("content", T.BinaryType())] if keep else [])])

    def reader(self, schema: T.StructType) -> _Reader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return _Reader({k.lower(): v for k, v in self.options.items()}, to_arrow_schema(schema))

    def writer(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer({k.lower(): v for k, v in self.options.items()})


def read_warc_records(
    spark: SparkSession, path: str, keep_content: bool = False, types: list[str] | None = None, range_bytes: int = 128 << 20,
) -> DataFrame:
    """Records of all WARCs under a path (glob allowed), one task per range of bytes.

    Memory is bounded by the largest content that is kept. Rows with
    ``warc_error`` stand for broken places and pass any choice of types.
    """
    spark.dataSource.register(WarcFiles)
    reader = spark.read.format("warc").option("rangeBytes", str(range_bytes)).option("content", str(keep_content).lower())
    records = reader.option("path", path).load()
    if types is not None:
        records = records.filter(F.col("rec_type").isin(types) | F.col("warc_error").isNotNull())
    return records


def write_warc(records: DataFrame, path: str) -> None:
    """Writes records (the columns of ``WRITTEN``) as gzip WARCs, one file per task that has any.

    A task that runs again writes another hidden file; only those of the attempts
    that count get their names.
    """
    records.sparkSession.dataSource.register(WarcFiles)
    names = [f.split(" ")[0] for f in WRITTEN.split(", ")]
    records.select(*names).write.format("warc").mode("append").option("path", path).save()


def with_post_query(records: DataFrame) -> DataFrame:
    """Indexable records with ``post_query`` of the request they answer, if that had a body.

    A request names its answer in WARC-Concurrent-To, or the answer the request.
    """
    asked = records.filter(F.col("post_query").isNotNull())
    answers = records.filter(F.col("rec_type").isin(INDEXED_RECORD_TYPES)).drop("post_query")
    for mine, theirs in (("record_id", "concurrent_to"), ("concurrent_to", "record_id")):
        queries = asked.filter(F.col(theirs).isNotNull()).groupBy("filename", F.col(theirs).alias(mine)).agg(F.min("post_query").alias(f"_by_{mine}"))
        answers = answers.join(queries, ["filename", mine], "left")
    return answers.withColumn("post_query", F.coalesce("_by_record_id", "_by_concurrent_to")).select(*records.columns)


def read_indexable_records(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_warc_records(spark, path, types=INDEXED_RECORD_TYPES, **options)


def warc_job(spark: SparkSession, path: str, mapper: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, **options) -> DataFrame:
    """Run a user's record mapper over WARC records, batch by batch."""
    return read_warc_records(spark, path, **options).mapInPandas(mapper, schema)


def file_hashes(spark: SparkSession, path: str, algorithm: str = "sha512") -> DataFrame:
    """(path, length, digest) of every file, each streamed by one task; the digest's column has the algorithm's name."""
    import hashlib

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name in batch["path"]:
                sum_ = hashlib.new(algorithm)
                system, inner = file_system(name)
                with system.open_input_stream(inner, compression=None) as stream:
                    while chunk := stream.read(_CHUNK):
                        sum_.update(chunk)
                out.append(sum_.hexdigest())
            yield batch.assign(**{algorithm: out})

    # Path rows are tiny; without a fixed number of partitions adaptive execution would put all the reading in one task.
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = spark.read.format("binaryFile").load(path).select("path", "length").repartition(tasks)
    return files.mapInPandas(digest, f"path string, length long, {algorithm} string")
