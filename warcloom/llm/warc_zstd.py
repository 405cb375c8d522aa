"""Zstandard WARC archives (.warc.zst): writer, reader and the revisits of equal payloads.

An archive begins with a skippable frame that holds the dictionary (itself
compressed); every record is one frame after it. Writer and reader are data
sources of Spark: a task writes archives under names of its own and the driver
lists them in a manifest at the end, so files of failed attempts are never read;
each archive is one partition of the reader, which streams it frame by frame and
holds one record at a time.

The reader checks each frame: that it decodes, holds one record with the
mandatory headers, that the block has the length its header says, and that a
response's payload has the length and the digest that its headers say. What fails
becomes a row with ``error``; after a frame that does not decode the reader goes
on at the next one that does and reports the gap in one row.

Defined cases: null html is an empty payload; a page without id is written without
one; an empty table gives an empty manifest and no rows. Rows that repeat the
smallest id of a payload are all responses. Without an id in the whole group, all
are responses. Record ids follow from page ids, so repeated ids repeat. Control
characters and spaces in URLs are percent-escaped. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import shared_folder

#: Frame magics of the format, and the one that marks the dictionary.
_FRAME = b"\x28\xb5\x2f\xfd"
_DICTIONARY = b"\x5d\x2a\x4d\x18"
_SKIPPABLE = {bytes([0x50 + i]) + b"\x2a\x4d\x18" for i in range(16)}
#: Fixed value: the profile of revisits found by their digest.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "manifest.json"
_CHUNK = 1 << 20
_SAMPLES = 512
_SAMPLE_BYTES = 65_536
_DICTIONARY_BYTES = 65_536
_MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

WRITTEN = "page_id long, url string, payload binary, digest binary, record_type string, refers_to long"
READ = (
    "archive string, ordinal long, offset long, length long, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_digest string, payload_bytes long, payload binary, error string")


def _place(path: str):
    """(file system, path in it) for a folder or file that driver and executors share."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def train_dictionary(pages: DataFrame, payload: Column) -> bytes:
    """A dictionary from at most 512 payloads of up to 64 KB, chosen by hash; empty if there are too few.

    It changes the size of archives, never what is read from them.
    """
    # Tasks send what has a small hash: about four times the sample together, not a whole sample each.
    share = min(1.0, 4 * _SAMPLES / max(pages.count(), 1))
    rows = (
        pages.select(payload.alias("payload")).where(F.octet_length("payload").between(1, _SAMPLE_BYTES))
        .withColumn("hash", F.xxhash64("payload")).where(F.shiftrightunsigned("hash", 32) < int(share * (1 << 32)))
        .orderBy("hash", "payload").limit(_SAMPLES).collect()
    )
    samples = [bytes(r.payload) for r in rows]
    if len(samples) < 16:
        return b""
    try:
        size = min(_DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 16))
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""  # samples too alike or too short to learn from


def _escaped(url: str) -> str:
    return "".join(c if 0x20 < ord(c) != 0x7F else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, kind: str, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_escaped(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.date = options["path"], options.get("date", "2000-01-01T00:00:00Z")
        self.dictionary = base64.b64decode(options.get("dictionary", ""))
        self.roll = int(options.get("rollBytes", str(1 << 30)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        known = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
        pack = zstandard.ZstdCompressor(dict_data=known, write_checksum=True, write_content_size=True)
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size > self.roll:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.zst")
                    out, size = system.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                    if self.dictionary:
                        inner = zstandard.ZstdCompressor(level=19).compress(self.dictionary)
                        size += out.write(_DICTIONARY + struct.pack("<I", len(inner)) + inner) or 0
                frame = pack.compress(record(
                    row["page_id"], row["url"], row["payload"] or b"", row["digest"], row["record_type"], row["refers_to"], self.date))
                out.write(frame)
                size += len(frame)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages: list[_Written | None]) -> None:
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        names = sorted(name for m in messages if m is not None for name in m.names)
        with system.open_output_stream(f"{folder}/{_MANIFEST}", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        """Nothing is listed, so nothing is read."""


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    if content[:4] == _FRAME:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


class _Source:
    """Bytes of a stream that may be handed back."""

    def __init__(self, stream):
        self.stream, self.held, self.at = stream, b"", 0

    def read(self) -> bytes:
        """Some bytes; empty at the end."""
        out, self.held = self.held or self.stream.read(_CHUNK), b""
        self.at += len(out)
        return out

    def exactly(self, n: int) -> bytes:
        parts, got = [], 0
        while got < n and (part := self.read()):
            parts.append(part)
            got += len(part)
        whole = b"".join(parts)
        self.back(whole[n:])
        return whole[:n]

    def back(self, rest: bytes) -> None:
        self.held, self.at = rest + self.held, self.at - len(rest)


def frames(stream) -> Iterator[tuple[int, int, bytes | None, str | None]]:
    """(offset, length, content, error) of each record's frame, or of each gap that does not decode."""
    source = _Source(stream)
    known: zstandard.ZstdCompressionDict | None = None
    gap_from, why = None, ""
    leading = True
    while True:
        offset = source.at
        magic = source.exactly(4)
        if not magic:
            break
        if magic in _SKIPPABLE:
            size = source.exactly(4)
            length = struct.unpack("<I", size)[0] if len(size) == 4 else 0
            content = source.exactly(length)
            if len(size) == 4 and len(content) == length:
                if gap_from is not None:
                    yield gap_from, offset - gap_from, None, why
                    gap_from = None
                if magic == _DICTIONARY and leading:
                    try:
                        known = _dictionary(content)
                    except zstandard.ZstdError as error:
                        yield offset, length + 8, None, f"dictionary: {error}"
                leading = False
                continue
            raw, reason = magic + size + content, "a skippable frame ends early"
        else:
            leading = False
            raw, content, reason = _decoded(source, magic, known)
            if content is not None:
                if gap_from is not None:
                    yield gap_from, offset - gap_from, None, why
                    gap_from = None
                yield offset, source.at - offset, content, None
                continue
        if gap_from is None:
            gap_from, why = offset, reason
        # The next place where a frame may begin; two frames can share no byte of their magics.
        near = [p for p in (raw.find(m, 1) for m in (_FRAME, *_SKIPPABLE)) if p > 0]
        if near:
            source.back(raw[min(near):])
        elif not _seek(source, raw[-3:]):
            break
    if gap_from is not None:
        yield gap_from, source.at - gap_from, None, why


def _decoded(source: _Source, magic: bytes, known: zstandard.ZstdCompressionDict | None) -> tuple[bytes, bytes | None, str]:
    """(bytes taken, content, reason) of the frame that starts with ``magic``."""
    if magic != _FRAME:
        return magic, None, "no frame begins here"
    unpack = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
    taken, parts, piece = [magic], [], magic
    try:
        while True:
            parts.append(unpack.decompress(piece))
            if unpack.eof:
                rest = unpack.unused_data
                source.back(rest)
                return b"", b"".join(parts), ""
            piece = source.read()
            if not piece:
                return b"".join(taken), None, "the archive ends inside a frame"
            taken.append(piece)
    except zstandard.ZstdError as error:
        return b"".join(taken), None, f"the frame does not decode: {error}"


def _seek(source: _Source, tail: bytes) -> bool:
    """Moves to the next magic; False at the end."""
    while piece := source.read():
        piece = tail + piece
        near = [p for p in (piece.find(m) for m in (_FRAME, *_SKIPPABLE)) if p >= 0]
        if near:
            source.back(piece[min(near):])
            return True
        tail = piece[-3:]
    return False


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("a header line has no colon")
        out[name.strip().lower()] = value.strip()
    return out


def checked(content: bytes) -> dict:
    """The fields of the one record in a frame; ValueError says what is wrong."""
    if not content.startswith(b"WARC/1."):
        raise ValueError("no WARC record")
    head, end, rest = content.partition(b"\r\n\r\n")
    if not end:
        raise ValueError("the header does not end")
    warc = _headers(head)
    missing = [name for name in _MANDATORY if not warc.get(name)]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}")
    if not warc["content-length"].isdigit():
        raise ValueError("content-length is no number")
    size = int(warc["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, its header says {size}")
    kind, digest = warc["warc-type"], warc.get("warc-payload-digest", "").removeprefix("sha1:") or None
    out = {
        "record_type": kind, "record_id": warc["warc-record-id"], "refers_to": warc.get("warc-refers-to"),
        "target_uri": warc.get("warc-target-uri"), "payload_digest": digest, "payload_bytes": None, "payload": None,
    }
    if kind in ("response", "revisit"):
        http, end, payload = rest[:size].partition(b"\r\n\r\n")
        if not end:
            raise ValueError("the HTTP head does not end")
        stated = _headers(http).get("content-length")
        if kind == "response":
            if stated is not None and stated != str(len(payload)):
                raise ValueError(f"the payload has {len(payload)} bytes, its head says {stated}")
            if digest and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                raise ValueError("the payload does not have its digest")
            out |= {"payload": payload, "payload_bytes": len(payload)}
        else:
            if not digest or not out["refers_to"]:
                raise ValueError("a revisit needs a digest and a record to refer to")
            out["payload_bytes"] = int(stated) if stated and stated.isdigit() else None
    return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: pa.Schema):
        self.path, self.payloads, self.schema = options["path"], options.get("payloads", "true").lower() == "true", schema

    def partitions(self) -> list[InputPartition]:
        """The archives of the manifest; those of a folder without one; or the one file."""
        from pyarrow import fs

        system, folder = _place(self.path)
        if system.get_file_info(folder).type == fs.FileType.File:
            return [InputPartition(folder)]
        if system.get_file_info(f"{folder}/{_MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{folder}/{_MANIFEST}", compression=None) as f:
                return [InputPartition(f"{folder}/{name}") for name in json.loads(f.read())] or [InputPartition(None)]
        found = system.get_file_info(fs.FileSelector(folder))
        return [InputPartition(i.path) for i in found if i.path.endswith(".warc.zst")] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        system, _ = _place(self.path)
        rows, size = [], 0
        with system.open_input_stream(partition.value, compression=None) as stream:
            for ordinal, (offset, length, content, error) in enumerate(frames(stream)):
                row = {"archive": partition.value, "ordinal": ordinal, "offset": offset, "length": length, "error": error}
                if content is not None:
                    try:
                        row |= checked(content)
                    except ValueError as wrong:
                        row["error"] = str(wrong)
                if not self.payloads:
                    row["payload"] = None
                rows.append(row)
                size += len(row.get("payload") or b"")
                if len(rows) >= 5000 or size > 16 * _CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, self.schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


class WarcZstd(DataSource):
    """Options: path; for writing date, dictionary (base64), rollBytes; for reading payloads (true or false)."""

    @classmethod
    def name(cls) -> str:
        return "warc_zstd"

    def schema(self) -> str:
        return READ

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))

    def reader(self, schema) -> _Reader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return _Reader(dict(self.options), to_arrow_schema(schema))


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """A record per page under ``path``; payloads of ``least_bytes`` or more are kept once.

    Of the pages with an equal payload the one with the smallest id is the response
    and the others are revisits. Only digests of payloads are grouped, and only the
    groups of two and more, written as a table, meet the pages again.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcZstd)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).cast("binary").alias("payload"))
    # Equality goes by SHA-256, as different payloads with one SHA-1 are known.
    keyed = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = (
        keyed.where(F.octet_length("payload") >= least_bytes).groupBy("key")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("members")).where("members > 1")
    )
    table = f"{shared_folder(spark)}/warc-groups-{uuid.uuid4().hex}"
    groups.write.parquet(table)
    revisit = F.col("members").isNotNull() & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    (
        keyed.join(spark.read.parquet(table), "key", "left")
        .select(
            "page_id", "url", "payload", F.unhex(F.sha1("payload")).alias("digest"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            F.when(revisit, F.col("first")).alias("refers_to"))
        .write.format("warc_zstd").mode("append").option("path", path)
        .option("dictionary", base64.b64encode(train_dictionary(rows, F.col("payload"))).decode()).save()
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of an archive, or of all that a folder's manifest lists, and a row with ``error`` for each broken place."""
    spark.dataSource.register(WarcZstd)
    return spark.read.format("warc_zstd").option("path", path).option("payloads", str(payloads).lower()).load()


def page_of(urn: Column) -> Column:
    """The page id in a record id; null if it has none."""
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
