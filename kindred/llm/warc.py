"""WARC archives of one Zstandard frame per record, with a shared dictionary.

An archive starts with a skippable frame that holds the dictionary; then every
record is a frame of its own, so a reader can start at any record. Archives are
written by the tasks into the shared folder under names of their own; a table
lists those of finished tasks, so files of lost attempts are never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import materialize, new_work_path

# The magic number of the dictionary's skippable frame, of the range
# of skippable frames, of a data frame, and the profile name of revisit records.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
DATA_FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"

#: Bytes after which a task begins a new archive.
ARCHIVE_BYTES = 256 << 20
#: Rows and bytes of each that the dictionary is trained on at most; it changes the size of archives, nothing else.
DICTIONARY_ROWS = 400
DICTIONARY_ROW_BYTES = 16_384
DICTIONARY_BYTES = 32_768
READ_BYTES = 1 << 18
BATCH_ROWS = 512

_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_NAME = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+\Z")
_RECORDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class ArchiveError(ValueError):
    """An archive breaks the format; the message names archive and record."""


@dataclass
class Record:
    type: str
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _escaped(url: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_RECORDS, f'page:{page_id}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: a response with its payload, or a revisit without."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_escaped(url) if url else f'urn:page:{page_id}'}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
        if refers_to is not None:
            lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[str], where: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not _NAME.match(name):
            raise ArchiveError(f"{where}: bad header line {line[:80]!r}")
        found[name.lower()] = value.strip()
    return found


def _length(headers: dict[str, str], where: str) -> int:
    value = headers.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise ArchiveError(f"{where}: Content-Length {value[:40]!r}")
    return int(value)


def parse_record(data: bytes, where: str) -> Record:
    """Checks version, headers, lengths, the record's end and the payload's digest."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        raise ArchiveError(f"{where}: headers do not end")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ArchiveError(f"{where}: version line {version[:40]!r}")
    headers = _headers(lines, where)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(headers)
    if missing:
        raise ArchiveError(f"{where}: without {', '.join(sorted(missing))}")
    size = _length(headers, where)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: block of {len(rest) - 4} bytes, Content-Length {size}")
    record = Record(headers["warc-type"], headers, rest[:size])
    if record.type in ("response", "revisit"):
        http_head, mark, record.payload = record.block.partition(b"\r\n\r\n")
        if not mark:
            raise ArchiveError(f"{where}: HTTP headers do not end")
        status, *http_lines = http_head.decode("latin-1").split("\r\n")
        if not status.startswith("HTTP/"):
            raise ArchiveError(f"{where}: status line {status[:40]!r}")
        record.http = _headers(http_lines, where)
        if record.type == "response":
            if len(record.payload) != _length(record.http, where):
                raise ArchiveError(f"{where}: payload of {len(record.payload)} bytes")
            said = headers.get("warc-payload-digest")
            if said and said != f"sha256:{hashlib.sha256(record.payload).hexdigest()}":
                raise ArchiveError(f"{where}: the payload's digest differs")
    return record


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def read_records(stream, name: str) -> Iterator[Record]:
    """The records of an open archive, one frame at a time."""
    buffer, dictionary = b"", b""

    def fill(n: int) -> bool:
        nonlocal buffer
        while len(buffer) < n:
            more = stream.read(max(READ_BYTES, n - len(buffer)))
            if not more:
                return False
            buffer += more
        return True

    n_records, decompressor = 0, zstandard.ZstdDecompressor()
    first = True
    while fill(1):
        where = f"{name}, record {n_records}"
        if not fill(4):
            raise ArchiveError(f"{where}: {len(buffer)} bytes are left over")
        (magic,) = struct.unpack_from("<I", buffer)
        if magic in SKIPPABLE_FRAMES:
            if not fill(8):
                raise ArchiveError(f"{where}: skippable frame is cut off")
            (size,) = struct.unpack_from("<I", buffer, 4)
            if not fill(8 + size):
                raise ArchiveError(f"{where}: skippable frame is cut off")
            if first and magic == DICTIONARY_FRAME:
                dictionary = buffer[8 : 8 + size]
                if dictionary.startswith(DATA_FRAME):
                    dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
            buffer = buffer[8 + size :]
        else:
            frame, parts = decompressor.decompressobj(), []
            try:
                while not frame.eof:
                    if not fill(1):
                        raise ArchiveError(f"{where}: frame is cut off")
                    parts.append(frame.decompress(buffer))
                    buffer = frame.unused_data if frame.eof else b""
            except zstandard.ZstdError as error:
                raise ArchiveError(f"{where}: {error}") from error
            yield parse_record(b"".join(parts), where)
            n_records += 1
        first = False


class _ArchiveWriter:
    def __init__(self, folder: str, dictionary: bytes, level: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.uri = folder
        self.dictionary = dictionary
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=True)
        self.stream, self.name = None, ""
        self.bytes = self.records = 0

    def add(self, record: bytes) -> None:
        if self.stream is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.fs.create_dir(self.folder, recursive=True)
            self.stream = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            if self.dictionary:
                self.stream.write(dictionary_frame(self.dictionary))
            self.bytes = self.records = 0
        frame = self.compressor.compress(record)
        self.stream.write(frame)
        self.bytes += len(frame)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.stream.close()
        self.stream = None
        return f"{self.uri}/{self.name}", self.records, self.bytes


def train_dictionary(pages: DataFrame, html_col: str) -> bytes:
    """Dictionary from a bounded sample of payloads; empty where the sample is too small."""
    sample = pages.select(F.substring(F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8"), 1, DICTIONARY_ROW_BYTES).alias("b"))
    rows = [bytes(row.b) for row in sample.limit(DICTIONARY_ROWS).collect()]
    rows = [row for row in rows if len(row) >= 64]
    if len(rows) < 16:
        return b""
    try:
        return zstandard.train_dictionary(max(256, min(DICTIONARY_BYTES, sum(map(len, rows)) // 10)), rows).as_bytes()
    except zstandard.ZstdError:  # the sample has too little in it
        return b""


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 3,
) -> DataFrame:
    """Writes one record per row and returns the list of archives: archive, records, bytes.

    Of rows with equal payloads of at least ``min_revisit_bytes`` the one with the
    smallest id becomes a response and the others revisits of it.

    Defined cases: a null html is an empty payload, always a response. A null url
    becomes ``urn:page:<id>``. Rows repeated with the smallest id are responses
    all. A row with a null id comes after all others; if every id of a payload is
    null, all are responses. An empty table writes no archive. Other columns are
    not read.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        payload.alias("payload"),
    )
    # only payloads that several rows share, one narrow row each
    first = (
        rows.filter(F.length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    marked = rows.join(first, "digest", "left").select(
        "page_id",
        "url",
        "digest",
        "payload",
        "first_id",
        (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"),
    )
    dictionary = train_dictionary(pages, html_col)

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = _ArchiveWriter(folder, dictionary, level)
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                page = None if pd.isna(row.page_id) else int(row.page_id)
                to = int(row.first_id) if row.revisit else None
                writer.add(record_bytes(page, row.url, row.payload, row.digest, to, row.revisit, date))
                if writer.bytes >= ARCHIVE_BYTES:
                    done.append(writer.close())
        if writer.stream is not None:
            done.append(writer.close())
        yield pd.DataFrame(done, columns=["archive", "records", "bytes"])

    return materialize(marked.mapInPandas(written, "archive string, records bigint, bytes bigint"), "archives")


def read_archives(archives: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, payload.

    Every archive is one task's stream of frames, so memory holds one record and
    one batch of rows. A damaged archive fails the job with its name and record.
    """
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    columns = [part.split()[0] for part in schema.split(", ")] + ["payload"] * with_payload

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=columns, dtype=object)
            return out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

        for batch in batches:
            for uri in batch["archive"]:
                fs, path = pafs.FileSystem.from_uri(uri)
                rows: list[tuple] = []
                held = 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for record in read_records(stream, uri):
                        headers = record.headers
                        response = record.type == "response"
                        digest = hashlib.sha256(record.payload).hexdigest() if response else headers["warc-payload-digest"].removeprefix("sha256:")
                        n_bytes = len(record.payload) if response else _length(record.http, uri)
                        ids = [int(headers[k]) if k in headers else None for k in ("x-page-id", "x-refers-to-page")]
                        rows.append((ids[0], headers.get("warc-target-uri"), n_bytes, digest, record.type, ids[1], *[record.payload] * with_payload))
                        held += len(record.payload) * with_payload
                        if len(rows) >= BATCH_ROWS or held > 16 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                if rows:
                    yield frame(rows)

    n_archives = max(1, archives.count())
    spread = archives.select("archive").repartition(n_archives)
    return spread.mapInPandas(read, schema + ", payload binary" * with_payload)


def archive_folder(spark) -> str:
    return new_work_path(spark, "warc")
