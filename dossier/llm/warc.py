"""Web pages as WARC archives compressed with Zstandard, written and read back.

An archive is a file whose first frame is skippable and holds a dictionary; each
record after it is one frame of its own, compressed with that dictionary. A
payload that occurs more than once is stored once, as a response; the others are
revisits of it, without payload.

Defined results: a null payload is empty; a null address leaves the header of
the target out and reads back as null; a row without an id is a response that
nothing refers to; rows that repeat the largest id of a payload are responses
all; an empty table makes no archive and reads as no rows; columns other than
the three named do not go into archives.
"""

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.operators.staging import scratch_dir, staged

# The format's magic numbers, version and header names.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"

# Pages carry no date of their own.
NO_DATE = "1970-01-01T00:00:00Z"
ID = "urn:page:"

# An archive is closed once it has so many bytes, so that reading spreads over tasks.
ARCHIVE_BYTES = 64 << 20
# The dictionary is trained on the first records of its archive: bounds of the sample and of the result.
SAMPLE_RECORDS = 200
SAMPLE_BYTES = 4 << 10
DICTIONARY_BYTES = 16 << 10

RECORD = (
    "archive string, offset bigint, record_type string, record_id string, page_id bigint, "
    "refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary, error string"
)
# Bytes of archives that one task reads, about.
READ_BYTES = 64 << 20
_PAGE_BATCH = 256


class ArchiveError(ValueError):
    """An archive that breaks the format."""


class Record(NamedTuple):
    """One record as it stands in an archive."""

    offset: int
    headers: dict[str, str]
    block: bytes


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _open(path: str, write: bool = False) -> BinaryIO:
    """A file in any store that pyarrow knows, as it is: by its name, pyarrow would compress it once more."""
    store, inner = _place(path)
    opened = store.open_output_stream if write else store.open_input_stream
    return opened(inner, compression=None)


def _made(path: str) -> None:
    store, inner = _place(path)
    store.create_dir(inner, recursive=True)


def _named(page_id: int | None) -> str:
    return f"<{ID}{'none' if page_id is None else page_id}>"


def _id_of(name: str | None) -> int | None:
    number = re.fullmatch(rf"<{ID}(-?[0-9]+)>", name or "")
    return int(number[1]) if number else None


def _header(url: str) -> str:
    """An address on one header line: control characters as percent codes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda x: f"%{ord(x[0]):02X}", url)


def encode_record(page_id, url, payload: bytes, refers_to, date: str = NO_DATE) -> bytes:
    """A response, or with ``refers_to`` a revisit, which keeps the HTTP headers but no payload."""
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    http = "\r\n".join(head).encode()
    block = http + _END + (payload if refers_to is None else b"")
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _named(page_id),
        "WARC-Date": date,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
    }
    if url is not None:
        headers["WARC-Target-URI"] = _header(url)
    if refers_to is not None:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = _named(refers_to)
    headers["Content-Length"] = str(len(block))
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in headers.items()]]
    return b"\r\n".join(lines) + _END + block + _END


def parse_record(text: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises ``ArchiveError`` on anything but one whole sound record."""
    head, found, rest = text.partition(_END)
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ArchiveError("no record of a known version")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name:
            raise ArchiveError(f"a header line without a name: {line[:80]!r}")
        if name.lower() in headers:
            raise ArchiveError(f"the header {name} stands twice")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ArchiveError(f"the header {name} is missing")
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit():
        raise ArchiveError("the length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + len(_END) or rest[length:] != _END:
        raise ArchiveError(f"a block of {len(rest) - len(_END)} bytes where the header says {length}")
    block = rest[:length]
    if headers.get("warc-block-digest", "") not in ("", f"sha1:{digest(block)}"):
        raise ArchiveError("the block does not match its digest")
    return headers, block


def parse_page(headers: dict[str, str], block: bytes) -> dict:
    """The page of a response or revisit; checks the HTTP length and the payload's digest."""
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"a record of type {kind}")
    head, found, payload = block.partition(_END)
    length = re.search(rb"(?im)^content-length: *([0-9]+)\r?$", head)
    if not found or not length:
        raise ArchiveError("a block without HTTP headers")
    size, named = int(length[1]), headers.get("warc-payload-digest", "")
    if not named.startswith("sha1:"):
        raise ArchiveError("no digest of the payload")
    if kind == "revisit":
        if payload or _id_of(headers.get("warc-refers-to")) is None:
            raise ArchiveError("a revisit with a payload or without the record it refers to")
    elif len(payload) != size or named != f"sha1:{digest(payload)}":
        raise ArchiveError("the payload does not match its length or digest")
    return {
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "page_id": _id_of(headers["warc-record-id"]),
        "refers_to": _id_of(headers.get("warc-refers-to")) if kind == "revisit" else None,
        "url": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": named.removeprefix("sha1:"),
        "payload": payload if kind == "response" else None,
    }


def _trained(records: list[bytes]) -> bytes:
    """A dictionary for records like these; empty if there are too few to train one."""
    samples = [x[:SAMPLE_BYTES] for x in records]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class _Writer:
    """One archive at a time; the first records wait in memory until the dictionary is trained."""

    def __init__(self, folder: str):
        self.folder, self.finished = folder, []
        self._begin()

    def _begin(self):
        self.path, self.file, self.waiting = f"{self.folder}/{uuid.uuid4().hex}.warc.zst", None, []
        self.size = self.records = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.file is None:
            self.waiting.append(record)
            if len(self.waiting) >= SAMPLE_RECORDS or sum(map(len, self.waiting)) >= ARCHIVE_BYTES // 4:
                self._start()
        else:
            self._frame(record)
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def _start(self) -> None:
        learnt = _trained(self.waiting)
        self.file = _open(self.path, write=True)
        shared = zstandard.ZstdCompressionDict(learnt) if learnt else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        self._write(struct.pack("<II", SKIPPABLE_MAGIC, len(learnt)) + learnt)
        for record in self.waiting:
            self._frame(record)
        self.waiting = []

    def _frame(self, record: bytes) -> None:
        self._write(self.compressor.compress(record))

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def close(self) -> None:
        if not self.records:
            return
        if self.file is None:
            self._start()
        self.file.close()
        self.finished.append((self.path, self.records, self.size))
        self._begin()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of ``page_id``, ``url``, ``payload`` and ``refers_to``; their paths, records and bytes.

    A task writes under names of its own and hands on the names; the list is a
    stored table, so it names the files of the attempts that succeeded, and what
    a lost attempt left behind is never read.
    """
    _made(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder)
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*batch.columns, strict=True):
                payload = payload.as_py() or b""
                writer.add(encode_record(page_id.as_py(), url.as_py(), payload, refers_to.as_py()))
        writer.close()
        yield pa.RecordBatch.from_pylist(
            [{"archive": x, "records": n, "bytes": size} for x, n, size in writer.finished],
            pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    rows = pages.select("page_id", "url", "payload", "refers_to")
    return staged(rows.mapInArrow(write, "archive string, records bigint, bytes bigint"), "archives")


def read_records(file: BinaryIO, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and text of each frame of an archive, one in memory at a time.

    The dictionary comes from the leading skippable frame, which may hold it
    compressed. A frame that is cut short, or bytes that begin no frame, raise
    ``ArchiveError``.
    """
    data, offset = file.read(8), 0
    decompressor = zstandard.ZstdDecompressor()
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE_MAGIC:
        size = struct.unpack("<I", data[4:])[0]
        learnt = file.read(size)
        if len(learnt) < size:
            raise ArchiveError("the dictionary is cut short")
        if learnt.startswith(FRAME_MAGIC):
            learnt = zstandard.ZstdDecompressor().decompress(learnt, max_output_size=1 << 27)
        if learnt:
            decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learnt))
        data, offset = b"", 8 + size
    while True:
        data = data or file.read(chunk)
        if not data:
            return
        frame, parts, used = decompressor.decompressobj(), [], 0
        while not frame.eof:
            if not data:
                raise ArchiveError(f"the frame at {offset} is cut short")
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as error:
                raise ArchiveError(f"the frame at {offset} cannot be decoded: {error}") from error
            used += len(data)
            data = frame.unused_data if frame.eof else file.read(chunk)
        used -= len(data)
        yield offset, b"".join(parts)
        offset += used


def read_archive(path: str, strict: bool = True) -> Iterator[dict]:
    """The pages of one archive. If not ``strict``, an unsound record is a row with ``error``.

    After a frame that cannot be decoded no further one can be found, so its row is the last.
    """
    empty = dict.fromkeys(x.split()[0] for x in RECORD.split(", "))
    with _open(path) as file:
        frames = read_records(file)
        while True:
            offset = None
            try:
                offset, text = next(frames)
                found = parse_page(*parse_record(text))
            except StopIteration:
                return
            except ArchiveError as error:
                if strict:
                    raise ArchiveError(f"{path}, record at {offset}: {error}") from error
                found = {"error": str(error)}
            yield empty | {"archive": path, "offset": offset} | found


def read_archives(archives: DataFrame, strict: bool = True, payload: bool = True) -> DataFrame:
    """The records of the archives named by ``archive``, each archive read by one task, record by record."""
    schema = pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
         ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in read_archive(path, strict):
                    rows.append(row if payload else row | {"payload": None})
                    size += len(row["payload"] or b"") * payload
                    if len(rows) >= _PAGE_BATCH or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # Names are tiny, so Spark would put them all into one partition, were it not told how many there are to be.
    return archives.select("archive").repartition(_readers(archives)).mapInArrow(read, RECORD)


def _readers(archives: DataFrame) -> int:
    """How many tasks read: one for each ``READ_BYTES``, at least as many as run at once, at most one for each archive."""
    size = F.sum("bytes") if "bytes" in archives.columns else F.lit(None).cast("bigint")
    number, total = archives.agg(F.count(F.lit(1)), size).first()
    wanted = number if total is None else -(-total // READ_BYTES)
    return max(1, min(number, max(wanted, archives.sparkSession.sparkContext.defaultParallelism)))


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` as bytes, and ``refers_to``: the largest id with an equal payload.

    Only payloads that occur more than once take part in the join, whose hot
    keys adaptive execution splits.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload")
    ).withColumn("_digest", F.sha1("payload"))
    shared = (
        rows.groupBy("_digest")
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1 AND _last IS NOT NULL")
        .select("_digest", "_last")
    )
    refers_to = F.when(F.col("page_id") != F.col("_last"), F.col("_last"))
    return rows.join(staged(shared, "payloads"), "_digest", "left").select(
        "page_id", "url", "payload", refers_to.alias("refers_to")
    )


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written to archives below ``folder`` and read back, one row for each record."""
    folder = f"{scratch_dir(spark, folder)}/archives-{uuid.uuid4().hex}"
    return read_archives(write_archives(with_revisits(pages), folder), payload=False)
