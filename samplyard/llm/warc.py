"""WARC archives as seekable Zstandard bundles.

An archive is a row of independent frames, each with whole records of about ``FRAME_BYTES`` together,
and a seek table in a skippable frame at its end, so any Zstandard reader reads the whole of it and
one that knows the table can start at any frame. The index maps the identifier of a record to its
archive, frame, and offset and length inside the frame.

Tasks write archives into a folder that all executors share. Each attempt of a task writes under a name
of its own and the index names the archives of the attempts that count, so a lost executor leaves at
most files that nothing refers to. The folder is a local path or an address that Arrow's file systems
open.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplyard.llm.tables import partitions, staged
from samplyard.operators.joins import keyed_join
from samplyard.session import work_path

FRAME_BYTES = 256 * 1024
ARCHIVE_BYTES = 256 * 1024 * 1024
#: Equal payloads of so many bytes are written once.
REVISIT_BYTES = 1000
LEVEL = 3

# Fixed values of the seekable format: a skippable frame of (compressed size, size, checksum) entries
# and a footer of frame count, descriptor (checksums: bit 7) and magic number.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
CHECKSUMS = 0x80

INDEX = "record_id string, page_id long, archive string, frame int, offset long, length long"
CONTENT = (
    "archive string, frame int, offset long, record_id string, record_type string, page_id long, url string, "
    "refers_record string, payload_digest string, payload_bytes long, payload binary"
)
#: The profile of a revisit record whose payload is that of an earlier response.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# ---- records -------------------------------------------------------------------------------

def record_name(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row}')}>"


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record; headers without a value are left out."""
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def target(url: bytes | None) -> str | None:
    """The address with what a header can't hold, or an address shouldn't, in percent form."""
    return None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def page_record(row: dict, date: str) -> tuple[str, bytes]:
    """Identifier and bytes of the record of a page."""
    payload, refers = row["payload"], row["leader"]
    name = record_name(row["page_id"], row["row"])
    digest = "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", name),
        ("WARC-Date", date),
        ("WARC-Target-URI", target(row["url"])),
        ("WARC-Payload-Digest", digest),
        ("X-Page-ID", None if row["page_id"] is None else str(row["page_id"])),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers is None:
        block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        headers += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", record_name(refers["page_id"], refers["row"])),
            ("WARC-Refers-To-Target-URI", target(refers["url"])),
        ]
        block = (head + "\r\n").encode()
    return name, record(headers, block)


def parse(data: memoryview, at: int) -> tuple[dict[str, str], memoryview, int]:
    """Headers and block of the record at an offset, and where the next one starts."""
    window = 2048
    while (end := bytes(data[at : at + window]).find(b"\r\n\r\n")) < 0:
        if at + window >= len(data):
            raise ValueError(f"no end of the record headers at {at}")
        window *= 2
    version, *lines = bytes(data[at : at + end]).decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    start = at + end + 4
    stop = start + int(headers["Content-Length"])
    if bytes(data[stop : stop + 4]) != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end where it says")
    return headers, data[start:stop], stop + 4


def content(headers: dict[str, str], block: memoryview) -> dict:
    """The facts of a page's record; a response has to have the payload its digest tells."""
    kind = headers["WARC-Type"]
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    facts = {
        "record_id": headers["WARC-Record-ID"],
        "record_type": kind,
        "page_id": int(headers["X-Page-ID"]) if "X-Page-ID" in headers else None,
        "url": headers.get("WARC-Target-URI"),
        "refers_record": headers.get("WARC-Refers-To"),
        "payload_digest": digest,
        "payload_bytes": None,
        "payload": None,
    }
    if kind == "response":
        payload = block[bytes(block[:1024]).index(b"\r\n\r\n") + 4 :]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {facts['record_id']} does not have its digest")
        facts |= {"payload": payload, "payload_bytes": len(payload)}
    return facts


# ---- archives ------------------------------------------------------------------------------

class Archive:
    """An archive being written: records in, their frame and offset out."""

    def __init__(self, path: str, frame_bytes: int = FRAME_BYTES):
        files, place = file_system(path)
        files.create_dir(place.rpartition("/")[0], recursive=True)
        self.path, self.frame_bytes, self.size, self.entries, self.pending = path, frame_bytes, 0, [], bytearray()
        self.out = files.open_output_stream(place, compression=None)

    def add(self, data: bytes) -> tuple[int, int]:
        # A record longer than a frame has one of its own.
        if self.pending and len(self.pending) + len(data) > self.frame_bytes:
            self.flush()
        place = len(self.entries), len(self.pending)
        self.pending += data
        return place

    def flush(self) -> None:
        if self.pending:
            data = bytes(self.pending)
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(data)
            self.entries.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.out.write(frame)
            self.size += len(frame)
            self.pending = bytearray()

    def close(self) -> None:
        self.flush()
        table = b"".join(ENTRY.pack(*e) for e in self.entries) + FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Frames:
    """The frames of an archive, each read on its own."""

    def __init__(self, path: str):
        files, place = file_system(path)
        self.file, self.path = files.open_input_file(place), path
        size = self.file.size()
        if size < FOOTER.size + 8:
            raise ValueError(f"{path} has no seek table")
        count, descriptor, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        length = count * ENTRY.size + FOOTER.size
        if magic != SEEKABLE or descriptor != CHECKSUMS or size < length + 8:
            raise ValueError(f"{path} has no seek table")
        data = self.file.read_at(length + 8, size - length - 8)
        if struct.unpack("<II", data[:8]) != (SKIPPABLE, length):
            raise ValueError(f"{path} has no seek table")
        self.entries = list(ENTRY.iter_unpack(data[8 : 8 + count * ENTRY.size]))
        self.starts = [0]
        for packed, _, _ in self.entries:
            self.starts.append(self.starts[-1] + packed)

    def __len__(self) -> int:
        return len(self.entries)

    def read(self, frame: int) -> memoryview:
        packed, size, checksum = self.entries[frame]
        raw = self.file.read_at(packed, self.starts[frame])
        data = zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {frame} of {self.path} is damaged")
        return memoryview(data)


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def with_leaders(pages: DataFrame) -> DataFrame:
    """``row, page_id, url, payload, digest, leader``: ``leader`` is the response that a revisit points at.

    Copies are counted before anything is joined, and only payloads that occur twice have a row on the
    right side; the join is on (hash, digest), so adaptive execution can split a payload that a third of
    all rows share, and rows without a partner spread out.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", F.col("url").cast("binary").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"), F.monotonically_increasing_id().alias("row")
    )
    # Two digests together tell payloads apart; short ones take no part.
    key = F.when(F.octet_length("payload") >= REVISIT_BYTES, F.concat("digest", F.md5("payload")))
    rows = staged(rows.withColumn("key", key), "pages")
    best = F.max(F.struct("page_id", "row", "url")).alias("best")
    copied = rows.filter("key IS NOT NULL").groupBy("key").agg(best, F.count("*").alias("n")).filter("n > 1").drop("n")
    spread = F.xxhash64(F.coalesce("key", F.col("row").cast("string")))
    joined = rows.withColumn("spread", spread).join(copied.withColumn("spread", F.xxhash64("key")), ["spread", "key"], "left")
    leader = F.when(F.col("best")["row"] != F.col("row"), F.col("best")).alias("leader")
    return joined.select("row", "page_id", "url", "payload", "digest", leader)


def write_archives(
    pages: DataFrame,
    folder: str,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record for every row of ``page_id, url, html`` and return the index, one row a record.

    Of rows with equal payloads of ``REVISIT_BYTES`` or more, the one with the largest page_id is the
    response (of several such rows any one, of rows without page_id none unless all lack it); the others are
    revisits that point at it. A null html is an empty payload; a null url or page_id leaves the header
    out; characters that a header can't hold are in percent form. Repeated rows are records of their
    own. A payload longer than a frame is a frame of its own. An empty table writes no archive. Other
    columns are left out. The archives are written now, once, however often the index is read.
    """
    run, schema = uuid.uuid4().hex, _arrow(INDEX)
    info = [("WARC-Type", "warcinfo"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, archive, number = uuid.uuid4().hex, None, 0
        for batch in batches:
            found = []
            for i in range(batch.num_rows):  # one row at a time: a payload may be long
                row = batch.slice(i, 1).to_pylist()[0]
                if archive is None:
                    archive = Archive(f"{folder.rstrip('/')}/{run}-{attempt}-{number}.warc.zst", frame_bytes)
                    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, archive.path)}>"
                    archive.add(record([*info, ("WARC-Record-ID", name)], b"software: samplyard\r\n"))
                name, data = page_record(row, date)
                frame, offset = archive.add(data)
                found.append((name, row["page_id"], archive.path, frame, offset, len(data)))
                if archive.size >= archive_bytes:
                    archive.close()
                    archive, number = None, number + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema) if found else _table([], schema)
        if archive is not None:
            archive.close()

    return staged(with_leaders(pages).mapInArrow(write, INDEX), "index")


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives an index names, in full: ``CONTENT``, a task an archive.

    The whole archive is read, frame by frame, and whatever does not have its checksum or digest fails
    the job. ``payload_bytes`` and ``payload`` are null for revisits, ``payload`` for all without
    ``payloads``.
    """
    schema = _arrow(CONTENT)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                frames = Frames(path)
                for number in range(len(frames)):
                    data, at, rows = frames.read(number), 0, []
                    while at < len(data):
                        headers, block, following = parse(data, at)
                        if headers["WARC-Type"] != "warcinfo":
                            facts = content(headers, block)
                            facts["payload"] = bytes(facts["payload"]) if payloads and facts["payload"] is not None else None
                            rows.append(facts | {"archive": path, "frame": number, "offset": at})
                        at = following
                    yield _table(rows, schema)

    # Dealt in turn: the partitions of the distinct names are few, and by the same key they would stay.
    archives = index.select("archive").distinct().repartition(partitions(index.sparkSession))
    return archives.mapInArrow(read, CONTENT)


def fetch_records(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``, read from their frames alone: ``CONTENT``.

    Identifiers that the index lacks give no row, repeated ones one for each place the index has.
    """
    schema = _arrow(CONTENT)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, opened, data = None, None, None
        for batch in batches:
            for path, number, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "frame", "offset", "length"))):
                if frames is None or frames.path != path:
                    frames, opened = Frames(path), None
                if opened != number:
                    data, opened = frames.read(number), number
                headers, block, following = parse(data, offset)
                if following != offset + length:
                    raise ValueError(f"the index and {path} disagree at {number}:{offset}")
                facts = content(headers, block)
                facts["payload"] = None if facts["payload"] is None else bytes(facts["payload"])
                yield _table([facts | {"archive": path, "frame": number, "offset": offset}], schema)

    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    ordered = places.repartition(partitions(index.sparkSession), "archive", "frame").sortWithinPartitions("archive", "frame", "offset")
    return ordered.select("archive", "frame", "offset", "length").mapInArrow(fetch, CONTENT)


def resolved(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of read records.

    A revisit takes the length of its payload and ``refers_to`` from the response it points at; where that
    one is missing, or has another digest, both are null.
    """
    rows = records.select("record_id", "record_type", "page_id", "refers_record", "payload_digest", "payload_bytes")
    responses = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_record"),
        F.col("page_id").alias("target_page"),
        F.col("payload_digest").alias("target_digest"),
        F.col("payload_bytes").alias("target_bytes"),
    )
    # Read once as a list of revisited records, so that the join's right side has only these.
    pointed = keyed_join(responses, rows.select("refers_record").filter("refers_record IS NOT NULL").distinct(), "refers_record", "left_semi")
    joined = keyed_join(rows, pointed, "refers_record")
    same = F.col("target_digest") == F.col("payload_digest")
    return joined.select(
        "page_id",
        F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.when(same, F.col("target_bytes"))).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(same, F.col("target_page")).alias("refers_to"),
    )


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives, read all of these back and tell what they hold; see
    :func:`write_archives` and :func:`resolved`. Without a folder, one in the shared folder is made."""
    index = write_archives(pages, folder or work_path(pages.sparkSession, "warc"))
    return resolved(staged(read_archives(index, payloads=False).drop("payload"), "records"))


ORACLE = f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload, row_number() OVER () AS n FROM pages),
ranked AS (
  SELECT *, strlen(payload) >= {REVISIT_BYTES} AS long,
         row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST, n) AS place,
         max(page_id) OVER (PARTITION BY payload) AS leader
  FROM rows
)
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN long AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN long AND place > 1 THEN leader END AS refers_to
FROM ranked
"""
