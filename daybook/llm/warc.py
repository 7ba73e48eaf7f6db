"""WARC archives of web pages, compressed record by record with a shared Zstandard dictionary.

An archive file starts with a skippable frame that holds the dictionary (itself compressed or not), then
has one frame per record; other skippable frames are passed over. Files without a dictionary frame are read as well.

**Writing.** Each page is a ``response`` record whose block is an HTTP message with the html in UTF-8 as its
payload (null: empty). Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest
``page_id`` is the response; the others are ``revisit`` records that refer to it and hold no payload. Pages that share
the smallest id, as repeated rows do, are all responses; a page without id refers to the others, and is a response
where none has an id. A payload that holds more than a thousandth of all rows is looked up in a broadcast
table of at most a thousand, so its rows are not gathered in one task. Spark's text writer puts the files
where the path says, in any file system: each line is a frame, and the line separator an empty skippable frame.
Control characters and spaces in URLs are written percent-encoded; a null URL is left out. Rows that repeat
all three columns give equal records. Columns other than ``page_id``, ``url`` and ``html`` are not read.

**Reading.** Each frame is decoded by itself and must hold one record: version, mandatory fields, a
block of the length stated, the closing line ends and nothing else, a payload of the length and SHA-256 stated. A
revisit's payload length and digest are those of the payload it refers to. What does not hold raises, or with
``strict=False`` becomes a row that has ``problem`` and the rest empty.

The dictionary is trained on at most ``SAMPLES`` pages, chosen by a hash, ``SAMPLE_BYTES`` of each; it changes
sizes, not contents. Too few pages to train on: no dictionary. No pages: no records.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.rows import stored

LEAST_BYTES = 100
SAMPLES = 400
SAMPLE_BYTES = 8192
DICTIONARY_BYTES = 16384
LEVEL = 3
#: Archive files end after about so many bytes.
FILE_BYTES = 32 << 20
#: Payloads with more than this share of all rows are few enough to broadcast.
HOT_SHARE = 1000

# --- fixed values of the formats ---
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values ---

#: An empty skippable frame, in ASCII as a line separator must be.
_EMPTY_FRAME = struct.pack("<II", SKIPPABLE[0], 0).decode("ascii")
_PAGE_ID = "<urn:daybook:page:%s>"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_OUT_BYTES = 8 << 20
_FED = 1 << 14

_FRAMES = "volume int, number long, frame binary"
_RECORDS = (
    "path string, record_id string, record_type string, url string, date string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to string, problem string"
)


# --- records --------------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return _PAGE_ID % ("" if page_id is None else page_id)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC/1.1"), *(f"{name}: {value}" for name, value in fields), f"Content-Length: {len(block)}"]
    return b"".join(("\r\n".join(head).encode(), b"\r\n\r\n", block, b"\r\n\r\n"))


def page_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """The record of a page: a revisit if ``refers_to`` names another page."""
    revisit = refers_to is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record(fields, http.encode() + (b"" if revisit else payload))


class Broken(ValueError):
    """What a record or archive lacks."""


def _fields(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Broken("a header line without a name")
        fields[name.strip().decode("ascii", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return fields


def _length(fields: dict[str, str]) -> int:
    text = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", text):
        raise Broken("Content-Length is not a number")
    return int(text)


def parsed(record: bytes) -> dict:
    """The parts of one record, checked."""
    head, end, rest = record.partition(b"\r\n\r\n")
    version, _, head = head.partition(b"\r\n")
    if not end or version not in VERSIONS:
        raise Broken("no WARC header")
    fields = _fields(head)
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise Broken(f"{name} is missing")
    length = _length(fields)
    block, closing = rest[:length], rest[length:]
    if len(block) != length or closing != b"\r\n\r\n":
        raise Broken("Content-Length is not that of the block")
    kind = fields["warc-type"]
    out = {
        "record_id": fields["warc-record-id"],
        "record_type": kind,
        "url": fields.get("warc-target-uri"),
        "date": fields["warc-date"],
        "refers_to": fields.get("warc-refers-to"),
    }
    if kind not in ("response", "revisit"):
        return out | {"payload": block, "payload_bytes": len(block), "payload_digest": hashlib.sha256(block).hexdigest()}
    http, end, payload = block.partition(b"\r\n\r\n")
    if not end or not http.startswith(b"HTTP/"):
        raise Broken("no HTTP header")
    stated = _length(_fields(http.partition(b"\r\n")[2]))
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha256" or not re.fullmatch("[0-9a-f]{64}", digest):
        raise Broken("no SHA-256 of the payload")
    if kind == "revisit":
        if payload or not out["refers_to"]:
            raise Broken("a revisit refers to a record and has no payload")
        return out | {"payload": None, "payload_bytes": stated, "payload_digest": digest}
    if stated != len(payload):
        raise Broken("the payload's length is not the one stated")
    if hashlib.sha256(payload).hexdigest() != digest:
        raise Broken("the payload's digest is not the one stated")
    return out | {"payload": payload, "payload_bytes": stated, "payload_digest": digest}


# --- archives -------------------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def _skippable(data: memoryview, at: int) -> int | None:
    """The length of a skippable frame's content, if one starts here."""
    if len(data) - at < 8:
        return None
    magic, size = struct.unpack_from("<II", data, at)
    if magic not in SKIPPABLE:
        return None
    if len(data) - at - 8 < size:
        raise Broken("a skippable frame is cut off")
    return size


def _decoded(frames: zstandard.ZstdDecompressor, data: memoryview, at: int) -> tuple[bytes, int]:
    """What the frame that starts here holds, and where it ends."""
    one, parts = frames.decompressobj(), []
    while not one.eof:
        fed = data[at : at + _FED]
        if not len(fed):
            raise Broken("a frame is cut off")
        parts.append(one.decompress(fed))
        at += len(fed) - len(one.unused_data)
    return b"".join(parts), at


def archived(content: bytes) -> Iterator[bytes]:
    """The records of an archive file, one from each frame."""
    data, at, dictionary = memoryview(content), 0, None
    size = _skippable(data, 0)
    if size is not None and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        raw = bytes(data[8 : 8 + size])
        if raw.startswith(FRAME_MAGIC):
            raw, _ = _decoded(zstandard.ZstdDecompressor(), memoryview(raw), 0)
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    frames = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        size = _skippable(data, at)
        if size is not None:
            at += 8 + size
            continue
        record, at = _decoded(frames, data, at)
        yield record


# --- writing --------------------------------------------------------------------------------


def trained(pages: DataFrame, count: int) -> bytes | None:
    """A dictionary for ``count`` pages, or None where there are too few to train one."""
    place = F.xxhash64("page_id", "payload")
    # about two samples' worth of rows pass, however many tasks there are; the first of them are taken
    sample = (
        pages.where(F.pmod(place, F.lit(max(count, 1))) < 2 * SAMPLES)
        .where("length(payload) > 0")
        .orderBy(place, "page_id")
        .select(F.substring("payload", 1, SAMPLE_BYTES).alias("start"))
        .limit(SAMPLES)
    )
    starts = [bytes(row.start) for row in sample.collect()]  # at most SAMPLES * SAMPLE_BYTES
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, starts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return None


def _frames(batches, dictionary: bytes | None, date: str):
    """Frames of records, in files of bounded size that start with the dictionary."""
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data)
    opening = [dictionary_frame(dictionary)] if dictionary else []
    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:daybook:info>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
    opening.append(compressor.compress(_record(info, b"format: WARC File Format 1.1\r\n")))
    volume, number, size, rows, waiting = -1, 0, FILE_BYTES, [], 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
            ["volume", "number", "frame"],
        )

    for part in batches:
        for page in zip(*(part.column(k) for k in ("page_id", "url", "payload", "digest", "refers_to"))):
            if size >= FILE_BYTES:
                volume, number, size = volume + 1, 0, 0
                rows += [(volume, n, frame) for n, frame in enumerate(opening)]
                number = len(opening)
            frame = compressor.compress(page_record(*(x.as_py() for x in page), date))
            rows.append((volume, number, frame))
            number, size, waiting = number + 1, size + len(frame), waiting + len(frame)
            if waiting >= _OUT_BYTES:
                yield batch()
                rows, waiting = [], 0
    if rows:
        yield batch()


def with_targets(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, and ``refers_to``: the page that has the payload already."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    shared = stored(
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("times"))
        .where("times > 1 and first is not null")
    )
    hot = F.col("times") * HOT_SHARE > rows.count()
    many, few = shared.where(hot).select("digest", "first"), shared.where(~hot).select("digest", "first")
    # fewer than HOT_SHARE payloads can each hold more than that share of the rows
    of_many = rows.join(F.broadcast(many), "digest")
    others = rows.join(F.broadcast(many.select("digest")), "digest", "left_anti").join(few.hint("shuffle_merge"), "digest", "left")
    target = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return of_many.unionByName(others).withColumn("refers_to", target).drop("first")


def write_warc(
    pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Writes the records of ``pages`` (``page_id``, ``url``, ``html``) as archive files below ``path``."""
    rows = with_targets(pages, least_bytes)
    payloads = pages.select(F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"), "page_id")
    dictionary = trained(payloads, pages.count())
    frames = rows.mapInArrow(lambda batches: _frames(batches, dictionary, date), _FRAMES)
    # Bytes pass through the text writer as they are. The files' order is that of the records.
    lines = frames.sortWithinPartitions("volume", "number").select(F.col("frame").cast("string").alias("value"), "volume")
    lines.write.partitionBy("volume").option("lineSep", _EMPTY_FRAME).text(path)


# --- reading --------------------------------------------------------------------------------


def _read(batches, strict: bool, payloads: bool):
    names = [field.split()[0] for field in _RECORDS.split(", ")]
    types = [pa.binary() if x == "payload" else pa.int64() if x == "payload_bytes" else pa.string() for x in names]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([row.get(name) for row in rows], kind) for name, kind in zip(names, types)], names
        )

    def records(path, content):
        found = archived(content)
        while True:
            try:
                record = next(found, None)
            except (Broken, zstandard.ZstdError) as problem:
                yield {"problem": str(problem)}  # where the next frame starts is not known
                return
            if record is None:
                return
            try:
                yield parsed(record)
            except Broken as problem:
                yield {"problem": str(problem)}

    for part in batches:
        for path, content in zip(part.column("path"), part.column("content")):
            path, rows, waiting = path.as_py(), [], 0
            for row in records(path, content.as_py()):
                if strict and "problem" in row:
                    raise Broken(f"{path}: {row['problem']}")
                waiting += len(row.get("payload") or b"")
                rows.append(row | {"path": path} | ({} if payloads else {"payload": None}))
                if waiting >= _OUT_BYTES:
                    yield batch(rows)
                    rows, waiting = [], 0
            if rows:
                yield batch(rows)


def read_warc(spark: SparkSession, path: str, strict: bool = True, payloads: bool = True) -> DataFrame:
    """The records of all archive files below ``path``, ``warcinfo`` among them.

    ``path`` of the file, ``record_id``, ``record_type``, ``url``, ``date``, ``payload`` (null for revisits, and
    without ``payloads``), ``payload_bytes``, ``payload_digest``, ``refers_to``, ``problem``. A file is read in one
    task, which holds it and one decoded record at a time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(lambda batches: _read(batches, strict, payloads), _RECORDS)


def dangling(records: DataFrame) -> DataFrame:
    """Payloads of revisits that no response record has under the id they refer to."""
    payload = ["payload_digest", "payload_bytes"]
    targets = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), *payload)
    asked = records.where("record_type = 'revisit'").select("refers_to", *payload).distinct()
    return asked.join(targets, ["refers_to", *payload], "left_anti")


def page_id(column: str):
    """The page a record id stands for."""
    return F.regexp_extract(column, _PAGE_ID % r"(-?\d*)", 1).try_cast("long")
