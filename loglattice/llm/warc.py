"""WARC archives in Zstandard with an embedded dictionary.

Each task turns its pages into WARC records, trains a dictionary on the first of them (``SAMPLE_BYTES`` at most), and emits a leading
skippable frame with the dictionary, then one compressed frame per record. Spark's own writer puts the frames into one file per task, so
a lost executor leaves no half-written archive and any file system will do. That writer ends every row with a line feed; each frame is
therefore followed by the head of a skippable frame of one byte, which the line feed fills.

Records of equal payloads of ``REVISIT_BYTES`` or more are stored once: the largest page id's record is a response, the others revisit it.
A null html is an empty payload, a null url leaves the target out. Null page ids rank below all others; rows that tie on page id and
payload are all responses, as are null-id rows whose payload no numbered page has. Repeated rows give repeated records. Columns with
clashing names are not read. An empty table gives an empty archive folder.
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

from loglattice.llm.common import column
from loglattice.session import fits_broadcast, scratch_dir

#: Smallest payload that a revisit record may replace.
REVISIT_BYTES = 1000
#: Records that a dictionary is trained on, and its size.
SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 2_000_000, 64_000, 6
#: Magic numbers of the frames: data, skippable with the dictionary, skippable filler.
DATA, DICTIONARY, FILLER = 0xFD2FB528, 0x184D2A5D, 0x184D2A50
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_TAIL = struct.pack("<II", FILLER, 1)


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit, whose block is the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; too few or too uniform samples serve as raw content instead."""
    size = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, size // 8)), samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:].rjust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: the dictionary's, then one per record; nothing for no record."""
    held, size = [], 0
    for one in records:
        held.append(one)
        size += len(one)
        if size >= SAMPLE_BYTES:
            break
    if not held:
        return
    taught = dictionary(held)
    raw = taught.as_bytes()
    yield struct.pack("<II", DICTIONARY, len(raw)) + raw
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=taught)
    for one in held:
        yield press.compress(one)
    held.clear()
    for one in records:
        yield press.compress(one)


def write_archives(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write one archive per task under ``path`` (a new shared folder if none is given) and return it."""
    path = path or scratch_dir(pages.sparkSession, "warc")
    rows = pages.select(
        column(page_id).cast("long").alias("page_id"), column(url).cast("string").alias("url"),
        F.coalesce(column(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    repeated = large.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
    refers = F.when((F.octet_length("payload") >= REVISIT_BYTES) & ~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))
    linked = rows.join(repeated, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield record(*[c[i].as_py() for c in batch.columns])

        for frame in frames(records()):
            yield pa.RecordBatch.from_arrays([pa.array([frame + _TAIL], pa.binary())], names=["frame"])

    linked.mapInArrow(run, "frame binary").select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(path)
    return path


def frame_end(data: memoryview, at: int) -> int:
    """Where the data frame that starts at ``at`` ends, from its block heads."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * (flags >> 2 & 1)


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of one archive."""
    data, at, unpack = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        (magic,) = struct.unpack_from("<I", data, at)
        if magic == DATA:
            end = frame_end(data, at)
            yield unpack.decompress(data[at:end])
        else:
            (size,) = struct.unpack_from("<I", data, at + 4)
            end = at + 8 + size
            if magic == DICTIONARY:
                raw = bytes(data[at + 8 : end])
                unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        at = end


def parse(one: bytes) -> tuple[int | None, int, str, str, int | None]:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``; a response's payload is checked against its digest."""
    head, _, block = one.partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = block[: int(named["Content-Length"])].partition(b"\r\n\r\n")
    number = lambda urn: None if urn is None or urn == _urn(None) else int(urn[len("<urn:x-page:") : -1])
    size, digest = int(re.search(rb"Content-Length: (\d+)", http)[1]), named["WARC-Payload-Digest"].removeprefix("sha1:")
    if named["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {named['WARC-Record-ID']}")
    return number(named["WARC-Record-ID"]), size, digest, named["WARC-Type"], number(named.get("WARC-Refers-To"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives under ``path``: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows = [parse(one) for one in records_of(archive.as_buffer())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).where("length > 0").select("content").mapInArrow(run, RESULT)
