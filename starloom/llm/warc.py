"""WARC archives with Zstandard frames: writer and validating reader.

An archive begins with a skippable frame that holds the dictionary, itself
compressed, if there is one.  Every record follows as a frame of its own, so a
record can be decoded without its neighbours.  Archives are bounded in size and
travel as rows (archive, content); ``spark.read.format("binaryFile")`` gives
the same for files (path, content).

Records with equal payloads of at least ``LEAST_REVISIT`` bytes are stored once:
that with the smallest id is a response, the others are revisits that name it
and hold no payload.  The length and digest of the full payload are headers of
every record.

The reader walks the frames by their block headers and checks, for every
record: the frame's own size if it states one, the version line, that all needed headers are
there once, that Content-Length is the block's length, and that the block and, but for a
revisit, the payload have the digests (``DIGESTS``, in hex or base32) and the length that are
stated.  Anything else raises ``WarcError``
with the archive and the offset.  Archives of other writers may have records of any
type and id, no payload length, no digest, or one of a kind that is not known, which is not checked;
the payload of a record that holds no HTTP message is its block.  Skippable frames between records
are passed over.

A null payload is empty.  A record without an id is never referred to; where a
payload has no id at all, all its records are responses.  Repeated rows of the
smallest id are all responses.  An empty table gives no archive; further
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code
from starloom.session import stage_table

#: Fixed values of the file formats.
DICTIONARY_MAGIC, SKIPPABLE_MAGIC = 0x184D2A5D, 0x184D2A50
UNSTATED = zstandard.CONTENTSIZE_UNKNOWN
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.0", b"WARC/1.1")
DIGESTS = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

LEAST_REVISIT = 100

#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 4 << 20

#: Records the dictionary is trained on, how long each may be, and the dictionary's size.
DICTIONARY_RECORDS = 256
DICTIONARY_RECORD_BYTES = 32_768
DICTIONARY_BYTES = 32_768

RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, record_id string, refers_to_id string, archive string, offset long"
)


class WarcError(ValueError):
    """An archive that is not as it must be."""


# --- bytes ------------------------------------------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """An uncompressed record; with ``refers_to`` a revisit, which leaves the payload out."""
    block = HTTP_HEAD + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'none' if page_id is None else page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(size),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe=":/?#[]@!$&'()*+,;=")
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in head.items())
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def frame_end(data: memoryview, begin: int) -> int:
    """Where the frame at ``begin`` ends, by the headers of its blocks."""
    try:
        head = zstandard.get_frame_parameters(bytes(data[begin : begin + 18]))
        at = begin + zstandard.frame_header_size(bytes(data[begin : begin + 18]))
    except zstandard.ZstdError as error:
        raise WarcError(f"no frame: {error}") from error
    while True:
        if at + 3 > len(data):
            raise WarcError("the frame is cut off")
        block = int.from_bytes(data[at : at + 3], "little")
        # a run of one byte is stored as that byte
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            at += 4 * head.has_checksum
            if at > len(data):
                raise WarcError("the frame is cut off")
            return at


def _page(value: str | None) -> int | None:
    """The page of an id that this module wrote."""
    own = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(own[1]) if own else None


def _digest(value: str) -> tuple[str, bytes] | None:
    """(algorithm, digest) of a header; None if the algorithm is not known."""
    name, colon, text = value.partition(":")
    size = DIGESTS.get(name.lower().replace("-", ""))
    if not colon or size is None:
        return None
    try:
        found = bytes.fromhex(text) if len(text) == 2 * size else base64.b32decode(text.upper() + "=" * (-len(text) % 8))
    except ValueError as error:
        raise WarcError(f"not a digest: {value}") from error
    if len(found) != size:
        raise WarcError(f"not a digest: {value}")
    return name.lower().replace("-", ""), found


def _differs(stated: str | None, data: bytes) -> bool:
    digest = _digest(stated) if stated else None
    return digest is not None and hashlib.new(digest[0], data).digest() != digest[1]


def parse(data: bytes) -> dict:
    """A record's fields, checked."""
    cut = data.find(b"\r\n\r\n")
    if cut < 0:
        raise WarcError("the header does not end")
    first, *lines = data[:cut].split(b"\r\n")
    if first not in VERSIONS:
        raise WarcError(f"not a record: {first[:40]!r}")
    head: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon or name.lower() in head:
            raise WarcError(f"bad header line {line[:80]!r}")
        head[name.lower()] = value.strip()
    kind = head.get("warc-type", "").lower()
    revisit = kind == "revisit"
    need = {"warc-type", "warc-record-id", "warc-date", "content-length"} | ({"warc-profile"} if revisit else set())
    if missing := need - head.keys():
        raise WarcError(f"no header {', '.join(sorted(missing))}")
    block = data[cut + 4 : -4]
    if data[-4:] != b"\r\n\r\n" or str(len(block)) != head["content-length"]:
        raise WarcError(f"the block has {len(block)} bytes, Content-Length is {head['content-length']}")
    if _differs(head.get("warc-block-digest"), block):
        raise WarcError("the block is not the one described")
    payload = block
    if head.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        if cut < 0 and not revisit:
            raise WarcError("the HTTP header does not end")
        payload = block[cut + 4 :] if cut >= 0 else b""
    stated, size = head.get("warc-payload-digest"), head.get("x-payload-length")
    digest = _digest(stated) if stated else None
    if revisit:
        if payload and digest is not None and not _differs(stated, payload):
            raise WarcError("a revisit with its payload")
        found = digest[1].hex() if digest and digest[0] == "sha256" else stated
    else:
        if _differs(stated, payload) or (size is not None and size != str(len(payload))):
            raise WarcError("the payload is not the one described")
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
    uri, refers = head.get("warc-target-uri"), head.get("warc-refers-to")
    return {
        "page_id": _page(head["warc-record-id"]), "url": None if uri is None else unquote(uri),
        "record_type": kind, "refers_to": _page(refers) if revisit else None,
        "payload_bytes": None if size is None else int(size), "payload_digest": found,
        "payload": None if revisit else payload, "record_id": head["warc-record-id"], "refers_to_id": refers,
    }


def records(content: bytes) -> Iterator[tuple[int, dict]]:
    """(offset, record) of every record of an archive."""
    data, at, dictionary = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", data[4:8])[0]
        if 8 + size > len(data):
            raise WarcError("the dictionary is cut off")
        raw = bytes(data[8 : 8 + size])
        raw = zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME_MAGIC else raw
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 <= len(data) and struct.unpack("<I", data[at : at + 4])[0] & ~0xF == SKIPPABLE_MAGIC:
            at += 8 + struct.unpack("<I", data[at + 4 : at + 8])[0]
            if at > len(data):
                raise WarcError("a skippable frame is cut off")
            continue
        end = frame_end(data, at)
        frame = bytes(data[at:end])
        size = zstandard.get_frame_parameters(frame[:18]).content_size
        try:
            # a frame need not state its size
            plain = reader.decompressobj().decompress(frame) if size == UNSTATED else reader.decompress(frame)
        except zstandard.ZstdError as error:
            raise WarcError(f"offset {at}: {error}") from error
        if size not in (len(plain), UNSTATED):
            raise WarcError(f"offset {at}: {len(plain)} bytes, the frame states {size}")
        try:
            yield at, parse(plain)
        except (WarcError, ValueError) as error:
            raise WarcError(f"offset {at}: {error}") from error
        at = end


# --- tables -----------------------------------------------------------------------------------------------------


def train(payloads: DataFrame, records: int = DICTIONARY_RECORDS) -> bytes:
    """A dictionary from a bounded number of whole payloads, those with the smallest hash; empty if they are too few."""
    n = payloads.count()
    # about four times the records lie below this share of the hashes; copies of a payload have one hash
    some = (
        payloads.where(f"size BETWEEN 1 AND {DICTIONARY_RECORD_BYTES}")
        .select("payload", F.shiftrightunsigned(F.xxhash64("payload"), 1).alias("h"))
        .where(F.col("h") / F.lit(float(1 << 63)) <= min(1.0, 4 * records / max(n, 1)))
        .groupBy("h").agg(F.min("payload").alias("payload")).orderBy("h").limit(records).collect()
    )
    samples = sorted({bytes(r["payload"]) for r in some})
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, content) of all rows of ``pages`` (page_id, url, html)."""
    send_code(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"),
    )
    dictionary = train(plain)
    first = (
        plain.where(f"size >= {LEAST_REVISIT}").groupBy("digest").agg(F.min("page_id").alias("first"))
        .where("first IS NOT NULL").select(F.col("digest").alias("key"), "first")
    )
    # a small payload has a key of its own, so it meets nothing and lies anywhere
    key = F.when(F.col("size") >= LEAST_REVISIT, F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.monotonically_increasing_id()))
    ready = plain.withColumn("key", key).join(first, "key", "left").select(
        "page_id", "url", "payload", "size", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )

    def task(batches):
        packer = zstandard.ZstdCompressor(
            level=3, write_content_size=True, write_checksum=True,
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        head = dictionary_frame(dictionary)
        frames, size, number, task_id = [], 0, 0, TaskContext.get().partitionId()

        def archive():
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{task_id:06d}-{number:05d}.warc.zst"]), pa.array([head + b"".join(frames)], pa.binary())],
                ["archive", "content"])

        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in columns]
                frames.append(packer.compress(record(*row)))
                size += len(frames[-1])
                if size >= archive_bytes:
                    yield archive()
                    frames, size, number = [], 0, number + 1
        if frames:
            yield archive()

    return ready.mapInArrow(task, "archive string, content binary")


def read_archives(archives: DataFrame, name: str = "archive", payloads: bool = True) -> DataFrame:
    """All records of archives (``name``, content), checked; payloads are left out on demand."""
    send_code(archives.sparkSession)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
             pa.string(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def task(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                archive, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows, size = [], 0
                try:
                    for offset, found in records(content or b""):
                        size += found["payload_bytes"] or 0
                        if not payloads:
                            found["payload"] = None
                        rows.append([*found.values(), archive, offset])
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                except WarcError as error:
                    raise WarcError(f"{archive}: {error}") from error
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return archives.select(F.col(name).alias("archive"), "content").mapInArrow(task, RECORD)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """What the archives of ``pages`` hold, read back from the stored archives."""
    stored = stage_table(write_archives(pages), "warc")
    return read_archives(stored, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset")
