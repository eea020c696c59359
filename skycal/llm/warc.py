"""Web archives compressed with Zstandard: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store

DICTIONARY_FRAME = 0x184D2A5D      # skippable frame that holds the dictionary
ARCHIVE_BYTES = 8 << 20            # records of an archive before compression; a record is never split
DICTIONARY_BYTES = 32 << 10
TRAINING_BYTES = 512 << 10         # leading records of an archive that its dictionary is trained on
REVISIT_FROM = 100                 # payload bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
_FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
_URN = re.compile(r"^<urn:page:(-?\d+|none):[0-9a-f]{64}>$")


class BadArchive(ValueError):
    """A frame, header or length that does not fit the format."""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with the page as HTTP message, or a revisit record that names the response's page."""
    name = "none" if page_id is None else page_id
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}:{digest}>",
             f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=1024, d=8)
    except zstandard.ZstdError:      # too few or too small samples
        return None


def compress(records: list[bytes], level: int = 3) -> bytes:
    """An archive of the records. Without enough records to train on, it has no dictionary and no leading frame."""
    samples, size = [], 0
    for r in records:
        if size >= TRAINING_BYTES:
            break
        samples.append(r[:TRAINING_BYTES])
        size += len(samples[-1])
    trained = _dictionary(samples) if len(samples) >= 8 else None
    parts, options = [], {}
    if trained is not None:
        body = zstandard.ZstdCompressor().compress(trained.as_bytes())
        parts, options = [struct.pack("<II", DICTIONARY_FRAME, len(body)), body], {"dict_data": trained}
    writer = zstandard.ZstdCompressor(level=level, write_checksum=True, **options)
    return b"".join([*parts, *(writer.compress(r) for r in records)])


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one for each frame."""
    at, known = 0, None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", archive, 4)[0]
        body = archive[8:8 + size]
        if len(body) != size:
            raise BadArchive("the dictionary frame is cut off")
        if body[:4] == _FRAME_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body)
        known, at = zstandard.ZstdCompressionDict(body), 8 + size
    view = memoryview(archive)
    reader = zstandard.ZstdDecompressor(**({"dict_data": known} if known else {}))
    while at < len(archive):
        one = reader.decompressobj()
        try:
            out = [one.decompress(view[at:at + (1 << 16)])]
            read = min(len(archive), at + (1 << 16))
            while not one.eof and read < len(archive):
                out.append(one.decompress(view[read:read + (1 << 16)]))
                read = min(len(archive), read + (1 << 16))
        except zstandard.ZstdError as e:
            raise BadArchive(f"frame at byte {at}: {e}") from e
        if not one.eof:
            raise BadArchive(f"the frame at byte {at} is cut off")
        at = read - len(one.unused_data)
        yield b"".join(out)


def parse(raw: bytes) -> dict:
    """Headers and content of one record; lengths and digests are checked."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not gap or not version.startswith("WARC/1."):
        raise BadArchive("not a WARC record")
    fields: dict[str, str] = {}
    for line in lines:
        key, colon, value = line.partition(":")
        if not colon or not key or key.lower() in fields:
            raise BadArchive(f"bad header line {line!r}")
        fields[key.lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if key not in fields:
            raise BadArchive(f"{key} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the content length does not fit")
    block = rest[:-4]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise BadArchive("the block digest does not fit")
    http, gap, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: *(\d+)\r?$", http)
    if not gap or not length:
        raise BadArchive("the HTTP head has no content length")
    kind, digest, ident = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:"), _URN.match(fields["warc-record-id"])
    if not ident:
        raise BadArchive("unknown record id")
    refers = None
    if kind == "response":
        if len(payload) != int(length[1]) or hashlib.sha256(payload).hexdigest() != digest:
            raise BadArchive("the payload does not fit its length or digest")
    elif kind == "revisit":
        target = _URN.match(fields.get("warc-refers-to", ""))
        if payload or not target or fields.get("warc-profile") != PROFILE:
            raise BadArchive("a revisit has a payload, or no target or profile")
        refers = int(target[1])
    else:
        raise BadArchive(f"unknown record type {kind}")
    return {"page_id": None if ident[1] == "none" else int(ident[1]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": int(length[1]), "payload_digest": digest, "refers_to": refers, "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(name, content) of archives that hold a record for every row of pages (page_id, url, html).

    Of rows with an equal payload of REVISIT_FROM bytes or more, the smallest page_id is the response, others
    revisit it. Rows that repeat this page_id too are responses. A null html is an empty payload, a null url
    is left out; a null page_id is written as one and never referred to. No pages make no archives."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = (rows.where(F.octet_length("payload") >= REVISIT_FROM).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    # The groups of copies are joined by digest; a large one is split by adaptive execution, its side being the left one.
    told = rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.expr("CASE WHEN NOT (page_id <=> first) THEN first END").alias("refers_to"))

    def run(batches):
        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def archive():
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:06d}-{made:05d}.warc.zst"]), pa.array([compress(held)], pa.binary())], names=["name", "content"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(record(*row))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive()
                    made, held, size = made + 1, [], 0
        if held:
            yield archive()

    return told.mapInArrow(run, "name string, content binary")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of archives with a binary column `content`, as write_archives gives them or as
    spark.read.format("binaryFile") reads files. A frame, header, length or digest that does not fit raises."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["payload"] if payloads else [])]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for raw in frames(content.as_py()):
                    rows.append(parse(raw))
                    if len(rows) == 256:
                        yield batch_of(rows)
                        rows = []
                yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)

    schema = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
    return archives.select("content").mapInArrow(run, schema + (", payload binary" if payloads else ""))


def round_trip(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Archives of all pages, stored in the shared folder and read back record by record."""
    store = Store(pages.sparkSession, "warc")
    return read_archives(store.put(write_archives(pages), "archives"), payloads)
