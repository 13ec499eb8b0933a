"""WARC archives of Zstandard frames with a dictionary of their own, written and read by Spark."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.llm.common import store

# Bytes of payloads and headers, before compression, that one archive holds, about.
ARCHIVE_BYTES = 64 << 20
# What a record takes besides its payload, about.
RECORD_BYTES = 512
# A dictionary is trained on the first records of its archive: on so many bytes at most, in pieces.
TRAINING_BYTES = 4 << 20
PIECE_BYTES = 4 << 10
DICTIONARY_BYTES = 110 << 10
LEVEL = 6
# Rows that share a payload are dealt to so many tasks that each gets about this number.
SALT_ROWS = 1 << 16
# Bytes of an archive that the decoder gets at a time, and of payloads in a batch that it gives back.
CHUNK = 16 << 10
BATCH_BYTES = 8 << 20

# Fixed values of the formats: Zstandard's skippable frames, and the one that holds a dictionary.
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY = 0x184D2A5D
FRAME = 0xFD2FB528
# Stands after every frame, as the separator of Spark's text writer: a skippable frame without content.
SEPARATOR = (SKIPPABLE[0].to_bytes(4, "little") + bytes(4)).decode("ascii")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "1970-01-01T00:00:00Z"

READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string,"
    " refers_to string, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _block(fields: list[tuple[str, str]], first: str) -> bytes:
    lines = [first, *(f"{name}: {value}" for name, value in fields)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("ascii")


def _urn(record_id: str) -> str:
    return f"<urn:x-record:{quote(record_id, safe='')}>"


def record(record_id: str | None, uri: str | None, payload: bytes, refers_to: str | None, captured: str) -> bytes:
    """One WARC record: the payload in an HTTP response, or only that response's header where it revisits another."""
    http = _block([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    body = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit")]
    fields += [] if record_id is None else [("WARC-Record-ID", _urn(record_id))]
    fields += [("WARC-Date", captured)]
    fields += [] if uri is None else [("WARC-Target-URI", quote(uri, safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))]
    fields += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return _block(fields, "WARC/1.1") + body + b"\r\n\r\n"


def information(captured: str) -> bytes:
    """The record that describes an archive."""
    body = _block([("format", "WARC File Format 1.1")], "software: tablewharf")[:-2]
    fields = [("WARC-Type", "warcinfo"), ("WARC-Date", captured), ("Content-Type", "application/warc-fields")]
    return _block([*fields, ("Content-Length", str(len(body)))], "WARC/1.1") + body + b"\r\n\r\n"


def trained(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the records' pieces, a tenth of their bytes at most; None where they are too few for one."""
    pieces, left = [], TRAINING_BYTES
    for r in records:
        part = memoryview(r)[:left]
        pieces += [bytes(part[at : at + PIECE_BYTES]) for at in range(0, len(part), PIECE_BYTES)]
        left -= len(part)
    total = sum(map(len, pieces))
    try:
        return zstandard.train_dictionary(max(256, min(size, total // 10)), pieces, k=512, d=8)
    except zstandard.ZstdError:
        return None


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: its dictionary in a skippable frame, then every record on its own.

    Records wait until enough bytes for training are there; the rest streams.
    """
    waiting, size = [], 0
    for r in records:
        waiting.append(r)
        size += len(r)
        if size >= TRAINING_BYTES:
            break
    if not waiting:
        return
    dictionary = trained(waiting)
    if dictionary is not None:
        content = dictionary.as_bytes()
        yield DICTIONARY.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
    encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    for r in waiting:
        yield encoder.compress(r)
    waiting.clear()
    for r in records:
        yield encoder.compress(r)


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES, captured: str = CAPTURED) -> None:
    """Write a record for every row of ``page_id, url, html`` into archives under a new ``folder``.

    The payload is the html in UTF-8, empty where it is null. Of rows whose payloads are equal (by SHA-256) and
    have at least ``least`` bytes, the one with the largest id is archived as ``response``; the others become ``revisit``
    records that refer to it and hold no payload. Null ids come before all others; where
    all ids of a group are null, and where the largest id repeats, each of those rows is a
    response. Null urls have no target; signs of a url that no URI holds are percent-encoded.
    Other columns are ignored. An empty table gives a folder without records.

    An archive is a partition of at most about ``archive_bytes`` (Spark deals small tables to its usual number of shuffle partitions): a dictionary, trained on its first records, leads it in a
    skippable frame, and each record is a frame that decodes with it alone. Rows are dealt by
    payload and a hash of id and url, so one payload that fills a third of the table spreads over many archives. The
    payloads move in one shuffle. Spark's text writer commits the files, so lost tasks leave nothing behind.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    salts = max(1, -(-pages.count() // SALT_ROWS))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*",
        F.unhex(F.sha2("payload", 256)).alias("digest"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int").alias("salt"),
        F.octet_length("payload").cast("long").alias("size"),
    )
    size = F.sum(F.col("size") + RECORD_BYTES).alias("bytes")
    groups = rows.groupBy("digest", "salt", (F.col("size") >= least).alias("counts")).agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"), size
    )
    groups = store(groups, "archive-groups")
    archives = max(1, -(-(groups.agg(F.sum("bytes")).first()[0] or 0) // archive_bytes))
    largest = groups.where("counts").groupBy("digest").agg(F.max("largest").alias("response_id"), F.sum("n").alias("n"))
    shared = groups.where("counts").select("digest", "salt").join(largest.where("n > 1").drop("n"), "digest")
    dealt = rows.drop("size").repartition(archives, "digest", "salt")
    joined = dealt.join(shared.repartition(archives, "digest", "salt").hint("shuffle_hash"), ["digest", "salt"], "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    wanted = joined.select(F.col("page_id").cast("string"), "url", "payload", refers_to.cast("string").alias("refers_to"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for n, batch in enumerate(batches):
                if n == 0 and batch.num_rows:
                    yield information(captured)
                for row in zip(*(column.to_pylist() for column in batch.columns)):
                    yield record(*row, captured)

        waiting, size = [], 0
        for frame in frames(records()):
            waiting.append(frame)
            size += len(frame)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.binary())], names=["frame"])
                waiting, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.binary())], names=["frame"])

    written = wanted.mapInArrow(archive, "frame binary")
    written.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(folder)


def records_of(archive: memoryview) -> Iterator[bytes]:
    """The decoded frames of an archive in order; skippable frames other than its dictionary are passed over."""
    decoder, at = zstandard.ZstdDecompressor(), 0
    while at < len(archive):
        magic = int.from_bytes(archive[at : at + 4], "little")
        if magic in SKIPPABLE:
            end = at + 8 + int.from_bytes(archive[at + 4 : at + 8], "little")
            if magic == DICTIONARY and at == 0:
                content = bytes(archive[at + 8 : end])
                if int.from_bytes(content[:4], "little") == FRAME:
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at = end
            continue
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if at >= len(archive):
                raise ValueError("the archive ends inside a frame")
            parts.append(frame.decompress(archive[at : at + CHUNK]))
            at = min(at + CHUNK, len(archive)) - len(frame.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, value in (line.split(":", 1) for line in lines if ":" in line)}


def _named(urn: str | None) -> str | None:
    found = re.fullmatch(r"<urn:x-record:(.*)>", urn or "")
    return unquote(found[1]) if found else urn


def parsed(content: bytes) -> tuple | None:
    """A row of ``READ_SCHEMA`` from one record; None for records that hold no page. Digests of payloads are verified."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size, refers_to = int(_fields(http)["content-length"]), _named(fields.get("warc-refers-to"))
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"the payload of {fields.get('warc-record-id')} does not match its digest")
    named, uri = _named(fields.get("warc-record-id")), fields.get("warc-target-uri")
    return named, kind, uri, size, digest, refers_to, payload if kind == "response" else None


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The page records of all archives in ``folder``: ``record_id, record_type, target_uri, payload_bytes,
    payload_digest, refers_to, payload``.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for revisits, whose own payload is null; so
    is every payload with ``with_payload=False``. Every stored payload is compared with its digest; a damaged archive
    raises. A task holds one archive and decodes record by record.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())]
        )

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

        rows, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for r in records_of(memoryview(content.as_buffer())):
                    row = parsed(r)
                    if row is None:
                        continue
                    row = row if with_payload else (*row[:-1], None)
                    rows.append(row)
                    size += RECORD_BYTES + len(row[-1] or b"")
                    if size >= BATCH_BYTES:
                        yield packed(rows)
                        rows, size = [], 0
        yield packed(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(read, READ_SCHEMA)
