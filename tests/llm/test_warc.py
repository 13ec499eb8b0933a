"""Archives: round trips, formats and dedup against plain versions."""

from __future__ import annotations

import base64
import glob
import hashlib
import random

import duckdb
import pytest
import zstandard

from tablewharf.llm import queries, warc
from tablewharf.sinks.workspace import new_folder

PAGES = "page_id long, url string, html string, record_type string, payload string"


def plain(rows, least=0):
    """(id, bytes, digest, type, response) of each row."""
    out = []
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "").encode() == body and r[0] is not None] if len(body) >= least else []
        response = max(ids) if ids else page_id
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, *(("response", None) if page_id == response else ("revisit", response))))
    return sorted(out, key=repr)


def written(spark, rows, **options):
    folder = new_folder(spark, "archives")
    warc.write_archives(spark.createDataFrame(rows, PAGES), folder, **options)
    return folder


def read(spark, folder):
    def number(text):
        return None if text is None else int(text)

    rows = warc.read_archives(spark, folder).collect()
    found = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows]
    return rows, sorted(found, key=repr)


@pytest.fixture
def rows():
    rng = random.Random(3)
    noise = "".join(rng.choices("abc <>\r\n\0é😀", k=5000))
    bodies = [None, "", "<p>one</p>", "<p>one</p>", "<p>two</p>", noise, noise, "x" * 300_000, warc.SEPARATOR * 3, "WARC/1.1\r\n\r\n"]
    urls = ["http://a/ü b?q=1%20", None, "http://x/\r\nX-Injected: 1"]
    rows = [(i, urls[i % 3], body, "response", None) for i, body in enumerate(bodies)]
    return [*rows, (None, None, "<p>one</p>", None, None), (None, "http://n/", "only without id", None, "p"), (5, "http://5/", noise, None, None)]


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip_and_revisits(spark, rows, least):
    found, tuples = read(spark, written(spark, rows, least=least, archive_bytes=20_000))
    assert tuples == plain(rows, least)
    bodies = {r[0]: (r[2] or "").encode() for r in rows}
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None and r.record_id is not None:
            assert bytes(r.payload) == bodies[int(r.record_id)]
        assert r.target_uri is None or r.target_uri.isascii()
    targets = {int(r.record_id): r.target_uri for r in found if r.record_id}
    assert targets[3] == "http://a/%C3%BC%20b?q=1%20" and targets[1] is None
    assert targets[2] == "http://x/%0D%0AX-Injected:%201"


def test_archives_are_standard_frames(spark):
    """A plain decoder with the leading dictionary reads every frame; the dictionary pays."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    rows = [(i, f"http://site/{i}", "<html><body>" + " ".join(rng.choices(words, k=60)), None, None) for i in range(3000)]
    folder = written(spark, rows)
    files = [open(name, "rb").read() for name in glob.glob(f"{folder.removeprefix('file:')}/part-*")]
    separator = warc.SEPARATOR.encode()
    records = []
    for data in filter(None, files):
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY
        at = end = 8 + int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8:end])
        assert dictionary.dict_id() > 0
        first = len(records)
        while at < len(data):
            if data.startswith(separator, at):
                at += len(separator)
                continue
            frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            records.append(frame.decompress(data[at:]))
            at = len(data) - len(frame.unused_data)
        assert records[first].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert len(records) == 3000 + len(list(filter(None, files)))
    for r in records:
        head, _, rest = r.partition(b"\r\n\r\n")
        length = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert rest[length:] == b"\r\n\r\n" and len(rest) == length + 4
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert sum(map(len, files)) < alone


def test_empty_and_tiny_tables(spark):
    assert read(spark, written(spark, []))[0] == []
    one = [(1, "http://1/", "<p>é</p>", None, None)]
    assert read(spark, written(spark, one))[1] == plain(one)


def test_repeated_rows_are_archived_each(spark):
    found, _ = read(spark, written(spark, [(4, "u", "same", None, None)] * 3 + [(2, "v", "same", None, None)]))
    kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in found)
    assert kinds == [("2", "revisit", "4")] + [("4", "response", None)] * 3


def test_damage_is_noticed(spark, tmp_path):
    good = warc.record("1", "http://1/", b"payload", None, warc.CAPTURED)
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(good.replace(b"payload\r\n", b"pAyload\r\n"))
    frame = zstandard.ZstdCompressor().compress(good)
    assert list(warc.records_of(memoryview(frame + frame))) == [good, good]
    with pytest.raises(ValueError, match="inside a frame"):
        list(warc.records_of(memoryview(frame[:-3])))
    packed = zstandard.ZstdCompressor().compress(warc.trained([good + bytes([i]) * 50 for i in range(100)]).as_bytes())
    lead = warc.DICTIONARY.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
    assert list(warc.records_of(memoryview(lead + frame))) == [good]


def test_op11(spark, small):
    found = sorted(tuple(r) for r in queries.op11_dictionary_warc(spark, small).collect())
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{small}/pages.parquet'").fetchall()
    assert found == sorted(plain(rows), key=lambda r: r[0])
