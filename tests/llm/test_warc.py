import hashlib
import random
import struct

import pytest

from skycal.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, first int, content string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 3, "y") for i, u, h in rows], SCHEMA)


def brute(rows):
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data]
        first = min((j for j in same if j is not None), default=None)
        revisit = len(data) >= 100 and first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def pages():
    rng = random.Random(1)
    texts = ["".join(rng.choice("<p>abc é\n") for _ in range(n)) for n in (0, 5, 99, 100, 101, 3000, 70_000)]
    rows = [(k, f"http://example.org/{k}?a=b c", rng.choice(texts)) for k in range(120)]
    return rows + [(None, "http://example.org/none", texts[5]), (500, None, None), (501, "bad\r\nurl", "x" * 99), (502, "", "x" * 99),
                   (503, "u", "x" * 300_000), (3, rows[3][1], rows[3][2]), (-7, "n", texts[4]), (600, "u", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n" * 20)]


def test_round_trip(spark):
    rows = pages()
    got = warc.round_trip(table_of(spark, rows).repartition(3)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(rows)
    html = {(i, hashlib.sha256((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == html[r.page_id, r.payload_digest] for r in got if r.record_type == "response")
    assert {r.url for r in got if r.page_id == 501} == {"bad%0D%0Aurl"} and {r.url for r in got if r.page_id == 500} == {None}


def test_files_are_read_through_sparks_binary_reader(spark, tmp_path):
    rows = pages()
    archives = warc.write_archives(table_of(spark, rows).coalesce(1), archive_bytes=20_000).collect()
    assert len(archives) > 2 and len({a.name for a in archives}) == len(archives)
    for a in archives:
        (tmp_path / a.name).write_bytes(a.content)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(str(tmp_path))
    got = warc.read_archives(files).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(rows)


def test_leading_frame_holds_the_dictionary_and_records_have_a_frame_each():
    rng = random.Random(3)
    records = [warc.record(k, "u", bytes(rng.choice(b"<p>abcdefgh ") for _ in range(4000)), "0" * 64, None) for k in range(40)]
    archive = warc.compress(records)
    magic, size = struct.unpack_from("<II", archive)
    assert magic == 0x184D2A5D and archive[8:12] == b"\x28\xb5\x2f\xfd" and list(warc.frames(archive)) == records
    assert archive[8 + size:12 + size] == b"\x28\xb5\x2f\xfd"
    few = warc.compress(records[:2])
    assert few[:4] == b"\x28\xb5\x2f\xfd" and list(warc.frames(few)) == records[:2]
    assert list(warc.frames(b"")) == []


def test_what_does_not_fit_raises():
    body = b"payload" * 30
    good = warc.record(1, "u", body, hashlib.sha256(body).hexdigest(), None)
    assert warc.parse(good)["payload"] == body
    for bad in (good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WORC/1.1"), good.replace(b"payloadpay", b"pAyloadpay"),
                good.replace(b"WARC-Type: response", b"WARC-Type: unknown"), good.replace(b"WARC-Date", b"WARC-Type"),
                good.replace(b"Content-Length: 2", b"Content-Length: 3")):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)
    archive = warc.compress([good] * 20)
    for bad in (archive[:-3], archive[:20], archive[:-9] + b"\0" * 9, archive + b"junk"):
        with pytest.raises(warc.BadArchive):
            list(warc.frames(bad))


def test_empty_table(spark):
    assert warc.round_trip(table_of(spark, [])).collect() == []
