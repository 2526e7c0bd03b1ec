"""WARC archives: exact round trip, and damaged records that must not pass."""

import hashlib

import pytest
import zstandard

from flyway.llm import warc as A
from flyway.llm.common import fresh_path

SCHEMA = "page_id bigint, url string, html string, digest string, n int, key string, refers_to int"
BIG = "<p>" + "é big page " * 200


def pages():
    rows = [(i, f"http://h/{i}", f"<html>page {i} " + "text " * (i * 7 % 400)) for i in range(60)]
    rows += [(100 + i, "http://x", BIG) for i in range(20)]              # one group of copies
    rows += [(200, None, None), (201, "u", ""), (202, "a b\r\nX: y", "s" * 999), (203, "v", "s" * 999),
             (204, "v", "s" * 1000), (205, "v", "s" * 1000), (205, "v", "s" * 1000), (None, "w", BIG),
             (None, "w", "n" * 2000), (None, "w", "n" * 2000)]
    return [(*r, "d", 1, "k", 2) for r in rows]


def expected(rows):
    last = {}
    for p, _, h, *_ in rows:
        if p is not None:
            last[h or ""] = max(p, last.get(h or "", p))
    out = []
    for p, _, h, *_ in rows:
        h = h or ""
        b, top = h.encode(), last.get(h)
        again = len(b) >= 1000 and top is not None and (p is None or p < top)
        out.append((str(p), len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response",
                    str(top if again else None)))
    return sorted(out)


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA)
    path = fresh_path(spark, "warc")
    A.write_warc(df, path, archive_bytes=20_000)
    back = A.read_warc(spark, path, payloads=True).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to))
                  for r in back) == expected(rows)
    html = {(r[0], (r[2] or "").encode()) for r in rows}
    assert all((r.page_id, bytes(r.payload)) in html for r in back if r.record_type == "response")
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    assert len(files) > 3
    for f in files:                                   # a standard reader given the dictionary agrees
        data = bytes(f.content)
        assert data[:4] == A.DICTIONARY_MAGIC
        n = int.from_bytes(data[4:8], "little")
        d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + n]))
        whole = d.stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(A.read_frames(data))


def test_empty_and_tiny(spark):
    for rows in ([], pages()[:2]):
        path = fresh_path(spark, "warc")
        A.write_warc(spark.createDataFrame(rows, SCHEMA), path)
        assert A.read_warc(spark, path).count() == len(rows)


def test_damage_is_found():
    good = A.make_record(5, "http://a", b"<p>body", None)
    assert A.parse_record(good)["payload"] == b"<p>body"
    again = A.parse_record(A.make_record(5, None, b"<p>body", 9))
    assert (again["refers_to"], again["payload_bytes"]) == (9, 7)
    for bad in (good[:-1], good[:-4], good.replace(b"body", b"bodx"), good.replace(b"WARC/1.1", b"WARC/9.9"),
                good.replace(b"X-Page-ID: 5", b"X-Page-ID: 6"), good.replace(b"WARC-Date", b"WARC-Dote"),
                good.replace(b"Content-Length: 7", b"Content-Length: 8"), good + b"x"):
        with pytest.raises((A.BadRecord, ValueError)):
            A.parse_record(bad)
    frame = zstandard.compress(good)
    assert list(A.read_frames(frame + A.SEPARATOR + frame)) == [good, good]
    for bad in (frame[:-3], b"abcd" + frame, frame + A.DICTIONARY_MAGIC + bytes(4), A.SEPARATOR[:6] + b"\x05\0"):
        with pytest.raises((A.BadRecord, zstandard.ZstdError)):
            list(A.read_frames(bad))
