"""Zstandard WARC archives: written by one job, read back and validated by another.

Layout: a leading skippable frame holds the dictionary, then each record is one frame of
its own, compressed with that dictionary.  Spark's text sink puts one row after the other
into a file with a line separator; the separator here is an empty skippable frame (its
eight bytes are ASCII), so the file is a valid Zstandard stream on any store that Spark
writes to, and readers skip the separators.

Equal payloads of at least ``least_bytes`` are recorded once: the record with the largest
page_id is the response, the others are revisits that name it.  Digests are found first
(a narrow table), repeated ones are pre-aggregated, and only the decisions are joined back,
on (page_id, digest), so a payload that a third of all pages share makes no hot task.

Archives hold about ``archive_bytes`` of payload, so both the writer's and the reader's
memory is bounded (by the largest record when that is larger).  The dictionary is trained
on at most ``sample_rows`` payloads, those with the smallest hashes, cut to
``sample_bytes`` each; it only changes the compression, never a record.

Defined results: a null html is an empty payload; a null page_id counts as smaller than
any other, and if all of a group are null each is a response; rows repeated with the
largest page_id are all responses; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, cut_lineage, record_batch

# Magic numbers of skippable frames (separator, dictionary) and of a Zstandard frame.
SEPARATOR = b"\x50\x2a\x4d\x18" + bytes(4)
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
SKIPPABLE = {bytes([0x50 + i, 0x2A, 0x4D, 0x18]) for i in range(16)}
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
EPOCH = "1970-01-01T00:00:00Z"              # archives of the same pages are the same bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    """A version-8-like UUID URN made of the page id and the payload digest."""
    h = hashlib.sha1(f"{page_id} {digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def make_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record: an HTTP response, or a revisit that holds only its HTTP head."""
    digest = hashlib.sha1(payload)
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = head if refers_to is not None else head + payload
    coded = "sha1:" + base64.b32encode(digest.digest()).decode()
    lines = [("WARC-Type", "response" if refers_to is None else "revisit"),
             ("WARC-Record-ID", record_id(page_id, digest.hexdigest())), ("WARC-Date", EPOCH),
             ("WARC-Target-URI", " ".join((url or "about:blank").split())),
             ("WARC-Payload-Digest", coded),
             ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
             ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        lines.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest.hexdigest())),
                  ("X-Refers-To-Page-ID", str(refers_to))]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return VERSION + b"\r\n" + text + b"\r\n" + block + b"\r\n\r\n"


class BadRecord(ValueError):
    pass


def parse_record(raw: bytes) -> dict:
    """A record's headers and content, after checking version, headers, lengths and digests."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first != VERSION or not sep:
        raise BadRecord("no WARC/1.1 record")
    headers = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon or name in headers:
            raise BadRecord(f"bad header {line[:60]!r}")
        headers[name] = value.strip()
    for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest",
                 "WARC-Block-Digest", "X-Payload-Length"):
        if name not in headers:
            raise BadRecord(f"no {name}")
    n = int(headers["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise BadRecord("Content-Length does not match the record")

    def coded(data: bytes) -> str:
        return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()

    if coded(block) != headers["WARC-Block-Digest"]:
        raise BadRecord("block digest does not match")
    http, sep, payload = block.partition(b"\r\n\r\n")
    if not sep or not http.startswith(b"HTTP/1.1 200"):
        raise BadRecord("no HTTP response")
    size = int(headers["X-Payload-Length"])
    if f"Content-Length: {size}".encode() not in http.split(b"\r\n"):
        raise BadRecord("HTTP length does not match")
    kind = headers["WARC-Type"]
    if kind == "response":
        if len(payload) != size or coded(payload) != headers["WARC-Payload-Digest"]:
            raise BadRecord("payload does not match its length or digest")
    elif kind != "revisit" or payload or headers.get("WARC-Profile") != PROFILE \
            or "WARC-Refers-To" not in headers:
        raise BadRecord(f"bad record of type {kind}")
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    page, refers = (headers.get(k) for k in ("X-Page-ID", "X-Refers-To-Page-ID"))
    page, refers = page and int(page), refers and int(refers)
    if headers["WARC-Record-ID"] != record_id(page, digest) or (
            kind == "revisit" and headers["WARC-Refers-To"] != record_id(refers, digest)):
        raise BadRecord("record ids do not match")
    return {"page_id": page, "url": headers.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": refers,
            "payload": payload if kind == "response" else None}


def read_frames(data: bytes):
    """The decoded frames of an archive, one at a time; the leading skippable frame is the dictionary."""
    at, dictionary, view = 0, None, memoryview(data)
    while at < len(data):
        magic = bytes(view[at:at + 4])
        if magic in SKIPPABLE:
            n = int.from_bytes(view[at + 4:at + 8], "little")
            if at + 8 + n > len(data):
                raise BadRecord("cut skippable frame")
            if magic == DICTIONARY_MAGIC:
                if at:
                    raise BadRecord("the dictionary does not lead the archive")
                dictionary = zstandard.ZstdCompressionDict(bytes(view[8:8 + n]))
            at += 8 + n
            continue
        if magic != FRAME_MAGIC:
            raise BadRecord(f"no frame at byte {at}")
        d = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj() if dictionary \
            else zstandard.ZstdDecompressor().decompressobj()
        out, step = [], 1 << 16
        while not d.eof and at < len(data):
            out.append(d.decompress(view[at:at + step]))
            at += min(step, len(data) - at)
        if not d.eof:
            raise BadRecord("cut frame")
        at -= len(d.unused_data)
        yield b"".join(out)


def write_kernel(dictionary: bytes | None, level: int):
    """mapInArrow: pages of one partition -> the rows (frames) of one archive."""
    schema = pa.schema([("frame", pa.binary())])

    def run(batches):
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        squeeze = zstandard.ZstdCompressor(level=level, dict_data=trained).compress
        begun = False
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256).to_pylist()
                frames = [squeeze(make_record(r["page_id"], r["url"], (r["html"] or "").encode(),
                                              r["refers_to"])) for r in part]
                if not begun and dictionary:
                    frames.insert(0, DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary)
                begun = True
                yield record_batch(schema, frame=frames)

    return run


def read_kernel(payloads: bool):
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())]
    if payloads:
        fields += [("url", pa.string()), ("payload", pa.binary())]
    schema = pa.schema(fields)

    def run(batches):
        for b in batches:
            for content in b.column("content"):
                rows = []
                for frame in read_frames(content.as_py()):
                    r = parse_record(frame)
                    rows.append([r[f.name] for f in schema])
                    if len(rows) == 1024:
                        yield record_batch(schema, **dict(zip(schema.names, zip(*rows))))
                        rows = []
                if rows:
                    yield record_batch(schema, **dict(zip(schema.names, zip(*rows))))

    return run


def train_dictionary(pages: DataFrame, sample_rows: int, sample_bytes: int, size: int) -> bytes | None:
    """Dictionary content from a bounded sample; None where there is too little to train on."""
    salted = pages.select(F.xxhash64("page_id", "html").alias("salt"),
                          F.encode(F.substring("html", 1, sample_bytes), "UTF-8").alias("part"))
    rows = [bytes(r["part"]) for r in bounded_sample(salted, "salt", sample_rows).collect() if r["part"]]
    try:
        return zstandard.train_dictionary(size, rows).as_bytes() if len(rows) >= 8 else None
    except zstandard.ZstdError:                  # too few or too uniform samples
        return None


def write_warc(pages: DataFrame, path: str, least_bytes: int = 1000, archive_bytes: int = 1 << 24,
               level: int = 3, sample_rows: int = 512, sample_bytes: int = 4096,
               dictionary_bytes: int = 1 << 14) -> None:
    """Write one record per row of (page_id, url, html) into Zstandard WARC archives under ``path``."""
    pages = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    keyed = pages.select("*", F.unhex(F.sha1(F.encode("html", "UTF-8"))).alias("digest"),
                         F.octet_length("html").cast("long").alias("n"))
    narrow = cut_lineage(keyed.select("page_id", "digest", "n"), "warc-digests")
    total = narrow.agg(F.sum("n")).first()[0] or 0
    groups = (narrow.where(F.col("n") >= least_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("times"))
              .where("times > 1 and last is not null").select("digest", "last"))
    least_id = F.lit(-(1 << 63))
    revisits = (narrow.join(cut_lineage(groups, "warc-groups"), "digest")
                .where(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")))
                .groupBy(F.coalesce("page_id", least_id).alias("key"), F.col("page_id").isNull().alias("no_id"),
                         "digest").agg(F.max("last").alias("refers_to")))
    archives = int(max(1, -(-total // archive_bytes)))
    rows = (keyed.withColumn("key", F.coalesce("page_id", least_id))
            .withColumn("no_id", F.col("page_id").isNull())
            .repartition(archives, "key", "no_id", "digest")
            .join(cut_lineage(revisits, "warc-revisits"), ["key", "no_id", "digest"], "left")
            .select("page_id", "url", "html", "refers_to"))
    dictionary = train_dictionary(pages, sample_rows, sample_bytes, dictionary_bytes)
    (rows.mapInArrow(write_kernel(dictionary, level), "frame binary")
         .select(F.col("frame").cast("string").alias("value"))
         .write.option("lineSep", SEPARATOR.decode("ascii")).text(path))


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to[, url, payload]) per record.

    Fails on a record whose headers, lengths or digests do not hold.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(read_kernel(payloads), "page_id bigint, payload_bytes bigint, "
                            "payload_digest string, record_type string, refers_to bigint"
                            + (", url string, payload binary" if payloads else ""))
