"""Benchmark decontamination: a prefix-filtered set join over item-sized windows.

A window is ``window`` consecutive words of an item, or a shorter item as a whole; it is a
sequence of ``shingle``-word shingles (of its own length where it has fewer words).  A text
contains the window only if it contains all of the window's shingles, so one of them is a
sufficient prefix: the rarest one by its count over all documents.

1. Documents are scanned once.  A bitmap of all benchmark shingles (``bitmap_bits`` bits, whatever
   the benchmark's size) tells which word positions may begin one.  Touching positions form
   segments of words; any occurrence of a window lies in one segment.  Texts without a segment
   leave the scan as a count of words only.
2. Equal segments are joined once, however many documents hold them.  Every shingle of every
   segment is counted over all documents (a segment weighs as often as it occurs), each
   window takes its rarest shingle as prefix, and only these are joined with the segments.
   A window with a shingle that no document holds is dropped.
3. Positional and length bounds: a prefix at offset o of a window of n words must stand at
   o or later in its segment, with n - o words to come.  The n words are then compared one by one.
4. Hit words are counted as the union of the occurrences within a segment, segments of
   a document are disjoint, so their hits add up.

Memory: the bitmap, one Arrow batch of texts, and per group one segment, which is part of one text.
Item ids of a document are gathered in one row; there are no more than the benchmark has.
Windows are joined by their words, so copies of an item cost one window; the join's sides are
what occurs in both tables, and Spark splits a hot prefix shingle by size.

Defined results: null and wordless texts have 0 words and no hits; a null doc_id gives a row like
any other; repeated rows give a row each; an item without words has no window; items without
item_id make words hit and are not listed or counted; rows of one item_id are one item;
an empty benchmark hits nothing; an empty documents table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage, record_batch

# Bytes of ASCII digits and letters (upper case as lower case) and of non-ASCII
# characters are parts of words, all others separate them.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
                   else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)
MEMO = 1 << 18


class WordHashes(dict):
    """Word -> 64-bit hash, forgotten as a whole when it holds ``MEMO`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def split_words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (the length is part of it)."""
    m = max(0, len(hashes) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = (out ^ hashes[k:k + m]) * MIX
        out ^= out >> np.uint64(29)
    return out


def spans(starts: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of touching or overlapping stretches, sorted by start."""
    ends = np.maximum.accumulate(starts + n)
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    first, last = np.r_[0, cut], np.r_[cut - 1, len(starts) - 1]
    return list(zip(starts[first].tolist(), ends[last].tolist()))


SEGMENT = "segments array<struct<digest: binary, words: array<binary>>>"


def scan_kernel(bitmap: bytes, bits: int, sizes: list[int], batch_words: int):
    """mapInArrow: (doc_id, text as bytes) -> (doc_id, n_words, segments)."""
    segment = pa.list_(pa.struct([("digest", pa.binary()), ("words", pa.list_(pa.binary()))]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("segments", segment)])
    held = np.frombuffer(bitmap, np.uint8)
    shift = np.uint64(64 - bits)

    def hits(words, ends, hashes):
        """(start, size) of every shingle that may be in the benchmark, by start."""
        flat = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        at, n = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size in sizes:
            place = shingle_hashes(flat, size) >> shift
            found = np.flatnonzero((held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
            found = found[found + size <= ends[np.searchsorted(ends, found, side="right")]]
            at.append(found)
            n.append(np.full(len(found), size))
        at, n = np.concatenate(at), np.concatenate(n)
        order = np.argsort(at, kind="stable")
        return at[order], n[order]

    def rows(ids, words, counts, hashes):
        ends = np.cumsum(counts)
        at, n = hits(words, ends, hashes) if words else (np.empty(0, np.int64),) * 2
        low = np.searchsorted(at, ends - counts)
        high = np.searchsorted(at, ends)
        out = []
        for i in range(len(ids)):
            mine = []
            if low[i] < high[i]:
                for a, b in spans(at[low[i]:high[i]], n[low[i]:high[i]]):
                    run = words[a:b]
                    mine.append({"digest": hashlib.sha256(b" ".join(run)).digest(), "words": run})
            out.append(mine)
        return record_batch(schema, doc_id=ids, n_words=counts, segments=out)

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            ids, words, counts = [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                own = split_words(text.as_py())
                ids.append(doc_id)
                words += own
                counts.append(len(own))
                if len(words) >= batch_words:
                    yield rows(ids, words, counts, hashes)
                    ids, words, counts = [], [], []
            if ids:
                yield rows(ids, words, counts, hashes)

    return run


def window_kernel(window: int, shingle: int):
    """mapInArrow: (item_id, text as bytes) -> the windows of every item with their shingles' hashes."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.binary())),
                        ("size", pa.int32()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text")):
                words = split_words(text.as_py())
                if not words:
                    continue
                n, k = min(window, len(words)), min(shingle, len(words))
                flat = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                h = shingle_hashes(flat, k).view(np.int64)
                for low in range(0, len(words) - n + 1, 4096):
                    at = range(low, min(low + 4096, len(words) - n + 1))
                    yield record_batch(schema, item_id=[item] * len(at), words=[words[i:i + n] for i in at],
                                       size=[k] * len(at), shingles=[h[i:i + n - k + 1] for i in at])

    return run


def position_kernel(window: int, sizes: list[int]):
    """mapInArrow: distinct segments -> every shingle with the words that a window around it can hold."""
    schema = pa.schema([("digest", pa.binary()), ("copies", pa.int64()), ("shingle", pa.int64()),
                        ("at", pa.int32()), ("before", pa.int32()), ("around", pa.list_(pa.binary()))])

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            for digest, copies, words in zip(*(b.column(c) for c in ("digest", "copies", "words"))):
                digest, copies, words = digest.as_py(), copies.as_py(), words.as_py()
                flat = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                for size in sizes:
                    h = shingle_hashes(flat, size).view(np.int64)
                    for low in range(0, len(h), 4096):
                        at = range(low, min(low + 4096, len(h)))
                        begin = [max(0, i - window + size) for i in at]
                        yield record_batch(
                            schema, digest=[digest] * len(at), copies=[copies] * len(at),
                            shingle=h[low:at.stop], at=list(at), before=[i - a for i, a in zip(at, begin)],
                            around=[words[a:i + window] for i, a in zip(at, begin)])

    return run


def bitmap_of(shingles: DataFrame, bits: int) -> bytes:
    """Bitmap of the leading ``bits`` bits of every hash; the driver gets ``2 ** bits`` bits at most."""
    cells = (shingles.select(F.shiftrightunsigned("shingle", 64 - bits).alias("place"))
             .groupBy(F.shiftright("place", 5).alias("cell"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(place & 31 AS INT)))").alias("set")))
    out = np.zeros(max(1, 1 << (bits - 5)), np.uint32)
    for r in cells.toLocalIterator():
        out[r["cell"]] = r["set"]
    return out.tobytes()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5,
                  bitmap_bits: int = 23, batch_words: int = 1 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated) of every document.

    ``items``: the ids of the items with an occurring window, sorted as strings.
    """
    listed = cut_lineage(
        benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
        .mapInArrow(window_kernel(window, shingle),
                    "item_id bigint, words array<binary>, size int, shingles array<bigint>"), "leak-windows")
    key = F.sha2(F.array_join(F.transform("words", lambda w: F.hex(w)), " "), 256)
    listed = listed.withColumn("window", key)
    sizes = sorted(r["size"] for r in listed.select("size").distinct().collect())      # 1 .. shingle at most
    windows = listed.dropDuplicates(["window"]).select("window", "words", "shingles")
    items = listed.where("item_id is not null").select("window", "item_id").distinct()
    grams = windows.select("window", F.posexplode("shingles").alias("offset", "shingle"))

    scanned = cut_lineage(
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .mapInArrow(scan_kernel(bitmap_of(grams, bitmap_bits), bitmap_bits, sizes, batch_words),
                    f"doc_id bigint, n_words bigint, {SEGMENT}")
        .withColumn("row", F.monotonically_increasing_id()), "leak-scan")           # fixed once written
    parts = scanned.where("size(segments) > 0").select("row", "doc_id", "n_words", F.explode("segments").alias("s"))
    distinct = parts.groupBy("s.digest").agg(F.count(F.lit(1)).alias("copies"), F.first("s.words").alias("words"))
    places = cut_lineage(distinct.mapInArrow(
        position_kernel(window, sizes), "digest binary, copies bigint, shingle bigint, at int, before int, "
        "around array<binary>"), "leak-places")

    counts = places.groupBy("shingle").agg(F.sum("copies").alias("n"))
    prefixes = (grams.join(counts, "shingle", "left").groupBy("window")
                .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("p"))
                .where("p.n > 0").select("window", "p.shingle", "p.offset"))
    prefixes = cut_lineage(prefixes.join(windows.select("window", "words"), "window"), "leak-prefixes")
    n = F.size("words")
    found = (places.join(prefixes, "shingle")
             .where((F.col("at") >= F.col("offset")) & (F.size("around") - F.col("before") >= n - F.col("offset")))
             .where(F.slice("around", F.col("before") - F.col("offset") + 1, n) == F.col("words"))
             .select("digest", "window", (F.col("at") - F.col("offset")).alias("start"),
                     (F.col("at") - F.col("offset") + n).alias("end")))
    found = cut_lineage(found, "leak-found")

    reached = F.max("end").over(W.partitionBy("digest").orderBy("start", "end").rowsBetween(
        W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reached, F.lit(0))))
    covered = found.select("digest", "start", "end").distinct().withColumn("fresh", fresh) \
        .groupBy("digest").agg(F.sum("fresh").alias("n_hit"))
    named = (found.select("digest", "window").distinct().join(items, "window")
             .groupBy("digest").agg(F.collect_set("item_id").alias("items")))
    judged = cut_lineage(covered.join(named, "digest", "left"), "leak-judged")

    nothing = F.array().cast("array<bigint>")
    hit = (parts.select("row", "doc_id", "n_words", F.col("s.digest").alias("digest"))
           .join(judged, "digest", "left").groupBy("row", "doc_id", "n_words")
           .agg(F.coalesce(F.sum("n_hit"), F.lit(0)).cast("long").alias("n_hit"),
                F.array_distinct(F.flatten(F.collect_list(F.coalesce("items", nothing)))).alias("items"))
           .drop("row"))
    clean = scanned.where("size(segments) = 0").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), nothing.alias("items"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return (clean.unionByName(hit).withColumn("items", names)
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
           FROM documents),
b AS (SELECT item_id, words, least(len(words), 10) AS n FROM (
        SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
        FROM benchmark) WHERE len(words) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS window
      FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM b)),
g AS (SELECT r, i, n, array_to_string(words[i:i + n - 1], ' ') AS window
      FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM w))),
hits AS (SELECT g.r, g.i, g.n, w.item_id FROM g JOIN w ON g.n = w.n AND g.window = w.window),
covered AS (SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(m.n_items, 0) AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.r = d.r LEFT JOIN named m ON m.r = d.r
"""
