"""Spelling variants: words one edit apart, found by FM-index search schemes.

A search scheme for one error splits a word in two halves: the error lies in one, so the other
occurs exactly, at the same end of the other word.  Both searches run on suffix-rank intervals over
the delimited vocabulary: one index of the words finds the right half exactly and extends to the left
with one error, one index of the reversed words finds the left half and extends to the right.
A step extends all intervals of a block of words by one code point: the new interval's ends
are ranks of the code point in the Burrows-Wheeler transform.  An error is an inserted or replaced
code point (those that the transform holds within the interval) or a skipped one; what follows must
match exactly up to the delimiter.  The row that is left names the word.

A pair within the left half's reach is counted by the search that holds the left half, other pairs
by the one that holds the right half, so none is counted twice, and no pair leaves its task.

Sharding: a word of m code points is indexed under its outer ``e(m) = (m - 1) // 2`` code points
(``min_length`` of at least 4 makes that one or more), and asks where words of m - 1, m and m + 1
can stand; the exact half of every word that may ask is at least that long, so equal outer parts
meet.  Shards hold about ``shard_words`` words; a key with more is split into pieces by the word's
hash, and asked in each.  A task holds one shard's index (about 30 bytes a code point) and one
block of asking words.

The vocabulary is counted in two steps, within a task (``held_words`` at a time) and by a shuffle of what
is left; a hot word leaves a task once per flush.  Forms are followed to their root by doubling.

Defined results: null and wordless texts have no words; a null doc_id is written as nothing before
the colon; repeated rows count each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, record_batch

# Words are made of ASCII letters (upper case as lower case) and the code points U+00C0
# to U+00FF, as Latin-1 bytes; all others separate them.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 192 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64())])


def counting_kernel(modulus: int, min_length: int, held_words: int):
    """mapInArrow: (doc_id, text) -> (word, n), runs lower-cased and those whose hash says so damaged."""

    def rows(total):
        return record_batch(SCHEMA, word=[w.decode("latin-1") for w in total], n=list(total.values()))

    def run(batches):
        total: dict[bytes, int] = defaultdict(int)
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                runs = (text.as_py() or "").encode("latin-1", "replace").translate(LETTERS).split()
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter([w for w in runs if len(w) >= min_length]).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
                    if h % modulus == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) >= held_words:
                    yield rows(total)
                    total.clear()
        if total:
            yield rows(total)

    return run


def vocabulary(docs: DataFrame, modulus: int = 199, min_length: int = 6, min_count: int = 5,
               held_words: int = 1 << 18) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points that occur ``min_count`` times."""
    parts = docs.select("doc_id", "text").mapInArrow(
        counting_kernel(modulus, min_length, held_words), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the text's suffixes in order, by prefix doubling."""
    n, step = len(text), 1
    rank = text.astype(np.int64)
    while True:
        key = rank * (n + 256)
        key[:max(n - step, 0)] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(sorted_key, prepend=sorted_key[:1]) != 0)
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search over distinct words, each between two delimiters (zero bytes)."""

    def __init__(self, words: list[bytes]):
        self.text = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        rows = suffix_array(self.text)
        self.width = len(rows) + 1
        self.bwt = self.text[rows - 1]
        places = np.arange(len(rows))
        order = np.argsort(self.bwt, kind="stable")
        # Occurrences by code point and row: a rank is a place in this list, and the interval's end too.
        self.marks = self.bwt[order].astype(np.int64) * self.width + places[order]
        self.starts = np.flatnonzero(self.text == 0)
        self.rows = rows
        self.letters = np.unique(self.bwt[self.bwt > 0])

    def extend(self, letter, low, high):
        """Intervals of the suffixes that start with ``letter`` and go on with one of [low, high)."""
        at = letter.astype(np.int64) * self.width
        return np.searchsorted(self.marks, at + low), np.searchsorted(self.marks, at + high)

    def letters_in(self, low, high):
        """(k, letter): the distinct letters before the suffixes of every interval k."""
        n = high - low
        few = np.flatnonzero(n <= len(self.letters))
        many = np.flatnonzero(n > len(self.letters))
        ends = np.cumsum(n[few])
        k = np.repeat(few, n[few])
        rows = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n[few], n[few]) + low[k]
        seen = np.unique(k * 256 + self.bwt[rows])
        k, letter = seen >> 8, (seen & 255).astype(np.uint8)
        inner = letter > 0
        wide = np.repeat(many, len(self.letters))
        return (np.concatenate([k[inner], wide]),
                np.concatenate([letter[inner], np.tile(self.letters, len(many))]))

    def word_of(self, row):
        """Number of the word whose leading delimiter starts the suffix of this row."""
        return np.searchsorted(self.starts, self.rows[row])


def one_error_search(index: FMIndex, words: list[bytes], exact: list[int]):
    """(query, word number) of all indexed words one edit away, the last ``exact`` letters being the same."""
    lengths = np.array([len(w) for w in words])
    flat = np.frombuffer(b"".join(words), np.uint8)
    begin = np.cumsum(lengths) - lengths
    q = np.arange(len(words))
    left = lengths.copy()                         # letters still to match
    low = np.zeros(len(words), np.int64)
    high = np.full(len(words), int(np.searchsorted(index.marks, index.width)))     # suffixes with a delimiter first
    stop = lengths - np.array(exact)
    free = (np.empty(0, np.int64),) * 4           # intervals with their one error made
    hits = []
    while len(q) or len(free[0]):
        fq, fleft, flow, fhigh = free
        done = fleft == 0
        if done.any():
            a, b = index.extend(np.zeros(done.sum(), np.uint8), flow[done], fhigh[done])
            met = a < b
            hits.append(fq[done][met] * len(index.starts) + index.word_of(a[met]))
            fq, fleft, flow, fhigh = fq[~done], fleft[~done], flow[~done], fhigh[~done]
        a, b = index.extend(flat[begin[fq] + fleft - 1], flow, fhigh)
        keep = a < b
        made = [(fq[keep], fleft[keep] - 1, a[keep], b[keep])]
        # Intervals without an error yet: the exact half first, then every kind of error.
        e = np.flatnonzero(left <= stop)
        if len(e):
            k, letter = index.letters_in(low[e], high[e])
            k = e[k]
            a, b = index.extend(letter, low[k], high[k])
            made.append((q[k], left[k], a, b))                                     # inserted
            more = left[k] > 0
            k, letter, a, b = k[more], letter[more], a[more], b[more]
            other = flat[begin[q[k]] + left[k] - 1] != letter
            made.append((q[k][other], left[k][other] - 1, a[other], b[other]))     # replaced
            skip = e[left[e] > 0]
            made.append((q[skip], left[skip] - 1, low[skip], high[skip]))          # deleted
        go = left > 0
        q, left, low, high = q[go], left[go], low[go], high[go]
        a, b = index.extend(flat[begin[q] + left - 1], low, high)
        keep = a < b
        q, left, low, high = q[keep], left[keep] - 1, a[keep], b[keep]
        stop = stop[go][keep]
        free = tuple(np.concatenate(x) for x in zip(*made))
    n = len(index.starts)
    pairs = np.unique(np.concatenate([np.empty(0, np.int64), *hits]))       # one word may be met by several edits
    return np.stack([pairs // n, pairs % n])


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def search_kernel(block: int):
    """mapInArrow over rows sorted by (shard, asks): a shard's words first, then those that ask it.

    Gives per asking word its near words that this search has to count, and the best of them.
    """

    def near(index, known, counts, ask, flip):
        query = [w[::-1] if flip else w for w in ask]
        exact = [len(w) // 2 if flip else len(w) - len(w) // 2 for w in ask]
        best: dict[int, list] = {}
        pairs = one_error_search(index, query, exact)
        for q, j in pairs.T.tolist():
            word, other = ask[q], known[j]
            half = len(word) // 2
            if not flip and other[:half] == word[:half]:
                continue                                   # the other search counts it
            now = best.setdefault(q, [0, 0, b""])
            now[0] += 1
            if counts[j] > now[1] or counts[j] == now[1] and other < now[2]:
                now[1:] = counts[j], other
        return record_batch(NEAR, word=[ask[q].decode("latin-1") for q in best],
                            n_near=[x[0] for x in best.values()], form_n=[x[1] for x in best.values()],
                            form=[x[2].decode("latin-1") for x in best.values()])

    def run(batches):
        now, flip, known, counts, index, ask = None, False, [], [], None, []
        for b in batches:
            for shard, way, asks, word, n in zip(*(b.column(c).to_pylist()
                                                   for c in ("shard", "flip", "asks", "word", "n"))):
                if shard != now or (ask and len(ask) >= block):
                    if ask and index:
                        yield near(index, known, counts, ask, flip)
                    ask = []
                if shard != now:
                    now, flip, known, counts, index = shard, way, [], [], None
                word = word.encode("latin-1")
                if not asks:
                    known.append(word)
                    counts.append(n)
                    continue
                if known and index is None:
                    index = FMIndex([w[::-1] if flip else w for w in known])
                ask.append(word)
        if ask and index:
            yield near(index, known, counts, ask, flip)

    return run


def near_words(words: DataFrame, shard_words: int = 1 << 14, block: int = 2048) -> DataFrame:
    """(word, n_near, form_n, form): near words counted, the most frequent (ties: smallest) of them."""
    m = F.length("word")

    def outer(size):
        """Both searches' keys of the outer ``size`` code points, with their length class."""
        return F.array(*[F.struct(F.lit(flip).alias("flip"), size.alias("size"), part.alias("outer"))
                         for flip, part in ((True, F.substring("word", F.lit(1), size)),
                                            (False, F.substring("word", m - size + 1, size)))])

    index = words.select("word", "n", F.lit(False).alias("asks"), F.explode(outer(F.floor((m - 1) / 2).cast("int"))).alias("key"))
    sizes = [F.floor((m - 2) / 2).cast("int"), F.floor((m - 1) / 2).cast("int"), F.floor(m / 2).cast("int")]
    asks = words.select("word", "n", F.lit(True).alias("asks"),
                        F.explode(F.array_distinct(F.concat(*map(outer, sizes)))).alias("key"))
    shards = max(1, -(-2 * words.count() // shard_words))
    pieces = index.groupBy("key").agg(F.count(F.lit(1)).alias("held")).select(
        "key", F.ceil(F.col("held") / shard_words).cast("int").alias("pieces"))
    pieces = cut_lineage(pieces, "spell-keys")
    placed = index.join(pieces, "key").withColumn(
        "piece", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    asked = asks.join(pieces, "key").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    rows = placed.unionByName(asked)
    # The piece of a key that fills a shard has one of its own; other keys share shards.
    shard = F.when(F.col("pieces") > 1, F.concat_ws(":", F.to_json("key"), "piece")).otherwise(
        F.concat_ws(":", "key.flip", F.pmod(F.xxhash64("key"), F.lit(shards))))
    rows = rows.select(shard.alias("shard"), F.col("key.flip").alias("flip"), "asks", "word", "n")
    found = (rows.dropDuplicates(["shard", "asks", "word"]).repartition(max(shards, 2), "shard")
             .sortWithinPartitions("shard", "asks", "word")
             .mapInArrow(search_kernel(block), "word string, n_near bigint, form_n bigint, form string"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(
        (-F.col("form_n")).alias("less"), "form")).alias("best")) \
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: where following forms ends."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        now = cut_lineage(now.join(step, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spell-roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(docs: DataFrame, modulus: int = 199, min_length: int = 6, min_count: int = 5,
                      factor: int = 5, shard_words: int = 1 << 14, block: int = 2048) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the documents' vocabulary."""
    words = cut_lineage(vocabulary(docs, modulus, min_length, min_count), "spell-words")
    near = cut_lineage(near_words(words, shard_words, block), "spell-near")
    known = words.join(near, "word", "left").withColumn("large", F.col("form_n") >= factor * F.col("n"))
    known = cut_lineage(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("large"), F.col("form")).alias("form"),
        F.when(F.col("large"), F.col("form_n")).alias("form_n")), "spell-forms")
    ends = roots(known.where("form is not null"))
    return (known.join(ends, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))


ORACLE = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
               lambda x, y: xor(x // 2, 3988292384 * (x % 2)))) AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
           SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
               regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'),
               lambda x: CAST('0x' || x AS BIGINT))),
             lambda x, y: xor(x // 256, t[xor(x % 256, y) % 256 + 1])), 4294967295) AS h
           FROM runs, crc WHERE length(run) >= 6),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                           ELSE run END AS word FROM hashed)
          WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT DISTINCT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(other, (-n, other)) AS form FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * w.n THEN b.form END AS form,
            CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n
          FROM words w LEFT JOIN best b USING (word)),
chain AS (SELECT word, word AS at FROM forms UNION ALL
          SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at AS root
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at AND e.form IS NULL
"""
