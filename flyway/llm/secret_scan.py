"""Secret scans: fixed patterns plus a randomness test battery with false-discovery control.

Base spans come from three patterns (assignments, access keys, long hex).  The method adds
spans of kind ``random``: runs of 20 or more characters of the base-64 alphabets that mix
letters and digits, or what base spans leave of a run at either side, if it is as long.  Such
a part is tested with and without the separators at its ends, and the larger p-value counts.
Each is read in the smallest encoding that
holds its characters (hex, base 32, base 36, base 64) and tested for being uniformly random there:

* chi-squared uniformity of the alphabet, in as many equal bins as five symbols each allow,
* the runs test of symbols above and below the middle of the alphabet,
* the serial correlation of neighbouring symbols,

joined by Fisher's method into one p-value of "this is random".  A string that fails the battery
(below ``battery``) is no secret.  To pass is no proof either: short identifiers pass too.  So what passes
has to disprove that it is structured.  The null hypothesis is a character model of identifiers,
paths and dates: runs of lower case, upper case, digits and separators (``SWITCH``), whose letters
follow each other as in the words of all documents.  Its likelihood over that of uniform symbols of
the encoding (each encoding with an equal share) is a p-value of "this is structured", as the
ratio exceeds 1 / p with probability p at most; a string that fails the battery has p-value 1.

A reported string is a discovery, and Benjamini-Hochberg over the p-values of all candidates keeps the expected
share of structured strings among the reported below ``alpha``.  It is length-aware: a p-value is weighed by
length (``n / mean length``), and the evidence itself grows with the length.

The corpus-wide step needs only a histogram of the weighed p-values (hundredths of a
decade, ``BINS`` rows at most); texts never move.

Defined results: a null or empty text has no spans; null doc_ids and repeated rows are
scanned row by row; an empty table gives no rows; extra columns are ignored by
``secret_spans`` and kept by ``redact_secrets``.  Offsets count code points.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, record_batch, text_chunks

# The base patterns and the order of the kinds.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")        # the runs [0-9a-f]+ of 24 or more characters
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "apikey", "api_key")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_"]
PLACES = [{c: i for i, c in enumerate(e)} for e in ENCODINGS]
BINS = 30_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, by start and kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in WORDS_OF_ASSIGN):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_tail(x: float, d: int) -> float:
    """Wilson and Hilferty's approximation."""
    return normal_tail(((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)))


def randomness(word: str) -> float | None:
    """p-value of the battery in the inferred encoding; None when there is nothing to test."""
    word = word.strip("=")
    if len(word) < 20 or word.isalpha() or not any(c.isalpha() for c in word):
        return None
    place = next((p for p in PLACES if all(c in p for c in word)), None)
    if place is None or not any(c in DIGITS for c in word):
        return None
    k, n = len(place), len(word)
    s = np.array([place[c] for c in word], float)
    bins = max(2, min(k, n // 5))
    seen = np.bincount((s * bins // k).astype(int), minlength=bins)
    share = np.bincount(np.arange(k) * bins // k, minlength=bins) / k
    p1 = chi_squared_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), bins - 1)
    high = s >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    p2 = 1e-12                                              # all on one side: no runs to speak of
    if a and b:
        mean = 2 * a * b / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p2 = 2 * normal_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var))
    d = s - s.mean()
    r = float((d[1:] * d[:-1]).sum() / max(float((d * d).sum()), 1e-9))
    p3 = 2 * normal_tail(abs(r + 1 / n) * math.sqrt(n))
    half = -sum(math.log(max(min(p, 1.0), 1e-300)) for p in (p1, p2, p3))
    return math.exp(-half) * (1 + half + half * half / 2)   # chi-squared tail, six degrees


# Character classes of the structured model (lower, upper, digit, separator), the share of each at a
# string's start, and that of the next character's class (columns) after each class (rows).
CLASSES = [LOWER, UPPER, DIGITS, "+/-_"]
CLASS = {c: i for i, cs in enumerate(CLASSES) for c in cs}
FIRST = [0.50, 0.25, 0.20, 0.05]
SWITCH = [[0.80, 0.07, 0.05, 0.08], [0.60, 0.30, 0.05, 0.05], [0.08, 0.05, 0.75, 0.12], [0.45, 0.20, 0.25, 0.10]]
LETTER = np.array([c & 31 if chr(c).isalpha() and c < 128 else 0 for c in range(256)], np.uint16)

IN_RUN = np.array([chr(c) in CLASS for c in range(256)], np.int8)


def letter_kernel(batches):
    """mapInArrow: (text) -> (pair, n): letters (case folded, 0: none) that follow each other outside candidates."""
    schema = pa.schema([("pair", pa.int32()), ("n", pa.int64())])
    total = np.zeros(27 * 27, np.int64)
    for b in batches:
        for texts in text_chunks(b.column("text"), 1 << 20):
            held = np.frombuffer("\0".join(texts).encode() + b"\0", np.uint8)
            x = LETTER[held]
            ends = np.flatnonzero(np.diff(IN_RUN[held], prepend=np.int8(0)))        # runs of candidate characters
            long = np.flatnonzero(ends[1::2] - ends[::2] >= 20)
            for i, j in zip(ends[::2][long].tolist(), ends[1::2][long].tolist()):
                x[i:j] = 0                                  # what may be a secret is no ordinary text
            total += np.bincount(x[:-1] * 27 + x[1:], minlength=27 * 27)
    some = np.flatnonzero(total)
    yield record_batch(schema, pair=some, n=total[some])


def letter_model(docs: DataFrame) -> np.ndarray:
    """log2 P(letter | letter before), 27 x 27, over the words of all documents, smoothed."""
    pairs = (docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
             .mapInArrow(letter_kernel, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    n = np.zeros(27 * 27)
    for r in pairs.collect():                               # 729 rows at most
        n[r["pair"]] = r["n"]
    n = n.reshape(27, 27)[:, 1:]
    alone = (n.sum(axis=0) + 1) / (n.sum() + 26)
    after = (n + 10 * alone) / (n.sum(axis=1, keepdims=True) + 10)
    p = 0.7 * after + 0.2 * alone + 0.1 / 26
    return np.log2(np.hstack([np.ones((27, 1)), p]))


def structured(word: str, letters: np.ndarray) -> float:
    """p-value of "this is structured": the model's likelihood over that of uniform symbols, 1 at most."""
    bits, kind, before = 0.0, None, 0
    for c in word:
        now = CLASS[c]
        bits += math.log2((FIRST if kind is None else SWITCH[kind])[now])
        letter = ord(c) & 31 if now < 2 else 0
        if letter:                                          # a capital after lower case begins a word
            bits += letters[0 if now == 1 and kind == 0 else before, letter]
        else:
            bits -= math.log2(len(CLASSES[now]))
        kind, before = now, letter
    uniform = sum(2.0 ** max(-1000.0, -len(word) * math.log2(len(p)) - bits) for p in PLACES
                  if all(c in p for c in word)) / len(PLACES)
    return min(1.0, 1.0 / uniform) if uniform > 0 else 1.0


def evidence(word: str, letters: np.ndarray, battery: float) -> float | None:
    """p-value of "this is structured"; 1 for a string that fails the battery, None for one it does not test."""
    p = randomness(word)
    if p is None:
        return None
    return max(structured(word.strip("="), letters), 1e-300) if p >= battery else 1.0


def candidates(text: str, base: list[tuple[int, int, int]], letters: np.ndarray,
               battery: float) -> list[tuple[int, int, float]]:
    """(start, end, p-value) of the candidate strings: the runs, less their base spans."""
    out = []
    for m in CANDIDATE.finditer(text):
        at, parts = m.start(), []
        for a, _, b in base:                                # by start
            if a >= m.end():
                break
            if b > at:
                parts.append((at, a))
                at = b
        parts.append((at, m.end()))
        for a, b in parts:
            if b - a < 20:
                continue
            word = text[a:b]
            p = evidence(word, letters, battery)
            if b - a < m.end() - m.start():                 # what joins a part to a base span is no symbol of it
                both = [x for x in (p, evidence(word.strip("+/-_"), letters, battery)) if x is not None]
                p = min(1.0, 2 * min(both)) if both else None           # the better of two readings
            if p is not None:
                out.append((a, b, p))
    return out


def scan_kernel(letters: np.ndarray, battery: float):
    schema = pa.schema([("doc_id", pa.int64()),
                        *((c, pa.list_(pa.int32())) for c in ("starts", "kinds", "ends")),
                        ("p", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            rows = []
            for texts in text_chunks(b.column("text"), 1 << 20):
                for t in texts:
                    base = base_spans(t)
                    spans = sorted([(s, k, e, None) for s, k, e in base]
                                   + [(s, 3, e, p) for s, e, p in candidates(t, base, letters, battery)],
                                   key=lambda x: x[:2])
                    rows.append(list(zip(*spans)) or [()] * 4)
            if rows:
                starts, kinds, ends, p = zip(*rows)
                yield record_batch(schema, doc_id=b.column("doc_id"), starts=starts, kinds=kinds,
                                   ends=ends, p=p)

    return run


def scan(docs: DataFrame, letters: np.ndarray, battery: float) -> DataFrame:
    """(doc_id, spans array<(start, kind, end, p)>) of every document, candidates included."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ints = "array<int>"
    found = texts.mapInArrow(scan_kernel(letters, battery), f"doc_id bigint, starts {ints}, kinds {ints}, ends {ints}, "
                                                            "p array<double>")
    return found.select("doc_id", F.arrays_zip(
        F.col("starts").alias("start"), F.col("kinds").alias("kind"), F.col("ends").alias("end"),
        "p").alias("spans"))


def discovery_level(found: DataFrame, alpha: float) -> tuple[float, float]:
    """(mean candidate length, weighed p-value up to which candidates are reported)."""
    c = found.select(F.explode("spans").alias("s")).where("s.p is not null").select(
        (F.col("s.end") - F.col("s.start")).alias("n"), F.col("s.p").alias("p"))
    mean, m = c.agg(F.avg("n"), F.count(F.lit(1))).first()
    if not m:
        return 1.0, 0.0
    step = F.floor(-F.log10(F.greatest(F.least(F.col("p") * F.lit(mean) / F.col("n"), F.lit(1.0)), F.lit(1e-300))) * 100)
    bins = sorted(((r[0], r[1]) for r in c.groupBy(F.least(step, F.lit(BINS)).alias("b")).count().collect()),
                  reverse=True)                             # at most BINS rows
    seen, level = 0, 0.0
    for b, n in bins:                                       # from the smallest p-values up
        seen += n
        upper = 10 ** (-b / 100)                            # the largest p-value of the bin
        if upper <= alpha * seen / m:
            level = upper
    return float(mean), level


def secret_spans(docs: DataFrame, alpha: float = 0.01, battery: float = 0.01) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every document."""
    found = cut_lineage(scan(docs, letter_model(docs), battery), "secret-spans")
    mean, level = discovery_level(found, alpha)
    kept = F.filter("spans", lambda s: s.p.isNull() | (
        s.p * F.lit(mean) / (s.end - s.start) <= F.lit(level)))
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")

    def count(kind: int):
        return F.size(F.filter("kept", lambda s: s.kind == kind)).cast("long")

    return (found.select("doc_id", kept.alias("kept"))
            .select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                    F.sha2(joined(F.filter("kept", lambda s: s.kind < 3)), 256).alias("base_sha256"),
                    joined(F.col("kept")).alias("spans")))


def redacted(text: str, letters: np.ndarray, battery: float, mean: float, level: float, mask: str) -> str:
    """The text with every reported span, overlapping ones as one, replaced by the mask."""
    base = base_spans(text)
    spans = sorted([(s, e) for s, _, e in base]
                   + [(s, e) for s, e, p in candidates(text, base, letters, battery) if p * mean / (e - s) <= level])
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact_secrets(docs: DataFrame, alpha: float = 0.01, battery: float = 0.01, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span masked in ``text``; n_chars, if there, follows the text.

    The letter model and the level are found over the whole table first; texts are then scanned again
    in place, so no text is shuffled or stored.
    """
    letters = letter_model(docs)
    mean, level = discovery_level(cut_lineage(scan(docs, letters, battery).where(F.exists(
        "spans", lambda s: s.p.isNotNull())), "secret-candidates"), alpha)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = [None if t is None else redacted(t, letters, battery, mean, level, mask)
                     for chunk in text_chunks(b.column(at), 1 << 20) for t in chunk]
            columns = list(b.columns)
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
