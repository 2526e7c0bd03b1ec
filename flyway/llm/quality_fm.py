"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its words (hashed into ``2 ** word_bits`` places, log counts
scaled to unit length), the structure statistics of the quality rules, and metadata that
the text carries (length, bytes per character, words per line).  The machine scores

    w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i) ** 2 - sum_i v_if ** 2 x_i ** 2)

so all pairwise interactions cost one pass over the non-zero features.  It is fitted by
Adam on the logistic loss.  doc_id, lang, source and labels are never features.

The fit uses at most ``fit_rows`` labelled rows outside the held-out fold (those with the
smallest hashes of their doc_id); only their sparse features reach the driver.  Every
document is scored in the tasks, whole text by whole text.

Defined results: a null or empty text has no words and is scored by its other features;
null doc_ids are scored (held_out is false: there is no text of the id to hash); repeated
rows give a row each; of several labels of one doc_id the lowest counts; without any
label every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, record_batch, text_chunks
from .quality_rules import STATS, features, text_statistics

DENSE = 10


class WordPlaces(dict):
    """word -> hashed place; forgets everything when it grows past a million words."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        place = self[word] = zlib.crc32(word) & self.mask
        return place


def document_features(text: bytes, n_chars: int, places: WordPlaces):
    """(hashed places, their values, dense features) of one text."""
    words = text.lower().split()
    at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
    at, times = np.unique(at, return_counts=True)
    value = np.log1p(times)
    value /= np.sqrt((value * value).sum()) or 1.0
    s = dict(zip(STATS, np.array([text_statistics(text, n_chars)]).T))
    meta = [np.log1p(len(words)), np.log1p(n_chars), len(text) / max(n_chars, 1),
            len(words) / max(int(s["n_lines"][0]), 1)]
    return at, value, np.concatenate([features(s)[0], meta])


def documents_of(batch: pa.RecordBatch):
    """(text bytes, code points) of the batch's texts."""
    for texts in text_chunks(batch.column("text"), 1 << 20):
        for t in texts:
            yield t.encode(), len(t)


def feature_kernel(word_bits: int):
    schema = pa.schema([("quality", pa.int32()), ("places", pa.list_(pa.int64())),
                        ("values", pa.list_(pa.float64())), ("dense", pa.list_(pa.float64()))])

    def run(batches):
        places = WordPlaces(word_bits)
        for b in batches:
            rows = [document_features(t, n, places) for t, n in documents_of(b)]
            if rows:
                at, value, dense = zip(*rows)
                yield record_batch(schema, quality=b.column("quality"), places=at, values=value,
                                   dense=dense)

    return run


class FactorisationMachine:
    """Weights and the scaling of the dense features, which follow the hashed places."""

    def __init__(self, places: int, factors: int, seed: int):
        n = places + DENSE
        self.bias, self.w = 0.0, np.zeros(n)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (n, factors))
        self.places, self.mean, self.scale = places, np.zeros(DENSE), np.ones(DENSE)

    def row(self, at, value, dense):
        d = np.clip((dense - self.mean) / self.scale, -5, 5)
        return (np.concatenate([at, np.arange(self.places, self.places + DENSE)]),
                np.concatenate([value, d]))

    def margin(self, at, x) -> float:
        vx = self.v[at] * x[:, None]
        s = vx.sum(0)
        return float(self.bias + self.w[at] @ x + 0.5 * (s @ s - (vx * vx).sum()))

    def fit(self, rows: list, y: np.ndarray, epochs: int, batch: int, rate: float, decay: float,
            seed: int) -> None:
        dense = np.array([r[2] for r in rows])
        self.mean, self.scale = dense.mean(0), np.maximum(dense.std(0), 1e-6)
        rows = [self.row(*r) for r in rows]
        n, k = self.v.shape
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (np.zeros(1), self.w, self.v)]
        rng, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for i in range(0, len(order), batch):
                pick = order[i:i + batch]
                at = np.concatenate([rows[j][0] for j in pick])
                x = np.concatenate([rows[j][1] for j in pick])
                size = np.array([len(rows[j][0]) for j in pick])
                first, owner = np.cumsum(size) - size, np.repeat(np.arange(len(pick)), size)
                vx = self.v[at] * x[:, None]
                s = np.add.reduceat(vx, first)
                z = (self.bias + np.add.reduceat(self.w[at] * x, first)
                     + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), first)))
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
                e = err[owner] * x
                gv = e[:, None] * (s[owner] - vx)
                grads = [np.array([err.sum()]), np.bincount(at, e, n) + decay * self.w,
                         np.column_stack([np.bincount(at, gv[:, f], n) for f in range(k)])
                         + decay * self.v]
                step += 1
                params = [np.array([self.bias]), self.w, self.v]
                for p, g, (m, u) in zip(params, grads, state):
                    m += 0.1 * (g - m)
                    u += 0.001 * (g * g - u)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(u / (1 - 0.999 ** step)) + 1e-8)
                self.bias = float(params[0][0])


def score_kernel(machine: FactorisationMachine | None, word_bits: int):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        places = WordPlaces(word_bits)
        for b in batches:
            if machine is None:
                scores = [0.5] * b.num_rows
            else:
                z = np.array([machine.margin(*machine.row(*document_features(t, n, places)))
                              for t, n in documents_of(b)])
                scores = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield record_batch(schema, doc_id=b.column("doc_id"), score=scores)

    return run


def held_out(doc_id) -> Column:
    """The fold that labels are never learned from: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_machine(docs: DataFrame, labels: DataFrame, fit_rows: int, word_bits: int, factors: int,
                epochs: int, seed: int) -> FactorisationMachine | None:
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
             .withColumn("salt", F.xxhash64("doc_id")))
    chosen = bounded_sample(known, "salt", fit_rows).select("doc_id", "quality")
    rows = (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id")                  # at most fit_rows rows
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
            .orderBy("doc_id").select("quality", "text")
            .mapInArrow(feature_kernel(word_bits),
                        "quality int, places array<bigint>, values array<double>, dense array<double>")
            .toArrow())
    if not rows.num_rows:
        return None
    sparse = [tuple(np.array(x) for x in r) for r in zip(*(
        rows.column(c).to_pylist() for c in ("places", "values", "dense")))]
    sparse = [(a.astype(np.int64), v.astype(float), d) for a, v, d in sparse]
    machine = FactorisationMachine(1 << word_bits, factors, seed)
    machine.fit(sparse, rows.column("quality").to_numpy().astype(float), epochs, 128, 0.01, 1e-5, seed)
    return machine


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = 8192, word_bits: int = 12,
                   factors: int = 6, epochs: int = 6, cutoff: float = 0.7, seed: int = 11) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    ``fit_rows`` bounds the labelled rows the machine is fitted on.
    """
    machine = fit_machine(docs, labels, fit_rows, word_bits, factors, epochs, seed)
    return (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .mapInArrow(score_kernel(machine, word_bits), "doc_id bigint, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= cutoff).cast("int").alias("predicted")))
