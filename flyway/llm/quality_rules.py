"""Quality rules: an isolation forest over rule statistics.

Per text one pass counts the rule statistics.  The fixed base rules reject a text
with fewer than 50 words, or one of whose words more than half stand in a repeated
3-word window.  The method's verdict comes on top.  Each statistic, per word, line or
character, is taken as its excess over the slack that nearly all labelled good texts
keep to, so ordinary texts coincide and cannot be isolated; 100 random trees then
isolate the others.  A short mean path means an anomaly, scored
``2 ** (-path / c(sample))`` in (0, 1).  The verdict rejects scores at or above a
threshold calibrated on the labelled rows that pass the base rules: the score step
with the best ``share of bad rejected - loss_weight * share of good rejected``.

Slack and trees are fitted on a bounded sample (``trees * per_tree`` labelled rows at
most, those with the smallest hashes); statistics, scores and the calibration
histogram cover every row.  What reaches the driver is that sample and the
histogram (two rows per score step at most).

Defined results: a null text has no words, so it fails the base rules; null doc_ids
and repeated rows are judged row by row; several labels of one doc_id count with
the lowest quality; without usable labels of both kinds the verdict equals the base
rules; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, cut_lineage, record_batch

STEPS = 10_000           # score grid of the calibration histogram


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a 3-word window that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    k = len(names)
    pair = np.unique(ids[:-2] * k + ids[1:-1], return_inverse=True)[1]
    _, window, times = np.unique(pair * k + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= again
    return int(inside.sum())


def text_statistics(text: bytes, n_chars: int) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks)."""
    words = text.split()                       # bytes split on exactly ASCII white space
    lines = [x for x in text.split(b"\n") if x.strip()]
    blanks = sum(text.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    symbols = sum(text.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = len(text) - len(text.translate(None, b"!?;:()[]{}=_/\\\"@^~"))
    return (len(words), n_chars - blanks, symbols, len(lines) - len(set(lines)),
            repeated_words(words), len(lines), upper, marks)


def statistics_kernel(batches):
    schema = STATS_ARROW
    for b in batches:
        chars = pc.utf8_length(b.column("text")).to_pylist()
        rows = [text_statistics(t, c)
                for t, c in zip(b.column("text").cast(pa.binary()).to_pylist(), chars)]
        cols = list(zip(*rows)) if rows else [()] * 8
        yield record_batch(schema, doc_id=b.column("doc_id"), salt=b.column("salt"),
                           **dict(zip(STATS, cols)))


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_upper", "n_marks"]
STATS_ARROW = pa.schema([("doc_id", pa.int64()), ("salt", pa.int64()),
                         *((c, pa.int64()) for c in STATS)])
STATS_SCHEMA = ", ".join(f"{f.name} bigint" for f in STATS_ARROW)


def features(s: dict) -> np.ndarray:
    """Rule statistics per word, line or character: (rows, 6) doubles."""
    n = np.maximum(s["n_words"], 1).astype(float)
    chars = np.maximum(s["word_chars"], 1).astype(float)
    return np.column_stack([
        s["word_chars"] / n, s["n_symbols"] / n, s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
        s["n_upper"] / chars, s["n_marks"] / n, s["n_repeat_words"] / n])


def mean_path(n):
    """Average unsuccessful-search depth of a binary tree over n points."""
    n = np.asarray(n, float)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow_forest(x: np.ndarray, trees: int, per_tree: int, seed: int) -> tuple:
    """Random-split trees as arrays (tree, node): feature (-1: leaf), cut, left child, path value."""
    rng = np.random.default_rng(seed)
    take = min(per_tree, len(x))
    depth = max(1, math.ceil(math.log2(max(take, 2))) + 4)
    size = 2 * take
    feature = np.full((trees, size), -1, np.int32)
    cut = np.zeros((trees, size))
    left = np.zeros((trees, size), np.int32)
    path = np.zeros((trees, size))
    for t in range(trees):
        todo, used = [(0, x[rng.choice(len(x), take, replace=False)], 0)], 1
        while todo:
            node, rows, level = todo.pop()
            spread = np.flatnonzero(rows.max(0) > rows.min(0))
            if level >= depth or len(rows) < 2 or not len(spread):
                path[t, node] = level + float(mean_path(len(rows)))
                continue
            f = int(rng.choice(spread))
            at = rng.uniform(rows[:, f].min(), rows[:, f].max())
            below = rows[:, f] < at
            if not below.any():
                below = rows[:, f] <= at
            feature[t, node], cut[t, node], left[t, node] = f, at, used
            todo += [(used, rows[below], level + 1), (used + 1, rows[~below], level + 1)]
            used += 2
    return feature, cut, left, path, take


def forest_scores(forest: tuple, x: np.ndarray) -> np.ndarray:
    """Anomaly score of every row: 2 ** (-mean path / expected path)."""
    feature, cut, left, path, take = forest
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in range(len(feature)):
        node = np.zeros(len(x), np.int32)
        live = rows
        while len(live):
            f = feature[t, node[live]]
            live, f = live[f >= 0], f[f >= 0]
            at = node[live]
            node[live] = left[t, at] + (x[live, f] >= cut[t, at])
        total += path[t, node]
    return 2.0 ** (-total / len(feature) / max(float(mean_path(take)), 1e-9))


def score_kernel(slack, forest):
    """mapInArrow function: statistics rows plus their anomaly score (0 without a forest)."""
    schema = STATS_ARROW.append(pa.field("anomaly", pa.float64()))

    def run(batches):
        for b in batches:
            s = {c: b.column(c).to_numpy() for c in STATS}
            a = (np.zeros(b.num_rows) if forest is None
                 else forest_scores(forest, np.maximum(features(s) - slack, 0)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(a)], schema=schema)

    return run


def fit_rules(docs: DataFrame, labels: DataFrame, trees: int, per_tree: int, slack_quantile: float,
              loss_weight: float, seed: int) -> tuple:
    """(scored statistics of every document, slack, forest, threshold)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    stats = cut_lineage(
        docs.select("doc_id", F.xxhash64("doc_id", "text").alias("salt"), text.alias("text"))
        .mapInArrow(statistics_kernel, STATS_SCHEMA),
        "rule-statistics")
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    sample = (bounded_sample(stats.join(marked, "doc_id"), "salt", trees * per_tree, "doc_id", *STATS)
              .select("quality", *STATS).toPandas())
    slack = forest = None
    good = (sample["quality"] == 1).to_numpy()
    if good.any() and not good.all():
        x = features({c: sample[c].to_numpy() for c in STATS})
        slack = np.quantile(x[good], slack_quantile, axis=0)
        forest = grow_forest(np.maximum(x - slack, 0), trees, per_tree, seed)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = cut_lineage(
        stats.mapInArrow(score_kernel(slack, forest), STATS_SCHEMA + ", anomaly double")
        .withColumn("base_failed", failed), "rule-scores")
    threshold = 1.0
    if forest is not None:
        steps = (scored.join(marked, "doc_id").where(~F.col("base_failed"))
                 .groupBy(F.floor(F.col("anomaly") * STEPS).alias("step"))
                 .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"),
                      F.sum((F.col("quality") != 1).cast("long")).alias("bad"))
                 .collect())                                 # at most STEPS rows
        threshold = calibrated([tuple(r) for r in steps], loss_weight)
    return scored, slack, forest, threshold


def quality_rules(docs: DataFrame, labels: DataFrame, trees: int = 100, per_tree: int = 256,
                  slack_quantile: float = 0.995, loss_weight: float = 20.0,
                  seed: int = 7) -> DataFrame:
    """(doc_id, statistics..., base_failed, anomaly, threshold, kept) of every document.

    ``trees * per_tree`` bounds the labelled rows the forest is fitted on;
    ``slack_quantile`` is the share of labelled good texts within the slack of a statistic;
    ``loss_weight`` is what the loss of a share of good texts counts against bad ones.
    """
    scored, _, _, threshold = fit_rules(docs, labels, trees, per_tree, slack_quantile, loss_weight, seed)
    return scored.select(
        "doc_id", *STATS[:5], "base_failed", "anomaly", F.lit(threshold).alias("threshold"),
        (~F.col("base_failed") & (F.col("anomaly") < threshold)).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, trees: int = 100, per_tree: int = 256,
                 slack_quantile: float = 0.995, loss_weight: float = 20.0, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_rules`` keeps.

    Once the forest and the threshold are known each row is judged where it lies, so no
    text is shuffled and null or repeated ids need no join.
    """
    _, slack, forest, threshold = fit_rules(docs, labels, trees, per_tree, slack_quantile, loss_weight, seed)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = pc.fill_null(b.column(at), "")
            rows = [text_statistics(t, n) for t, n in zip(
                texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist())]
            if not rows:
                continue
            s = dict(zip(STATS, np.array(rows).T))
            keep = (s["n_words"] >= 50) & (100 * s["n_repeat_words"] <= 50 * s["n_words"])
            if forest is not None:
                keep &= forest_scores(forest, np.maximum(features(s) - slack, 0)) < threshold
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def calibrated(steps: list[tuple[int, int, int]], loss_weight: float) -> float:
    """Score from which rejecting pays best; 1 where rejecting never pays.  steps: (step, good, bad)."""
    all_good, all_bad = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not all_good or not all_bad:
        return 1.0
    lost = caught = 0
    best, threshold = 0.0, 1.0
    for step, good, bad in sorted(steps, reverse=True):
        lost, caught = lost + good, caught + bad
        gain = caught / all_bad - loss_weight * lost / all_good
        if gain > best:
            best, threshold = gain, step / STEPS
    return threshold
