"""Species co-occurrence recommender.

Fit, per fold, over the training rows (species_from U species_to of a transition):

* n_i  -- rows containing species i
* n_ij -- rows containing both i and j (i != j)
* p(j|i) = (n_ij + alpha) / (n_i + alpha*S); a species never seen gets 1/S everywhere

Predict for a test row with viewed set V, w_i = 1 / (1 + 10 * share_i):

    score_j = sum_i w_i p(j|i) / sum_i w_i
            = [sum_{i: n_ij>0} w_i n_ij / d_i  +  sum_i w_i c_i] / sum_i w_i

with d_i = n_i + alpha*S and c_i = alpha/d_i (1/S when d_i = 0).  The second term
is one scalar per observer, so only observed pairs are joined (sparse identity);
every other species gets the scalar alone and is supplied as a ranked filler.

Scale notes
-----------
* n_ij is computed without emitting species pairs per row: each partition
  multiplies its own 0/1 incidence block (rows x species) into a partial Gram
  matrix, keyed by (year_from, year_to), and ships only the non-zero cells.
  The shuffle is bounded by partitions x S^2, whatever the row count, and the
  accumulators of a task hold at most ``_MAX_CELLS`` cells together.
* Counts are summed per year pair first and only then per fold through the
  tiny fold table, so a transition is never replicated into every fold.
* Scoring never joins rows with species pairs.  The fitted table is cut into
  column blocks of at most ``_MODEL_CELLS`` cells, one row per (fold, block), a compressed
  sparse row matrix of integer codes; test rows are packed into blocks of codes as well; a
  block pair is scored by one matrix product and leaves K rows per observer.  Popular species make no key, and whether the
  model rows are broadcast or shuffled is Spark's choice by their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.species import species_index
from ..session import cut_lineage
from .common import KEY, PRED_COLUMNS, test_rows, top_k

GRAM_SCHEMA = T.StructType([
    T.StructField("year_from", T.IntegerType()),
    T.StructField("year_to", T.IntegerType()),
    T.StructField("species_i", T.StringType()),
    T.StructField("species_j", T.StringType()),
    T.StructField("n_ij", T.LongType()),
])

_MAX_CELLS = 1 << 24    # cells of all accumulators of a task (128 MiB of float64)
_MAX_VOCAB = 4096       # side of one accumulator
_ROWS_PER_CHUNK = 2048
_MODEL_CELLS = 1 << 22  # cells of a model block or a packed test block (32 MiB of float64)


def _flush(key, vocab: dict[str, int], mat: np.ndarray):
    names = np.array(list(vocab), dtype=object)
    np.fill_diagonal(mat, 0.0)
    i, j = np.nonzero(mat)
    if len(i):
        yield pd.DataFrame({"year_from": np.full(len(i), key[0], dtype=np.int32),
                            "year_to": np.full(len(i), key[1], dtype=np.int32),
                            "species_i": names[i], "species_j": names[j],
                            "n_ij": mat[i, j].round().astype(np.int64)})


def _partial_gram(max_vocab: int = _MAX_VOCAB, rows_per_chunk: int = _ROWS_PER_CHUNK,
                  max_cells: int = _MAX_CELLS):
    """Per partition: accumulate B^T B of the 0/1 incidence rows, per year pair.

    An accumulator is flushed (partial counts emitted, summed later by Spark) before
    a row would take its vocabulary past ``max_vocab``, and all are when they hold
    more than ``max_cells`` cells together: memory stays bounded for any vocabulary
    and any number of year pairs (one row's own set is the least that is held).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _gram_batches(batches, max_vocab, rows_per_chunk, max_cells)
    return run


def _multiply(vocab: dict[str, int], mat: np.ndarray, rows: list[list[str]]) -> np.ndarray:
    n = len(vocab)
    mat = np.pad(mat, ((0, n - mat.shape[0]), (0, n - mat.shape[1])))
    inc = np.zeros((len(rows), n), dtype=np.float32)
    at = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    inc[at, np.fromiter((vocab[sp] for x in rows for sp in x), np.int64, len(at))] = 1.0
    mat += inc.T @ inc
    return mat


def _gram_batches(batches, max_vocab: int, rows_per_chunk: int, max_cells: int):
    acc: dict[tuple[int, int], list] = {}                 # key -> [vocabulary, matrix, pending rows]
    for pdf in batches:
        for (yf, yt), g in pdf.groupby(["year_from", "year_to"], sort=False):
            key = (int(yf), int(yt))
            held = acc.setdefault(key, [{}, np.zeros((0, 0)), []])
            for x in g["species"]:
                row = list(x) if x is not None else []
                vocab, mat, rows = held
                if vocab and len(vocab) + sum(sp not in vocab for sp in row) > max_vocab:
                    yield from _flush(key, vocab, _multiply(vocab, mat, rows))
                    held[:] = vocab, mat, rows = {}, np.zeros((0, 0)), []
                for sp in row:
                    vocab.setdefault(sp, len(vocab))
                rows.append(row)
                if len(rows) >= rows_per_chunk or len(rows) * len(vocab) > max_cells:
                    held[1], held[2] = _multiply(vocab, mat, rows), []
            vocab, mat, rows = held
            held[1], held[2] = _multiply(vocab, mat, rows), []
            if sum(m.size for _, m, _ in acc.values()) > max_cells:
                for k, (v, m, _) in acc.items():
                    yield from _flush(k, v, m)
                acc = {}
    for key, (vocab, mat, _) in acc.items():
        yield from _flush(key, vocab, mat)


def combined_rows(trans: DataFrame) -> DataFrame:
    """(year_from, year_to, species = from U to) of each distinct training transition."""
    return trans.select("year_from", "year_to",
                        F.array_union("species_from", "species_to").alias("species"))


def cooc_pairs_by_year_pair(rows: DataFrame, max_vocab: int = _MAX_VOCAB,
                            rows_per_chunk: int = _ROWS_PER_CHUNK) -> DataFrame:
    """n_ij per (year_from, year_to) -- J11 without per-row pair emission."""
    return (rows.mapInPandas(_partial_gram(max_vocab, rows_per_chunk), GRAM_SCHEMA)
                .groupBy("year_from", "year_to", "species_i", "species_j")
                .agg(F.sum("n_ij").alias("n_ij")))


def _train_pairs(folds: DataFrame) -> DataFrame:
    return F.broadcast(folds.where(F.col("role") == "train").select("fold", "year_from", "year_to"))


def fit_counts(trans: DataFrame, folds: DataFrame, max_vocab: int = _MAX_VOCAB,
               rows_per_chunk: int = _ROWS_PER_CHUNK) -> tuple[DataFrame, DataFrame]:
    """Per-fold species counts (fold, species, n_i) and pair counts (fold, i, j, n_ij).

    ``trans`` are the distinct transitions, ``folds`` the fold table; the fold
    table is bounded by years^2 x folds and broadcast.
    """
    rows = combined_rows(trans)
    tp = _train_pairs(folds)
    n_i = (rows.select("year_from", "year_to", F.explode("species").alias("species"))
               .groupBy("year_from", "year_to", "species").agg(F.count(F.lit(1)).alias("n"))
               .join(tp, ["year_from", "year_to"])
               .groupBy("fold", "species").agg(F.sum("n").alias("n_i")))
    n_ij = (cooc_pairs_by_year_pair(rows, max_vocab, rows_per_chunk)
            .join(tp, ["year_from", "year_to"])
            .groupBy("fold", "species_i", "species_j").agg(F.sum("n_ij").alias("n_ij")))
    return n_i, n_ij


def history_share(n_i: DataFrame) -> DataFrame:
    """share_i = n_i / sum n within the fold -- A8."""
    return n_i.withColumn("share", F.col("n_i") / F.sum("n_i").over(Window.partitionBy("fold")))


def cooccurrence_table(n_i: DataFrame, n_ij: DataFrame, n_species, alpha: float = 0.1) -> DataFrame:
    """Smoothed p(j|i) for observed pairs -- A9 (fold, species_i, species_j, n_ij, p_j_given_i)."""
    d = n_i.select("fold", F.col("species").alias("species_i"),
                   (F.col("n_i") + F.lit(alpha) * n_species).alias("d_i"))
    return (n_ij.join(d, ["fold", "species_i"])
                .withColumn("p_j_given_i", (F.col("n_ij") + F.lit(alpha)) / F.col("d_i"))
                .drop("d_i"))


def boost_factor(features: DataFrame) -> DataFrame:
    """(fold?, species, boost) with boost = 1 + 0.2 * popularity_score -- J9."""
    keys = [c for c in ("fold", "species") if c in features.columns]
    return features.select(*keys, (F.lit(1.0) + F.lit(0.2) * F.col("popularity_score")).alias("boost"))


MODEL_SCHEMA = "fold int, cb int, ends binary, at binary, n binary"


def _pack_cells(n_species: int):
    """applyInArrow over the cells (i, j, n_ij) of a (fold, column block): one compressed sparse row matrix.

    ``ends`` (int64) holds where each of the ``n_species`` rows ends, ``at`` (int32) the columns, ``n`` (int64)
    the counts.  A group has at most ``_MODEL_CELLS`` cells.
    """
    schema = pa.schema([("fold", pa.int32()), ("cb", pa.int32()), ("ends", pa.binary()),
                        ("at", pa.binary()), ("n", pa.binary())])

    def run(key, cells):
        i, j, n = (cells.column(c).to_numpy() for c in ("i", "j", "n_ij"))
        order = np.lexsort((j, i))
        packed = (np.cumsum(np.bincount(i, minlength=n_species)), j[order].astype(np.int32), n[order])
        return pa.Table.from_arrays([pa.array([k.as_py()], t.type) for k, t in zip(key, schema)]
                                    + [pa.array([x.tobytes()], pa.binary()) for x in packed], schema=schema)

    return run


def _model_blocks(n_i: DataFrame, n_ij: DataFrame, catalogue: DataFrame, n_species: float,
                  alpha: float, boost: DataFrame | None) -> tuple[DataFrame, int]:
    """The fitted model as one row per (fold, column block), and the number of column blocks.

    A row holds, in catalogue order, the names, shares, denominators and boosts of all species, and
    the block's counts as a compressed sparse row matrix (all species x the block's columns).  A catalogue
    with a column ``fold`` differs between the folds; ``n_species`` is the size of the largest.
    """
    columns = int(max(1, min(n_species, _MODEL_CELLS // max(n_species, 1))))
    n_blocks = int(-(-n_species // columns)) or 1
    codes = cut_lineage(species_index(catalogue), "cooc-codes")
    stats = cut_lineage(history_share(n_i), "cooc-stats")
    own = [c for c in ("fold",) if c in codes.columns]
    species = codes
    if not own:
        folds = [r["fold"] for r in stats.select("fold").distinct().collect()]    # a few folds
        species = codes.select("species", "species_idx", F.explode(
            F.array(*map(F.lit, sorted(folds))).cast("array<int>")).alias("fold"))
    size = F.count(F.lit(1)).over(Window.partitionBy("fold"))
    species = species.withColumn("d0", F.lit(alpha) * size).join(stats.select("fold", "species", "share", "n_i"), ["fold", "species"], "left")
    if boost is not None:
        species = species.join(boost, [c for c in ("fold", "species") if c in boost.columns], "left")
    else:
        species = species.withColumn("boost", F.lit(1.0))
    species = (species.groupBy("fold").agg(F.sort_array(F.collect_list(F.struct(      # S rows a fold
                   "species_idx", F.col("species").alias("s"), F.coalesce("share", F.lit(0.0)).alias("share"),
                   (F.coalesce("n_i", F.lit(0)) + F.col("d0")).alias("d"),
                   F.coalesce("boost", F.lit(1.0)).alias("boost")))).alias("c"))
               .select("fold", F.col("c.s").alias("names"), F.col("c.share").alias("shares"),
                       F.col("c.d").alias("d"), F.col("c.boost").alias("boosts"),
                       F.explode(F.sequence(F.lit(0), F.floor((F.size("c") - 1) / columns).cast("int"))).alias("cb"),
                       F.lit(columns).alias("columns")))
    code_i, code_j = (codes.select(*own, F.col("species").alias(f"species_{x}"), F.col("species_idx").alias(x)) for x in "ij")
    cells = (n_ij.join(code_i, [*own, "species_i"]).join(code_j, [*own, "species_j"])
             .select(F.col("fold").cast("int").alias("fold"), F.floor(F.col("j") / columns).cast("int").alias("cb"),
                     "i", (F.col("j") % columns).alias("j"), "n_ij")
             .groupBy("fold", "cb").applyInArrow(_pack_cells(int(n_species)), MODEL_SCHEMA))
    return species.join(cells, ["fold", "cb"], "left"), n_blocks


TEST_SCHEMA = ("fold int, ids array<bigint>, known array<string>, sizes binary, codes binary, "
               "extras array<array<double>>")


LABELLED_SCHEMA = TEST_SCHEMA + ", to_sizes binary, to_codes binary, held binary"


def _pack_tests(max_rows: int, max_codes: int, labelled: bool = False):
    """mapInArrow: (fold, observer_id, species_from, extra) sorted by fold -> blocks of test rows.

    A block names each of its species once (``known``); ``codes`` (int32) are places in that list, the sets
    one after the other, and ``sizes`` (int64) says how long each is.  ``labelled``: the rows come with species_to
    (``to_sizes``, ``to_codes``) and is_validation (``held``, uint8).
    """
    schema = pa.schema([("fold", pa.int32()), ("ids", pa.list_(pa.int64())), ("known", pa.list_(pa.string())),
                        ("sizes", pa.binary()), ("codes", pa.binary()),
                        ("extras", pa.list_(pa.list_(pa.float64())))]
                       + [(c, pa.binary()) for c in ("to_sizes", "to_codes", "held") if labelled])

    def run(batches):
        fold, ids, sizes, codes, extras, places, labels = None, [], [], [], [], {}, ([], [], [])

        def out():
            values = (fold, ids, list(places), np.array(sizes, np.int64).tobytes(),
                      np.array(codes, np.int32).tobytes(), extras,
                      *(np.array(c, t).tobytes() for c, t in zip(labels, (np.int64, np.int32, np.uint8))))
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(values, schema)], schema=schema)

        for b in batches:
            to = (b.column(c).to_pylist() if labelled else [None] * b.num_rows for c in ("species_to", "is_validation"))
            for f, i, v, x, t, h in zip(*(b.column(c).to_pylist() for c in
                                          ("fold", "observer_id", "species_from", "extra")), *to):
                v, t = v or [], t or []
                if ids and (f != fold or len(ids) >= max_rows or len(codes) + len(v) > max_codes
                            or len(labels[1]) + len(t) > max_codes):
                    yield out()
                    ids, sizes, codes, extras, places, labels = [], [], [], [], {}, ([], [], [])
                fold = f
                ids.append(i)
                sizes.append(len(v))
                codes.extend(places.setdefault(s, len(places)) for s in v)
                extras.append(x)
                if labelled:
                    labels[0].append(len(t))
                    labels[1].extend(places.setdefault(s, len(places)) for s in t)
                    labels[2].append(bool(h))
        if ids:
            yield out()

    return run


def _read_model(b, i, alpha: float) -> tuple:
    """A model block of a batch as arrays, its counts as a matrix."""
    def numbers(c):
        return b.column(c)[i].values.to_numpy()
    names, share, d, boost = b.column("names")[i].values, numbers("shares"), numbers("d"), numbers("boosts")
    lo = b.column("cb")[i].as_py() * b.column("columns")[i].as_py()
    hi = min(lo + b.column("columns")[i].as_py(), len(names))
    m = np.zeros((len(names), hi - lo))
    if b.column("ends")[i].is_valid:
        ends, at, n = (np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in
                       (("ends", np.int64), ("at", np.int32), ("n", np.int64)))
        m[np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), at] = n
    w = 1.0 / (1.0 + np.append(share, 0.0) * 10.0)          # last place: species outside the catalogue
    d = np.append(d, alpha * len(names))
    c = np.divide(alpha, d, out=np.full(len(d), 1.0 / len(names)), where=d > 0)
    pull = np.divide(w, d, out=np.zeros(len(d)), where=d > 0)
    return names, m, lo, hi, w, w * c, pull, share[lo:hi].copy(), boost[lo:hi].copy()


def _by_model(batches, alpha: float):
    """(batch, row, model block) of every row; the last model block is kept, rows of one follow one another."""
    now, held = None, None
    for b in batches:
        for i in range(b.num_rows):
            key = b.column("fold")[i].as_py(), b.column("cb")[i].as_py()
            if key != now:
                now, held = key, _read_model(b, i, alpha)
            yield b, i, held


def _places(b, i, names, column: str = "codes") -> np.ndarray:
    """The catalogue places of a test block's codes; species outside the catalogue come last."""
    place = pc.fill_null(pc.index_in(b.column("known")[i].values, names), len(names)).to_numpy()
    return place[np.frombuffer(b.column(column)[i].as_buffer(), np.int32)]


def _scored_rows(b, i, held, reach: bool = False):
    """(first row, rows, score, seen, reached by a pair) of a test block against its model block, in parts."""
    names, m, lo, hi, w, wc, pull, t_share, _ = held
    sizes = np.frombuffer(b.column("sizes")[i].as_buffer(), np.int64)
    places, ends = _places(b, i, names), np.append(0, np.cumsum(sizes))
    step = max(1, _MODEL_CELLS // max(len(names), hi - lo, 1))
    for first in range(0, len(sizes), step):
        n = min(step, len(sizes) - first)
        at = places[ends[first]:ends[first + n]]
        row = np.repeat(np.arange(n), sizes[first:first + n])
        base = np.bincount(row, wc[at], n)
        weight = np.bincount(row, w[at], n)
        inside, here = at < len(names), (at >= lo) & (at < hi)
        a, seen = np.zeros((n, len(names))), np.zeros((n, hi - lo), bool)
        a[row[inside], at[inside]] = pull[at[inside]]
        seen[row[here], at[here] - lo] = True
        score = a @ m
        reached = score > 0 if reach else None
        with np.errstate(divide="ignore", invalid="ignore"):
            score += base[:, None]
            score /= weight[:, None]
        score[weight == 0] = t_share                        # no history: popularity share
        yield first, n, score, seen, reached


def _score_kernel(k, alpha: float, mode: str = "top", rerank=None):
    """mapInArrow over (test block, model block): the K best unseen species of every row.

    ``mode`` "reached": every species that an observed pair reaches, seen or not, unboosted.
    ``rerank(fold, score, share, extras)`` may replace the score matrix of a block before the
    ranking.  ``k`` may be a function of the rows' extras that gives each row its own number.  Model and sets arrive as number arrays and
    the last model block is kept as a matrix, so a pair of blocks costs one product and the ranking.
    """
    schema = pa.schema([("fold", pa.int32()), ("observer_id", pa.int64()), ("species", pa.string()),
                        ("score", pa.float64()), ("share", pa.float64()), ("rank", pa.int32())])

    def block(b, i, held):
        names, lo, hi, t_share, boost = held[0], held[2], held[3], held[7], held[8]
        fold = b.column("fold")[i].as_py()
        ids, all_extras = b.column("ids")[i].values.to_numpy(), b.column("extras")[i].values
        targets = names.slice(lo, hi - lo)
        for first, n, score, seen, reached in _scored_rows(b, i, held, mode == "reached"):
            best = None
            if mode == "reached":
                row, j = np.nonzero(reached)
            else:
                score *= boost
                extras = all_extras.slice(first, n).to_pylist() if rerank is not None or callable(k) else None
                if rerank is not None:
                    score = rerank(fold, score, t_share, extras)
                ks = np.asarray(k(extras)) if callable(k) else np.full(n, k)
                most = int(ks.max())
                ranked = np.round(score, 9)
                ranked[seen] = -np.inf
                if ranked.shape[1] > most:
                    floor = np.partition(ranked, ranked.shape[1] - most, axis=1)[:, ranked.shape[1] - most]
                    ranked[ranked < floor[:, None]] = -np.inf
                row, j = np.nonzero(ranked > -np.inf)
                order = np.lexsort((j, -ranked[row, j], row))      # targets lie in name order
                row, j = row[order], j[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) + 1
                kept = best <= ks[row]
                row, j, best = row[kept], j[kept], best[kept]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(row), fold), pa.int32()), pa.array(ids[first + row], pa.int64()),
                targets.take(pa.array(j, pa.int64())), pa.array(score[row, j]),
                pa.array(t_share[j]), pa.nulls(len(row), pa.int32()) if best is None else pa.array(best, pa.int32())],
                schema=schema)

    def run(batches):
        for b, i, held in _by_model(batches, alpha):
            yield from block(b, i, held)

    return run


def packed_tests(test: DataFrame, max_rows: int = 2048, labelled: bool = False) -> DataFrame:
    """Blocks of test rows of one fold (see ``_pack_tests``)."""
    return (test.withColumn("fold", F.col("fold").cast("int"))
            .repartitionByRange("fold", "observer_id").sortWithinPartitions("fold")
            .mapInArrow(_pack_tests(max_rows, _MODEL_CELLS, labelled), LABELLED_SCHEMA if labelled else TEST_SCHEMA))


def _block_scores(test: DataFrame, model: DataFrame, n_blocks: int, k,
                  alpha: float, mode: str = "top", rerank=None, max_rows: int = 2048) -> DataFrame:
    """(fold, observer_id, species, score, share, rank in the block); ``test`` may carry an array column ``extra``."""
    extra = F.col("extra") if "extra" in test.columns else F.lit(None).cast("array<double>").alias("extra")
    packed = (packed_tests(test.select("fold", "observer_id", "species_from", extra), max_rows)
              .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    return (packed.join(model, ["fold", "cb"])
            .mapInArrow(_score_kernel(k, alpha, mode, rerank),
                        "fold int, observer_id bigint, species string, score double, share double, rank int"))


def ranked_scores(test: DataFrame, model: DataFrame, n_blocks: int, k, alpha: float, kk=None, **params) -> DataFrame:
    """The K best species of every test row, one row a key (M2, M6).

    A catalogue of one block is ranked in the kernel, for good; the best of several blocks are ranked together.
    ``k`` as in ``_score_kernel``; where it is a function, ``kk`` (fold, observer_id, kk) says the same per row.
    """
    scored = _block_scores(test, model, n_blocks, k, alpha, **params)
    if n_blocks == 1:
        return scored.select(*PRED_COLUMNS)
    return top_k(scored.drop("rank"), k) if kk is None else top_k(scored.drop("rank").join(kk, KEY), "kk")


def _largest(n_species: DataFrame) -> float:
    """The size of the largest catalogue (one row, or one a fold)."""
    return float(n_species.agg(F.max("n_species")).first()[0] or 0)


def fitted_model(data, alpha: float = 0.1, features: DataFrame | None = None) -> tuple:
    """The written model blocks of every fold and the number of column blocks."""
    size = _largest(data.n_species)
    n_i, n_ij = fit_counts(data.transitions, data.folds)
    boost = boost_factor(features) if features is not None else None
    model, n_blocks = _model_blocks(n_i, n_ij, data.catalogue, size, alpha, boost)
    return cut_lineage(model, "cooc-model"), n_blocks


def cooccurrence_topk(fold_trans: DataFrame, trans: DataFrame, folds: DataFrame,
                      catalogue: DataFrame, n_species: DataFrame, k: int = 10,
                      alpha: float = 0.1, n_folds: int = 4, features: DataFrame | None = None,
                      min_cooccurrence: int | None = None,
                      query_rows: DataFrame | None = None) -> DataFrame:
    """Top-K unseen species by co-occurrence score -- M2.

    ``features`` (species features, keyed by (fold, species) or species) enables
    the popularity boost; ``min_cooccurrence`` optionally drops rare pairs (the
    reference stores but never applies it: default off).
    """
    size = _largest(n_species)
    n_i, n_ij = fit_counts(trans, folds)
    if min_cooccurrence:
        n_ij = n_ij.where(F.col("n_ij") >= min_cooccurrence)
    boost = boost_factor(features) if features is not None else None
    model, n_blocks = _model_blocks(n_i, n_ij, catalogue, size, alpha, boost)
    model = cut_lineage(model, "cooc-model")
    if query_rows is not None:                      # may ask for a key twice
        return top_k(_block_scores(query_rows, model, n_blocks, k, alpha).drop("rank"), k)
    return ranked_scores(test_rows(fold_trans), model, n_blocks, k, alpha)


def cooc_raw_scores(fold_trans: DataFrame, trans: DataFrame, folds: DataFrame, catalogue: DataFrame,
                    n_species: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Per test row, the unboosted score of every species reached by an
    observed pair from its history (viewed species included, before exclusion)."""
    size = _largest(n_species)
    n_i, n_ij = fit_counts(trans, folds)
    model, n_blocks = _model_blocks(n_i, n_ij, catalogue, size, alpha, None)
    scores = _block_scores(test_rows(fold_trans), cut_lineage(model, "cooc-model"), n_blocks, None, alpha,
                           "reached")
    return scores.drop("share", "rank")
