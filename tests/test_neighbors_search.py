"""Nearest observers against all pairs, on sets that take every path of the search, and what it skips."""

import math
import random

import pytest

from flyway.models.neighbors import _Search, neighbor_search

TEST = "fold int, observer_id long, species_from array<string>"
TRAIN = "fold int, observer_id long, year_from int, species array<string>"


def skewed(seed, n, vocab=400, most=60, common=6):
    """Sets of very different sizes; a few species are in nearly all of them."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        size = max(1, int(most * r.random() ** 3))
        s = {f"c{j}" for j in range(common) if r.random() < 0.9} | {f"s{int(vocab * r.random() ** 2)}" for _ in range(size)}
        out.append((1 + i % 2, i, sorted(s)))
    return out


def similarity(metric, a, b):
    c = len(a & b)
    if not c:
        return 0.0, 0
    return (c / math.sqrt(len(a) * len(b)) if metric == "cosine" else c / len(a | b)), c


def plain(test, train, metric, n, min_common):
    out = {}
    for f, i, s in test:
        near = []
        for tf, ti, ty, ts in train:
            sim, c = similarity(metric, set(s), set(ts))
            if tf == f and c >= min_common and sim > 0:
                near.append((-round(sim, 9), ti, ty, c))
        out[f, i] = sorted(near)[:n]
    return {k: v for k, v in out.items() if v}


CASES = {"skewed": dict(vocab=400, most=60, common=6), "dense": dict(vocab=12, most=30, common=2),
         "sparse": dict(vocab=5000, most=8, common=0), "prefix": dict(vocab=3000, most=150, common=25)}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("metric,min_common", [("cosine", 1), ("jaccard", 1), ("cosine", 4)])
def test_equals_all_pairs(spark, case, metric, min_common):
    test = skewed(1, 60, **CASES[case]) + [(1, 900, []), (3, 901, ["c1"])]
    train = [(f, i, 2000 + i % 3, s) for f, i, s in skewed(2, 240, **CASES[case])] + [(1, 5, 1999, []), (1, 6, 1999, ["c1"])]
    got = {}
    for r in neighbor_search(spark.createDataFrame(test, TEST), spark.createDataFrame(train, TRAIN), metric, 7, min_common,
                             test_block_rows=16, train_block_rows=30).collect():
        got.setdefault((r.fold, r.observer_id), []).append((r.nb_rank, -round(r.sim, 9), r.nb_observer_id, r.nb_year_from, r.common))
    want = plain(test, train, metric, 7, min_common)
    assert {k: [x[1:] for x in sorted(v)] for k, v in got.items()} == want


def test_skips_most_pairs(spark):
    """Every test row has four near copies: its size bound and its rarest species leave little to look at."""
    r = random.Random(3)
    test = [(1, i, s) for _, i, s in skewed(3, 200, vocab=2000, most=120, common=12) if len(s) > 15]
    train = [(1, 10 * i + k, 2000, sorted({x for x in s if r.random() < 0.97} | {f"n{r.randrange(50)}"}))
             for _, i, s in test for k in range(4)]
    train += [(1, 10 ** 6 + i, 2000, s) for _, i, s in skewed(4, 800, vocab=2000, most=120, common=12)]
    effort = neighbor_search(spark.createDataFrame(test, TEST), spark.createDataFrame(train, TRAIN), "jaccard", 3,
                             output="effort", test_block_rows=10, train_block_rows=50).collect()
    every = len(test) * len(train)
    blocks = sum(e.blocks_met for e in effort) / (math.ceil(len(test) / 10) * math.ceil(len(train) / 50))
    assert blocks < 0.85, blocks                               # decided on block ends, before any set is shuffled
    assert sum(e.rows_met for e in effort) < 0.35 * every, sum(e.rows_met for e in effort) / every
    assert sum(e.candidates for e in effort) < 0.1 * every, sum(e.candidates for e in effort) / every


def test_known_bounds_do_not_change_the_result():
    import numpy as np
    sets = [s for _, _, s in skewed(5, 40)]
    names = sorted({x for s in sets for x in s})
    place = {x: i for i, x in enumerate(names)}
    sets.sort(key=len)

    def packed(prefix, rows):
        return {f"{prefix}names": names, f"{prefix}sizes": np.array([len(s) for s in rows], np.int32).tobytes(),
                f"{prefix}codes": np.array([place[x] for s in rows for x in s], np.int32).tobytes(),
                f"{prefix}ids": np.arange(len(rows)).tobytes(), f"{prefix}years": np.zeros(len(rows), np.int32).tobytes()}

    first = _Search({"fold": 1, "block": 1, **packed("", sets[10:20])}, "cosine", 5, 1, "neighbors")
    first.meet(packed("t_", sets))
    again = _Search({"fold": 1, "block": 1, "least": first.least.tobytes(), **packed("", sets[10:20])}, "cosine", 5, 1, "neighbors")
    again.meet(packed("t_", sets))
    assert first.result().equals(again.result()) and again.candidates <= first.candidates
