"""What the nearest-observer search ships and writes: narrow codes, K ranked species, one list row per class."""

import numpy as np
import pyarrow as pa

from flyway.models import neighbors as nb
from tests.test_neighbors_classes import repeated
from tests.test_neighbors_search import TEST, TRAIN, skewed


def test_codes_are_as_wide_as_the_vocabulary(monkeypatch):
    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(nb, "TaskContext", Context)
    for n, width in ((200, 1), (300, 2)):
        sets = [[f"s{i}" for i in range(lo, lo + 10)] for lo in range(0, n, 10)]
        batch = pa.RecordBatch.from_pylist([{"fold": 1, "species": s, "members": [{"observer_id": i, "year": 2000}],
                                             "weight": 1, "bands": []} for i, s in enumerate(sets)])
        block, = (b.to_pylist()[0] for b in nb._pack(1000, 1 << 22)([batch]))
        assert len(block["codes"]) == n * width
        assert [block["names"][c] for c in nb._codes(block)] == [x for s in sets for x in s]


def test_ranked_classes_equal_their_votes(spark):
    """K unseen species a class leave the kernel, in the order of all votes; one that has seen all gets a mark."""
    test = [t for t in skewed(1, 60, vocab=60, most=20, common=3) if t[0] == 1] + [(1, 700, ["a", "b"]), (1, 701, ["a"]), (1, 702, ["none"])]
    train = [(f, i, 2000, s) for f, i, s in skewed(2, 150, vocab=60, most=20, common=3)] + [(1, 900 + i, 2000, ["a", "b"]) for i in range(9)]
    frames = spark.createDataFrame(test, TEST), spark.createDataFrame(train, TRAIN)
    classes, members = nb.test_classes(frames[0])
    own = {}
    for m in members.collect():
        own.setdefault(m["class"], []).append(m.observer_id)
    found = nb.search_classes(classes, frames[1], "cosine", 7, 1, "ranked", 16, 30, k=4).collect()
    got, sets = {}, {i: s for _, i, s in test}
    for r in found:
        for i in own[r.observer_id]:
            got.setdefault(i, []).append((r["rank"], r.species, round(r.score, 9)))
    want = {}
    for r in nb.neighbor_search(*frames, "cosine", 7, output="votes", test_block_rows=16, train_block_rows=30).collect():
        want.setdefault(r.observer_id, []).append((-round(r.score, 9), r.species))
    want = {i: [(n + 1, s, -v) for n, (v, s) in enumerate(sorted(x for x in v if x[1] not in sets[i])[:4])] or [(0, None, 0.0)]
            for i, v in want.items()}
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in got.items()} == want
    assert got[700] == [(0, None, 0.0)] and got[701][0][:2] == (1, "b") and 702 not in got


def test_a_class_leaves_as_one_row(spark):
    test, train = repeated(1, 90, 7), [(f, i, 2000, s) for f, i, s in repeated(2, 300, 30)]
    classes, _ = nb.test_classes(spark.createDataFrame(test, TEST))
    rows = nb.search_classes(classes, spark.createDataFrame(train, TRAIN), "jaccard", 20, 1, "neighbors", 4, 8, lists=True).collect()
    assert len(rows) == len({tuple(s) for *_, s in test}) and all(0 < len(r.sim) == len(r.nb_observer_id) <= 20 for r in rows)


def test_pairs_short_of_common_species_are_not_scored():
    """One species of eight in common cannot enter where ten equal sets are known: the block is not met at all."""
    def packed(prefix, sets):
        names = sorted({x for s in sets for x in s})
        return {f"{prefix}names": names, f"{prefix}sizes": np.array([len(s) for s in sets], np.int32).tobytes(),
                f"{prefix}codes": np.array([names.index(x) for s in sets for x in s], np.int32).tobytes(),
                f"{prefix}ids": np.arange(len(sets)).tobytes(), f"{prefix}years": np.zeros(len(sets), np.int32).tobytes()}

    same = [f"s{i}" for i in range(8)]
    search = nb._Search({"fold": 1, "block": 1, **packed("", [same])}, "cosine", 5, 1, "neighbors")
    search.meet(packed("t_", [same] * 10))
    met = search.candidates
    search.meet(packed("t_", [["s0"] + [f"o{j}" for j in range(7)] for _ in range(20)]))
    assert search.candidates == met
    assert search.result().column("nb_observer_id").to_pylist() == [0, 1, 2, 3, 4]
