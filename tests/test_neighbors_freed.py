"""What the nearest-observer search leaves on disk: freed shuffles, narrow rounds, waves, lists shuffled for copies only."""

import glob
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from flyway.models import neighbors as nb
from flyway.session import SHUFFLE_CLEANUP, cut_lineage
from tests.test_neighbors_classes import repeated
from tests.test_neighbors_search import TEST, TRAIN, skewed


def _shuffled(spark):
    return set(glob.glob(f"{spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]}"
                         "/**/shuffle_*.data", recursive=True))


def _frames(spark):
    test = skewed(1, 60, vocab=60, most=20, common=3) + repeated(5, 90, 7)
    train = [(f, i, 2000, s) for f, i, s in skewed(2, 150, vocab=60, most=20, common=3) + repeated(6, 60, 9)]
    return spark.createDataFrame(test, TEST), spark.createDataFrame(train, TRAIN)


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_what_a_written_table_shuffled_is_freed(spark):
    before = _shuffled(spark)
    df = cut_lineage(spark.range(20_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):                                   # files go in the background
        if not _shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffled(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert sum(r["count"] for r in df.collect()) == 20_000


@pytest.mark.parametrize("output", ["neighbors", "votes", "counts"])
def test_waves_give_the_rows_of_one(spark, monkeypatch, output):
    frames, names = _frames(spark), []
    want = _rows(nb.neighbor_search(*frames, n_neighbors=7, output=output, test_block_rows=4, train_block_rows=30))

    def cut(df, name):
        names.append(name)
        return cut_lineage(df, name)

    monkeypatch.setattr(nb, "cut_lineage", cut)
    monkeypatch.setattr(nb, "STRIPES", 2)
    monkeypatch.setattr(nb, "STRIPE_BLOCKS", 2)
    got = _rows(nb.neighbor_search(*frames, n_neighbors=7, output=output, test_block_rows=4, train_block_rows=30))
    assert got == want and names.count("nb-wave") > 1


def test_a_class_of_one_row_names_its_observer(spark, monkeypatch):
    """Its lists need no join; those of classes of several rows, or of a row without an observer, do."""
    frames, found = _frames(spark), []
    nobody = spark.createDataFrame([(1, None, ["c0", "s1"])], TEST)

    def cut(df, name):
        out = cut_lineage(df, name)
        found.extend(out.select("observer_id", "only").collect() if name == "nb-found" else [])
        return out

    monkeypatch.setattr(nb, "cut_lineage", cut)
    got = nb.neighbor_search(frames[0].unionByName(nobody), frames[1], n_neighbors=7).collect()
    classes = [[m.observer_id for m in c] for c in _members(frames[0].unionByName(nobody))]
    assert sorted(r.only for r in found if r.only is not None) == sorted(c[0] for c in classes if len(c) == 1 and c[0] is not None)
    assert sum(r.only is None for r in found) == sum(len(c) > 1 or c[0] is None for c in classes) > 1
    assert {r.observer_id for r in got} == {i for c in classes for i in c}


def _members(test):
    return [r.rows for r in test.groupBy("fold", F.array_sort("species_from"))
            .agg(F.collect_list(F.struct("observer_id")).alias("rows")).collect()]


def test_bounds_need_nobodys_name():
    """The first round is sent sizes and members held, no observers and years; its bounds are the same."""
    def packed(prefix, sets, **more):
        names = sorted({x for s in sets for x in s})
        return {f"{prefix}names": names, f"{prefix}sizes": np.array([len(s) for s in sets], np.int32).tobytes(),
                f"{prefix}codes": np.array([names.index(x) for s in sets for x in s], np.uint8).tobytes(), **more}

    assert not {"ids", "years"} & set(nb.SHIPPED["bounds"]) and nb.SHIPPED["counts"] == ["weights"]
    sets = [["a"], ["a", "b"], ["a", "b", "c"]]
    held = {"t_held": np.array([2, 1, 3], np.int32).tobytes()}
    named = {"t_ids": np.arange(6).tobytes(), "t_years": np.zeros(6, np.int32).tobytes()}
    least = []
    for more in (held, {**held, **named}):
        search = nb._Search({"fold": 1, "block": 1, **packed("", [["a", "b"], ["c"]], ids=np.arange(2).tobytes())}, "cosine", 4, 1, "bounds")
        search.meet(packed("t_", sets, **more))
        least.append(search.least.tolist())
    assert least[0] == least[1] and least[0][0] > 0
