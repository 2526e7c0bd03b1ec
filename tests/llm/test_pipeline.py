"""The corpus pipeline, stage by stage on each stage's own input, against plain code."""

import importlib.util
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from flyway.llm import secret_scan as S
from flyway.llm.common import cut_lineage, table
from flyway.llm.mixing import mix_sources
from flyway.llm.quality_rules import quality_rules

from . import fixtures as X
from .test_bpe import expected, got
from .test_secret_scan import plain
from .test_text_operators import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in P.STAGES:
        docs.append(cut_lineage(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_columns_stay(steps):
    assert all(d.columns == steps[0].columns for d in steps[1:-1])


def test_quality(spark, steps):
    verdict = quality_rules(steps[0], table(spark, SF, "labels")).collect()
    kept = {r.doc_id for r in verdict if r.kept}
    assert rows(steps[1]) == Counter(t for t in rows(steps[0]).elements() if t[0] in kept) and 0 < len(kept) < 200


def test_one_of_each_group(steps):
    fps = {r.doc_id: plain_fingerprint(r.text) for r in steps[1].collect()}
    root = plain_components(set(fps.values()), 2)
    first = {}
    for d in sorted(fps):
        first.setdefault(root[fps[d]], d)
    assert rows(steps[2]) == Counter(t for t in rows(steps[1]).elements() if t[0] in first.values())
    assert len(first) < len(fps)


def test_secrets_are_masked(steps):
    before = {r.doc_id: r for r in steps[2].collect()}
    after = {r.doc_id: r for r in steps[3].collect()}
    assert before.keys() == after.keys()
    letters = S.letter_model(steps[2])
    mean, level = S.discovery_level(S.scan(steps[2], letters, 0.01), 0.01)
    for d, r in before.items():
        assert after[d].text == S.redacted(r.text, letters, 0.01, mean, level, "[SECRET]")
        assert after[d].n_chars == len(after[d].text) and not plain(after[d].text)
        if not plain(r.text):
            assert after[d] == r


def test_mix(steps):
    want = {r.doc_id: r.passes for r in mix_sources(steps[3]).collect()}
    copies = Counter()
    for t, n in rows(steps[4]).items():
        copies[t[0]] += n
    assert copies == Counter({d: n for d, n in want.items() if n}) and set(rows(steps[4])) <= set(rows(steps[3]))
    assert set(want.values()) == {0, 1, 2}


def test_encoding(steps):
    assert got(steps[5]) == expected([(r.doc_id, r.text) for r in steps[4].collect()])


def test_run_equals_the_stages(spark, steps):
    assert rows(P.run(spark, SF)) == rows(steps[5])


def test_awkward_documents(spark):
    docs, all_rows = X.documents(spark)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for start in (docs, docs.limit(0)):
        now = start
        for _, stage in P.STAGES:
            now = cut_lineage(stage(spark, now, SF), "test-awkward")
        now.count()
    kept = cut_lineage(P.keep_one_of_each_group(spark, docs, SF), "test-once")
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids.pop(None) == 2 and set(ids.values()) == {1}


def test_shared_and_missing_ids(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma"))
    docs = spark.createDataFrame([(3, a, "en"), (5, a, "en"), (5, b, "en"), (7, b, "de"), (5, b, "de"),
                                  (None, c, "en"), (None, c, "de"), (None, c, "en")],
                                 "doc_id bigint, text string, lang string")
    kept = P.keep_one_of_each_group(spark, docs, SF)
    assert rows(kept) == Counter([(3, a, "en"), (5, b, "de"), (None, c, "de")])


def test_clashing_names_survive(spark):
    """Columns named like the stages' own keys keep their values, in every stage that returns documents."""
    names = ["row_key", "component_key", "copy", "passes", "row", "fp", "size", "key", "doc", "d"]
    docs = table(spark, SF, "documents").limit(80).withColumns(
        {c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in names})
    docs = docs.unionAll(docs.limit(7)).select("passes", "doc_id", "copy", "text", *[c for c in docs.columns if c not in (
        "passes", "doc_id", "copy", "text")])
    now = cut_lineage(docs, "test-clash")
    for name, stage in P.STAGES[:-1]:
        now = cut_lineage(stage(spark, now, SF), "test-clash")
        assert now.columns == docs.columns, name
        got = now.collect()
        assert got and all(r[c] == f"{c}-{r.doc_id}" for r in got for c in names), name
    empty = cut_lineage(docs.limit(0), "test-clash")
    for name, stage in P.STAGES[:-1]:
        empty = cut_lineage(stage(spark, empty, SF), "test-clash")
        assert empty.columns == docs.columns and not empty.count(), name


def test_mix_by_row(spark):
    docs = spark.createDataFrame([(None, "w " * (i + 1), "en", "s0", 2 * i + 2) for i in range(12)]
                                 + [(1, "same", "en", "s0", 4)] * 3,
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = Counter()
    for r in mix_sources(docs).collect():
        want[r.doc_id, r.source, r.size] += r.passes
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in P.mix(spark, docs, SF).collect())
    assert got == +want and {n for (d, *_), n in want.items() if d is None} == {1, 2}


def test_registered():
    assert importlib.util.find_spec("corpus_pipeline") and os.path.exists(P.__file__)
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run
    assert {k.split("_")[0] for k in E.queries() if k.startswith("op")} == {f"op{n}" for n in range(1, 14)}
