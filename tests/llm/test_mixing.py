"""Source mixing against its SQL on awkward tables: nulls, ties, repeats, empty and long texts, clashing names."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from flyway.llm.mixing import ORACLE, mix_sources

SCHEMA = "doc_id bigint, source string, text string"


def expected(rows):
    import pandas as pd
    docs = pd.DataFrame(rows, columns=["doc_id", "source", "text"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("given", docs)
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(source AS VARCHAR) AS source, "
                "CAST(text AS VARCHAR) AS text FROM given")
    return con.execute(ORACLE).fetchall()


def ordered(rows):
    return sorted(((-1 if r[0] is None else r[0]), r[1], r[2], round(r[3], 6), r[4]) for r in rows)


def got(df):
    return ordered(mix_sources(df).select("doc_id", "size", "source_size", "target", "taken").collect())


def words(n):
    return " ".join(["w"] * n)


def awkward():
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "c", "d", None]), words(rng.randrange(40))) for i in range(200)]
    rows += [(None, "a", words(3)), (None, None, None), (500, "b", None), (501, "c", ""), (502, "a", " \t\n "),
             (503, "d", words(5000)), (504, "empty", ""), (505, "empty", None), (506, "é", "w w w\x0bw")]
    return rows


def test_awkward_rows(spark):
    rows = awkward()
    assert got(spark.createDataFrame(rows, SCHEMA)) == ordered(expected(rows))


def test_repeated_rows_and_ids(spark):
    """Equal rows get equal places in any order, so the words taken agree as a bag."""
    rows = awkward()[:60] * 3 + [(7, "a", words(4)), (7, "a", words(9)), (7, "b", words(9))]
    assert got(spark.createDataFrame(rows, SCHEMA)) == ordered(expected(rows))


def test_a_hot_source_of_equal_sizes(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", words(10)) for i in range(900)]
    out = got(spark.createDataFrame(rows, SCHEMA))
    assert out == ordered(expected(rows))
    assert all(r[4] <= 2 * r[1] for r in out)


@pytest.mark.parametrize("rows", [[], [(1, "a", None)], [(1, None, words(5))]])
def test_tiny_tables(spark, rows):
    out = got(spark.createDataFrame(rows, SCHEMA))
    assert out == (ordered(expected(rows)) if rows else [])


def test_partitions_and_clashing_names_change_nothing(spark):
    df = spark.createDataFrame(awkward(), SCHEMA)
    plain = got(df)
    assert got(df.repartition(11)) == plain
    extra = df.select("*", *[F.lit("x").alias(c) for c in ("size", "key", "part", "end", "target", "budget", "range",
                                                           "finish", "pass", "source_rank", "source_size", "n")])
    assert got(extra) == plain
