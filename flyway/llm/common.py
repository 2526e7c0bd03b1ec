"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

# Fixed value: a word is a maximal run of code points that are not ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(df: DataFrame):
    """SHA-256 of a row's columns: rows with one key are the same in all of them."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:16]}")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or no rows of ``schema`` when nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def text_chunks(column: pa.Array, limit: int):
    """The column's texts as lists of about ``limit`` bytes, one text at least, made as they are read."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < len(column):
        held = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, held + limit, side="right")))
        yield column.slice(i, j - i).to_pylist()
        i = j


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def cut_bucketed(df: DataFrame, name: str, column: str, kind: str) -> DataFrame:
    """Like ``cut_lineage``, in buckets of ``column`` (and folders of ``kind``).

    A later join or grouping on ``column`` reads the buckets as they lie and shuffles only
    its other side.  The files lie in the shared folder; the table's name, which Spark looks
    up again when it plans, stays in the session's catalog.
    """
    spark = df.sparkSession
    table_name = f"{name}_{uuid.uuid4().hex[:16]}"
    (df.write.partitionBy(kind).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column)
       .option("path", fresh_path(spark, name)).saveAsTable(table_name))
    return spark.table(table_name)


def bounded_sample(df: DataFrame, salt: str, rows: int, *order: str) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash ``salt``; the same on every run.

    A hash filter first brings the rows down to about twice the bound, so that no partition sends a full
    sample of its own to the final sort.  Equal rows share a hash: where they leave fewer rows than the bound,
    the filter is widened until there are enough.
    """
    n, share = df.count(), 1.0
    place = F.pmod(F.col(salt), F.lit(1 << 31))
    some = df
    while n > 2 * rows:
        share = min(1.0, 2 * rows / n if some is df else 4 * share)
        some = df.where(place < int(share * (1 << 31)))
        if share == 1.0 or some.limit(rows).count() == rows:
            break
    return some.orderBy(place, salt, *order).limit(rows)


__all__ = ["WORD_PATTERN", "F", "bounded_sample", "cut_bucketed", "cut_lineage", "fresh_path", "read_or_empty",
           "record_batch", "row_key", "table", "text_chunks"]
