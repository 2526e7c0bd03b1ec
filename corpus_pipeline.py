"""Corpus pipeline: quality rules, SimHash near-dedup, secret scans, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on every document that the one before
kept; all but the last return the columns of ``documents``.  ``run`` applies them to the
documents table and writes each stage's result as Parquet into the shared scratch folder, from
where the next one reads it.

Defined results: quality and secrets are judged row by row.  The near-duplicate stage keeps
one row of every group, the first by doc_id, text and the other columns, whatever other texts
its doc_id stands on.  Rows without a doc_id cannot be named as the document of a group: they
are told from each other only, and the first of a group's stays beside the named one.  In
the mix every row comes in as many copies as it was taken itself.  A null text is an empty one.  Extra
columns stay as they are whatever their names: stages work on keys of their own beside a row packed in one
column.  An empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flyway.llm.bpe import bpe_round_trip
from flyway.llm.common import cut_lineage, row_key, table
from flyway.llm.mixing import mix_sources
from flyway.llm.quality_rules import keep_quality
from flyway.llm.secret_scan import redact_secrets
from flyway.llm.simhash import simhash_near_dedup


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the forest's verdict."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, row): the row's other columns, text first, in one struct that no name can clash with."""
    rest = ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    return docs.select("doc_id", row_key(docs).alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))


def unpacked(held: DataFrame, columns: list[str]) -> DataFrame:
    return held.select(*[F.col("doc_id") if c == "doc_id" else F.col("row").getField(c).alias(c) for c in columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of every group of linked fingerprints, and one without doc_id."""
    held = packed(docs)
    groups = simhash_near_dedup(held.select("doc_id", "row_key", F.col("row.text").alias("text")),
                                shingle=3, max_bits=2, key="row_key")
    firsts = (groups.where("doc_id is null or doc_id = component_id")
              .select("row_key", "component_key").distinct())
    same = held.join(firsts, "row_key").groupBy("component_key", "doc_id").agg(F.min("row").alias("row"))
    return unpacked(same, docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported secret span masked; documents stay."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    held = packed(docs)
    sized = held.select("doc_id", "row_key", F.col("row.text").alias("text"), F.col("row.source").alias("source"))
    taken = (mix_sources(sized, row="row_key").where("passes > 0")
             .groupBy("row_key").agg(F.sum("passes").alias("passes")))     # equal rows: their copies together
    copies = taken.select("row_key", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("copy"))
    return unpacked(held.dropDuplicates(["row_key"]).join(copies, "row_key"), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' and decoded texts' digests, one row per document copy."""
    return bpe_round_trip(docs)


STAGES = [("quality_rules", keep_good), ("simhash_near_dedup", keep_one_of_each_group),
          ("secret_scans", mask_secrets), ("source_mixing", mix), ("byte_bpe", encode)]

# The forest, the trained threshold and the test battery have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
