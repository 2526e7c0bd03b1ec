"""Mixing sources to target weights by weighted fair queueing.

Sources, in code-point order with null last, weigh ``weights`` repeating.  Together
they get ``budget`` times all words; a source's target stops at ``max_passes`` times
its size and the excess is shared again by weight.  With sources sorted by
``max_passes * size / weight`` the capped ones are a prefix, so the targets need one
pass over the source table instead of a loop.

Queueing: a source's documents stand in a shuffled order (by the MD5 of their id), one
pass after the other.  A document's virtual finish time is the source's words up to
its end divided by the source's target.  All finish times are sorted by global range
partitions and cut where their running sum of words passes the budget.

Running sums never gather a source or the whole queue in one task: a source's order is
split at the leading hex digits of the MD5 (``16 ** digits`` parts, so a source with a
third of all rows is spread over that many groups), a queue at its range partitions;
totals per part are summed first and carried in as offsets.  The table of sources is
one row per source and is ranked in one task: it holds as many rows as the mixture has
weights.

Defined results: a null text has size 0 and is never taken; null doc_ids queue under
one hash, larger ones after smaller; repeated rows queue one after the other; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut_lineage

ORDER = ["finish", "key", "size", "source_rank", "pass"]


def source_targets(sized: DataFrame, weights: tuple[int, ...], budget: float,
                   max_passes: int) -> DataFrame:
    """(source, source_rank, source_size, target, budget) per source."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("source_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*map(F.lit, weights)),
                     ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    everything = W.partitionBy()
    s = (s.withColumn("weight", w.cast("long"))
         .withColumn("cap", max_passes * F.col("source_size"))
         .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget))))
    before = W.orderBy(F.col("cap") / F.col("weight"), "source_rank").rowsBetween(
        W.unboundedPreceding, -1)
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    s = s.withColumn("capped", F.col("cap") / F.col("weight") < level)
    left = (F.col("budget") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    return s.select("source", "source_rank", "source_size", "budget",
                    F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(left / open_weight * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5,
                max_passes: int = 2, digits: int = 3, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, passes, taken) of every document.

    ``row`` names a column of ``docs`` that is returned with each row and orders those with one
    doc_id and size.
    """
    rows = [row] if row else []
    sized = cut_lineage(docs.select(
        "doc_id", "source", *rows, F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0))
        .cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key")),
        "mix-sizes")
    targets = cut_lineage(source_targets(sized, weights, budget, max_passes), "mix-targets")
    known = sized.join(targets, sized.source.eqNullSafe(targets.source)).drop(targets.source)
    known = known.withColumn("part", F.substring("key", 1, digits))
    parts = known.groupBy("source_rank", "part").agg(F.sum("size").alias("n"))
    ahead = W.partitionBy("source_rank").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("source_rank", "part",
                           F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    inside = W.partitionBy("source_rank", "part").orderBy("key", "size", *rows).rowsBetween(
        W.unboundedPreceding, 0)
    queued = cut_lineage(
        known.join(offsets, ["source_rank", "part"])
        .withColumn("end", F.col("offset") + F.sum("size").over(inside)).drop("part", "offset"),
        "mix-queues")

    def finish(n: int):
        return ((F.col("end") + (n - 1) * F.col("source_size")).cast("double") / F.col("target"))

    items = (queued.where("size > 0")
             .select("key", "size", "source_rank", "budget",
                     F.posexplode(F.array(*[finish(n + 1) for n in range(max_passes)])).alias("pass", "finish")))
    ranged = cut_lineage(items.repartitionByRange(*ORDER)
                         .withColumn("range", F.spark_partition_id()), "mix-order")
    totals = ranged.groupBy("range").agg(F.sum("size").alias("n"), F.min("finish").alias("low"))
    carried = totals.select("range", F.coalesce(F.sum("n").over(
        W.orderBy("low", "range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("carried"))
    running = F.sum("size").over(W.partitionBy("range").orderBy(*ORDER).rowsBetween(
        W.unboundedPreceding, 0))
    last = (ranged.join(F.broadcast(carried), "range")            # one row per range partition
            .withColumn("total", F.col("carried") + running)
            .where("total <= budget").agg(F.max(F.struct(*ORDER)).alias("last")).first()["last"])
    passes = F.lit(0).cast("long")
    if last is not None:                                          # where the queue is cut
        cut = F.struct(*[F.lit(last[c]).alias(c) for c in ORDER])
        for n in range(max_passes):
            place = F.struct(finish(n + 1).alias("finish"), "key", "size", "source_rank",
                             F.lit(n).alias("pass"))
            passes = passes + ((F.col("size") > 0) & (place <= cut)).cast("long")
    return (queued.withColumn("passes", F.coalesce(passes, F.lit(0)))
            .select("doc_id", *rows, "source", "size", "source_size", "target", "passes",
                    (F.col("passes") * F.col("size")).alias("taken")))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM s0),
s2 AS (SELECT *, CAST(CASE (source_rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS weight,
         2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE) AS budget FROM s1),
s3 AS (SELECT *, CAST(cap AS DOUBLE) / weight <
         (budget - coalesce(CAST(sum(cap) OVER b AS BIGINT), 0))
         / CAST(CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER b AS BIGINT), 0) AS DOUBLE) AS capped
       FROM s2 WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / weight, source_rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_rank, source_size, budget,
    CASE WHEN capped THEN CAST(cap AS DOUBLE)
         ELSE (budget - CAST(sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS BIGINT))
              / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) * weight END AS target
  FROM s3),
queued AS (
  SELECT z.*, t.source_rank, t.source_size, t.budget, t.target,
         CAST(sum(z.size) OVER (PARTITION BY t.source_rank ORDER BY z.key, z.size
                                ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fin
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source),
items AS (
  SELECT key, size, source_rank, budget, p AS pass,
         CAST(fin + p * source_size AS DOUBLE) / target AS finish
  FROM queued, (VALUES (0), (1)) v(p) WHERE size > 0),
sums AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key, size, source_rank, pass ROWS UNBOUNDED PRECEDING) AS total
  FROM items),
cut AS (SELECT * FROM sums WHERE total <= budget
        ORDER BY finish DESC, key DESC, size DESC, source_rank DESC, pass DESC LIMIT 1),
decided AS (
  SELECT q.doc_id, q.size, q.source_size, q.target,
    (SELECT count(*) FROM cut c WHERE q.size > 0
       AND (CAST(q.fin AS DOUBLE) / q.target, q.key, q.size, q.source_rank, 0)
           <= (c.finish, c.key, c.size, c.source_rank, c.pass))
    + (SELECT count(*) FROM cut c WHERE q.size > 0
       AND (CAST(q.fin + q.source_size AS DOUBLE) / q.target, q.key, q.size, q.source_rank, 1)
           <= (c.finish, c.key, c.size, c.source_rank, c.pass)) AS passes
  FROM queued q)
SELECT doc_id, size, source_size, target, CAST(passes * size AS BIGINT) AS taken FROM decided
"""
