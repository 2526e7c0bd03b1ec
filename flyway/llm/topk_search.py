"""Exact top-k inner products over norm-sorted vectors with SVD-rotated partial sums.

Vectors become integers ``floor(scale * x)`` and are sorted by descending length into
blocks by range partitions (ties by id, so equal vectors spread over blocks).  Query
blocks first meet the stripe of the longest vectors, which gives every query a k-th best
score; a later block is sent to a query block only while the Cauchy-Schwarz bound
``|q| * longest in the block`` reaches that score for one of its queries.

Inside a task candidates come by descending length.  Both sides are rotated by the
singular vectors of a bounded sample, which gathers most of the inner product in the
first places: the partial sum over these plus ``|rest of q| * |rest of x|`` bounds the
score, and only candidates whose bound reaches the query's k-th best so far are scored
exactly, in integers.  The rotation only prunes; results are exact for any sample.

Work is dealt by (stripe, group of query blocks): a task holds one stripe's blocks, packed, and the group's
query blocks come to it one by one.  So a candidate is shuffled once a group, and the many copies
are of the small query blocks.  Pairs exist between blocks, never between rows in a shuffle; a stripe's
running top k per query is all that leaves a task.  Block figures (one row per block) reach the driver.

Defined results: vectors that are null or hold null, NaN or infinite components, and rows
without a vec_id, take no part, nor do vectors with a component whose ``floor(scale * x)`` is no 64-bit
integer; a score beyond 64 bits is an error, never wrong; shorter vectors count as padded with zeros; candidates
with the query's own vec_id are its own row; repeated rows are candidates (and queries)
each; with fewer than k candidates all are returned; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_sample, cut_lineage, record_batch

FOUND = "query_block bigint, place bigint, query_id bigint, q_length double, vec_id bigint, score bigint"
BLOCK = "block bigint, n bigint, longest double, ids binary, vectors binary, width int"
EXACT = float(1 << 52)             # below this, sums of integer products are exact in doubles


def integer_kernel(scale: float):
    """mapInArrow: (vec_id, embedding) -> (vec_id, 64-bit integers, length), unusable vectors left out."""
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("length", pa.float64()),
                        ("width", pa.int32())])

    def run(batches):
        for b in batches:
            ids, rows = [], []
            for i, x in zip(b.column("vec_id").to_pylist(), b.column("embedding")):
                if not x.is_valid or i is None or x.values.null_count:
                    continue
                v = np.floor(x.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if (np.abs(v) < 2.0 ** 63).all():         # not so for NaN and infinity
                    ids.append(i)
                    rows.append(v.astype(np.int64))
            yield record_batch(schema, vec_id=ids, vector=[v.tobytes() for v in rows],
                               length=[float(np.sqrt((v.astype(float) ** 2).sum())) for v in rows],
                               width=[len(v) for v in rows])

    return run


def smallest(m: np.ndarray) -> np.ndarray:
    """The matrix in the smallest integer type that holds it."""
    top = int(np.abs(m).max()) if m.size else 0
    kind = next(t for t, most in ((np.int8, 127), (np.int16, 32767), (np.int32, 2 ** 31 - 1),
                                  (np.int64, 2 ** 63 - 1)) if top <= most)
    return m.astype(kind)


def block_kernel(rows: int, dim: int):
    """mapInArrow: sorted (vec_id, vector, length) of a partition -> blocks of ``rows`` vectors."""
    schema = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("longest", pa.float64()),
                        ("ids", pa.binary()), ("vectors", pa.binary()), ("width", pa.int32())])

    def run(batches):
        block, ids, vectors, longest, held = TaskContext.get().partitionId() << 24, [], [], 0.0, 0

        def out():
            m = smallest(np.array(vectors, np.int64).reshape(len(ids), dim))
            return record_batch(schema, block=[block], n=[len(ids)], longest=[longest],
                                ids=[np.array(ids, np.int64).tobytes()], vectors=[m.tobytes()],
                                width=[m.itemsize])

        for b in batches:
            for i, v, length in zip(*(b.column(c).to_pylist() for c in ("vec_id", "vector", "length"))):
                x = np.zeros(dim, np.int64)
                x[:len(v) // 8] = np.frombuffer(v, np.int64)
                ids.append(i)
                vectors.append(x)
                longest = max(longest, length)
                if len(ids) == rows:
                    yield out()
                    block, ids, vectors, longest = block + 1, [], [], 0.0
        if ids:
            yield out()

    return run


def matrix(ids: bytes, vectors: bytes, width: int, dim: int):
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vectors, f"i{width}").reshape(len(ids), dim).astype(np.float64)


class Queries:
    """A query block, its rotation and the running top k of every query."""

    def __init__(self, ids, vectors, rotation, head, k, floor):
        self.ids, self.x, self.k, self.head = ids, vectors, k, head
        turned = vectors @ rotation
        self.front = turned[:, :head]
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(1))
        self.length = np.sqrt((vectors ** 2).sum(1))
        self.q, self.vec = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0, np.float64)
        self.least = floor.copy()                     # k-th best so far: nothing below can enter

    def meet(self, ids, x, rotation, tile: int = 4096) -> None:
        """Candidates in descending length, tile by tile."""
        length = np.sqrt((x ** 2).sum(1))
        for i in range(0, len(ids), tile):
            reach = self.length * length[i:i + tile].max(initial=0.0)
            live = np.flatnonzero(reach * (1 + 1e-9) >= self.least - 0.5)
            if not len(live):
                if (np.diff(length) <= 1e-6).all():   # sorted: no later tile can reach
                    return
                continue
            part, name = x[i:i + tile], ids[i:i + tile]
            turned = part @ rotation
            rest = np.sqrt((turned[:, self.head:] ** 2).sum(1))
            bound = self.front[live] @ turned[:, :self.head].T
            bound += self.rest[live, None] * rest
            slack = 0.5 + 1e-9 * float(reach.max())
            a, c = np.nonzero(bound >= (self.least[live] - slack)[:, None])
            a = live[a]
            other = self.ids[a] != name[c]
            a, c = a[other], c[other]
            for j in range(0, len(a), 1 << 16):
                self.enter(a[j:j + (1 << 16)], name, part, c[j:j + (1 << 16)])

    def enter(self, a, name, part, c) -> None:
        if self.length.max() * np.sqrt((part ** 2).sum(1)).max() < EXACT:
            s = np.einsum("ij,ij->i", self.x[a], part[c])
        else:                                         # too large for doubles: Python integers
            s = np.array([sum(int(x) * int(y) for x, y in zip(self.x[i], part[j]))
                          for i, j in zip(a, c)], object)
        near = s >= self.least[a]
        q = np.concatenate([self.q, a[near]])
        vec, score = np.concatenate([self.vec, name[c[near]]]), np.concatenate([self.score, s[near]])
        order = np.lexsort((vec, -score, q))
        q, vec, score = q[order], vec[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.q, self.vec, self.score = q[keep], vec[keep], score[keep]
        last = place == self.k - 1
        self.least[q[last]] = np.maximum(self.least[q[last]], score[last].astype(float))


def search_kernel(rotation: np.ndarray, head: int, k: int):
    """mapInArrow over rows sorted by (stripe, part, asks): a stripe's blocks by rank, then the query blocks.

    Gives the top k per query and stripe.
    """
    schema = pa.schema([("query_block", pa.int64()), ("place", pa.int64()), ("query_id", pa.int64()),
                        ("q_length", pa.float64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    dim = len(rotation)

    def run(batches):
        now, held = None, []
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if (r["stripe"], r["part"]) != now:
                    now, held = (r["stripe"], r["part"]), []
                if r["asks"] < 0:
                    held.append((r["rank"], r["ids"], r["vectors"], r["width"]))
                    continue
                ids, x = matrix(r["ids"], r["vectors"], r["width"], dim)
                floor = np.full(len(ids), -np.inf)
                for f in r["floors"] or ():
                    floor[f["place"]] = f["least"]
                q = Queries(ids, x, rotation, head, k, floor)
                for rank, *block in held:
                    if rank < r["rank"]:                  # the query block reaches so far
                        q.meet(*matrix(*block, dim), rotation)
                yield record_batch(schema, query_block=[r["asks"]] * len(q.q), place=q.q, query_id=q.ids[q.q],
                                   q_length=q.length[q.q], vec_id=q.vec, score=[int(s) for s in q.score])

    return run


def fitted_rotation(vectors: DataFrame, dim: int, sample_rows: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of a bounded sample, and how many hold nine tenths of its energy."""
    rows = bounded_sample(vectors.withColumn("salt", F.xxhash64("vec_id", "vector")), "salt", sample_rows)
    x = np.zeros((sample_rows, dim))
    for i, r in enumerate(rows.select("vector").collect()):
        v = np.frombuffer(bytes(r["vector"]), np.int64)
        x[i, :len(v)] = v
    _, s, vt = np.linalg.svd(x.T @ x)
    energy = np.cumsum(s) / max(float(s.sum()), 1e-9)
    return vt.T, int(min(np.searchsorted(energy, 0.9) + 1, dim))


def reachable_blocks(longest: np.ndarray):
    """pandas UDF: how many of the blocks (longest vector first) reach score / length ``slope``."""
    rising = -np.asarray(longest)

    @F.pandas_udf("int")
    def count(slope: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(rising, -slope.to_numpy() * (1 - 1e-9) + 1e-9, side="right"))

    return count


def top_inner_products(embeddings: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20,
                       scale: float = 64.0, query_rows: int = 256, stripe_blocks: int = 16,
                       least_rows: int = 4096, most_rows: int = 65536, part_blocks: int = 64,
                       least_tasks: int = 4, sample_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all vectors for every row that meets ``queries``.

    ``sample_rows`` bounds the vectors the rotation is fitted on; a block of candidates has
    ``least_rows`` to ``most_rows`` vectors (32 MB at most), 64 blocks or more where the table allows it.
    ``part_blocks`` query blocks share a task's stripe, fewer where that would leave less than ``least_tasks`` tasks.
    """
    spark = embeddings.sparkSession
    vectors = cut_lineage(embeddings.select("vec_id", "embedding").mapInArrow(
        integer_kernel(scale), "vec_id bigint, vector binary, length double, width int"), "topk-vectors")
    n, dim = vectors.agg(F.count(F.lit(1)), F.max("width")).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = max(dim, 1)
    rotation, head = fitted_rotation(vectors, dim, sample_rows)

    def blocks(df: DataFrame, rows: int, name: str) -> DataFrame:
        order = [F.desc("length"), F.asc("vec_id")]
        parts = max(1, -(-df.count() // rows))
        return cut_lineage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                           .mapInArrow(block_kernel(rows, dim), BLOCK), name)

    most_rows = max(1, min(most_rows, (1 << 25) // (8 * dim)))
    candidates = blocks(vectors, min(max(n // 64, least_rows), most_rows), "topk-blocks")
    asked = blocks(vectors.where(queries), query_rows, "topk-queries").withColumnRenamed("block", "query_block")
    ranked = sorted(((-r["longest"], r["block"]) for r in candidates.select("longest", "block").collect()))
    order = spark.createDataFrame([(b, i) for i, (_, b) in enumerate(ranked)], "block bigint, rank int")
    candidates = candidates.join(F.broadcast(order), "block")       # one row per block
    floors = "array<struct<place:bigint,least:double>>"

    n_asked, n_stripes = asked.count(), -(-len(ranked) // stripe_blocks)
    stripe = F.floor(F.col("rank") / stripe_blocks).cast("int").alias("stripe")
    held = candidates.select(stripe, F.lit(-1).cast("long").alias("asks"), "rank", "ids", "vectors", "width",
                             F.lit(None).cast(floors).alias("floors"))

    def search(asking: DataFrame, stripes: int) -> DataFrame:
        """``asking``: query blocks with ``low`` and ``upto``, the ranks of the blocks to meet."""
        parts = max(-(-n_asked // part_blocks), min(n_asked, -(-least_tasks // max(stripes, 1))), 1)
        low, high = F.floor(F.col("low") / stripe_blocks), F.floor((F.col("upto") - 1) / stripe_blocks)
        dealt = asking.select(
            F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("stripe"),
            F.col("query_block").alias("asks"), F.col("upto").alias("rank"), "ids", "vectors", "width", "floors",
            F.pmod(F.xxhash64("query_block"), F.lit(parts)).cast("int").alias("part"))
        needed = dealt.select("stripe", "part").distinct()
        rows = held.join(needed, "stripe").unionByName(dealt)
        return (rows.repartition("stripe", "part").sortWithinPartitions("stripe", "part", "asks", "rank")
                .select("stripe", "part", "asks", "rank", "ids", "vectors", "width", "floors")
                .mapInArrow(search_kernel(rotation, head, k), FOUND))

    first = min(stripe_blocks, len(ranked))
    found = search(asked.withColumn("floors", F.lit(None).cast(floors))
                   .withColumn("low", F.lit(0)).withColumn("upto", F.lit(first)), 1)
    if len(ranked) > first:
        found = cut_lineage(found, "topk-first")
        kth = (found.groupBy("query_block", "place")
               .agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"),
                    F.max("q_length").alias("q_length")).where(F.col("n") >= k)
               .groupBy("query_block")                    # at most query_rows places in a block
               .agg(F.collect_list(F.struct("place", "least")).alias("floors"),
                    F.min(F.when(F.col("q_length") > 0, F.col("least") / F.col("q_length"))
                          .otherwise(0.0)).alias("slope")))
        slope = F.when(F.size("floors") == F.col("n"), F.greatest("slope", F.lit(0.0))).otherwise(0.0)
        upto = reachable_blocks(np.array([-x for x, _ in ranked]))(slope)
        later = (asked.join(kth, "query_block", "left").withColumn("upto", upto)
                 .where(F.col("upto") > first).withColumn("low", F.lit(first)))
        found = found.unionByName(search(cut_lineage(later, "topk-later"), n_stripes - 1))
    best = W.partitionBy("query_block", "place").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 20
"""
