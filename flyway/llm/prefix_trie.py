"""Conversation prefix trie with subtree totals by parallel tree contraction.

``rebuild`` gives conversations shared openings; ``prefix_trie`` builds the trie of all their
prefixes; ``subtree_sums`` totals a column over every subtree of any forest by contraction:

* Compress: a maximal chain of nodes with one child each is replaced by its lower end.  Its nodes
  double their pointers down the chain, summing on the way, so a chain of n takes about log n
  joins.  The node above the chain takes over its sum and its lower end.
* Rake: what then has no child is a leaf, and its total is known.  Its parent takes it over.

Both alternate until only the roots remain: after compress every inner node has two children,
so each rake removes more than half of the nodes.  Then the compressed nodes are expanded again,
last round first: a chain node's total is its sum down the chain and the total of the chain's
lower end.  Each step is written to the shared folder.

A prefix is known by its length and two 64-bit sums (xor) of its turns' hashes, each turn's SHA-256
hashed with its depth; so a prefix needs no chain of joins, and running sums do it.  Nodes are then
named by (smallest member, depth).  No conversation is gathered: turns are range-sorted, a turn's
place is its place within its range and the counts of the ranges before; running sums are split every
``part`` turns.  A node's children are only counted and summed, pre-aggregated before the shuffle.
The ids of the conversations that end at a node are sorted by range, joined to strings of ``chunk``
ids and hashed one after the other by one task a node, which holds one such string at a time
(SHA-256 knows no other order).

Defined results: turns are ordered by turn (null first), equal ones by their role and text's SHA-256;
repeated rows are turns of their own; null role or text is empty; rows without conv_id take no part;
an empty table gives no rows, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut_lineage, record_batch

EMPTY_HASH = hashlib.sha256(b"").hexdigest()
BEFORE = (W.unboundedPreceding, -1)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, sha, words) of every turn, in its conversation's order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.col("turn").asc_nulls_first(), "sha", "row"]
    ranged = cut_lineage(turns.repartitionByRange("conv_id", *order)
                         .withColumn("range", F.spark_partition_id()), "trie-turns")
    counts = ranged.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    ahead = counts.select("conv_id", "range", F.coalesce(F.sum("n").over(
        W.partitionBy("conv_id").orderBy("range").rowsBetween(*BEFORE)), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(W.partitionBy("conv_id", "range").orderBy(*order))
    return (ranged.withColumn("inside", inside).join(ahead, ["conv_id", "range"])
            .select("conv_id", (F.col("ahead") + F.col("inside")).alias("place"), "sha", "words"))


def rebuild(conversations: DataFrame, group: int = 20, modulus: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, sha, words) of the rebuilt conversations' turns, and (conv_id, length) of all.

    The first h turns of conversation ``c - c % group`` (h = crc32(c) % ``modulus``) replace c's own first h.
    """
    turns = cut_lineage(placed_turns(conversations), "trie-places")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("long")
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = turns.where(F.col("place") < modulus)
    base_sizes = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("n_base"))
    convs = cut_lineage(
        sizes.select("conv_id", "n", h.alias("h"), base).join(base_sizes, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
        .withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "trie-convs")
    opening = (convs.select("conv_id", "base", "h")
               .join(heads.select(F.col("conv_id").alias("base"), "place", "sha", "words"), "base")
               .where("place <= h").select("conv_id", F.col("place").alias("depth"), "sha", "words"))
    own = (turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "sha", "words"))
    return opening.unionAll(own), convs.select("conv_id", "length")


def prefixes(turns: DataFrame, part: int = 1024) -> DataFrame:
    """Turns with the key (a, b) of the prefix that they end and of the one before it."""
    keyed = cut_lineage(turns.select(
        "conv_id", "depth", "words", F.floor(F.col("depth") / part).alias("part"),
        F.xxhash64("sha", "depth").alias("ha"), F.xxhash64(F.lit(part), "depth", "sha").alias("hb")), "trie-keys")
    ahead = W.partitionBy("conv_id").orderBy("part").rowsBetween(*BEFORE)
    parts = keyed.groupBy("conv_id", "part").agg(F.bit_xor("ha").alias("ha"), F.bit_xor("hb").alias("hb"))
    parts = parts.select("conv_id", "part", *[F.coalesce(F.bit_xor(c).over(ahead), F.lit(0)).alias(f"o{c}")
                                             for c in ("ha", "hb")])
    upto = W.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    run = keyed.withColumns({f"s{c}": F.bit_xor(c).over(upto) for c in ("ha", "hb")}).join(parts, ["conv_id", "part"])
    a, b = (F.col(f"s{c}").bitwiseXOR(F.col(f"o{c}")) for c in ("ha", "hb"))
    return run.select("conv_id", "depth", "words", a.alias("a"), b.alias("b"),
                      a.bitwiseXOR(F.col("ha")).alias("pa"), b.bitwiseXOR(F.col("hb")).alias("pb"))


def _string_kernel(chunk: int):
    """Sorted (a, b, depth, conv_id) -> per key and ``chunk`` ids one comma-joined string."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()),
                        ("ids", pa.string())])

    def run(batches):
        key, held = None, []

        for x in batches:
            out = []
            for a, b, d, c in zip(*(x.column(k).to_pylist() for k in ("a", "b", "depth", "conv_id"))):
                if held and (key != (a, b, d) or len(held) >= chunk):
                    out.append((*key, held[0], ",".join(map(str, held))))
                    held = []
                key = (a, b, d)
                held.append(c)
            if out:
                yield record_batch(schema, **dict(zip(schema.names, zip(*out))))
        if held:
            yield record_batch(schema, a=[key[0]], b=[key[1]], depth=[key[2]], first=[held[0]],
                               ids=[",".join(map(str, held))])

    return run


def _digest_kernel():
    """Sorted (a, b, depth, first, ids) -> one SHA-256 a key over its strings, comma-joined."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches):
        key, sha = None, None
        for x in batches:
            out = []
            for a, b, d, ids in zip(*(x.column(k).to_pylist() for k in ("a", "b", "depth", "ids"))):
                if key != (a, b, d):
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (a, b, d), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield record_batch(schema, **dict(zip(schema.names, zip(*out))))
        if key is not None:
            yield record_batch(schema, a=[key[0]], b=[key[1]], depth=[key[2]], ends_sha256=[sha.hexdigest()])

    return run


def end_digests(ends: DataFrame, chunk: int = 4096) -> DataFrame:
    """(a, b, depth, ends_sha256): the digest of the sorted ids of the conversations that end at a prefix."""
    strings = (ends.repartitionByRange("a", "b", "depth", "conv_id")
               .sortWithinPartitions("a", "b", "depth", "conv_id")
               .mapInArrow(_string_kernel(chunk), "a bigint, b bigint, depth bigint, first bigint, ids string"))
    return (cut_lineage(strings, "trie-ends").repartition("a", "b", "depth")
            .sortWithinPartitions("a", "b", "depth", "first")
            .mapInArrow(_digest_kernel(), "a bigint, b bigint, depth bigint, ends_sha256 string"))


def subtree_sums(nodes: DataFrame, *values: str) -> DataFrame:
    """(id, *values): each value summed over the node's whole subtree, by rake and compress.

    ``nodes``: (id, parent, *values), parent null for roots; ids of any type that can be compared.
    """
    def added(table):
        return table.groupBy("id").agg(*[F.sum(v).alias(f"add_{v}") for v in values])

    def plus(more):
        return [(F.col(v) + F.coalesce(F.col(f"{more}_{v}"), F.lit(0))).alias(v) for v in values]

    alive = cut_lineage(nodes.select("id", "parent", *values), "tree-nodes")
    raked, chains = [], []
    while alive.where("parent is not null").limit(1).count():
        kids = (alive.where("parent is not null").groupBy(F.col("parent").alias("id"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("only")))
        state = cut_lineage(alive.join(kids, "id", "left")
                            .withColumn("n", F.coalesce("n", F.lit(0))), "tree-state")
        unary = "n = 1 and parent is not null"
        chain = state.where(unary).select("id", F.col("only").alias("next"), "parent", *values)
        while True:                                     # pointer doubling down the chains
            below = chain.select(F.col("id").alias("next"), F.col("next").alias("beyond"),
                                 *[F.col(v).alias(f"add_{v}") for v in values])
            chain = cut_lineage(chain.join(below, "next", "left")
                                .select("id", F.coalesce("beyond", "next").alias("next"), "parent", *plus("add"),
                                        F.col("beyond").isNotNull().alias("moved")), "tree-chain")
            if not chain.where("moved").limit(1).count():
                break
            chain = chain.drop("moved")
        chains.append(chain)
        tops = cut_lineage(chain.join(chain.select(F.col("id").alias("parent")), "parent", "left_anti"), "tree-tops")
        short = (state.where(f"not ({unary})")
                 .join(tops.select(F.col("next").alias("id"), F.col("parent").alias("above")), "id", "left")
                 .withColumn("parent", F.coalesce("above", "parent")).drop("above", "only"))
        short = cut_lineage(short, "tree-short")
        leaves = short.where("n = 0 and parent is not null")
        raked.append(leaves.select("id", *values))
        given = added(leaves.select(F.col("parent").alias("id"), *values)
                      .unionAll(tops.select(F.col("parent").alias("id"), *values)))
        alive = cut_lineage(short.where("n > 0 or parent is null").join(given, "id", "left")
                            .select("id", "parent", *plus("add")), "tree-nodes")
    totals = alive.select("id", *values)
    for leaves, chain in zip(reversed(raked), reversed(chains)):
        totals = totals.unionAll(leaves)
        ends = totals.select(F.col("id").alias("next"), *[F.col(v).alias(f"add_{v}") for v in values])
        totals = cut_lineage(totals.unionAll(chain.join(ends, "next").select("id", *plus("add"))), "tree-totals")
    return totals


def prefix_trie(turns: DataFrame, lengths: DataFrame, part: int = 1024) -> DataFrame:
    """Every node of the trie of conversations with its members, children and subtree totals.

    ``turns``: (conv_id, depth from 1, sha, words); ``lengths``: (conv_id, length) of all conversations.
    """
    keyed = cut_lineage(prefixes(turns, part), "trie-prefixes")
    top = [F.lit(0).cast("long").alias(c) for c in ("a", "b", "depth")]
    root = lengths.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0") \
        .select(*top, "n_convs", "conv_id", F.lit(0).cast("long").alias("words"),
                *[F.lit(None).cast("long").alias(c) for c in ("pa", "pb")])
    grown = keyed.groupBy("a", "b", "depth").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    plain = cut_lineage(root.unionByName(grown), "trie-nodes")
    above = plain.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("parent_conv_id"))
    kids = plain.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"),
                                            (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    last = keyed.join(lengths, "conv_id").where("depth = length").select("a", "b", "depth", "conv_id")
    ends = end_digests(last.unionAll(lengths.where("length = 0").select(*top, "conv_id")))
    nodes = cut_lineage(
        plain.join(above, ["pa", "pb", "depth"], "left").join(kids, ["a", "b", "depth"], "left")
        .join(ends, ["a", "b", "depth"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "words",
                F.coalesce("n_children", F.lit(0)).alias("n_children"),
                F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256")), "trie-tree")
    sums = subtree_sums(nodes.select(
        F.struct("conv_id", "depth").alias("id"),
        F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"),
                                            (F.col("depth") - 1).alias("depth"))).alias("parent"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "n_leaves", "saved_tokens")
    sums = sums.select("id.conv_id", "id.depth", "n_leaves", "saved_tokens")
    return (nodes.join(sums, ["conv_id", "depth"])
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    "ends_sha256"))


ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
               lambda x, y: xor(x // 2, 3988292384 * (x % 2)))) AS t),
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
              sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
          FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
            xor(list_reduce(list_concat([4294967295::BIGINT],
                  list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
                lambda x, y: xor(x // 256, t[xor(x % 256, y) % 256 + 1])), 4294967295) % 4 AS h
          FROM (SELECT DISTINCT conv_id FROM turns), crc),
kept AS (SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
         UNION ALL
         SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
rebuilt AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM kept),
members AS (SELECT conv_id, depth, text,
              list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM rebuilt
            UNION ALL SELECT conv_id, 0, '', [] FROM convs),
sized AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends, min(conv_id) OVER (PARTITION BY prefix) AS node
          FROM members),
nodes AS (SELECT node AS conv_id, depth, count(*) AS n_convs,
            (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
            coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS end_ids
          FROM sized GROUP BY node, depth),
linked AS (SELECT n.*, s.node AS parent_conv_id FROM nodes n LEFT JOIN sized s ON s.conv_id = n.conv_id AND s.depth = n.depth - 1),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l LEFT JOIN kids k USING (conv_id, depth)),
sums AS (SELECT s.node AS conv_id, s.depth, sum((n.n_children = 0)::BIGINT) AS n_leaves, sum(n.saved) AS saved_tokens
         FROM full_nodes n JOIN sized s ON s.conv_id = n.conv_id AND s.depth <= n.depth GROUP BY s.node, s.depth)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(f.end_ids) AS ends_sha256
FROM full_nodes f JOIN sums s USING (conv_id, depth)
"""
