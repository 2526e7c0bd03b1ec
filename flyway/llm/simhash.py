"""SimHash near-duplicates: 64-bit fingerprints linked by BK-trees, grouped by reachability.

Fingerprints: A-Z lower-cased, words are runs of anything but ASCII white space,
every window of ``shingle`` words (the whole sequence when there are fewer) is
hashed with XXH64 (UTF-8, seed 42); a bit is one when set in over half the hashes.
A text without words has fingerprint zero and is linked like any other.

Links: equal fingerprints are collapsed first, so a group of copies is one node.
The 64 bits are cut into ``max_bits + 4`` blocks; two fingerprints within ``max_bits``
agree on at least four of them, so each fingerprint is sent once per choice of four
blocks to the shard of those blocks' value (15 shards for 2 bits).  A shard is a set of
BK-trees, one per value of the blocks: children hang under their parent by their
integer Hamming distance, and a probe at distance d follows only the edges d - r .. d + r.
A tree meets only probes of its own shard -- sending every tree to every probe would
cost the square of the corpus and pass every fingerprint through the driver -- and its
size has a proven bound: the bits outside four blocks (22) allow 2 ** 22 nodes at most.
A shard's links are contracted to one edge per node to its local root before they leave
the task, so no group is ever emitted as pairs.

Components: star contraction over those edges, then the smallest doc_id per component.

Defined results: a null text counts as empty; a null doc_id takes part and gets its
component's smallest non-null doc_id (null when there is none); repeated rows each
give a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import cut_lineage, record_batch
from .components import star_components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))   # A-Z to a-z


def shingle_hashes(text: bytes, shingle: int, part: int = 1 << 16):
    """uint64 hash arrays (at most ``part`` long) of the text's shingles, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return
    line = b" ".join(words)
    if len(words) <= shingle:
        yield np.array([xxh64_intdigest(line, 42)], np.uint64)
        return
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words))).tolist()
    spans = list(zip(starts, ends[shingle - 1:].tolist()))
    for i in range(0, len(spans), part):
        yield np.array([xxh64_intdigest(line[a:b], 42) for a, b in spans[i:i + part]], np.uint64)


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit SimHash."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, shingle):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint_kernel(shingle: int, key: list[str]):
    schema = pa.schema([("doc_id", pa.int64()), *((k, pa.binary()) for k in key), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            yield record_batch(schema, doc_id=b.column("doc_id"), **{k: b.column(k) for k in key},
                               fp=[fingerprint(t.as_py(), shingle) for t in texts])

    return run


def bk_trees(fp: np.ndarray, tree: np.ndarray):
    """BK-trees of several sets at once: (root row per tree, edge codes, edge children).

    The first row of a set is its root; the others part by their distance to it, the
    first of each part is the child at that distance, and so on: the tree that one
    insertion after the other would give.  An edge's code is parent * 65 + distance.
    """
    group = np.unique(tree, return_inverse=True)[1]
    _, first = np.unique(group, return_index=True)
    roots, codes, children = first, [], []
    rows, node = np.arange(len(fp)), first[group]
    while True:
        rest = rows != node
        rows, node = rows[rest], node[rest]
        if not len(rows):
            break
        code = node * 65 + np.bitwise_count(fp[rows] ^ fp[node])
        edge, first, group = np.unique(code, return_index=True, return_inverse=True)
        codes.append(edge)
        children.append(rows[first])
        node = rows[first][group]
    if not codes:
        return roots, np.empty(0, np.int64), np.empty(0, np.int64)
    codes, children = np.concatenate(codes), np.concatenate(children)
    order = np.argsort(codes)
    return roots, codes[order], children[order]


def probe(fp: np.ndarray, rows: np.ndarray, root: np.ndarray, codes, children, radius: int):
    """Pairs (row, other row) within the radius, following edges d - radius .. d + radius only."""
    q, node, left, right = rows, root, [], []
    while len(q):
        d = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
        near = (d <= radius) & (q != node)
        left.append(q[near])
        right.append(node[near])
        low = np.searchsorted(codes, node * 65 + np.maximum(d - radius, 0))
        high = np.searchsorted(codes, node * 65 + np.minimum(d + radius, 64), side="right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        q, node = np.repeat(q, n), children[at]
    return np.concatenate(left), np.concatenate(right)


def contract(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Flat parent array (smallest row of each group) after joining the pairs (a, b)."""
    while True:
        x, y = parent[a], parent[b]
        if (x == y).all():
            return parent
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def link_kernel(radius: int, chunk: int = 1 << 16):
    """mapInArrow function over rows sorted by (blocks, value): fp -> edges to a local root."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(fp, tree):
        _, group, size = np.unique(tree, return_inverse=True, return_counts=True)
        several = size[group] > 1
        fp, tree = fp[several], group[several]
        if not len(fp):
            return None
        roots, codes, children = bk_trees(fp, tree)
        root = roots[np.unique(tree, return_inverse=True)[1]]
        parent = np.arange(len(fp))
        for i in range(0, len(fp), chunk):
            rows = np.arange(i, min(i + chunk, len(fp)))
            parent = contract(parent, *probe(fp, rows, root[rows], codes, children, radius))
        hung = parent != np.arange(len(fp))
        return record_batch(schema, a=fp[hung].view(np.int64), b=fp[parent[hung]].view(np.int64))

    def run(batches):
        held = None                       # rows of the last, perhaps unfinished tree
        for b in batches:
            now = [b.column(c).to_numpy() for c in ("fp", "blocks", "value")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            fp, blocks, value = now
            if not len(fp):
                continue
            new = np.flatnonzero((blocks[1:] != blocks[:-1]) | (value[1:] != value[:-1])) + 1
            cut = int(new[-1]) if len(new) else 0
            held = [x[cut:] for x in now]
            tree = np.zeros(len(fp), np.int64)
            tree[new] = 1
            out = edges(fp[:cut].view(np.uint64), np.cumsum(tree)[:cut]) if cut else None
            if out is not None:
                yield out
        if held is not None:
            out = edges(held[0].view(np.uint64), np.zeros(len(held[0]), np.int64))
            if out is not None:
                yield out

    return run


def block_masks(max_bits: int) -> list[int]:
    """Signed 64-bit masks of every choice of four of ``max_bits + 4`` blocks."""
    blocks = max_bits + 4
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    ones = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(blocks)]
    masks = [sum(c) for c in combinations(ones, 4)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def simhash_near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                       key: str | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id, component_key) of every document.

    ``key`` names a binary column of ``docs`` that is returned with each row.

    component_key is the component's smallest fingerprint (as a signed bigint): it names
    groups none of whose documents has a doc_id.
    """
    keys = [key] if key else []
    prints = cut_lineage(
        docs.select("doc_id", *keys, F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .mapInArrow(fingerprint_kernel(shingle, keys),
                    ", ".join(["doc_id bigint", *(f"{k} binary" for k in keys), "fp bigint"])), "fingerprints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "simhash-nodes")
    routed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("blocks"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
        for i, m in enumerate(block_masks(max_bits))])).alias("s")).select("fp", "s.*")
    links = (routed.repartition("blocks", "value").sortWithinPartitions("blocks", "value", "fp")
             .mapInArrow(link_kernel(max_bits), "a bigint, b bigint"))
    root = star_components(links)
    member = cut_lineage(
        nodes.join(root, nodes.fp == root.node, "left")
        .select("fp", "least_doc", F.coalesce("root", "fp").alias("component_key")), "simhash-members")
    least = cut_lineage(member.groupBy("component_key").agg(F.min("least_doc").alias("component_id")),
                        "simhash-least")
    found = member.select("fp", "component_key").join(least, "component_key")
    return (prints.join(cut_lineage(found, "simhash-groups"), "fp")
            .select("doc_id", *keys, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "component_key"))
