"""Nearest-observer recommenders (J13, J14, W4, P10, P11, M3 cosine, M4 Jaccard).

For a test row with source set V and a training row with set R = from U to:
common = |V n R|, cosine = common / sqrt(|V| |R|), Jaccard = common / |V u R|.
Neighbours need common >= min_common and similarity > 0; the N most similar
(ties: training observer, then year) vote: score_j = sum sim * [j in R] / sum sim.

Scale design
------------
A join of the two sides on species would emit, for every species, all (test, train) pairs
holding it -- quadratic in the most popular species.  Instead equal sets of a fold are one class on
both sides: a training class keeps its first N members (by observer and year, no other can be a
neighbour), a test class is searched once and its result given to all its members.  Classes are
range-sorted by set size and packed into blocks of integer-coded sets, and blocks meet in two rounds:

* Bounds: a test block meets the training blocks nearest to it in set size.  Each row's N-th best
  similarity there bounds its neighbours from below, and with it their set sizes
  (cosine: between s^2 |V| and |V| / s^2; Jaccard: between s |V| and |V| / s).
* Search: test blocks of a fold that follow one another in set size form a stripe, one task.  Only the
  training blocks that some row of the stripe can reach are shuffled, once per stripe and not once per
  pair of blocks; they stream past the stripe's test blocks.  More than 2 * ``STRIPES`` stripes go in waves, each
  written and its shuffle freed before the next, so a training block lies on disk some 2 * ``STRIPES`` times at most.

Within a pair of blocks an inverted index (species -> training rows, by size, so a row's size bound
is a slice of each list) gives the candidates.  A row that needs ``c`` common species can skip all
but its |V| - c + 1 rarest species when it looks for candidates (prefix filter); the others are then
looked up for the candidates only.  Where that is dearer all lists are counted, or, where lists are long (small
vocabularies, dense sets), one bit a training row stands for each entry and a row's bits are added up 64 training
rows at a time, up to ``c``; a row without a bound takes its first from the sets with most common species.  ``c`` depends on the size of the training set, so a block is
left out where its smallest set asks for too many, and only pairs that hold the ``c`` of their sizes are scored.
What is sent is small: codes take one or two bytes where a block's vocabulary allows, a class gets its results as
one row of lists, and a ranking keeps its first K unseen species inside the kernel.  A popular species' list is cut into the blocks' rows.
All three are exact; the same kernel gives neighbours, votes or pair counts, at every size.
With ``bands`` (MinHash, see ``lsh``) only sets that agree in a band hash are candidates: where bits are counted, what
could enter is asked for its bands, else the lists are those of band hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import KEY, PRED_COLUMNS, test_rows, top_k

BLOCK_CELLS = 1 << 22      # rows x vocabulary of a block
BLOCK_BITS = 1 << 27       # vocabulary x training rows that are counted in bits: 16 MiB
BIT = 0.06                 # nanoseconds that a bit (a test row's species, a training row) costs, in words of 64
STRIPES = 32               # tasks aimed at, as far as blocks allow; each is sent the training blocks that it can reach
STRIPE_BLOCKS = 16         # test blocks that one task holds at most
BLOCK = ("fold int, block bigint, names array<string>, sizes binary, codes binary, ids binary, "
         "years binary, held binary, weights binary, bands binary")
OUTPUTS = {
    "neighbors": [("fold", pa.int32()), ("observer_id", pa.int64()), ("nb_observer_id", pa.int64()),
                  ("nb_year_from", pa.int32()), ("common", pa.int64()), ("sim", pa.float64()),
                  ("nb_rank", pa.int32())],
    "votes": [("fold", pa.int32()), ("observer_id", pa.int64()), ("species", pa.string()),
              ("score", pa.float64())],
    "ranked": [("fold", pa.int32()), ("observer_id", pa.int64()), ("species", pa.string()),
               ("score", pa.float64()), ("rank", pa.int32())],
    "counts": [("fold", pa.int32()), ("observer_id", pa.int64()), ("n_candidates", pa.int64())],
    "bounds": [("block", pa.int64()), ("least", pa.binary()), ("need_low", pa.float64()), ("need_high", pa.float64())],
    "effort": [("fold", pa.int32()), ("block", pa.int64()), ("blocks_met", pa.int64()), ("rows_met", pa.int64()),
               ("candidates", pa.int64())],
}
# Columns of a training block that a round reads; the others are not shuffled.
SHIPPED = {"bounds": ["held"], "counts": ["weights"]}
_DDL = {pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double", pa.string(): "string",
        pa.binary(): "binary"}


def _width(n: int):
    """The narrowest type of codes below ``n``."""
    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.int32


def _codes(r: dict, prefix: str = "") -> np.ndarray:
    """The codes of a block, whatever their width: as many as its sizes say."""
    n, b = int(np.frombuffer(r[f"{prefix}sizes"], np.int32).sum()), r[f"{prefix}codes"]
    return np.frombuffer(b, {1: np.uint8, 2: np.uint16, 4: np.int32}[len(b) // n])


def _pack(max_rows: int, max_cells: int):
    """mapInArrow: classes (fold, species, members, weight, bands) sorted by fold -> blocks of coded sets."""
    schema = pa.schema([("fold", pa.int32()), ("block", pa.int64()), ("names", pa.list_(pa.string()))]
                       + [(c, pa.binary()) for c in ("sizes", "codes", "ids", "years", "held", "weights", "bands")])
    types = (np.int32, np.int32, np.int64, np.int32, np.int32, np.int64, np.int64)

    def run(batches):
        block, fold, names, cols = TaskContext.get().partitionId() << 32, None, {}, [[] for _ in types]

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([c], f.type) for c, f in zip(
                    [fold, block, list(names), *(np.array(c, _width(len(names)) if i == 1 else t).tobytes()
                                                 for i, (c, t) in enumerate(zip(cols, types)))], schema)],
                schema=schema)

        for b in batches:
            for f, species, members, weight, bands in zip(*(b.column(c).to_pylist() for c in
                                                            ("fold", "species", "members", "weight", "bands"))):
                new = sum(s not in names for s in species)
                if cols[0] and (f != fold or len(cols[0]) >= max_rows
                                or (len(cols[0]) + 1) * (len(names) + new) > max_cells):
                    yield out()
                    block, names, cols = block + 1, {}, [[] for _ in types]
                fold = f
                cols[0].append(len(species))
                cols[1] += [names.setdefault(s, len(names)) for s in species]
                cols[2] += [m["observer_id"] for m in members]
                cols[3] += [m["year"] for m in members]
                cols[4].append(len(members))
                cols[5].append(weight)
                cols[6] += bands
        if cols[0]:
            yield out()

    return run


class _Search:
    """A test block and the running top N of each of its rows."""

    def __init__(self, r: dict, metric: str, n_neighbors: int, min_common: int, output: str, k: int = 0):
        self.fold, self.block, self.names, self.output, self.k = r["fold"], r["block"], r["names"], output, k
        self.metric, self.n, self.min_common = metric, n_neighbors, max(min_common, 1)
        self.ids = np.frombuffer(r["ids"], np.int64)
        # A class of one row has that row's observer as its weight, marked by a 1 as its year (see ``test_classes``).
        self.only = np.frombuffer(r["weights"], np.int64) if r.get("weights") else np.zeros(len(self.ids), np.int64)
        self.alone = np.frombuffer(r["years"], np.int32) == 1 if r.get("years") else np.zeros(len(self.ids), bool)
        self.size = np.frombuffer(r["sizes"], np.int32).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.codes = _codes(r).astype(np.int64)
        self.rows = np.repeat(np.arange(len(self.ids)), self.size)
        self.place = {s: i for i, s in enumerate(self.names)}
        # N-th best rounded similarity so far, or what the bounds round has found
        self.least = np.frombuffer(r["least"], np.float64).copy() if r.get("least") else np.full(len(self.ids), -1.0)
        self.bands = np.frombuffer(r["bands"], np.int64).reshape(len(self.ids), -1) if r.get("bands") else None
        self.kept = [np.empty(0, t) for t in (np.int64, np.float64, np.int64, np.int64, np.float64, np.int64)]
        self.new, self.n_new, self.vocab, self.counts = [], 0, {}, np.zeros(len(self.ids), np.int64)
        self.sets, self.set_size, self.n_sets = [np.empty(0, np.int32)], [np.empty(0, np.int64)], 0    # neighbours' sets, end to end
        self.blocks_met = self.rows_met = self.candidates = 0

    def reach(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: least and largest set size of a neighbour that can still enter, and least common species."""
        s = np.maximum(self.least - 1e-8, 0.0)
        s = np.minimum(s * s if self.metric == "cosine" else s, 1.0)
        with np.errstate(divide="ignore"):
            high = np.where(s > 0, self.size / np.maximum(s, 1e-300), np.inf)
        low = s * self.size
        return low - 1e-6, high + 1e-6, np.maximum(np.ceil(low - 1e-6), self.min_common).astype(np.int64)

    def _least_common(self, q: np.ndarray, size: np.ndarray, least: np.ndarray | None = None) -> np.ndarray:
        """Common species that a training set of ``size`` needs to enter at row ``q`` (not rounded up)."""
        s, n = np.clip((self.least[q] if least is None else least) - 1e-8, 0.0, 1.0), self.size[q]
        if self.output == "counts":
            return np.full(np.broadcast(q, size).shape, self.min_common, np.float64)
        least = s * np.sqrt(n * size.astype(np.float64)) if self.metric == "cosine" else s / (1.0 + s) * (n + size)
        return np.maximum(least - 1e-6, self.min_common)

    def meet(self, r: dict, cells: int = 1 << 22) -> None:
        size = np.frombuffer(r["t_sizes"], np.int32).astype(np.int64)         # ascending
        low, high, need = self.reach()
        if self.output in ("counts",):
            low, high, need = np.zeros(len(low)), np.full(len(low), np.inf), np.full(len(low), self.min_common)
        part = np.flatnonzero((low <= size[-1]) & (high >= size[0]) & (need <= self.size))
        if not len(part):
            return
        begin = np.searchsorted(size, np.ceil(np.maximum(low, 0)), side="left")     # a row's slice of every list
        end = np.where(np.isinf(high), len(size), np.searchsorted(size, np.floor(np.minimum(high, size[-1])), side="right"))
        part = part[begin[part] < end[part]]
        need[part] = np.maximum(need[part], np.ceil(self._least_common(part, size[begin[part]])))
        part = part[need[part] <= np.minimum(self.size[part], size[end[part] - 1])]
        if not len(part):
            return
        self.blocks_met += 1
        if "own" not in r:                                                    # shared by the test blocks of the stripe
            r["own"] = {"place": {s: i for i, s in enumerate(r["t_names"])}, "codes": _codes(r, "t_")}
            r["own"]["per"] = np.append(np.bincount(r["own"]["codes"], minlength=len(r["t_names"])), 0)
        codes, place = r["own"]["codes"], r["own"]["place"]
        held = np.frombuffer(r["t_held"], np.int32).astype(np.int64) if r.get("t_held") else np.ones(len(size), np.int64)
        some = int(held.sum()) if r.get("t_ids") is None else 0               # bounds alone ask for nobody's name
        block = {"size": size, "codes": codes, "first": np.cumsum(size) - size, "own": r["own"], "names": r["t_names"],
                 "ids": np.frombuffer(r["t_ids"], np.int64) if not some else np.zeros(some, np.int64),
                 "years": np.frombuffer(r["t_years"], np.int32).astype(np.int64) if not some else np.zeros(some, np.int64),
                 "held": held, "member": np.cumsum(held) - held,
                 "weight": np.frombuffer(r["t_weights"], np.int64) if r.get("t_weights") else held,
                 "vocab": np.array([self.vocab.setdefault(s, len(self.vocab)) for s in r["t_names"]], np.int64)
                 if self.output in ("votes", "ranked") else None}
        block["sizes"], block["size_at"] = np.unique(size, return_inverse=True)
        # The test rows' species in the training block's codes; the last code is that of species it lacks.
        block["tokens"] = np.array([place.get(s, len(place)) for s in self.names], np.int64)[self.codes]
        if self.bands is not None:
            block["hashes"] = np.frombuffer(r["t_bands"], np.int64).reshape(len(size), -1)
        n, nt = self.size[part], len(size)
        held = r["own"]["per"][block["tokens"][_ranges(self.first[part], n)]]
        few = int((np.minimum.reduceat(held, np.cumsum(n) - n) * (n - need[part] + 1)).sum())
        reach = 0.5 * (end[part] - begin[part]).mean() / nt
        if len(place) * nt <= BLOCK_BITS and BIT * len(held) * nt < reach * min(80 * few, 40 * int(held.sum()) + 10 * len(part) * nt):
            self._meet_rows(part, block, begin, end, need, sliced=True)       # lists would cost more, whatever their slices
        else:
            known = np.array([self.place.get(s, -1) for s in r["t_names"]], np.int64)
            at = known[codes]
            rows = np.repeat(np.arange(nt), size)[at >= 0]
            block["lists"] = np.sort(at[at >= 0] * nt + rows)                 # species, then row (by size)
            step = max(1, cells // nt // (1 if self.bands is None else 8))
            for lo in range(0, len(part), step):
                self._meet_rows(part[lo:lo + step], block, begin, end, need)
        # A few new pairs wait for more, except where a row still lacks a bound.
        if self.n_new >= max(1 << 13, len(self.kept[0]) // 8) or (self.least < 0).any():
            self._enter_new()

    def _enter_new(self) -> None:
        if self.new:
            self._enter(*map(np.concatenate, zip(*self.new)))
            self.new, self.n_new = [], 0

    def _agreeing(self, q: np.ndarray, block: dict) -> np.ndarray:
        """Pairs (place in q * training rows + training row) that agree in a band, each once."""
        nt, seen = len(block["size"]), []
        if "band_rows" not in block:
            order = np.argsort(block["hashes"], axis=0, kind="stable")        # per band: hash, then row (by size)
            block["band_rows"], block["band_hashes"] = order, np.take_along_axis(block["hashes"], order, 0)
        for k in range(self.bands.shape[1]):
            h = self.bands[q, k]
            a, b = (np.searchsorted(block["band_hashes"][:, k], h, side=s) for s in ("left", "right"))
            seen.append(np.arange(len(q)).repeat(b - a) * nt + block["band_rows"][_ranges(a, b - a), k])
            if sum(map(len, seen)) > 1 << 22:
                seen = [np.unique(np.concatenate(seen))]
        return np.unique(np.concatenate(seen))

    def _count(self, pair: np.ndarray, tokens: np.ndarray, block: dict) -> np.ndarray:
        """Common species of each pair; tokens: the test rows' species, padded with -1."""
        nt, lists, count = len(block["size"]), block["lists"], np.zeros(len(pair), np.int64)
        if not len(lists):
            return count
        for k in range(tokens.shape[1]):
            t = tokens[pair // nt, k]
            place = np.searchsorted(lists, t * nt + pair % nt)
            count += (t >= 0) & (place < len(lists)) & (lists[np.minimum(place, len(lists) - 1)] == t * nt + pair % nt)
        return count

    def _meet_rows(self, q: np.ndarray, block: dict, begin, end, need, sliced: bool = False) -> None:
        nt = len(block["size"])
        self.rows_met += int((end[q] - begin[q]).sum())
        if not sliced:
            n = self.size[q]
            own = np.repeat(np.arange(len(q)), n)                             # (row, species) of this part
            token = self.codes[_ranges(self.first[q], n)]
            a = np.searchsorted(block["lists"], token * nt + begin[q][own])
            b = np.searchsorted(block["lists"], token * nt + end[q][own])
            held = b - a
            order = np.lexsort((held, own))                                   # each row's rarest species first
            a, held, token = a[order], held[order], token[order]
            rank = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            prefix = rank < (n - need[q] + 1)[own]
            rest = n - np.minimum(n, n - need[q] + 1)
            few, every = int(held[prefix].sum()), int(held.sum())
            by_list = np.add.reduceat(np.where(prefix, held, 0), np.cumsum(n) - n) if len(own) else np.zeros(0)
            lookups = int((by_list * rest).sum())
            # Nanoseconds: 40 an entry and 10 a pair, twice that for lookups, against BIT a pair and species.
            sliced = len(block["names"]) * nt <= BLOCK_BITS and BIT * len(own) * nt < min(
                80 * (few + 6 * lookups), 40 * every + 10 * len(q) * nt)
        if sliced and self.output == "counts":
            self._tally(q, block, need)
            return
        least = self.least[q]
        if sliced and (least < 0).any():
            least = np.maximum(least, self._first_floor(q, block, need, least < 0))
            need = need.copy()
            need[q] = np.maximum(need[q], np.ceil(self._least_common(q, block["size"][begin[q]], least)))
        asked = self._least_common(q[:, None], block["sizes"][None, :], least[:, None])     # (row, size of training sets)
        if sliced:
            pair = self._sliced(q, block, need)
            common = self._common(q, pair, block)
        elif self.bands is not None:
            pair = self._agreeing(q, block)
            pair = pair[(pair % nt >= begin[q][pair // nt]) & (pair % nt < end[q][pair // nt])]
            common = self._count(pair, self._padded(own, rank, token, len(q)), block)
            pair, common = pair[common > 0], common[common > 0]
        elif (few + 6 * lookups) * 2 < every:
            pair = np.unique(own[prefix].repeat(held[prefix]) * nt + block["lists"][_ranges(a[prefix], held[prefix])] % nt)
            common = self._count(pair, self._padded(own, rank, token, len(q)), block)
        else:
            common = np.bincount(own.repeat(held) * nt + block["lists"][_ranges(a, held)] % nt, minlength=1)
            pair = np.flatnonzero(common)
            common = common[pair]
        self.candidates += len(pair)
        enough = common >= asked[pair // nt, block["size_at"][pair % nt]]
        pair, common = pair[enough], common[enough].astype(np.float64)
        at, t = pair // nt, pair % nt
        if self.output == "counts":
            np.add.at(self.counts, q[at], block["weight"][t])
            return
        na, nb = self.size[q[at]].astype(np.float64), block["size"][t].astype(np.float64)
        sim = common / np.sqrt(na * nb) if self.metric == "cosine" else common / (na + nb - common)
        score = np.round(sim, 9)
        good = np.flatnonzero((score > 0) & (score >= least[at]))
        if sliced and self.bands is not None:
            good = good[self._agree(q[at[good]], t[good], block)]
        floor = self._floor(at[good], block["held"][t[good]], score[good], len(q))
        good = good[score[good] >= floor[at[good]]]
        if not len(good):
            return
        at, t, sim, score, common = at[good], t[good], sim[good], score[good], common[good]
        if block["vocab"] is not None:
            some, mark = np.unique(t, return_inverse=True)
            mark = mark + self.n_sets
            self.sets.append(block["vocab"][block["codes"][_ranges(block["first"][some], block["size"][some])]].astype(np.int32))
            self.set_size.append(block["size"][some])
            self.n_sets += len(some)
        held = block["held"][t]
        member = _ranges(block["member"][t], held)
        extra = common.astype(np.int64) if block["vocab"] is None else mark
        self.n_new += len(member)
        self.new.append((q[at].repeat(held), score.repeat(held), block["ids"][member], block["years"][member],
                         sim.repeat(held), extra.repeat(held)))

    @staticmethod
    def _padded(own: np.ndarray, rank: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
        tokens = np.full((n, int(rank.max()) + 1 if len(rank) else 0), -1, np.int64)
        tokens[own, rank] = token
        return tokens

    @staticmethod
    def _bits(block: dict) -> np.ndarray:
        """Per species of the training block one bit a row, in words of 64 rows; the last species has none."""
        own = block["own"]
        if "bits" not in own:
            nt, v = len(block["size"]), len(block["names"])
            words, rows = -(-nt // 64), np.repeat(np.arange(nt), block["size"])
            own["bits"], step = np.zeros((v + 1, words), np.uint64), max(1, (1 << 23) // (words * 64))
            for lo in range(0, v, step):
                some = np.zeros((min(step, v - lo), words * 64), bool)
                mine = (own["codes"] >= lo) & (own["codes"] < lo + step)
                some[own["codes"][mine] - lo, rows[mine]] = True
                own["bits"][lo:lo + step][:len(some)] = np.packbits(some, axis=1, bitorder="little").view(np.uint64)
        return own["bits"]

    def _parts(self, q: np.ndarray, deep: np.ndarray, block: dict):
        """(places in q, their species) by set size and by ``deep``, in parts whose planes stay in a cache."""
        n = self.size[q]
        order = np.lexsort((deep, n))
        cuts = np.flatnonzero(np.diff(n[order]) | np.diff(deep[order])) + 1
        for group in np.split(order, cuts):
            step = max(1, (1 << 15) // self._bits(block).shape[1])
            for lo in range(0, len(group), step):
                some = group[lo:lo + step]
                yield some, block["tokens"][self.first[q[some]][:, None] + np.arange(n[some[0]])]

    def _reached(self, q: np.ndarray, block: dict, need: np.ndarray):
        """(places in q, one bit per training row that holds ``need`` of the row's species).

        The bits of a row's species are added up in planes, 64 training rows at a time.  They start so that
        the ``need``-th one carries out of the highest plane.
        """
        bits = self._bits(block)
        deep = np.ceil(np.log2(np.maximum(need[q], 1))).astype(np.int64)
        for some, tokens in self._parts(q, deep, block):
            d = int(deep[some[0]])
            begin = (1 << d) - need[q[some]]
            planes = [np.repeat(np.where(begin >> p & 1, ~np.uint64(0), np.uint64(0))[:, None], bits.shape[1], 1) for p in range(d)]
            over, carry = np.zeros((len(some), bits.shape[1]), np.uint64), np.empty((len(some), bits.shape[1]), np.uint64)
            for j in range(tokens.shape[1]):
                x = bits[tokens[:, j]]
                for p in planes:
                    np.bitwise_and(p, x, out=carry)
                    np.bitwise_xor(p, x, out=p)
                    x, carry = carry, x
                over |= x
            yield some, over

    @staticmethod
    def _places_of(some: np.ndarray, over: np.ndarray, nt: int) -> np.ndarray:
        """Pairs (place in q * training rows + training row) of the bits that are set."""
        words = over.shape[1]
        at = np.flatnonzero(over)
        word, found = over.ravel()[at], [np.empty(0, np.int64)]
        while len(at):                                   # the lowest bit of every word, most have but one
            low = word & (~word + np.uint64(1))
            found.append(some[at // words] * nt + at % words * 64 + np.bitwise_count(low - np.uint64(1)))
            word ^= low
            left = np.flatnonzero(word)
            at, word = at[left], word[left]
        return np.concatenate(found)

    def _sliced(self, q: np.ndarray, block: dict, need: np.ndarray) -> np.ndarray:
        nt = len(block["size"])
        return np.concatenate([self._places_of(some, over, nt) for some, over in self._reached(q, block, need)])

    def _tally(self, q: np.ndarray, block: dict, need: np.ndarray) -> None:
        """Adds the weights of all training sets that hold ``need`` common species, bit by bit of the weights."""
        weight, words = block["weight"], self._bits(block).shape[1]
        masks = []
        for b in range(int(weight.max()).bit_length()):
            some = np.zeros(words * 64, bool)
            some[:len(weight)] = weight >> b & 1
            masks.append(np.packbits(some, bitorder="little").view(np.uint64))
        for some, over in self._reached(q, block, need):
            for b, mask in enumerate(masks):
                self.counts[q[some]] += np.bitwise_count(over & mask).sum(1, dtype=np.int64) << b

    def _common(self, q: np.ndarray, pair: np.ndarray, block: dict) -> np.ndarray:
        """Common species of each pair, from one bit a species."""
        nt, words = len(block["size"]), -(-(len(block["names"]) + 1) // 64)

        def packed(n, rows, codes):
            out, step = np.empty((words, n), np.uint64), max(1, (1 << 23) // (words * 64))
            for lo in range(0, n, step):
                i, j = np.searchsorted(rows, [lo, lo + step])
                some = np.zeros((min(step, n - lo), words * 64), bool)
                some[rows[i:j] - lo, codes[i:j]] = True
                out[:, lo:lo + step] = np.packbits(some, axis=1, bitorder="little").view(np.uint64).T
            return out

        if "sets" not in block["own"]:
            block["own"]["sets"] = packed(nt, np.repeat(np.arange(nt), block["size"]), block["codes"])
        if "asked" not in block:                         # the code of species that the block lacks is in no set of it
            block["asked"] = packed(len(self.ids), self.rows, block["tokens"])
        common = np.zeros(len(pair), np.int64)
        mine, theirs = q[pair // nt], pair % nt
        for w in range(words):
            common += np.bitwise_count(block["asked"][w][mine] & block["own"]["sets"][w][theirs])
        return common

    def _first_floor(self, q: np.ndarray, block: dict, need: np.ndarray, unknown: np.ndarray) -> np.ndarray:
        """A similarity that N members of this block reach, for rows that have no bound yet; -1 where none is found.

        Of each row only the training sets with most common species are scored, the least number of those
        levels that holds twice N sets.
        """
        nt, bits, places, want = len(block["size"]), self._bits(block), np.flatnonzero(unknown), 2 * self.n
        pairs = [np.empty(0, np.int64)]
        for some, tokens in self._parts(q[places], np.zeros(len(places), np.int64), block):
            some = places[some]
            planes = [np.zeros((len(some), bits.shape[1]), np.uint64) for _ in range(tokens.shape[1].bit_length())]
            for j in range(tokens.shape[1]):
                x = bits[tokens[:, j]]
                for p in planes:
                    carry = p & x
                    p ^= x
                    x = carry
            left = np.arange(len(some))
            for c in range(tokens.shape[1], 0, -1):
                above, same = np.zeros((len(left), bits.shape[1]), np.uint64), np.full((len(left), bits.shape[1]), ~np.uint64(0))
                for b in range(len(planes) - 1, -1, -1):
                    p = planes[b][left]
                    if c >> b & 1:
                        same &= p
                    else:
                        above |= same & p
                        same &= ~p
                above |= same
                found = np.bitwise_count(above).sum(1, dtype=np.int64) >= want
                if found.any():
                    pairs.append(self._places_of(some[left[found]], above[found], nt))
                    left = left[~found]
                    if not len(left):
                        break
        pair = np.concatenate(pairs)
        common = self._common(q, pair, block)
        pair, common = pair[common >= self.min_common], common[common >= self.min_common].astype(np.float64)
        at, t = pair // nt, pair % nt
        if self.bands is not None:
            ok = self._agree(q[at], t, block)
            at, t, common = at[ok], t[ok], common[ok]
        na, nb = self.size[q[at]].astype(np.float64), block["size"][t].astype(np.float64)
        sim = common / np.sqrt(na * nb) if self.metric == "cosine" else common / (na + nb - common)
        return self._floor(at, block["held"][t], np.round(sim, 9), len(q))

    def _floor(self, at: np.ndarray, held: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
        """Per row the score of its N-th best member, -1 where there are fewer."""
        order = np.lexsort((-score, at))                                      # a row's best first
        at, held, score = at[order], held[order], score[order]
        before = np.cumsum(held) - held                                       # members of the row's better classes
        before -= before[np.searchsorted(at, at)] if len(at) else 0
        last = (before < self.n) & (before + held >= self.n)
        floor = np.full(n, -1.0)
        floor[at[last]] = score[last]
        return floor

    def _agree(self, q: np.ndarray, t: np.ndarray, block: dict) -> np.ndarray:
        """Which pairs agree in a band."""
        left = np.arange(len(q))
        agree = np.zeros(len(q), bool)
        for k in range(self.bands.shape[1]):
            same = self.bands[q[left], k] == block["hashes"][t[left], k]
            agree[left[same]] = True
            left = left[~same]
            if not len(left):
                break
        return agree

    def _enter(self, *new) -> None:
        """new: row, rounded similarity, observer, year, similarity, common (or place of its set)."""
        touched = np.zeros(len(self.ids), bool)
        touched[new[0]] = True
        again = touched[self.kept[0]]
        merged = [np.concatenate([x[again], y]) for x, y in zip(self.kept, new)]
        order = np.lexsort((merged[3], merged[2], -merged[1], merged[0]))
        q = merged[0][order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        full = rank == self.n - 1
        self.least[q[full]] = merged[1][order[full]]
        kept = [np.concatenate([x[~again], y[order[rank < self.n]]]) for x, y in zip(self.kept, merged)]
        order = np.argsort(kept[0], kind="stable")
        self.kept = [x[order] for x in kept]
        if self.n_sets > 2 * len(order):                 # forget the sets of rows that fell out
            used, self.kept[5] = np.unique(self.kept[5], return_inverse=True)
            flat, first, size = self._set_pool()
            self.sets, self.set_size = [flat[_ranges(first[used], size[used])]], [size[used]]
            self.n_sets = len(used)

    def _set_pool(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sets of kept neighbours end to end, where each begins and its size."""
        size = np.concatenate(self.set_size)
        return np.concatenate(self.sets), np.cumsum(size) - size, size

    def result(self) -> pa.RecordBatch | None:
        schema = pa.schema(OUTPUTS[self.output])
        self._enter_new()
        q, _, nb, year, sim, extra = self.kept
        if self.output == "bounds":
            low, high, _ = self.reach()
            cols = [[self.block], [self.least.tobytes()], [low.min()], [high.max()]]
        elif self.output == "effort":
            cols = [[self.fold], [self.block], [self.blocks_met], [self.rows_met], [self.candidates]]
        elif self.output == "counts":
            some = np.flatnonzero(self.counts)
            cols = [np.full(len(some), self.fold), self.ids[some], self.counts[some]]
        elif self.output == "neighbors":
            rank = np.arange(len(q)) - np.searchsorted(q, q) + 1
            cols = [np.full(len(q), self.fold), self.ids[q], nb, year, extra, sim, rank]
        else:
            width, names = max(len(self.vocab), 1), np.array(list(self.vocab), object)
            parts = [[], [], [], []]
            by_name = np.argsort(np.argsort([s or "" for s in names])) if self.output == "ranked" else None
            own = np.array([self.vocab.get(s, -1) for s in self.names], np.int64)[self.codes]
            step = max(1, BLOCK_CELLS // width)
            flat, first, set_size = self._set_pool()
            for lo in range(0, len(self.ids), step):     # a dense vote matrix of bounded size
                i, j = np.searchsorted(q, [lo, lo + step])
                if i == j:
                    continue
                size = set_size[extra[i:j]]
                code = flat[_ranges(first[extra[i:j]], size)]
                row = np.repeat(q[i:j] - lo, size)
                votes = np.bincount(row * width + code, np.repeat(sim[i:j], size), step * width)
                total = np.bincount(q[i:j] - lo, sim[i:j], step)
                votes = votes.reshape(step, width)
                if by_name is not None:
                    seen = np.flatnonzero((own >= 0) & (self.rows >= lo) & (self.rows < lo + step))
                    votes[self.rows[seen] - lo, own[seen]] = 0.0
                    votes[:, [i for i, s in enumerate(names) if s is None]] = 0.0
                r, s = np.nonzero(votes)
                score = votes[r, s] / total[r]
                if by_name is not None:                  # a row's best K; one that has seen all gets a mark, rank 0
                    order = np.lexsort((by_name[s], -np.round(score, 9), r))
                    rank = np.arange(len(r)) - np.searchsorted(r, r) + 1
                    order, rank = order[rank <= self.k], rank[rank <= self.k]
                    none = np.setdiff1d(q[i:j] - lo, r)
                    r, s, score = r[order], s[order], score[order]
                    parts[0].append(self.ids[lo + none])
                    parts[1].append(np.full(len(none), None, object))
                    parts[2].append(np.zeros(len(none)))
                    parts[3] += [np.zeros(len(none), np.int64), rank]
                parts[0].append(self.ids[lo + r])
                parts[1].append(names[s])
                parts[2].append(score)
            cols = [np.concatenate(p) if p else [] for p in parts[:3 + (by_name is not None)]]
            cols.insert(0, np.full(len(cols[0]), self.fold))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[k] .. start[k] + n[k] - 1 of every k, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(start - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def _listed(found: pa.RecordBatch, search: _Search) -> pa.RecordBatch:
    """One row per (fold, class), whose rows lie together: the one observer or null, and a list of every other column."""
    ids = found.column("observer_id").to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.empty(0, np.int64)
    ends = pa.array(np.append(first, len(ids)), pa.int32())
    keys = [found.column(c).take(pa.array(first)) for c in ("fold", "observer_id")]
    order = np.argsort(search.ids)
    row = order[np.searchsorted(search.ids, ids[first], sorter=order)]
    keys.append(pa.array(search.only[row], mask=~search.alone[row]))
    return pa.RecordBatch.from_arrays(keys + [pa.ListArray.from_arrays(ends, c) for c in found.columns[2:]],
                                      names=[*found.schema.names[:2], "only", *found.schema.names[2:]])


def _search_kernel(metric: str, n_neighbors: int, min_common: int, output: str, k: int, lists: bool):
    """Rows by stripe: its test blocks (kind 0), then the training blocks that they meet, nearest first."""
    def out(search):
        return _listed(search.result(), search) if lists else search.result()

    def run(batches):
        now, searches = None, []
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if r["stripe"] != now:
                    yield from map(out, searches)
                    now, searches = r["stripe"], []
                if r["kind"] == 0:
                    searches.append(_Search(r, metric, n_neighbors, min_common, output, k))
                else:
                    met = {f"t_{c}": v for c, v in r.items()}
                    for s in searches:
                        s.meet(met)
        yield from map(out, searches)
    return run


def test_classes(test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sets (fold, class, species[, bands]) of the test rows, written once, and (fold, class, observer_id).

    ``only``: the observer of a class of one row, null elsewhere.
    """
    sets = test.select(F.col("fold").cast("int").alias("fold"), "observer_id", F.array_sort("species_from").alias("species"))
    classes = cut_lineage(sets.groupBy("fold", "species").agg(F.count(F.lit(1)).alias("weight"), F.min("observer_id").alias("least"))
                          .select("fold", "species", "weight", F.monotonically_increasing_id().alias("class"),
                                  F.when(F.col("weight") == 1, F.col("least")).alias("only")), "nb-classes")
    return classes, sets.join(classes.drop("weight"), ["fold", "species"]).select("fold", "class", "observer_id", "only")


def train_classes(train: DataFrame, n_members: int) -> DataFrame:
    """Distinct sets of the training rows: (fold, species, members, weight); the first ``n_members`` by observer and year."""
    rows = train.select(F.col("fold").cast("int").alias("fold"), "observer_id", F.col("year_from").cast("int").alias("year"),
                        F.array_sort("species").alias("species")).where(F.size("species") > 0)
    if not n_members:
        return (rows.groupBy("fold", "species").agg(F.count(F.lit(1)).alias("weight"))
                .withColumn("members", F.expr("CAST(array() AS array<struct<observer_id: bigint, year: int>>)")))
    # Rows are sorted by a hash of the set first: sets are compared where it is equal only.
    first = Window.partitionBy("hash", "fold", "species").orderBy("observer_id", "year")
    return (rows.withColumn("hash", F.xxhash64("fold", "species"))
            .withColumn("place", F.row_number().over(first)).where(F.col("place") <= n_members)
            .groupBy("hash", "fold", "species").agg(F.sort_array(F.collect_list(F.struct("observer_id", "year"))).alias("members"))
            .withColumn("weight", F.size("members").cast("bigint")).drop("hash"))


def neighbor_search(test: DataFrame, train: DataFrame, metric: str = "cosine", n_neighbors: int = 50,
                    min_common: int = 1, output: str = "neighbors", test_block_rows: int = 2048,
                    train_block_rows: int = 8192, near_blocks: int = 2, bands=None) -> DataFrame:
    """Neighbours (J13 + W4 + P10 + P11), their votes (J14) or candidate counts per test row.

    ``test``: (fold, observer_id, species_from); ``train``: (fold, observer_id, year_from,
    species).  ``output``: "neighbors", "votes", "counts" or "effort" (blocks, rows within the size bounds
    and candidates that the search met per test block).  Test rows without a species have no
    neighbour.  ``near_blocks`` training blocks give a test block its bounds.  ``bands``: an expression
    array<bigint> over the column ``species``; only sets that agree in one place of it are compared.
    """
    classes, members = test_classes(test.where(F.size("species_from") > 0))
    lists = output in ("neighbors", "votes")
    found = search_classes(classes, train, metric, n_neighbors, min_common, output, test_block_rows, train_block_rows,
                           near_blocks, bands, lists=lists)
    if output == "effort":
        return found
    columns = [c for c, _ in OUTPUTS[output]]
    if not lists:
        return found.withColumnRenamed("observer_id", "class").join(members, ["fold", "class"]).select(*columns)
    # Only the lists of classes of several rows are shuffled to their members.
    found = cut_lineage(found, "nb-found")
    alone = found.where("only IS NOT NULL").withColumn("observer_id", F.col("only")).select(*columns)
    several = found.where("only IS NULL").drop("only").withColumnRenamed("observer_id", "class")
    several = several.join(members.where("only IS NULL"), ["fold", "class"]).select(*columns)
    return alone.unionByName(several).select(*columns[:2], F.inline(F.arrays_zip(*columns[2:])))


def search_classes(classes: DataFrame, train: DataFrame, metric: str, n_neighbors: int, min_common: int, output: str,
                   test_block_rows: int, train_block_rows: int, near_blocks: int = 2, bands=None, k: int = 0,
                   lists: bool = False) -> DataFrame:
    """``neighbor_search`` of test classes (see ``test_classes``): their numbers stand as observer_id.

    Output "ranked" gives a class the ``k`` unseen species of most votes, or, where it has neighbours but has
    seen all their species, one row of rank 0.  ``lists``: a class's rows as one row of lists, beside its one observer.
    """
    bands = F.expr("CAST(array() AS array<bigint>)") if bands is None else bands

    def blocks(df: DataFrame, rows: int, name: str) -> DataFrame:
        order = ["fold", "n", "species"]
        return cut_lineage(df.withColumn("n", F.size("species")).where("n > 0")
                           .repartitionByRange(*order).sortWithinPartitions(*order)
                           .select("fold", "species", "members", "weight", bands.alias("bands"))
                           .mapInArrow(_pack(rows, BLOCK_CELLS), BLOCK), name)

    rows = min(test_block_rows, max(256, -(-classes.count() // STRIPES)))
    asked = blocks(classes.withColumns({
        "members": F.array(F.struct(F.col("class").alias("observer_id"), F.col("only").isNotNull().cast("int").alias("year"))),
        "weight": F.coalesce("only", F.lit(0)).cast("bigint")}), rows, "nb-test")
    known = blocks(train_classes(train, 0 if output == "counts" else n_neighbors), train_block_rows, "nb-train")

    def ends(df: DataFrame, low: str, high: str) -> DataFrame:
        """One row per block, without its sets: rows lie in order of set size."""
        def int_at(end):
            return F.conv(F.hex(F.reverse(F.substring("sizes", end, 4))), 16, 10).cast("int")
        return df.select("fold", F.col("block").alias("t_block") if low == "low" else "block",
                         int_at(F.lit(1)).alias(low), int_at(F.length("sizes") - 3).alias(high))

    def searched(stripes: DataFrame, pairs: DataFrame, rows: DataFrame, what: str, n: int) -> DataFrame:
        """stripes: (block, stripe); pairs: (stripe, t_block, far).  A block comes once per stripe, nearest in set size first."""
        listed = lists and what == output
        schema = ", ".join(f"{c} array<{_DDL[t]}>" if listed and i > 1 else f"{c} {_DDL[t]}"
                           for i, (c, t) in enumerate(OUTPUTS[what]))
        if listed:
            schema = schema.replace("observer_id bigint, ", "observer_id bigint, only bigint, ", 1)
        own = rows.drop("held", *(() if listed else ("years", "weights"))).hint("merge").join(stripes, "block").withColumns({"kind": F.lit(0), "far": F.lit(0)})
        others = known.select("fold", "block", "names", "sizes", "codes", "bands", *SHIPPED.get(what, ["ids", "years", "held"]))
        others = others.hint("merge").join(pairs.withColumnRenamed("t_block", "block"), "block").withColumn("kind", F.lit(1))
        return (own.unionByName(others, allowMissingColumns=True).repartition(2 * n, "stripe")
                .sortWithinPartitions("stripe", "kind", "far", "block")
                .mapInArrow(_search_kernel(metric, n_neighbors, min_common, what, k, listed), schema))

    def far(low: str, high: str):
        return F.greatest(F.lit(0), F.col("low") - F.col(high), F.col(low) - F.col("high"))

    # What meets what is decided on the ends of blocks alone; sets are joined to what is left.
    mine, theirs = ends(asked, "a_low", "a_high"), ends(known, "low", "high")
    n_blocks = asked.count()
    per = min(STRIPE_BLOCKS, max(1, n_blocks // STRIPES))
    place = F.row_number().over(Window.partitionBy("fold").orderBy("a_low", "a_high", "block")) - 1
    n_stripes = max(1, -(-n_blocks // per))
    waves = -(-n_stripes // (2 * STRIPES))
    stripes = cut_lineage(mine.withColumn("place", F.floor(place / per)).withColumn(
        "stripe", F.first("block").over(Window.partitionBy("fold", "place").orderBy("a_low", "a_high", "block")))
        .withColumn("wave", F.col("place") % waves).drop("place"), "nb-stripes")

    def in_waves(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        def wave(w: int) -> DataFrame:
            now = stripes.where(F.col("wave") == w).select("block", "stripe")
            return searched(now, pairs.join(now.select("stripe").distinct(), "stripe"), rows, output, -(-n_stripes // waves))
        if waves == 1:
            return searched(stripes.select("block", "stripe"), pairs, rows, output, n_stripes)
        return reduce(DataFrame.unionByName, [cut_lineage(wave(w), "nb-wave") for w in range(waves)])

    if output == "counts":
        spans = stripes.groupBy("fold", "stripe").agg(F.min("a_low").alias("a_low"), F.max("a_high").alias("a_high"))
        pairs = spans.join(theirs, "fold").select("stripe", "t_block", far("a_low", "a_high").alias("far"))
        return in_waves(pairs, asked)
    near = Window.partitionBy("block").orderBy("far", F.abs(F.col("low") + F.col("high") - F.col("a_low") - F.col("a_high")),
                                               "t_block")
    first = (mine.join(theirs, "fold").withColumn("far", far("a_low", "a_high"))
             .withColumn("place", F.row_number().over(near)).where(F.col("place") <= near_blocks)
             .select(F.col("block").alias("stripe"), "t_block", "far"))
    bounds = cut_lineage(searched(mine.select("block", F.col("block").alias("stripe")), first, asked, "bounds", n_stripes),
                         "nb-bounds")
    spans = stripes.join(bounds, "block").groupBy("fold", "stripe").agg(
        F.min("a_low").alias("a_low"), F.max("a_high").alias("a_high"),
        F.min("need_low").alias("need_low"), F.max("need_high").alias("need_high"))
    pairs = (spans.join(theirs, "fold").where("high >= need_low and low <= need_high")
             .select("stripe", "t_block", far("a_low", "a_high").alias("far")))
    return in_waves(pairs, asked.join(bounds.select("block", "least"), "block"))


def neighbor_topk(fold_trans: DataFrame, k: int = 10, metric: str = "cosine",
                  n_neighbors: int = 50, min_common: int = 1, features: DataFrame | None = None,
                  test_block_rows: int = 2048, train_block_rows: int = 8192) -> DataFrame:
    """Top-K unseen species voted by the N nearest training rows -- M3 / M4.

    Test rows without a neighbour fall back to the training popularity share.
    Only species with a positive score are emitted.  ``features`` (species
    features) switches the popularity boost on (off by default, as in the reference).
    """
    # What is recommended depends on the fold and the set alone, so classes of equal sets stand for their rows.
    classes, members = test_classes(test_rows(fold_trans))
    test = classes.select("fold", F.col("class").alias("observer_id"), F.col("species").alias("species_from"))
    train = (fold_trans.where(F.col("role") == "train")
                       .select("fold", "observer_id", "year_from",
                               F.array_union("species_from", "species_to").alias("species")))
    # Written once: the ranking below and the search for rows without votes both read it.
    voted = cut_lineage(search_classes(classes, train, metric, n_neighbors, min_common,
                                       "ranked" if features is None else "votes",
                                       test_block_rows, train_block_rows, k=k), "nb-votes")
    # Popularity fallback for rows with no neighbour.
    # Ranked per fold (S rows each); a lonely row needs at most K + |V| of them.
    share = (train.select("fold", F.explode("species").alias("species"))
                  .groupBy("fold", "species").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("score", F.col("n") / F.sum("n").over(Window.partitionBy("fold"))))
    share = share.withColumn("pos", F.row_number().over(
        Window.partitionBy("fold").orderBy(F.desc(F.round("score", 9)), "species")))
    lonely = test.join(voted.select(*KEY).distinct(), KEY, "left_anti")
    fallback = (lonely.select(*KEY, F.explode(F.sequence(F.lit(1), F.lit(k) + F.size("species_from")))
                                     .alias("pos"))
                      .join(share, ["fold", "pos"]).select(*KEY, "species", "score"))
    cands = fallback
    if features is not None:
        cands = voted.unionByName(fallback)
        keys = [c for c in ("fold", "species") if c in features.columns]
        b = features.select(*keys, (F.lit(1.0) + F.lit(0.2) * F.col("popularity_score")).alias("boost"))
        cands = (cands.join(b, keys, "left")
                      .withColumn("score", F.col("score") * F.coalesce("boost", F.lit(1.0))))
    cands = (cands.join(test.select(*KEY, "species_from"), KEY)
                  .where(~F.array_contains("species_from", F.col("species")) & (F.col("score") > 0)))
    ranked = top_k(cands, k)
    if features is None:
        ranked = ranked.unionByName(voted.where("rank > 0"))
    return (ranked.withColumnRenamed("observer_id", "class").join(members, ["fold", "class"])
            .select(*PRED_COLUMNS))
