"""Logistic regression over (row, species) pairs that are never written out (M6's fit).

The features of a pair are bias, co-occurrence score, share, log share, the row's features x and score * x.
A pass meets every packed test block with its model block, as scoring does, and adds up loss, gradient and
curvature of every fit that learns from the block's fold; what leaves a task is some (4 + 2 |x|)^2 sums per fit, so
neither the number of rows nor of species is bounded.  The sums are exact: a row's pairs share x, so
each feature product is a sum over species first.

The objective is that of ``pyspark.ml``'s LogisticRegression: mean cross-entropy + regParam / 2 * the squared weights
of features scaled to unit variance, bias free; a feature without variance gets no weight.  Newton's steps,
halved where the objective would rise, take some ten passes, and all fits share them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cooccurrence import _by_model, _places, _scored_rows

SHARE_FLOOR = 1e-6
_CELLS = 1 << 19           # pairs of a part: 4 MiB a matrix
ALL, REST, HELD = 0, 1, 2  # a fit's rows: every one, those not held out, those held out


def pair_logits(w: np.ndarray, score: np.ndarray, share: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Log odds of every (row, species) pair; ``w``: bias, score, share, log share, x, score * x."""
    m = x.shape[1]
    return (w[0] + score * w[1] + share * w[2] + np.log(share + SHARE_FLOOR) * w[3]
            + (x @ w[4:4 + m])[:, None] + score * (x @ w[4 + m:])[:, None])


def _sums(w: np.ndarray, score, share, x, label, used) -> np.ndarray:
    """pairs, positive pairs, loss, gradient and curvature over the pairs that are ``used``, as one vector."""
    p = 1.0 / (1.0 + np.exp(-pair_logits(w, score, share, x)))
    loss = -np.log(np.maximum(np.where(label, p, 1.0 - p), 1e-15))[used].sum()
    r = np.where(used, p - label, 0.0)
    v = np.where(used, p * (1.0 - p), 0.0)
    own = np.stack([share, np.log(share + SHARE_FLOOR)], 1)               # features of a species alone
    m = x.shape[1]
    at_x, at_sx = slice(4, 4 + m), slice(4 + m, 4 + 2 * m)
    grad, curve = np.zeros(4 + 2 * m), np.zeros((4 + 2 * m, 4 + 2 * m))
    r0, r1 = r.sum(1), (r * score).sum(1)
    grad[0], grad[1], grad[2:4] = r0.sum(), r1.sum(), r.sum(0) @ own
    grad[at_x], grad[at_sx] = r0 @ x, r1 @ x
    vs = v * score
    by_row = [v.sum(1), vs.sum(1), (vs * score).sum(1)]                   # of 1, score and its square
    row_own, row_s_own = v @ own, vs @ own
    curve[0, 0], curve[0, 1], curve[1, 1] = (c.sum() for c in by_row)
    curve[0, 2:4], curve[1, 2:4] = row_own.sum(0), row_s_own.sum(0)
    curve[2:4, 2:4] = own.T @ (v.sum(0)[:, None] * own)
    for i, j in ((0, 0), (1, 1)):
        curve[i, at_x], curve[i, at_sx] = by_row[j] @ x, by_row[j + 1] @ x
    curve[2:4, at_x], curve[2:4, at_sx] = row_own.T @ x, row_s_own.T @ x
    curve[at_x, at_x], curve[at_x, at_sx], curve[at_sx, at_sx] = (x.T @ (c[:, None] * x) for c in by_row)
    curve = np.triu(curve) + np.triu(curve, 1).T
    return np.concatenate([[used.sum(), (label & used).sum(), loss], grad, curve.ravel()])


def _pass_kernel(asked: list[tuple], alpha: float):
    """mapInArrow over (labelled test block, model block): (fit, place, value), the sums of each fit in this task.

    ``asked``: (fit, folds it learns from, which rows, weights).
    """
    schema = pa.schema([("fit", pa.int32()), ("place", pa.int32()), ("value", pa.float64())])

    def run(batches):
        total = {}
        for b, i, model in _by_model(batches, alpha):
            fold = b.column("fold")[i].as_py()
            names, lo, hi, share = model[0], model[2], model[3], model[7]
            mine = [a for a in asked if fold in a[1]]
            if not mine:
                continue
            extras = b.column("extras")[i].values
            x = extras.flatten().to_numpy().reshape(len(extras), -1)
            sizes = np.frombuffer(b.column("to_sizes")[i].as_buffer(), np.int64)
            held = np.frombuffer(b.column("held")[i].as_buffer(), np.uint8) > 0
            row, at = np.repeat(np.arange(len(sizes)), sizes), _places(b, i, names, "to_codes")
            label = np.zeros((len(sizes), hi - lo), bool)
            here = (at >= lo) & (at < hi)
            label[row[here], at[here] - lo] = True
            step = max(1, _CELLS // max(hi - lo, 1))
            for first, n, score, seen, _ in _scored_rows(b, i, model):
                for c in range(0, n, step):
                    part, rows = slice(c, min(c + step, n)), slice(first + c, first + min(c + step, n))
                    for fit, _, which, w in mine:
                        used = ~seen[part]
                        if which != ALL:
                            used &= (held[rows] == (which == HELD))[:, None]
                        if used.any():
                            s = _sums(w, score[part], share, x[rows], label[rows], used)
                            total[fit] = total[fit] + s if fit in total else s
        for fit, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), fit), pa.int32()),
                                              pa.array(np.arange(len(s)), pa.int32()), pa.array(s)], schema=schema)

    return run


@dataclass
class _Fit:
    folds: frozenset
    which: int
    reg: float
    w: np.ndarray                           # weights of the plain features, bias first
    scale: np.ndarray | None = None         # deviation of the features; 0: no weight
    mean: np.ndarray | None = None
    best: tuple = field(default=(np.inf, None, None))     # objective, weights, next step
    step: float = 1.0
    passes: int = 0
    done: bool = False

    def first(self, n: float, positive: float, grad: np.ndarray, curve: np.ndarray) -> None:
        """From the sums at weight 0, where the curvature is a quarter of the features' moments."""
        if not 0 < positive < n:
            self.done = True                # one label only: nothing to learn
            return
        moments = curve * 4.0
        self.mean = moments[0] / n
        var = (np.diag(moments) / n - self.mean ** 2) * n / max(n - 1, 1)
        self.scale = np.where(var > 1e-12 * np.maximum(np.diag(moments) / n, 1e-300), np.sqrt(np.maximum(var, 0)), 0.0)
        self.scale[0], self.mean[0] = 0.0, 0.0
        self.w = np.zeros(len(self.w))
        self.w[0] = np.log(positive / (n - positive))

    def advance(self, n: float, loss: float, grad: np.ndarray, curve: np.ndarray, max_iter: int, tol: float) -> None:
        self.passes += 1
        objective = loss / n + self.reg / 2 * ((self.w * self.scale) ** 2).sum()
        if not objective <= self.best[0] * (1 + 1e-12):     # too far: half the way from the best
            self.step /= 2
        else:
            gained = self.best[0] - objective
            to = np.diag(np.append(0.0, 1.0 / self.scale[1:][self.scale[1:] > 0]))   # scaled, centred weights -> plain ones
            keep = np.append(0, 1 + np.flatnonzero(self.scale[1:] > 0))
            to[0, 0], to[0, 1:] = 1.0, -self.mean[keep[1:]] / self.scale[keep[1:]]
            reg = np.append(0.0, np.full(len(keep) - 1, self.reg))
            beta = self.w[keep] * self.scale[keep]
            g = to.T @ (grad[keep] / n) + reg * beta
            h = to.T @ (curve[np.ix_(keep, keep)] / n) @ to + np.diag(reg + 1e-12)
            move = np.zeros(len(self.w))
            move[keep] = to @ np.linalg.lstsq(h, -g, rcond=1e-14)[0]
            self.best, self.step = (objective, self.w, move), 1.0
            self.done = gained <= tol * max(abs(objective), 1e-300) or np.abs(g).max() < 1e-10
        self.done |= self.passes >= max_iter or self.step < 1e-4
        self.w = self.best[1] if self.done else self.best[1] + self.step * self.best[2]


def _one_pass(blocks: DataFrame, asked: list[tuple], alpha: float) -> dict[int, np.ndarray]:
    rows = (blocks.mapInArrow(_pass_kernel(asked, alpha), "fit int, place int, value double")
            .groupBy("fit", "place").agg(F.sum("value").alias("value")).collect())
    out = {}
    for r in rows:                          # (4 + 2 |x|)^2 sums a fit, whatever the rows
        out.setdefault(r["fit"], {})[r["place"]] = r["value"]
    return {f: np.array([s[i] for i in range(len(s))]) for f, s in out.items()}


def logistic_fits(blocks: DataFrame, fits: dict, n_features: int, alpha: float, max_iter: int = 50,
                  tol: float = 1e-9) -> dict:
    """The weights (bias, score, share, log share, x, score * x) of every fit that meets both labels.

    ``blocks``: labelled test blocks joined with their model blocks; ``fits``: key -> (folds, which rows,
    regParam); ``n_features``: |x|.
    """
    width = 4 + 2 * n_features
    held = {k: _Fit(frozenset(f), which, reg, np.zeros(width)) for k, (f, which, reg) in fits.items()}
    keys, first = list(held), True
    while any(not f.done for f in held.values()):
        sums = _one_pass(blocks, [(i, held[k].folds, held[k].which, held[k].w) for i, k in enumerate(keys)
                                  if not held[k].done], alpha)
        for i, k in enumerate(keys):
            fit = held[k]
            if fit.done:
                continue
            if i not in sums:
                fit.done = True
                continue
            (n, positive, loss), grad, curve = sums[i][:3], sums[i][3:3 + width], sums[i][3 + width:].reshape(width, width)
            if first:
                fit.first(n, positive, grad, curve)
            else:
                fit.advance(n, loss, grad, curve, max_iter, tol)
        first = False
    return {k: f.w for k, f in held.items() if f.scale is not None}


def log_losses(blocks: DataFrame, weights: dict, folds: dict, alpha: float, which: int = HELD) -> dict:
    """Mean log loss of given weights on the rows held out of their folds; keys without such a row are left out."""
    keys = list(weights)
    if not keys:
        return {}
    sums = _one_pass(blocks, [(i, frozenset(folds[k]), which, weights[k]) for i, k in enumerate(keys)], alpha)
    return {keys[i]: s[2] / s[0] for i, s in sums.items()}
