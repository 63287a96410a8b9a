"""Gradient-boosted regression trees on a numpy histogram, flattened for vectorised scoring, with monotonic constraints."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, rising: set[int] = frozenset(), trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 48, least: int = 8, cuts: dict[int, list[float]] | None = None) -> dict[str, np.ndarray]:
    """Squared loss on ``y``. Features in ``rising`` never lower the score: a split on one keeps left value <= right value and
    passes the middle on as a bound to both sides. ``cuts`` are values a feature may be split at beside its quantiles. The result is flat arrays: one row a node, complete binary trees."""
    n, m = x.shape
    size = 2 ** (depth + 1) - 1
    edges = [np.unique(np.concatenate([np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]), (cuts or {}).get(f, [])])) for f in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    base = float(y.mean()) if n else 0.0
    feature, cut, value = np.full((trees, size), -1, np.int32), np.zeros((trees, size)), np.zeros((trees, size))
    score = np.full(n, base)
    for t in range(trees):
        rest = y - score
        work = [(0, np.arange(n), -np.inf, np.inf)]
        while work:
            node, rows, low, high = work.pop()
            value[t, node] = np.clip(rest[rows].mean(), low, high) if len(rows) else 0.0
            if node * 2 + 2 >= size or len(rows) < 2 * least:
                continue
            best = None
            for f in range(m):
                count = np.bincount(binned[rows, f], minlength=len(edges[f]) + 1)
                total = np.bincount(binned[rows, f], rest[rows], minlength=len(edges[f]) + 1)
                nl, sl = np.cumsum(count)[:-1], np.cumsum(total)[:-1]
                nr, sr = len(rows) - nl, rest[rows].sum() - sl
                ok = (nl >= least) & (nr >= least)
                if not ok.any():
                    continue
                left, right = sl / np.maximum(nl, 1), sr / np.maximum(nr, 1)
                if f in rising:
                    ok &= np.clip(left, low, high) <= np.clip(right, low, high)
                gain = np.where(ok, sl * left + sr * right, -np.inf)
                k = int(gain.argmax())
                if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
                    best = (gain[k], f, k, left[k], right[k])
            if best is None or best[0] <= rest[rows].sum() ** 2 / len(rows) + 1e-12:
                continue
            _, f, k, left, right = best
            feature[t, node], cut[t, node] = f, edges[f][k]
            goes = binned[rows, f] <= k
            middle = (np.clip(left, low, high) + np.clip(right, low, high)) / 2
            bounds = ((low, middle), (middle, high)) if f in rising else ((low, high), (low, high))
            work += [(node * 2 + 1, rows[goes], *bounds[0]), (node * 2 + 2, rows[~goes], *bounds[1])]
        value[t] *= rate
        score = score + _tree(x, feature[t], cut[t], value[t], depth)
    return {"feature": feature, "cut": cut, "value": value, "base": np.array(base), "depth": np.array(depth)}


def _tree(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int) -> np.ndarray:
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(int(depth)):
        f = feature[node]
        node = np.where(f < 0, node, node * 2 + 1 + (x[rows, np.maximum(f, 0)] > cut[node]))
    return value[node]


def predict(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), float(model["base"]))
    for f, c, v in zip(model["feature"], model["cut"], model["value"]):
        out += _tree(x, f, c, v, int(model["depth"]))
    return out
