"""Shared by the operators: hashes of all fixed-width windows of many texts at once, and rows taken once a key."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.session import checkpoint

SENT_KEYS = 200_000  # keys that come more than once are broadcast up to this number
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)


def normalised(text: str) -> str:
    """Lower case, each run of white space one space, none outside."""
    return " ".join(text.lower().split())


_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(str(base))
    if got is None or len(got) < n:
        with np.errstate(over="ignore"):
            got = np.full(max(n, 1 << 20), base, np.uint64)
            got[0] = 1
            got = np.cumprod(got, dtype=np.uint64)
        _powers[str(base)] = got
    return got[:n]


def window_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, position) of each window that lies within its text; equal windows have equal hashes."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    counts = np.maximum(lengths - width + 1, 0)
    doc = np.repeat(np.arange(len(texts)), counts)
    position = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    start = position + np.repeat(np.cumsum(lengths) - lengths, counts)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * _power(BASE, len(codes)), out=prefix[1:])
    return (prefix[start + width] - prefix[start]) * _power(_INVERSE, len(codes) + 1)[start], doc, position


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of each hash, by multiply and shift."""
    h = (h ^ np.uint64(seed * 0xD6E8FEB86659FD93 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    return h


def once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key before any work is done on it; of different rows under one key the greatest by value.

    Keys that come more than once are found from the keys alone, so the other columns of the rest aren't grouped."""
    rest = [c for c in rows.columns if c not in keys]
    match = [F.col("a." + c).eqNullSafe(F.col("b." + c)) for c in keys]
    twice = checkpoint(rows.select(*keys).groupBy(*keys).count().where("count > 1").drop("count"))
    b = F.broadcast(twice).alias("b") if twice.count() <= SENT_KEYS else twice.alias("b")  # beyond that the rows are shuffled
    single = rows.alias("a").join(b, match, "left_anti").select(*rows.columns)
    several = rows.alias("a").join(b, match, "left_semi").select(*rows.columns)
    several = several.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*rows.columns)
    return single.unionByName(several)
