"""The few text functions SQL has no expression for, as Arrow batch functions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType


def longest_match(text: str, words: set[str], longest: int) -> list[str]:
    """Runs of letters and digits are words; in ideographs the longest dictionary word is taken from the left, else one sign."""
    out, k, n = [], 0, len(text)
    while k < n:
        c = text[k]
        if "一" <= c <= "鿿":
            for size in range(min(longest, n - k), 1, -1):
                if text[k : k + size] in words:
                    break
            else:
                size = 1
            out.append(text[k : k + size])
            k += size
        elif c.isalnum():
            end = k
            while end < n and text[end].isalnum() and not "一" <= text[end] <= "鿿":
                end += 1
            out.append(text[k:end].casefold())
            k = end
        else:
            k += 1
    return out


def dictionary_tokens(words: list[str]) -> Callable[[Column], Column]:
    """A tokenizer over a frozen dictionary, which is sent with the plan; null texts give null."""
    known, longest = set(words), max(map(len, words), default=1)

    @F.pandas_udf(ArrayType(StringType()))
    def tokenize(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else longest_match(x, known, longest))

    return tokenize


def shortest_window(text: str, pieces: list[str]) -> tuple[int, int] | None:
    """(start, end) of the shortest stretch of the text that holds all pieces, the first among equals; None if one is missing."""
    hits = sorted((m, m + len(p), i) for i, p in enumerate(dict.fromkeys(p for p in pieces if p)) for m in _all(text, p))
    want = len({p for p in pieces if p})
    have: Counter = Counter()
    best, left = None, 0
    for right, (_, _, i) in enumerate(hits):
        have[i] += 1
        while len(have) == want:
            a, b = hits[left][0], max(h[1] for h in hits[left : right + 1])
            if best is None or b - a < best[1] - best[0]:
                best = (a, b)
            have[hits[left][2]] -= 1
            if not have[hits[left][2]]:
                del have[hits[left][2]]
            left += 1
    return best


def _all(text: str, piece: str):
    k = text.find(piece)
    while k >= 0:
        yield k
        k = text.find(piece, k + 1)


def longest_common(a: str, b: str, least: int = 20) -> str:
    """The longest common stretch of at least ``least`` characters, the leftmost in ``a``; by binary search over the length, since a
    common stretch holds shorter ones."""
    low, high, best = least, min(len(a), len(b)), ""
    while low <= high:
        size = (low + high) // 2
        seen = {b[k : k + size] for k in range(len(b) - size + 1)}
        at = next((k for k in range(len(a) - size + 1) if a[k : k + size] in seen), None)
        if at is None:
            high = size - 1
        else:
            best, low = a[at : at + size], size + 1
    return best


@F.pandas_udf(StringType())
def common_stretch(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else longest_common(x, y) or None for x, y in zip(a, b)], dtype=object)


@F.pandas_udf(ArrayType(IntegerType()))
def covering_window(text: pd.Series, pieces: pd.Series) -> pd.Series:
    """[start, end] of ``shortest_window``; null without one."""
    return pd.Series([None if t is None or p is None else (list(w) if (w := shortest_window(t, list(p))) else None) for t, p in zip(text, pieces)], dtype=object)
