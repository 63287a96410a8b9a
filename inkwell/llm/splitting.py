"""Cutting oversized texts at natural boundaries, with an overlap.

A text is a sequence of units (words with what parts them); the prefix sums of their lengths are the offsets, and those at which a
cut is natural form sorted arrays by rank: paragraph, line, sentence, word. The end of a piece is the last boundary under the limit, by binary search, of the best rank
that has one in the piece's later part, else of the best rank that has one beyond the overlap; without any it is a hard cut. The next piece starts ``overlap`` characters before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.windows import once

LATE = 0.5  # a boundary of a better rank is preferred only beyond this share of the limit; earlier ones count if no rank has a later one


_UNIT = re.compile(r"[^\s，、：。！？；]*(?:\s+|[，、：]|[。！？；]+[”’」』）]*\s*|$)")
_ENDS = [re.compile(p) for p in (r"\n[^\S\n]*\n\s*$", r"\n\s*$", r"(?:[.!?…][\"”’»)\]]*\s+|[。！？；]+[”’」』）]*\s*)$")]


def boundaries(text: str) -> list[np.ndarray]:
    """Sorted offsets by rank: each unit's end is the prefix sum of the unit lengths, and its rank what the unit ends with."""
    units = [u for u in _UNIT.findall(text) if u]
    offsets = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
    ranks = np.fromiter((next((k for k, e in enumerate(_ENDS) if e.search(u)), len(_ENDS)) for u in units), np.int64, len(units))
    return [offsets[ranks <= k] if k == len(_ENDS) else offsets[ranks == k] for k in range(len(_ENDS) + 1)]


def cuts(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces in code points; each at most ``limit`` long, each but the first starting ``overlap`` before
    the last one's end. An overlap that leaves no progress is cut to limit - 1. A text within the limit is one piece."""
    limit = max(1, limit)
    overlap = min(max(0, overlap), limit - 1)
    n = len(text)
    if n <= limit:
        return [(0, n)]
    ranks, out, start = boundaries(text), [], 0
    while n - start > limit:
        last = [int(b[k - 1]) for b in ranks if (k := int(np.searchsorted(b, start + limit, "right")))]
        late, early = start + max(overlap + 1, int(limit * LATE)), start + overlap + 1
        end = next((b for floor in (late, early) for b in last if b >= floor), start + limit)
        out.append((start, end))
        start = end - overlap
    out.append((start, n))
    return out


def split_items(items: DataFrame, limits: DataFrame, profiles: list[str] | None = None, oversized_only: bool = True) -> DataFrame:
    """(segment_id, profile, piece_no, n_pieces, start_char, end_char, heading_path, content) of each segment and profile.

    Lengths are counted from the content, never taken from char_count. With ``oversized_only`` texts within the limit aren't
    cut or shown; else they are one piece. Null and empty contents have no pieces; a null limit means no limit; rows that come
    twice give their pieces once, and of different texts under one id the greatest is cut; further columns are not read; an empty table gives no rows.
    """
    limits = limits.select("profile", "max_chars", F.coalesce("overlap_chars", F.lit(0)).alias("overlap_chars")).where("profile is not null and max_chars > 0")
    if profiles:
        limits = limits.where(F.col("profile").isin(profiles))
    rows = [tuple(r) for r in limits.distinct().collect()]  # the profiles: a fixed table of a few rows
    spans = F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(m).alias("max_chars"), F.lit(o).alias("overlap_chars")) for p, m, o in rows]) if rows else F.expr("cast(array() as array<struct<profile:string,max_chars:int,overlap_chars:int>>)")
    items = once(items.where(F.char_length("content") > 0).select("segment_id", "heading_path", "content"), ["segment_id"])
    items = items.select("segment_id", "heading_path", "content", F.explode(spans).alias("l")).select("segment_id", "heading_path", "content", "l.*")
    items = items.where(F.char_length("content") > (F.col("max_chars") if oversized_only else F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for seg, path, text, profile, limit, overlap in zip(*(c.to_pylist() for c in batch.columns)):
                pieces = cuts(text, limit, overlap)
                for k, (a, b) in enumerate(pieces, 1):
                    for col, v in zip(cols, (seg, profile, k, len(pieces), a, b, path, text[a:b])):
                        col.append(v)
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["segment_id", "profile", "piece_no", "n_pieces", "start_char", "end_char", "heading_path", "content"])

    return items.mapInArrow(run, "segment_id string, profile string, piece_no int, n_pieces int, start_char int, end_char int, heading_path array<string>, content string")


def found(items: DataFrame, limits: DataFrame, profile: str = "standard") -> DataFrame:
    """(segment_id) of the segments that the profile cuts."""
    pieces = split_items(items, limits, [profile])
    return pieces.where("piece_no = 2").select("segment_id")
