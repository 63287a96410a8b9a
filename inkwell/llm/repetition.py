"""Repetition inside single documents.

The repeated share is the share of a normalised text's characters that lie in a stretch of ``WIDTH`` characters which also starts
at an earlier position of the text. It is counted exactly for every text and is one of the statistics that gradient-boosted trees
read; the others are short windows, words and bytes that came before, and sizes. The trees are fitted on a bounded sample of
labelled rows, never fall when a statistic of repetition rises, may split the share at the threshold itself, and are flattened to
arrays that score whole batches. Their score selects the repetitive texts; the exact share is checked after it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm import trees
from inkwell.llm.windows import mixed, normalised, window_hashes

WIDTH = 30
THRESHOLD = 0.4
SAMPLE = 6_000  # labelled rows the trees are fitted on, at most
DECIDES = 0.5  # a text is repetitive from this score on; the trees are fitted to 0 and 1
#: Statistics that may only raise the score.
RISING = {0, 1, 2, 3}
FEATURES = ("exact repeated share", "sampled short windows that came before", "words that came before", "bytes saved by compression", "characters", "mean word length")


def exact_share(text: str, width: int = WIDTH) -> float:
    """By definition, on a normalised text; 0 if it is no longer than a stretch."""
    n, last, seen, covered = len(text), -1, set(), 0
    for i in range(n - width + 1):
        w = text[i : i + width]
        if w in seen:
            covered += width - max(0, last - i)
            last = i + width
        else:
            seen.add(w)
    return covered / n if n else 0.0


def _repeats(texts: list[str], width: int, every: int) -> np.ndarray:
    """For each text the share of windows that came before, over the windows whose hash is divisible by ``every``."""
    h, doc, _ = window_hashes(texts, width)
    h = mixed(h, width)
    kept = (h % np.uint64(every)) == 0
    doc = doc[kept]
    keys = h[kept] ^ mixed(doc.astype(np.uint64), 7)  # equal windows of one text have one key
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    total = np.bincount(doc, minlength=len(texts))
    distinct = np.bincount(doc[order[fresh]], minlength=len(texts))
    return 1 - distinct / np.maximum(total, 1)


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` for each normalised text."""
    out = np.zeros((len(texts), len(FEATURES)))
    out[:, 0] = [exact_share(t) for t in texts]
    out[:, 1] = _repeats(texts, 12, 8)
    for k, t in enumerate(texts):
        words = t.split(" ")
        raw = t.encode("utf-8", "surrogatepass")
        out[k, 2] = 1 - len(set(words)) / len(words)
        out[k, 3] = 1 - len(zlib.compress(raw, 1)) / (len(raw) + 12)
        out[k, 4] = len(t)
        out[k, 5] = len(t) / len(words)
    return out


def items(blocks: DataFrame, pages: DataFrame, *extra: Column) -> DataFrame:
    """(item_table, item_key, content): text blocks and page results with a content."""
    b = blocks.where("block_type = 'text' and content is not null").select(F.lit("blocks").alias("item_table"), F.col("block_id").alias("item_key"), "content", *extra)
    p = pages.where("content is not null").select(F.lit("page_results").alias("item_table"), F.col("record_id").cast("string").alias("item_key"), "content", *extra)
    return b.unionByName(p)


def fit_model(rows: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Trees that tell repetitive texts (1) from others (0), fitted on at most ``sample`` rows chosen by a hash of the key; the
    choice ignores the content. Texts around the threshold are made for the sample, so that both classes are in it."""
    total = max(1, rows.count())
    picked = rows.where(F.pmod(F.xxhash64("item_key"), F.lit(1_000_000)) < min(1_000_000, int(1.2e6 * sample / total) + 1)).select("content").limit(sample).toArrow()
    texts = [normalised(t) for t in picked.column(0).to_pylist()]
    plain = " ".join(f"{k * 7919 % 10007:x}{k:x}" for k in range(400))
    texts += [normalised(plain[:n] + " " + (plain[:40] + " ") * k) for n in (200, 600, 1500) for k in range(60)] + ["", "abc " * 300]
    x = features(texts)
    return trees.fit(x, (x[:, 0] >= threshold).astype(float), RISING, cuts={0: [float(np.nextafter(threshold, 0.0))]})


def repeated_share(rows: DataFrame, threshold: float = THRESHOLD, model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(item_table, item_key, n_chars, score, repeated_share) of every row with a content, once a key.

    ``score`` is the trees' and ``repeated_share`` the exact share of every text. Empty and blank texts and texts shorter than a
    stretch have share 0; null contents have no row; long texts are counted whole; of rows with one key the one with the greatest
    share counts; other columns are not read; an empty table gives no rows.
    """
    model = model or fit_model(rows, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = [normalised(t) for t in batch.column(2).to_pylist()]
                x = features(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int32()), pa.array(trees.predict(model, x)), pa.array(x[:, 0])],
                    ["item_table", "item_key", "n_chars", "score", "repeated_share"],
                )

    out = rows.select("item_table", "item_key", "content").mapInArrow(run, "item_table string, item_key string, n_chars int, score double, repeated_share double")
    return out.groupBy("item_table", "item_key").agg(F.max(F.struct("repeated_share", "score", "n_chars")).alias("r")).select("item_table", "item_key", "r.n_chars", "r.score", "r.repeated_share")


def found(blocks: DataFrame, pages: DataFrame, threshold: float = THRESHOLD, model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The texts the trees select, whose exact share reaches the threshold."""
    scored = repeated_share(items(blocks, pages), threshold, model)
    return scored.where((F.col("score") >= DECIDES) & (F.col("repeated_share") >= threshold)).select("item_table", "item_key")
