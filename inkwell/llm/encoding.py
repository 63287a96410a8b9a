"""Token ids of a whole corpus by a public byte-level BPE vocabulary.

The method: the corpus' frequent words are counted over all documents, compiled with their ids into a minimal acyclic transducer
(``lexicon``) and memory-mapped by the workers; words the lexicon lacks are merged exactly by the vocabulary's ranks.
"""

from __future__ import annotations

import base64
import os
import pickle
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import lexicon
from inkwell.session import shared_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text into words before any merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEXICON_WORDS = 50_000  # the most frequent words that are compiled; a bound of the driver's work, without effect on results
LONGEST_WORD = 20  # characters; longer words are merged, not looked up
CACHED_WORDS = 200_000  # merged words a worker remembers before it starts anew


def load_ranks(vocabulary: str | bytes) -> dict[bytes, int]:
    lines = vocabulary if isinstance(vocabulary, bytes) else open(vocabulary, "rb").read()  # noqa: SIM115
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: the adjacent pair of lowest rank is merged again and again, the leftmost first among equals."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def _merger(vocabulary: bytes):
    ranks = load_ranks(vocabulary)
    try:
        import tiktoken

        return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    except (ImportError, AttributeError):
        return lambda word: merge_word(word, ranks)


class Encoder:
    """One worker's encoder: transducer first, exact merges for the rest, both remembered by word."""

    def __init__(self, auto: dict[str, np.ndarray], vocabulary: bytes):
        import regex

        self.split = regex.compile(PATTERN).findall
        self.auto, self.merge, self.known = auto, _merger(vocabulary), {}

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > CACHED_WORDS:
            self.known, fresh = {}, list(words)
        as_bytes = [w.encode("utf-8", "surrogatepass") for w in fresh]
        starts, ids, known = self.auto["starts"], self.auto["ids"], self.known
        for word, raw, rank in zip(fresh, as_bytes, lexicon.ranks(self.auto, as_bytes).tolist()):
            known[word] = ids[starts[rank] : starts[rank + 1]].tolist() if rank >= 0 else self.merge(raw)

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the offsets of each text; null and empty texts have none."""
        from array import array

        words = [self.split(t) if t else [] for t in texts]
        unique: set[str] = set()
        for w in words:
            unique.update(w)
        self.learn(unique)
        known, flat, offsets = self.known, array("i"), np.zeros(len(texts) + 1, np.int32)
        for k, w in enumerate(words):
            for x in w:
                flat.extend(known[x])
            offsets[k + 1] = len(flat)
        return np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32), offsets


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all documents; each partition counts its own words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, counts = regex.compile(PATTERN).findall, Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    counts.update(split(t))
            if len(counts) > 500_000:
                yield as_batch(counts)
                counts = Counter()
        yield as_batch(counts)

    def as_batch(counts: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) <= LONGEST_WORD]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    return docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """The compiled lexicon and vocabulary, as the workers get them: a memory-mapped file in the shared folder if that is a
    mounted path, else a broadcast. Its size is bounded by ``LEXICON_WORDS`` and the vocabulary, whatever the corpus."""

    def __init__(self, spark: SparkSession, docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, size: int = LEXICON_WORDS):
        with open(vocabulary, "rb") as f:
            self.vocabulary = f.read()
        # the order among words equally frequent doesn't matter for the result
        rows = count_words(docs, text).where("n > 1").orderBy(F.desc("n"), "word").limit(size).select("word").toArrow().column(0).to_pylist()
        words, merge = [w.encode("utf-8") for w in rows], _merger(self.vocabulary)
        auto = lexicon.build(words, [merge(w) for w in words])
        folder = shared_dir(spark)
        self.path, self.sent = None, None
        if folder.startswith("file:") or folder.startswith("/"):
            self.path = f"/{folder.removeprefix('file:').lstrip('/').rstrip('/')}/lexicon-{uuid.uuid4().hex}"
            os.makedirs(self.path)
            for name, part in auto.items():
                np.save(f"{self.path}/{name}.npy", part)
            with open(f"{self.path}/vocabulary", "wb") as f:
                f.write(self.vocabulary)
        else:
            self.sent = spark.sparkContext.broadcast(pickle.dumps((auto, self.vocabulary)))

    def opener(self):
        """A function without Spark objects but the broadcast, to be called in a worker."""
        path, sent = self.path, self.sent

        def open_encoder() -> Encoder:
            if path is None:
                auto, vocabulary = pickle.loads(sent.value)
            else:
                auto = {p.removesuffix(".npy"): np.load(f"{path}/{p}", mmap_mode="r") for p in os.listdir(path) if p.endswith(".npy")}
                vocabulary = open(f"{path}/vocabulary", "rb").read()  # noqa: SIM115
            return Encoder(auto, vocabulary)

        return open_encoder


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, counts_only: bool = False) -> DataFrame:
    """(key, ids) of each document, or (key, n_tokens) with ``counts_only``.

    Null and empty texts give an empty list (0 tokens); white space, very long texts and repeated rows are encoded like any
    text, row by row; an empty table gives an empty result; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    opener = Lexicon(spark, docs, text, vocabulary).opener()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or opener()
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                flat, offsets = encoder.batch(part.column(1).to_pylist())
                if counts_only:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets).astype(np.int64))], [key, "n_tokens"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ("n_tokens long" if counts_only else "ids array<int>"))


def decode(ids: list[int], ranks: dict[bytes, int]) -> str:
    """The inverse of one encoding, for round trips."""
    back = {v: k for k, v in ranks.items()}
    return b"".join(back[i] for i in ids).decode("utf-8", "replace")
