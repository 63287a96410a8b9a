"""Noise of scanned pages: found and repaired into continuous paragraphs.

1. All words of all texts are counted. Words with at least ``FREQUENT`` of all uses are the lexicon (so it has 1 / FREQUENT words
   at most, whatever the corpus).
2. Skip-gram vectors of the lexicon's most frequent words are learned with negative sampling: gradient steps on the objective
   over the co-occurrence counts of all texts, which is the same sum as over the texts themselves.
3. A rare word is linked to those frequent words that plausible glyph edits turn it into, that are far more frequent, and that are
   its neighbours: the words around the rare word, summed over all its uses, must be more likely beside the frequent word than by
   chance. The most likely one comes first. A word with known surroundings and no fitting neighbour is a word of its own.
4. Where several words remain, the vectors of the words around decide in each place. A text's running heads and page numbers are removed, broken words joined, words corrected and lines reflowed.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.windows import once
from inkwell.session import checkpoint

FREQUENT = 1.5e-5  # of all uses of words
RARER = 0.03  # a misread word has at most this share of the uses of the word it stands for
VECTOR_WORDS, DIMENSIONS, WINDOW = 1500, 32, 2  # context words; all lexicon words up to TARGET_WORDS have vectors
TARGET_WORDS, NEGATIVES, STEPS = 6000, 5, 60

# What recognition makes of letters (misread, meant), and characters that stand for unreadable ones.
GLYPHS = [("0", "o"), ("1", "l"), ("5", "s"), ("!", "i"), ("|", "l"), ("|", "i"), ("1", "i"), ("8", "b"), ("6", "b"), ("9", "g"), ("q", "g"), ("c", "e"), ("e", "c"), ("ri", "n"), ("rn", "m"), ("m", "rn"), ("li", "h"), ("ii", "u"), ("vv", "w"), ("cl", "d"), ("in", "m"), ("f", "t"), ("u", "n"), ("n", "u"), ("h", "b"), ("I", "l"), ("l", "I")]
UNREADABLE = "\ufffd囗卄〡□■▯\ue000-\uf8ff"  # as a class of an expression
_UNREADABLE = re.compile(f"[{UNREADABLE}]")
HYPHENS = "-‐‑\xad¬"

_L = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(rf"[{_L}](?:[{_L}]|[0-9!|](?=[{_L}])|(?<=[{_L}]{{2}})[0-9!|](?![\w|!]))+")
_BROKEN = re.compile(rf"([{_L}]+)([{HYPHENS}])[ \t]*\n[ \t]*([a-zß-öø-ÿ]+)")
_INSIDE = re.compile(rf"[{_L}][0-9!|][a-zà-ÿ]|[a-zà-ÿ]{{2}}[0-9!|](?![\w|!])")
_NUMBER_LINE = re.compile(r"^[ \t]*(?:\d{1,4}|[—–·•-][ \t]?\d{1,4}[ \t]?[—–·•-]|\[\d{1,4}\]|(?:p\.|pp\.|[Pp]age|[Ss]eite|S\.|[Pp]ágina|[Pp]ág\.)[ \t]*\d{1,4}(?:[ \t]*(?:of|von|de|sur|/)[ \t]*\d{1,4})?|第[ \t]*\d{1,4}[ \t]*页(?:[ \t]*[,，/]?[ \t]*共[ \t]*\d+[ \t]*页)?)[ \t]*$")
_HEAD_NUMBER = re.compile(r"^[ \t]*(?:\S[^.!?。|\n]{2,80}?(?:[ \t]{3,}|　+|[ \t]+\|[ \t]+)\d{1,4}|\d{1,4}(?:[ \t]{3,}|　+|[ \t]+\|[ \t]+)\S[^.!?。|\n]{2,80})[ \t]*$")
_STRUCTURE = re.compile(r"^[ \t]*(?:#{1,6}[ \t]|[-*+•][ \t]|\d+[.)][ \t]|>|\||```|\$\$|<|\[\d+\][ \t]|\[\^|!\[|={1,6}[^=]|\\|\{\{|[;:])|[>|}]$|\$\$$|;$|:$")
_STOP = re.compile(r"[.!?…。！？；;:：][\"”’»)\]）」』]*$")
_HAN = re.compile("[一-鿿]")


def words_of(text: str) -> list[str]:
    return WORD.findall(text)


def meant_by(word: str, lexicon: dict[str, int], count: int) -> list[str]:
    """Frequent words that one or two glyph edits make of a word, far more frequent than it; most frequent first."""
    if word in lexicon:
        return []
    found: dict[str, int] = {}
    symbols = any(not c.isalpha() for c in word)
    one = _edits(word)
    two = (x for w in one for x in _edits(w)) if symbols else ()
    for w in [*one, *two]:
        for form in (w, w.lower(), w[:1].upper() + w[1:]) if symbols else (w,):
            n = lexicon.get(form)
            if n and (count <= RARER * n or symbols):
                found[form if w not in lexicon else w] = n
    return sorted(found, key=lambda w: (-found[w], w))


def _edits(word: str) -> list[str]:
    out = []
    for seen, meant in GLYPHS:
        k = word.find(seen)
        while k >= 0:
            out.append(word[:k] + meant + word[k + len(seen) :])
            k = word.find(seen, k + 1)
    return out


def count_words(rows: DataFrame) -> DataFrame:
    """(word, n) over all texts; broken words are joined first, so that halves aren't counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(words_of(_BROKEN.sub(r"\1\3", t) if "\n" in t else t))
            if len(counts) > 500_000:
                yield as_batch(counts)
                counts = Counter()
        yield as_batch(counts)

    def as_batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return rows.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Linker:
    """Words outside the lexicon that a glyph edit may turn into a word of it; remembered by word."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon, self.known = lexicon, {}

    def possible(self, word: str) -> bool:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 300_000:
                self.known = {}
            got = self.known[word] = len(word) >= 2 and bool(meant_by(word, self.lexicon, 0))
        return got


def surroundings(rows: DataFrame, lexicon: dict[str, int], targets: list[str], contexts: list[str]) -> DataFrame:
    """(word, context, n) over all texts: how often each context word (by number) stood within the window of each target word and
    of each rare word that may be a misread one."""
    number = {w: k for k, w in enumerate(targets)}
    v = len(contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker, ids, names = Linker(lexicon), dict(number), list(targets)
        held, size = [], 0
        for batch in batches:
            flat: list[int] = []
            for t in batch.column(0).to_pylist():
                for w in words_of(t):
                    k = ids.get(w)
                    if k is None:
                        k = -1
                        if w not in lexicon and linker.possible(w):
                            k = ids[w] = len(names)
                            names.append(w)
                    flat.append(k)
                flat += [-1] * WINDOW
            a = np.array(flat, np.int64)
            keys = []
            for step in range(1, WINDOW + 1):
                x, y = a[:-step], a[step:]
                for one, other in ((x, y), (y, x)):
                    ok = (one >= 0) & (other >= 0) & (other < v)
                    keys.append(one[ok] * v + other[ok])
            held.append(np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            size += len(held[-1][0])
            if size > 2_000_000:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > 1_500_000:
                    yield as_batch(held, names)
                    held, size = [], 0
        yield as_batch(held, names)

    def as_batch(held: list, names: list[str]) -> pa.RecordBatch:
        keys, n = _merged(held)
        words = pa.array(names, pa.string()).take(pa.array(keys // max(v, 1), pa.int64()))
        return pa.RecordBatch.from_arrays([words, pa.array((keys % max(v, 1)).astype(np.int32)), pa.array(n)], ["word", "context", "n"])

    return rows.select("text").mapInArrow(run, "word string, context int, n long").groupBy("word", "context").agg(F.sum("n").alias("n"))


def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, of = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(of, np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)


def skip_grams(counts: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(word vectors, context vectors) by skip-gram with negative sampling on a matrix of counts, word x context: gradient steps
    (Adam) on the sum over all pairs and the expected negatives; each word weighs the same."""
    v, c = counts.shape
    rng = np.random.default_rng(1)
    rows = counts.sum(1, keepdims=True).astype(np.float32)
    seen = (counts / np.maximum(rows, 1)).astype(np.float32)
    noise = counts.sum(0).astype(np.float32) ** 0.75
    noise = (NEGATIVES * noise / max(float(noise.sum()), 1.0))[None, :] * (rows > 0)
    w = [rng.normal(0, 0.3, (v, DIMENSIONS)).astype(np.float32), rng.normal(0, 0.3, (c, DIMENSIONS)).astype(np.float32)]
    m, s = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[0] @ w[1].T, -30, 30)))
        g = (seen + noise) * p - seen
        for k, d in enumerate((g @ w[1], g.T @ w[0] * (c / max(v, 1)))):
            m[k] = 0.9 * m[k] + 0.1 * d
            s[k] = 0.99 * s[k] + 0.01 * d * d
            w[k] -= 0.1 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)
    return w[0], w[1]


@dataclass
class Knowledge:
    """What was learned. Lexicon and vectors are bounded by FREQUENT and TARGET_WORDS; ``suspects`` is a table (word, meant): rare
    words with what they may mean, best first. It stays distributed; a text's own suspects come to it by a join."""

    lexicon: dict[str, int] = field(default_factory=dict)
    vectors: dict[str, np.ndarray] = field(default_factory=dict)
    suspects: DataFrame | None = None


def learn(rows: DataFrame) -> Knowledge:
    counts = checkpoint(count_words(rows))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(5, FREQUENT * total)
    lexicon = {r[0]: r[1] for r in counts.where(F.col("n") >= least).where(r"word rlike '^\\p{L}+$'").collect()}  # 1 / FREQUENT words at most
    targets = sorted(lexicon, key=lambda w: (-lexicon[w], w))[:TARGET_WORDS]
    contexts = targets[:VECTOR_WORDS]
    around = checkpoint(surroundings(rows, lexicon, targets, contexts))
    number = {w: k for k, w in enumerate(targets)}
    # the matrix is bounded by the numbers of target and context words
    known = around.join(F.broadcast(rows.sparkSession.createDataFrame([(w,) for w in targets], "word string")), "word", "left_semi").toArrow()
    matrix = np.zeros((len(targets), len(contexts)), np.float32)
    matrix[[number[w] for w in known.column("word").to_pylist()], known.column("context").to_numpy()] = known.column("n").to_numpy()
    words, beside = skip_grams(matrix)
    suspects = checkpoint(linked(counts, around, lexicon, number, words, beside))
    return Knowledge(lexicon, dict(zip(targets, words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9))), suspects)


def linked(counts: DataFrame, around: DataFrame, lexicon: dict[str, int], number: dict[str, int], words: np.ndarray, beside: np.ndarray) -> DataFrame:
    """(word, meant): the rare words' candidates by glyph edits and counts that are also neighbours by the vectors."""
    shift = math.log(NEGATIVES)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for w, n, context, times in zip(*(c.to_pylist() for c in batch.columns)):
                fits = [(fit(m, context or [], times or []), k, m) for k, m in enumerate(meant_by(w, lexicon, n))]
                fits = [(-f, k, m) for f, k, m in fits if f > 0 or f == 0 and not context]
                if fits:
                    got.append((w, [m for _, _, m in sorted(fits)]))
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in got], pa.string()), pa.array([m for _, m in got], pa.list_(pa.string()))], ["word", "meant"])

    def fit(meant: str, context: list[int], times: list[int]) -> float:
        """The mean log ratio of a context beside the candidate to its chance; 0 if nothing is known of either."""
        k = number.get(meant)
        if k is None or not context:
            return 0.0 if not context else 1e-9
        return float(np.average(beside[context] @ words[k], weights=times)) + shift

    rare = counts.where(F.length("word") >= 2).mapInArrow(_rare(lexicon), "word string, n long")
    lists = around.groupBy("word").agg(F.collect_list(F.struct("context", "n")).alias("c")).select("word", F.col("c.context").alias("context"), F.col("c.n").alias("times"))
    return rare.join(lists, "word", "left").select("word", "n", "context", "times").mapInArrow(link, "word string, meant array<string>")


def _rare(lexicon: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [k for k, (w, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())) if meant_by(w, lexicon, n)]
            yield batch.take(pa.array(keep, pa.int64()))

    return run


class Cleaner:
    def __init__(self, k: Knowledge):
        self.k = k
        self.linker = Linker(k.lexicon)
        self.by_length: dict[int, list[str]] = {}
        for w in k.lexicon:
            self.by_length.setdefault(len(w), []).append(w)

    def fits(self, candidates: list[str], around: list[str]) -> str:
        """The candidate whose vector is nearest to the words around; the most frequent if nothing is known of them."""
        vectors = self.k.vectors
        near = [vectors[w] for w in around if w in vectors]
        known = [c for c in candidates if c in vectors]
        if not near or not known or len(candidates) == 1:
            return candidates[0]
        mean = np.mean(near, axis=0)
        return max(known, key=lambda c: float(mean @ vectors[c]))

    def noise(self, text: str) -> list[str]:
        """Kinds of noise in a text but for misread words: broken, unreadable, furniture."""
        kinds = []
        if _UNREADABLE.search(text):
            kinds.append("unreadable")
        if "\n" in text:
            if any(not self.compound(m) for m in _BROKEN.finditer(text)) or self.broken_at_end(text):
                kinds.append("broken")
            if self.furniture(text.split("\n")):
                kinds.append("furniture")
        return kinds

    def doubtful(self, text: str) -> list[str]:
        """Words that may be misread by their glyphs; the table of suspects decides."""
        known, possible, lexicon = self.linker.known, self.linker.possible, self.k.lexicon
        return [w for w in set(words_of(text)) if w not in lexicon and (known[w] if w in known else possible(w))]

    def compound(self, m: re.Match) -> bool:
        """A hyphen of the word's own: both halves are words and the joined one isn't."""
        lexicon = self.k.lexicon
        return m[2] in "-‐‑" and m[1] + m[3] not in lexicon and m[1].lower() + m[3] not in lexicon and (m[1] in lexicon or m[1].lower() in lexicon) and m[3] in lexicon

    def broken_at_end(self, text: str) -> bool:
        return bool(re.search(rf"[{_L}]{{2,}}[\xad¬][ \t]*(?:\n|$)", text))

    def furniture(self, lines: list[str]) -> list[int]:
        """Numbers of the lines that are page numbers or running heads: they stand between, before or after wrapped lines."""
        if len(lines) < 2:
            return []
        out, stripped = [], [x.strip() for x in lines]
        fenced, body = False, []
        for k, x in enumerate(stripped):
            if x.startswith("```"):
                fenced = not fenced
            if x and not fenced and (_NUMBER_LINE.match(x) or _HEAD_NUMBER.match(x) and not x.startswith("|")):
                out.append(k)
            elif x and not fenced and not _STRUCTURE.search(x):
                body.append(k)
        if len(body) < 2:
            return out if len(body) or len(out) < len([x for x in stripped if x]) else []
        plain = set(body)
        # under greedy wrapping the next line's first word would not have fitted; a line that is much shorter is a head
        for run in _runs(lines, plain | set(out)):
            wrapped = [k for k in run if k in plain]
            if len(wrapped) < 3:
                caps = [k for k in wrapped if _capitals(stripped[k])] if len(run) > 1 else []
                out += caps
                continue
            width = sorted(len(stripped[k]) for k in wrapped)[int(0.8 * (len(wrapped) - 1))]
            for i, k in enumerate(wrapped):
                x = stripped[k]
                if _capitals(x):
                    out.append(k)
                    continue
                if _STOP.search(x) or x[-1] in ",，、" or x[-1] in HYPHENS or x[:1].islower() or x[:1].isdigit() and not _HAN.search(x):
                    continue
                if i == 0 and k + 1 not in out:
                    continue  # a text may begin inside a line
                last = i == len(wrapped) - 1
                follow = stripped[wrapped[i + 1]] if not last else ""
                word = follow[:1] if _HAN.match(follow) else follow.split(" ")[0]
                before = stripped[wrapped[i - 1]] if i else ""
                short = len(x) + 1 + len(word) < 0.9 * width if not last else len(x) < 0.9 * width
                if _HAN.search(x):
                    if len(x) < width - 2 and not re.search(r"[，。、；]", x) and (i == 0 or not last or _STOP.search(before)):
                        out.append(k)
                elif short and "," not in x[:-1].replace(", ", "", 1) and not re.search(r"[.;!?] ", x) and (follow[:1].islower() or not last and not _STOP.search(before) and i > 0 or i == 0 and not last or last and _STOP.search(before)):
                    out.append(k)
        return sorted(set(out))

    def correct(self, text: str, suspects: dict[str, list[str]]) -> str:
        found = list(WORD.finditer(text))
        parts, done = [], 0
        for i, m in enumerate(found):
            if m[0] in suspects:
                around = [found[j][0] for j in range(max(0, i - WINDOW), min(len(found), i + WINDOW + 1)) if j != i]
                parts += [text[done : m.start()], self.fits(suspects[m[0]], around)]
                done = m.end()
        return "".join(parts) + text[done:]

    def fill(self, text: str) -> str:
        """Words with one or two unreadable letters get the only or best fitting frequent word."""

        def one(m: re.Match) -> str:
            w = m[0]
            if not any(c.isalpha() for c in w) or len(w) < 3:
                return w
            shape = re.compile("".join("." if _UNREADABLE.match(c) else re.escape(c) for c in w) + r"\Z")
            fits = [x for x in self.by_length.get(len(w), ()) if shape.match(x)]
            return self.fits(sorted(fits, key=lambda x: (-self.k.lexicon[x], x)), words_of(text[max(0, m.start() - 30) : m.end() + 30])) if fits else w

        return re.sub(rf"[{_L}{UNREADABLE}]*[{UNREADABLE}][{_L}{UNREADABLE}]*", one, text)

    def repair(self, text: str, suspects: dict[str, list[str]] | None = None) -> str:
        if not text.strip():
            return text
        lines = text.split("\n")
        gone = set(self.furniture(lines))
        text = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        text = _BROKEN.sub(lambda m: f"{m[1]}-{m[3]}" if self.compound(m) else m[1] + m[3], text)
        text = re.sub(rf"(?<=[{_L}])[\xad¬](?=[{_L}])", "", text)
        out: list[str] = []
        fenced, fresh = False, True
        for x in text.split("\n"):
            if x.strip().startswith("```"):
                fenced, fresh = not fenced, True
                out.append(x)
            elif fenced or not x.strip() or _STRUCTURE.search(x.strip()):
                out.append(x)
                fresh = True
            elif fresh:
                out.append(x.strip())
                fresh = False
            else:
                x = x.strip()
                glue = "" if _HAN.match(x) or re.match(r"[，。、；：！？）]", x) or out[-1] and (_HAN.match(out[-1][-1]) or out[-1][-1] in "，。、；：") and not x[:1].isascii() or out[-1] and out[-1][-1].isdigit() and _HAN.search(out[-1]) else " "
                out[-1] += glue + x
        text = "\n".join(out)
        if _UNREADABLE.search(text):
            text = self.fill(text)
        return (self.correct(text, suspects) if suspects else text).replace("ﬁ", "fi").replace("ﬂ", "fl")


def _runs(lines: list[str], among: set[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for k in sorted(among):
        if out and out[-1][-1] == k - 1:
            out[-1].append(k)
        else:
            out.append([k])
    return out


def _capitals(x: str) -> bool:
    letters = [c for c in x if c.isalpha() and c.upper() != c.lower()]
    return 8 <= len(letters) <= 90 and " " in x.strip() and all(c.isupper() for c in letters) and not _STOP.search(x)


def items(blocks: DataFrame, pages: DataFrame, fragments: DataFrame) -> DataFrame:
    """(item_table, item_key, text, anomalies): text blocks, page results and fragments with a text."""
    none = F.lit(None).cast("array<string>")
    b = blocks.where("block_type = 'text' and content is not null").select(F.lit("blocks").alias("item_table"), F.col("block_id").alias("item_key"), F.col("content").alias("text"), none.alias("anomalies"))
    p = pages.where("content is not null").select(F.lit("page_results").alias("item_table"), F.col("record_id").cast("string").alias("item_key"), F.col("content").alias("text"), none.alias("anomalies"))
    x = fragments.where("text is not null").select(F.lit("excluded_fragments").alias("item_table"), F.col("fragment_id").cast("string").alias("item_key"), "text", F.col("source_text_anomalies").alias("anomalies"))
    return b.unionByName(p).unionByName(x)


def marks(rows: DataFrame, knowledge: Knowledge) -> DataFrame:
    """(item_table, item_key, kinds, words): noise and doubtful words of the texts that have any; no texts."""
    sent = rows.sparkSession.sparkContext.broadcast(Knowledge(knowledge.lexicon, knowledge.vectors))  # bounded by the lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleaner = None
        for batch in batches:
            cleaner = cleaner or Cleaner(sent.value)
            keep, noise, words = [], [], []
            for k, t in enumerate(batch.column(2).to_pylist()):
                kinds, doubtful = cleaner.noise(t), cleaner.doubtful(t)
                if kinds or doubtful:
                    keep.append(k)
                    noise.append(kinds)
                    words.append(doubtful)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(noise, pa.list_(pa.string())), pa.array(words, pa.list_(pa.string()))], ["item_table", "item_key", "kinds", "words"])

    return rows.select("item_table", "item_key", "text").mapInArrow(run, "item_table string, item_key string, kinds array<string>, words array<string>")


def misread(marked: DataFrame, knowledge: Knowledge) -> DataFrame:
    """(item_table, item_key, word, meant) of the doubtful words that are suspects."""
    return marked.select("item_table", "item_key", F.explode("words").alias("word")).join(knowledge.suspects, "word").select("item_table", "item_key", "word", "meant").distinct()


def repaired(rows: DataFrame, knowledge: Knowledge | None = None) -> DataFrame:
    """(item_table, item_key, noise array<string>, anomalies_confirmed int, repaired_text) once a key.

    A text without noise keeps its text but for the reflow of its lines. anomalies_confirmed counts the recorded anomalies that
    are in the text and hold an unreadable or misread character; wrong ones change nothing. Null texts have no row; empty and
    blank ones come out as they are; long texts are repaired whole; of different texts under one key the greatest counts; an empty
    table gives no rows."""
    rows = once(rows.select("item_table", "item_key", "text", "anomalies"), ["item_table", "item_key"])
    knowledge = knowledge or learn(rows)
    sent = rows.sparkSession.sparkContext.broadcast(Knowledge(knowledge.lexicon, knowledge.vectors))  # bounded by the lexicon
    words = misread(marks(rows, knowledge), knowledge).groupBy("item_table", "item_key").agg(F.collect_list(F.struct("word", "meant")).alias("s"))
    given = rows.join(words, ["item_table", "item_key"], "left").select("item_table", "item_key", "text", "anomalies", F.col("s.word").alias("words"), F.col("s.meant").alias("meant"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleaner = None
        for batch in batches:
            cleaner = cleaner or Cleaner(sent.value)
            noise, confirmed, texts = [], [], []
            for t, recorded, word, meant in zip(*(c.to_pylist() for c in batch.columns[2:])):
                suspects = dict(zip(word, meant)) if word else {}
                noise.append(cleaner.noise(t) + ["misread"] * bool(suspects))
                confirmed.append(sum(1 for a in recorded or () if a and a in t and (_UNREADABLE.search(a) or a in suspects)))
                texts.append(cleaner.repair(t, suspects))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(noise, pa.list_(pa.string())), pa.array(confirmed, pa.int32()), pa.array(texts, pa.string())], ["item_table", "item_key", "noise", "anomalies_confirmed", "repaired_text"])

    return given.mapInArrow(run, "item_table string, item_key string, noise array<string>, anomalies_confirmed int, repaired_text string")


def found(blocks: DataFrame, pages: DataFrame, fragments: DataFrame) -> DataFrame:
    """Texts with noise. Only keys and doubtful words leave the tasks that read the texts."""
    rows = items(blocks, pages, fragments)
    knowledge = learn(rows)
    marked = checkpoint(marks(rows, knowledge))
    keys = ["item_table", "item_key"]
    return marked.where(F.size("kinds") > 0).select(*keys).unionByName(misread(marked, knowledge).select(*keys)).distinct()
