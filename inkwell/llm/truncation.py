"""Text cut off by field limits or on the way.

A record is complete, or cut in one of three ways, and each way leaves its own lengths. The likelihoods are fitted by maximum
likelihood to the records of each source (model) and script:

1. Characters per completion token. The lengths of complete texts are log-normal for their tokens; that of a text cut on its way
   is only known to be more than what is left, so it enters with the survival function (right-censored). The share of censored
   records, mean and deviation are fitted together (EM).
2. Limits. Values of the characters or tokens that occur far more often than their neighbours are candidate limits. A
   right-censored log-normal is fitted to the values (those at limits count as censored), and a value at a limit gets the
   likelihood ratio of the limit's excess against the density there.
3. Ending and finish reason. How often each kind of ending and reason occurs in each class is learned from all records, by EM
   over the counts of equal evidence, beginning from the meaning of the endings.

A record is truncated if the posterior of the three censored classes together is above one half.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import checkpoint

SPIKE = 6.0  # times the neighbours' mean makes a candidate limit
LEAST = 4  # records at a candidate limit
START_SHARE = 3e-5  # a word begins sentences if so many of all sentences begin with it
BIN = 0.005  # of the logarithm of characters per token, in the histograms the fits read
#: Fixed value: words of finish reasons that tell of a limit, letters only, lower case.
LIMIT_WORDS = "length|max|limit|trunc|cutoff|incomplete"
REASONS = ("limit", "error", "none", "stop")
ENDINGS = ("open", "stop", "item", "mid", "continued", "empty")
CLASSES = ("complete", "token_limit", "field_limit", "transfer", "odd_count")
#: What each class shows before any record is seen, counted as PRIOR records: reasons and endings in the order above.
PRIOR = 20.0
_SHARES = np.array([0.88, 0.04, 0.02, 0.05, 0.01])
_REASON = np.array([[0.002, 0.001, 0.06, 0.937], [0.85, 0.02, 0.1, 0.03], [0.001, 0.05, 0.1, 0.849]])
_ENDING = np.array([[0.002, 0.81, 0.12, 0.008, 0.04, 0.02], [0.23, 0.1, 0.02, 0.6, 0.05, 0.0]])
#: The classes keep their meaning: complete texts seldom end open or in mid-sentence, or under a reason that tells of a limit.
_MOST = {"reason": np.array([0.005, 0.01, 1.0, 1.0]), "ending": np.array([0.005, 1.0, 1.0, 0.02, 1.0, 1.0])}
_OF_REASON, _OF_ENDING = np.array([0, 1, 2, 2, 0]), np.array([0, 1, 1, 1, 0])  # the distributions each class uses


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last two columns, content and its code counts, become the ending, the length without a cut's mark, head and starts."""
    for batch in batches:
        ends, bare, heads, starts = [], [], [], []
        text, chars, fences, dollars, table = (batch.column(c).to_pylist() for c in ("content", "n_chars", "fences", "dollars", "open_table"))
        for t, n, f, m, o in zip(text, chars, fences, dollars, table):
            t = t.rstrip()
            ends.append(ending(t, f, m, o))
            mark = _MARKER.search(t, max(0, len(t) - 8))
            bare.append(n - (len(mark[0]) if mark else 0))
            heads.append(t.lstrip()[:40])
            starts.append(sorted({_digits.sub("0", x) for x in _SENTENCE.findall(t)}))
        kept = [batch.column(c) for c in ("record_id", "document_id", "page_idx", "source", "reason", "n_chars", "n_tokens", "script")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(ends, pa.string()), pa.array(bare, pa.int32()), pa.array(heads, pa.string()), pa.array(starts, pa.list_(pa.string()))], _RECORD)


_RECORD = ["record_id", "document_id", "page_idx", "source", "reason", "n_chars", "n_tokens", "script", "ending", "n_bare", "head", "starts"]
_SENTENCE = re.compile(r"(?:[.!?][ \n]+|[。！？]\n*|\n\n)([一-鿿0-9]{2}|[^\s#<|`*一-鿿0-9-][^\s一-鿿]*)")
_digits = re.compile("[0-9]")


def records(pages: DataFrame) -> DataFrame:
    """One row a record_id with all the evidence needs, made in one pass over whole texts; the texts themselves aren't shuffled.
    Of rows with one record_id the greatest by value counts (the latest, where recorded_at is given), so ties don't matter."""
    c = F.coalesce("content", F.lit(""))
    han = F.regexp_count(c, F.lit(r"[一-鿿]"))
    letters = F.lower(F.regexp_replace(F.coalesce("finish_reason", F.lit("")), r"[^A-Za-z]", ""))
    reason = F.when(letters.rlike(LIMIT_WORDS), "limit").when(letters == "error", "error").when(letters.isin("", "unknown"), "none").otherwise("stop")
    table = F.length(c) - F.length(F.substring_index(c, "<table", -1)) - (F.length(c) - F.length(F.substring_index(c, "</table", -1)))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    given = pages.where("record_id is not null").select(
        "record_id", "document_id", "page_idx", F.coalesce("model", F.lit("")).alias("source"), reason.alias("reason"),
        F.char_length(c).alias("n_chars"), F.when(F.col("completion_tokens") > 0, F.col("completion_tokens")).cast("int").alias("n_tokens"),
        F.when(han * 3 > F.char_length(c), "han").otherwise("alphabet").alias("script"), c.alias("content"),
        F.regexp_count(c, F.lit("```")).alias("fences"), F.regexp_count(c, F.lit(r"\$\$")).alias("dollars"), (c.contains("<table") & (table > 0)).alias("open_table"),
    )
    made = given.mapInArrow(_map, f"record_id {kinds['record_id']}, document_id {kinds['document_id']}, page_idx {kinds['page_idx']}, source string, reason string, n_chars int, n_tokens int, script string, ending string, n_bare int, head string, starts array<string>")
    return made.groupBy("record_id").agg(F.max(F.struct(*_RECORD[1:])).alias("r")).select("record_id", "r.*")


def fit_censored(n: int, s1: float, s2: float, censored: list[tuple[float, int]], rounds: int = 60) -> tuple[float, float]:
    """Mean and deviation of log lengths: n values known with sums s1, s2 of the logs and their squares, and counts of values
    known only to be at least a limit. EM; each round replaces the censored logs by their conditional moments."""
    total = n + sum(k for _, k in censored)
    if total == 0:
        return 0.0, 1.0
    mu = s1 / n if n else math.log(max(censored[0][0], 1))
    sd = math.sqrt(max(s2 / n - mu * mu, 1e-4)) if n else 0.5
    for _ in range(rounds):
        a, b = s1, s2
        for limit, k in censored:
            z = (math.log(limit) - mu) / sd
            tail = 0.5 * math.erfc(z / math.sqrt(2))
            hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / tail if tail > 1e-12 else z + 1 / max(z, 1e-6)
            mean = mu + sd * hazard
            a += k * mean
            b += k * (sd * sd * (1 + z * hazard - hazard * hazard) + mean * mean)
        mu, sd = a / total, math.sqrt(max(b / total - (a / total) ** 2, 1e-4))
    return mu, sd


def density(mu: float, sd: float, value: float) -> float:
    z = (math.log(value) - mu) / sd
    return math.exp(-z * z / 2) / (sd * value * math.sqrt(2 * math.pi))


def limits(counts: DataFrame) -> DataFrame:
    """(source, script, measure, value, ratio): candidate limits with the log likelihood ratio that a value there is censored.

    counts: source, measure, script, value, n. A source's values go to one task: as many as its longest text has characters at
    most. No limit is left out."""

    def one(t: pa.Table) -> pa.Table:
        value, n, script = t.column("value").to_numpy(), t.column("n").to_numpy(), np.array(t.column("script").to_pylist(), object)
        at, of = np.unique(value, return_inverse=True)
        total = np.bincount(of, n)
        sums = np.concatenate([[0.0], np.cumsum(total)])
        around = (sums[np.searchsorted(at, at + 20, "right")] - sums[np.searchsorted(at, at - 20)] - total) / 40.0
        spike = (total >= LEAST) & (total >= SPIKE * (around + 0.3))
        rows: list[tuple] = []
        for name in sorted(set(script)):
            mine = script == name
            free, held = mine & ~spike[of], mine & spike[of]
            logs = np.log(value[free])
            if not held.any():
                continue
            mu, sd = fit_censored(int(n[free].sum()), float((n[free] * logs).sum()), float((n[free] * logs * logs).sum()), sorted(zip(value[held].tolist(), n[held].tolist())))
            dens = np.array([density(mu, sd, v) for v in value[held]])
            excess = np.maximum(n[held] - dens * n[mine].sum(), 0.5)
            for v, e, d in zip(value[held].tolist(), excess / excess.sum(), dens):
                rows.append((v, name, math.log(e) - math.log(max(d, 1e-12))))
        first = [t.column(c)[0].as_py() for c in ("source", "measure")]
        return pa.table([pa.array([first[0]] * len(rows), pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([first[1]] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], ["source", "script", "measure", "value", "ratio"])

    return counts.groupBy("source", "measure").applyInArrow(one, "source string, script string, measure string, value int, ratio double")


def whole_and_cut(y: np.ndarray, sd: float) -> tuple[np.ndarray, np.ndarray]:
    """Log densities of y, the log length per token less its mean: of complete texts, and of texts cut anywhere, whose whole
    length is right-censored at what is left (the survival function under a cut position that is uniform)."""
    f = -0.5 * (y / sd) ** 2 - np.log(sd * math.sqrt(2 * math.pi))
    above = 0.5 * np.array([math.erfc(v) for v in np.ravel((y + sd * sd) / sd / math.sqrt(2))]).reshape(np.shape(y))
    return np.maximum(f, -60.0), np.minimum(y + sd * sd / 2 + np.log(np.maximum(above, 1e-26)), 0.0)


def fit_ratio(x: np.ndarray, n: np.ndarray, prior: tuple[float, float] | None = None, rounds: int = 40) -> tuple[float, float]:
    """Mean and deviation of the log of characters per token of complete texts, from a histogram of complete, right-censored
    and odd records, by EM. ``prior`` (of all sources) weighs as much as a few records."""
    order = np.argsort(x)
    x, n = x[order], n[order].astype(float)
    if not len(x):
        return prior or (0.0, 0.1)
    done = np.cumsum(n) / n.sum()
    q = [x[np.searchsorted(done, p)] for p in (0.25, 0.5, 0.75)]
    mu, sd = (prior if prior and n.sum() < 30 else (q[1], max(0.03, (q[2] - q[0]) / 1.35)))
    share = np.array([0.9, 0.07, 0.03])
    for _ in range(rounds):
        f, g = whole_and_cut(x - mu, sd)
        parts = share * np.exp(np.stack([f, g, np.full(len(x), -math.log(6))], 1))
        r = n[:, None] * parts / parts.sum(1, keepdims=True)
        share = (r.sum(0) + 1.0) / (r.sum() + 3.0)
        w, m0, v0, k = r[:, 0], *((prior[0], prior[1] ** 2, 8.0) if prior else (mu, 0.05**2, 2.0))
        mu = float(((w * x).sum() + k * m0) / (w.sum() + k))
        sd = math.sqrt(max(((w * (x - mu) ** 2).sum() + k * v0) / (w.sum() + k), 0.02**2))
    return mu, sd


def ratios(recs: DataFrame) -> DataFrame:
    """(source, script, mu, sd) of the log of characters per token."""
    x = F.round(F.log(F.col("n_chars") / F.col("n_tokens")) / BIN).cast("int").alias("x")
    counts = checkpoint(recs.where("n_tokens > 0 and n_chars > 0").select("source", "script", x).groupBy("source", "script", "x").agg(F.count("*").alias("n")))
    pooled: dict[str, list] = {}
    for r in counts.groupBy("script", "x").agg(F.sum("n").alias("n")).collect():  # two scripts, and bins of a logarithm
        pooled.setdefault(r[0], []).append((r[1] * BIN, r[2]))
    prior = {k: fit_ratio(*map(np.array, zip(*v))) for k, v in pooled.items()}

    def one(t: pa.Table) -> pa.Table:
        source, script = t.column("source")[0].as_py(), t.column("script")[0].as_py()
        mu, sd = fit_ratio(t.column("x").to_numpy() * BIN, t.column("n").to_numpy(), prior.get(script))
        return pa.table({"source": pa.array([source], pa.string()), "script": pa.array([script], pa.string()), "mu": [mu], "sd": [sd]})

    return counts.groupBy("source", "script").applyInArrow(one, "source string, script string, mu double, sd double")


def log_likelihoods(reason: np.ndarray, end: np.ndarray, y: np.ndarray, sd: np.ndarray, tokens: np.ndarray, by_tokens: np.ndarray, by_chars: np.ndarray, p: dict, fg: tuple | None = None) -> np.ndarray:
    """One row a record, one column a class. y and sd are nan where no ratio is known; by_tokens and by_chars are the log
    likelihood ratios at a limit and nan elsewhere; tokens tells whether a count is known."""
    known = ~np.isnan(y)
    f, g = fg or whole_and_cut(np.where(known, y, 0.0), np.where(known, sd, 1.0))
    f, g, odd = np.where(known, f, 0.0), np.where(known, g, 0.0), np.where(known, -math.log(6), 0.0)
    at_t, at_c = ~np.isnan(by_tokens), ~np.isnan(by_chars)
    lt, lc = np.where(at_t, by_tokens, 0.0), np.where(at_c, by_chars, 0.0)
    out = np.log(p["share"]) + np.log(p["reason"])[_OF_REASON][:, reason].T + np.log(p["ending"])[_OF_ENDING][:, end].T
    never = -1e3
    out[:, 0] += f
    out[:, 1] += np.logaddexp(math.log(0.9) + f, math.log(0.1) + odd) + np.where(at_t, math.log(p["at"]) + lt, np.where(tokens, math.log(1 - p["at"]), 0.0))
    out[:, 2] += np.where(at_c, g + lc, never)
    out[:, 3] += g
    out[:, 4] += np.where(at_t, odd + lt, never)
    return out


def learn(cells: list[tuple], rounds: int = 60) -> dict:
    """Shares of the classes, and of reasons and endings in them, by EM over (reason, end, y, sd, tokens, by_tokens, by_chars,
    n): the counts of equal evidence over all records."""
    p = {"share": _SHARES.copy(), "reason": _REASON.copy(), "ending": np.maximum(_ENDING, 1e-9), "at": 0.8}
    if not cells:
        return p
    reason, end, y, sd, tokens, bt, bc, n = (np.array(c) for c in zip(*[tuple(math.nan if v is None else v for v in c) for c in cells]))
    reason, end, tokens = reason.astype(int), end.astype(int), tokens.astype(bool)
    fg = whole_and_cut(np.where(np.isnan(y), 0.0, y), np.where(np.isnan(y), 1.0, sd))
    for _ in range(rounds):
        r = log_likelihoods(reason, end, y, sd, tokens, bt, bc, p, fg)
        r = np.exp(r - r.max(1, keepdims=True))
        r = n[:, None] * r / r.sum(1, keepdims=True)
        p["share"] = (r.sum(0) + PRIOR * _SHARES) / (r.sum() + PRIOR)
        for name, of, begin in (("reason", _OF_REASON, _REASON), ("ending", _OF_ENDING, _ENDING)):
            codes = reason if name == "reason" else end
            got = PRIOR * begin.copy()
            for k, d in enumerate(of):
                got[d] += np.bincount(codes, r[:, k], minlength=begin.shape[1])
            got[1:, -1] *= name == "reason"  # an empty text is never a cut one
            got = got / got.sum(1, keepdims=True)
            got[0] = np.minimum(got[0], _MOST[name])
            p[name] = np.maximum(got, 1e-9)
        at = (r[:, 1] * ~np.isnan(bt)).sum()
        p["at"] = float((at + 0.8 * PRIOR) / ((r[:, 1] * tokens).sum() + PRIOR))
    return p


_FURNITURE = re.compile(r"^\s*(?:\d{1,4}|[—–·•-]\s*\d+\s*[—–·•-]|(?:p\.|[Pp]age|[Ss]eite|[Pp]ágina)\s*\d+.{0,12}|\[\d+\]|第\s*\d+\s*页|[^.!?。]{3,80}(?:\s{3,}|　+)\d{1,4}|\d{1,4}(?:\s*\|\s*|　+)[^.!?。]{3,80})\s*$")
_MARKER = re.compile(r"\s?\[?(?:…|\.\.\.)\]?$")  # left by what cut the text
_STOP = re.compile(r"[.!?。！？][\"”’»)\]）」』*_]*$")
_OPEN_LINK = re.compile(r"!?\[[^\]\n]*(?:\]\([^)\n]*)?$")
_NATURAL = re.compile(r"^\s*(?:#{1,6}\s|[-*+•]\s|\d+[.)]\s|\[\d+\]|\[\^|!\[|\$\$|```)|(?:</\w+>|\$\$|\$|```|\|)\s*$|:$|：$")


def ending(tail: str, fences: int, dollars: int, open_table: bool) -> str:
    """open: surely cut; stop: a natural end; item: a list, heading, table and the like; mid: inside a sentence; empty."""
    lines = tail.rstrip().split("\n")
    while len(lines) > 1:
        last, above = lines[-1].strip(), lines[-2].rstrip()
        # a head line stands alone below a finished line of the same paragraph, or is in capitals
        head = 2 < len(last) < 80 and not _STOP.search(last) and (last.isupper() or bool(_STOP.search(above)) and not _NATURAL.search(last))
        if not (_FURNITURE.match(last) or head or not last):
            break
        lines.pop()
    last = lines[-1].rstrip()
    if not last:
        return "empty"
    if fences % 2 or dollars % 2 or open_table:
        return "open"
    if (m := _MARKER.search(last)) and m.start() and not _STOP.search(last[: m.start()]):
        return "open"
    if _OPEN_LINK.search(last) and not re.match(r"^\s*\[\d+\]", last) or last.startswith("|") and not last.endswith("|"):
        return "open"
    if _STOP.search(last):
        return "stop"
    if _NATURAL.search(last):
        return "item"
    return "mid"


def start_key(head: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(head, r"^([一-鿿0-9]{2}|[^\s一-鿿]+)", 1), r"[0-9]", "0")


def continued(recs: DataFrame) -> DataFrame:
    """(document_id, at, follows): whether the page ``at`` begins in the middle of a sentence: in lower case, or with a word that
    begins none of the sentences of the corpus' pages (as counted over all of them)."""
    starts = recs.select(F.explode("starts").alias("start")).groupBy("start").agg(F.count("*").alias("n"))
    least = F.broadcast(starts.agg((F.sum("n") * START_SHARE).alias("least")))  # one row
    starts = starts.join(least, F.col("n") >= F.greatest(F.col("least"), F.lit(2))).select("start")
    heads = recs.where("head != ''").groupBy("document_id", F.col("page_idx").alias("at")).agg(F.min("head").alias("next_head")).withColumn("start", start_key(F.col("next_head")))
    known = heads.join(starts.withColumn("is_start", F.lit(True)), "start", "left")
    fresh = F.coalesce("is_start", F.lit(False)) | F.col("next_head").rlike(r"^[#\-*|<`$•!\[]|^[0-9]+[.)] ")
    return known.select("document_id", "at", (F.col("next_head").rlike(r"^\p{Ll}") | ~fresh).alias("follows"))


def evidence(pages: DataFrame) -> DataFrame:
    """What the classes are told apart by, once a record_id."""
    recs = checkpoint(records(pages))
    value = lambda m, c: F.struct(F.lit(m).alias("measure"), F.col(c).alias("value"))
    counts = recs.select("source", "script", F.explode(F.array(value("chars", "n_bare"), value("tokens", "n_tokens"))).alias("m")).select("source", "script", "m.*").where("value > 0")
    spikes = checkpoint(limits(counts.groupBy("source", "measure", "script", "value").agg(F.count("*").alias("n"))))
    at = lambda m, c: spikes.where(F.col("measure") == m).select("source", "script", F.col("value").alias(c), F.round("ratio", 1).alias(f"by_{m}"))
    known = continued(recs).select(F.col("document_id").alias("d"), "at", "follows")
    out = recs.join(known, (F.col("document_id") == F.col("d")) & (F.col("page_idx") + 1 == F.col("at")), "left").drop("d", "at", "starts", "head")
    out = out.join(ratios(recs), ["source", "script"], "left").join(at("tokens", "n_tokens"), ["source", "script", "n_tokens"], "left").join(at("chars", "n_bare"), ["source", "script", "n_bare"], "left")
    y = F.when((F.col("n_tokens") > 0) & (F.col("n_chars") > 0), F.round(F.log(F.col("n_chars") / F.col("n_tokens")) - F.col("mu"), 2))
    ends = F.when((F.col("ending") == "mid") & F.coalesce("follows", F.lit(False)), "continued").otherwise(F.col("ending"))
    code = lambda c, names: F.array_position(F.array(*map(F.lit, names)), c).cast("int") - 1
    return out.select("record_id", F.col("source").alias("model"), "reason", "n_chars", "n_tokens", ends.alias("ending"), code(F.col("reason"), REASONS).alias("r"), code(ends, ENDINGS).alias("e"), y.alias("y"), F.when(y.isNotNull(), F.round("sd", 3)).alias("sd"), F.col("n_tokens").isNotNull().alias("t"), "by_tokens", "by_chars")


_CELL = ["r", "e", "y", "sd", "t", "by_tokens", "by_chars"]


def scored(pages: DataFrame) -> DataFrame:
    """(record_id, model, reason, n_chars, n_tokens, ending, score, truncated) once a record_id; score: log odds of a cut.

    Null finish reasons and token counts are unknown evidence; null and empty contents are not truncated; a null model is a
    source of its own; rows delivered twice count once; null record_ids are left out; other columns are not read; an empty table gives no rows."""
    known = checkpoint(evidence(pages))
    y = F.when(F.col("y").isNotNull(), F.greatest(F.lit(-3.0), F.least(F.lit(1.0), F.round(F.col("y") * 50) / 50)))
    coarse = {"y": y, "sd": F.least(F.lit(0.5), F.round("sd", 2)), "by_tokens": F.round("by_tokens"), "by_chars": F.round("by_chars")}
    # equal evidence, rounded: the product of the roundings bounds the cells, whatever the number of records
    cells = [tuple(r) for r in known.select(*[coarse.get(c, F.col(c)).alias(c) for c in _CELL]).groupBy(*_CELL).count().collect()]
    fitted = learn(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [batch.column(c).to_numpy(zero_copy_only=False) for c in _CELL]
            real = [np.array(x, float) if k in (2, 3, 5, 6) else x for k, x in enumerate(got)]
            ll = log_likelihoods(*real[:4], real[4].astype(bool), *real[5:], fitted)
            score = np.logaddexp.reduce(ll[:, 1:4], 1) - np.logaddexp(ll[:, 0], ll[:, 4])
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(score), pa.array(score > 0)], ["record_id", "model", "reason", "n_chars", "n_tokens", "ending", "score", "truncated"])

    kind = pages.schema["record_id"].dataType.simpleString()
    return known.mapInArrow(run, f"record_id {kind}, model string, reason string, n_chars int, n_tokens int, ending string, score double, truncated boolean")


def report(scores: DataFrame) -> DataFrame:
    """Per model: records, truncated records and their share."""
    return scores.groupBy("model").agg(F.count("*").alias("records"), F.sum(F.col("truncated").cast("long")).alias("truncated"), F.avg(F.col("truncated").cast("double")).alias("share"))


def found(pages: DataFrame) -> DataFrame:
    return scored(pages).where("truncated").select("record_id")
