"""Sparse, dense and fused ranking. All questions are ranked in one plan; scores are ordered by round(score, 9), then id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import tokens
from inkwell.operators.units import SEPARATOR

K1, B = 1.5, 0.75
QUERY_BLOCK, UNIT_BLOCK = 1024, 4096  # queries and units whose scores are in a worker's memory at once (32 MB)
QUESTION_BLOCK = 8192  # questions of BM25, whose scores are held one question at a time


def postings(units: DataFrame, unit: str = "unit_id", text: str = "retrieval_text") -> DataFrame:
    """(unit_id, term, tf, dl)."""
    t = units.select(F.col(unit).alias("unit_id"), tokens(F.col(text)).alias("t"))
    terms = t.select("unit_id", F.size("t").alias("dl"), F.explode("t").alias("term"))
    return terms.groupBy("unit_id", "term").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def index_statistics(post: DataFrame) -> DataFrame:
    """One row: units with a token, and their average length."""
    lengths = post.groupBy("unit_id").agg(F.first("dl").alias("dl"))
    return lengths.agg(F.count("*").alias("units"), F.avg("dl").alias("avgdl"))


def bm25(post: DataFrame, questions: DataFrame, question: str = "question_id", text: str = "question") -> DataFrame:
    """(question_id, unit_id, score): every unit that shares a term. A term asked twice counts twice. Scores are summed before
    the shuffle, so a frequent term moves one partial sum a question and unit, not one row a posting."""
    asked = questions.select(F.col(question).alias("question_id"), F.explode(tokens(F.col(text))).alias("term")).groupBy("question_id", "term").agg(F.count("*").alias("qf"))
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    s = F.broadcast(index_statistics(post))  # one row
    wanted = asked.join(df, "term")
    hit = post.join(wanted, "term").join(s)
    idf = F.log(1 + (F.col("units") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("qf") * idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return hit.groupBy("question_id", "unit_id").agg(F.sum(part).alias("score"))


def _filled(batches: Iterator[pa.RecordBatch], size: int, pack) -> Iterator[pa.RecordBatch]:
    """Rows, ``size`` at a time, as one packed row each (``pack`` makes it of a table)."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == size:
                yield from pack(pa.Table.from_batches(held)).to_batches()
                held, n = [], 0
    if n:
        yield from pack(pa.Table.from_batches(held)).to_batches()


def _blocks(rows: DataFrame, order: list[str], size: int, pack, schema: str) -> DataFrame:
    """``_filled`` over the rows of each partition."""
    return rows.select(*order).mapInArrow(lambda batches: _filled(batches, size, pack), schema)


def _best(scores: np.ndarray, k: int, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, columns of its k best scores above ``least``), ties to the smaller column."""
    cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k] if scores.shape[1] > k else np.full(len(scores), -np.inf)
    for row, low in enumerate(cut):
        at = np.flatnonzero((scores[row] >= low) & (scores[row] > least))
        yield row, at[np.argsort(-scores[row, at], kind="stable")[:k]]


def _one(values, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


_UNITS = "ids array<string>, dl array<int>, terms array<string>, starts array<int>, at array<smallint>, tf array<int>"


def _pack_units(t: pa.Table) -> pa.Table:
    t = t.sort_by("unit_id")
    col = t.column("t").combine_chunks()
    lengths = np.diff(col.offsets.to_numpy())
    coded = col.flatten().dictionary_encode()
    terms, n = coded.dictionary, t.num_rows
    key, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + np.repeat(np.arange(n), lengths), return_counts=True) if len(coded) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    starts = np.searchsorted(key // n, np.arange(len(terms) + 1))
    return pa.table([_one(t.column("unit_id").to_pylist(), pa.string()), _one(lengths.astype(np.int32), pa.int32()), _one(terms.to_pylist(), pa.string()), _one(starts.astype(np.int32), pa.int32()), _one((key % n).astype(np.int16), pa.int16()), _one(tf.astype(np.int32), pa.int32())], ["ids", "dl", "terms", "starts", "at", "tf"])


def unit_blocks(units: DataFrame, unit: str = "unit_id", text: str = "retrieval_text") -> DataFrame:
    """Units packed into blocks of postings sorted by term: ids, dl, terms, and for term n ``at`` (places in ids) and ``tf`` from
    starts[n] to starts[n + 1]. All that BM25 needs of the texts, in less room than the texts."""
    read = units.select(F.col(unit).cast("string").alias("unit_id"), tokens(F.col(text)).alias("t"))
    return _blocks(read, ["unit_id", "t"], UNIT_BLOCK, _pack_units, _UNITS)


def chunk_blocks(atoms: DataFrame, max_chars: int = 1200) -> DataFrame:
    """``unit_blocks`` of ``fixed_chunks``, without a further shuffle of texts: the window that gave atoms their positions has put a
    document's atoms into one partition, where they are sorted and packed as they pass. The blank line between atoms is white
    space, so a unit's tokens are those of its atoms, one after another. ``atoms`` are those of ``units.atoms``."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        article, used, g = None, 0, 0
        name, held = None, []  # of the unit that isn't ended

        def out(ids: list[str], lists: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), lists], ["unit_id", "t"])

        def ended() -> pa.RecordBatch:
            values = pa.concat_arrays(held)
            return out([name], pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))

        for batch in batches:
            cuts, names = [], []
            for i, (a, n) in enumerate(zip(batch.column("article_id").to_pylist(), batch.column("n").to_pylist())):
                if a != article:
                    article, used, g = a, n, 1
                elif used + n + SEPARATOR > max_chars:
                    used, g = n, g + 1
                else:
                    used += n + SEPARATOR
                    continue
                cuts.append(i)
                names.append(f"t0-{a}-{str(g).rjust(5, '0')[:5]}")  # as lpad
            t = batch.column("t")
            at, values = t.offsets.to_numpy(), t.values
            piece = lambda i, j: values.slice(at[i], at[j] - at[i])  # noqa: E731, B023
            if name is not None:
                held.append(piece(0, cuts[0] if cuts else len(t)))
            if cuts:
                if name is not None:
                    yield ended()
                if len(cuts) > 1:
                    yield out(names[:-1], pa.ListArray.from_arrays(pa.array(at[cuts], pa.int32()), values))
                name, held = names[-1], [piece(cuts[-1], len(t))]
        if name is not None:
            yield ended()

    read = atoms.select("article_id", "pos", "n", "text").sortWithinPartitions("article_id", "pos").select("article_id", "n", tokens(F.col("text")).alias("t"))
    return read.mapInArrow(lambda batches: _filled(chunks(batches), UNIT_BLOCK, _pack_units), _UNITS)


def bm25_top_k(units: DataFrame, questions: DataFrame, k: int, unit: str = "unit_id", unit_text: str = "retrieval_text", question: str = "question_id", text: str = "question") -> DataFrame:
    """(question_id, unit_id, score): the k best of ``bm25`` per question and block of units, a superset of the k best.

    Units are packed into blocks of postings sorted by term, questions into blocks of weighted terms; each pair of blocks is
    scored in memory, question by question, and sends k rows a question on at most. No posting and no partial sum is shuffled: only
    the document frequencies and what each block ranks best. Blocks are bounded in rows, so memory is too."""
    read = units.select(tokens(F.col(unit_text)).alias("t"))
    s = read.where("size(t) > 0").agg(F.count("*").alias("units"), F.avg(F.size("t")).alias("avgdl"))
    df = read.select(F.explode(F.array_distinct("t")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return _scored(unit_blocks(units, unit, unit_text), s, df, questions, k, question, text)


def bm25_top_k_of_blocks(blocks: DataFrame, questions: DataFrame, k: int, question: str = "question_id", text: str = "question") -> DataFrame:
    """``bm25_top_k`` of ``unit_blocks``, which should be checkpointed: frequencies and lengths are read off the blocks too."""
    s = blocks.select(F.explode("dl").alias("dl")).where("dl > 0").agg(F.count("*").alias("units"), F.avg("dl").alias("avgdl"))
    df = blocks.select(F.expr("inline(transform(terms, (t, i) -> struct(t as term, starts[i + 1] - starts[i] as n)))")).groupBy("term").agg(F.sum("n").alias("df"))
    return _scored(blocks, s, df, questions, k, question, text)


def _scored(u: DataFrame, s: DataFrame, df: DataFrame, questions: DataFrame, k: int, question: str, text: str) -> DataFrame:
    asked = questions.select(F.col(question).cast("string").alias("question_id"), F.explode(tokens(F.col(text))).alias("term")).groupBy("question_id", "term").agg(F.count("*").alias("qf"))
    idf = F.log(1 + (F.col("units") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.join(df, "term").join(F.broadcast(s)).select("question_id", "term", (F.col("qf") * idf).alias("w"), "avgdl")  # one row
    lists = weighed.groupBy("question_id").agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("w"), F.first("avgdl").alias("avgdl"))

    def pack_questions(t: pa.Table) -> pa.Table:
        who, terms, w = t.column("question_id").to_pylist(), t.column("terms").combine_chunks(), t.column("w").combine_chunks()
        return pa.table([_one(who, pa.string()), _one(np.repeat(np.arange(len(who), dtype=np.int32), np.diff(terms.offsets.to_numpy())), pa.int32()), _one(terms.flatten().to_pylist(), pa.string()), _one(w.flatten().to_numpy(), pa.float64()), pa.array([t.column("avgdl")[0].as_py()], pa.float64())], ["who", "row", "asked", "w", "avgdl"])

    q = _blocks(lists, ["question_id", "terms", "w", "avgdl"], QUESTION_BLOCK, pack_questions, "who array<string>, row array<int>, asked array<string>, w array<double>, avgdl double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows: dict[str | None, np.ndarray] = {}  # of each block of questions, by its first: the k-th best score of any block of units so far
        held, post = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, dl, terms, starts, at, tf, who, row, asked, w, avgdl = (batch.column(c)[i] for c in range(11))
                if held is None or not held.equals(ids.values):  # a block of units comes once for each block of questions
                    held, post = ids.values, _parts(*(x.values.to_numpy() for x in (dl, starts, at, tf)), avgdl.as_py())
                low = lows.setdefault(who.values[0].as_py(), np.zeros(len(who.values)))
                number = pc.index_in(asked.values, value_set=terms.values).fill_null(-1).to_numpy(zero_copy_only=False)
                yield _taken(who.values, ids.values, *_ranked(*post, len(ids.values), row.values.to_numpy(), number, w.values.to_numpy(), low, k))

    # a stated set of questions against all units, block by block; in few parts of the units, as each part sends k rows a question on
    few = u.coalesce(2 * u.sparkSession.sparkContext.defaultParallelism)
    return few.crossJoin(q).mapInArrow(score, "question_id string, unit_id string, score double")


def _parts(dl: np.ndarray, starts: np.ndarray, at: np.ndarray, tf: np.ndarray, avgdl: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, places, what each posting gives a term of weight 1, the most a term gives any unit)."""
    at, tf = at.astype(np.intp), tf.astype(np.float64)
    part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl[at] / avgdl)) if len(at) else tf
    return starts, at, part, np.maximum.reduceat(part, starts[:-1]) if len(at) else part


def _ranked(starts: np.ndarray, at: np.ndarray, part: np.ndarray, most: np.ndarray, units: int, row: np.ndarray, number: np.ndarray, w: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, unit, score) of the k best units of each question, without those under ``low``, which is raised. A question whose
    terms can't reach its ``low`` together is passed over: k units elsewhere are better than all of these."""
    there = number >= 0
    row, number, w = row[there], number[there], w[there]
    reach = np.bincount(row, w * most[number], len(low)) if len(row) else np.zeros(len(low))
    ends = np.searchsorted(row, np.arange(len(low) + 1))
    a, b, w = starts[number].tolist(), starts[number + 1].tolist(), w.tolist()
    sums, rows, cols, scores = np.zeros(units), [], [], []
    for r in np.flatnonzero((reach > 0) & (reach > low - 1e-8)).tolist():
        sums[:] = 0
        for n in range(ends[r], ends[r + 1]):
            sums[at[a[n] : b[n]]] += w[n] * part[a[n] : b[n]]
        c = np.flatnonzero(sums > max(low[r] - 1e-8, 0))
        s = np.round(sums[c], 9)
        if len(c) > k:
            cut = np.partition(s, len(s) - k)[len(s) - k]
            low[r] = max(low[r], cut)
        keep = (s >= low[r]) & (s > 0)
        c, s = c[keep], s[keep]
        best = np.argsort(-s, kind="stable")[:k]  # ties to the smaller id
        rows.append(np.full(len(best), r))
        cols.append(c[best])
        scores.append(s[best])
    return tuple(np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((rows, np.intp), (cols, np.intp), (scores, np.float64)))


def _taken(who: pa.Array, ids: pa.Array, r: np.ndarray, c: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([who.take(pa.array(r)), ids.take(pa.array(c)), pa.array(scores)], ["question_id", "unit_id", "score"])


def _hits(scores: np.ndarray, who: pa.Array, ids: pa.Array, k: int, least: float) -> pa.RecordBatch:
    rows, cols = [], []
    for row, at in _best(scores, k, least):
        rows.append(np.full(len(at), row))
        cols.append(at)
    r, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, cols))
    return _taken(who, ids, r, c, scores[r, c])


def top_k(scores: DataFrame, k: int, score: Column | None = None, ties: list[str] | None = None) -> DataFrame:
    """Rank 1 to k per question, by falling rounded score, then id."""
    order = W.partitionBy("question_id").orderBy(F.desc(F.round(score if score is not None else F.col("score"), 9)), *(ties or ["unit_id"]))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def zero_padded(hits: DataFrame, questions: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """Lists shorter than k are filled with units of score 0 in order of id. The k smallest ids hold enough of them for any
    question, so nothing is crossed with the corpus."""
    first = units.select("unit_id").distinct().orderBy("unit_id").limit(k)
    short = questions.select("question_id").distinct().join(hits.groupBy("question_id").agg(F.count("*").alias("n")), "question_id", "left").where(f"coalesce(n, 0) < {k}").select("question_id")
    fill = short.join(F.broadcast(first)).join(hits.select("question_id", "unit_id"), ["question_id", "unit_id"], "left_anti").withColumn("score", F.lit(0.0))  # k rows a short list
    return hits.select("question_id", "unit_id", "score").unionByName(fill)


def padded(ranked: DataFrame, questions: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """Ranked lists (question_id, unit_id, score, rank), the short ones filled as in ``zero_padded``; lists of k aren't touched."""
    first = units.select("unit_id").distinct().orderBy("unit_id").limit(k)
    sizes = ranked.groupBy("question_id").agg(F.max("rank").alias("n"))
    short = questions.select("question_id").distinct().join(sizes, "question_id", "left").select("question_id", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < k)
    fill = short.join(F.broadcast(first)).join(ranked.select("question_id", "unit_id"), ["question_id", "unit_id"], "left_anti")  # k rows a short list
    place = F.col("n") + F.row_number().over(W.partitionBy("question_id").orderBy("unit_id"))
    fill = fill.select("question_id", "unit_id", F.lit(0.0).alias("score"), place.alias("rank")).where(F.col("rank") <= k)
    return ranked.select("question_id", "unit_id", "score", "rank").unionByName(fill)


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(question_id, unit_id, score, rank): exact cosine of every query with every other vector; 0 where a norm is 0.

    Vectors and queries are packed into blocks of bounded size, and each pair of blocks is one matrix product that sends k rows a
    query on. It is one plan: nothing comes to the driver, and the vectors are read once."""
    kind = vectors.schema[key].dataType.simpleString()
    arrow = pa.string() if kind == "string" else pa.int64()
    ident = "string" if kind == "string" else "bigint"

    def packed(df: DataFrame, size: int, ids: str, values: str) -> DataFrame:
        def pack(t: pa.Table) -> pa.Table:
            t = t.sort_by("id")
            return pa.table([_one(t.column("id").to_pylist(), arrow), _one(t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), pa.float64())], [ids, values])

        rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast(ident).alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return _blocks(rows, ["id", "v"], size, pack, f"{ids} array<{ident}>, {values} array<double>")

    def unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.where(norm > 0, x / np.maximum(norm, 1e-300), 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, v, who, q = (batch.column(c)[i].values for c in range(4))
                s = np.round(unit(q.to_numpy().reshape(len(who), -1)) @ unit(v.to_numpy().reshape(len(ids), -1)).T, 9)
                place = {x: n for n, x in enumerate(ids.to_pylist())}
                for r, x in enumerate(who.to_pylist()):
                    if x in place:
                        s[r, place[x]] = -np.inf
                yield _hits(s, who, ids, k, -np.inf)

    pairs = packed(vectors, UNIT_BLOCK, "ids", "v").crossJoin(packed(queries, QUERY_BLOCK, "who", "q"))  # a stated set against all, in blocks
    return top_k(pairs.mapInArrow(score, f"question_id {ident}, unit_id {ident}, score double"), k)


def hashed_vectors(rows: DataFrame, key: str, text: str, size: int = 64) -> DataFrame:
    """(key, embedding): a plain encoder without a model: each distinct word adds 1 or -1 to one of ``size`` places, both taken
    from the word's SHA-256. Another encoder is any DataFrame of the same form."""
    h = F.sha2(F.col("w"), 256)
    place = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(size))
    sign = F.when(F.substring(h, 9, 1) < "8", 1.0).otherwise(-1.0)
    words = rows.select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("w")).select(key, place.cast("int").alias("i"), sign.alias("x"))
    sums = words.groupBy(key, "i").agg(F.sum("x").alias("x")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", "x"))).alias("m"))
    return sums.select(key, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda n: F.coalesce(F.try_element_at("m", n), F.lit(0.0))).alias("embedding"))


def dense_hits(units: DataFrame, questions: DataFrame, k: int, encode=hashed_vectors) -> DataFrame:
    """(question_id, unit_id, rank, score) by exact cosine of encoded texts."""
    u = encode(units.select("unit_id", "retrieval_text"), "unit_id", "retrieval_text")
    q = encode(questions.select(F.col("question_id").alias("unit_id"), "question"), "unit_id", "question")
    return cosine_top_k(u, q, k, "unit_id", "embedding")


def fuse(lists: DataFrame, k: int = 60, limit: int = 50, weight: Column | None = None) -> DataFrame:
    """Reciprocal rank fusion of (question_id, list, unit_id, rank): the sum of weight / (k + rank)."""
    w = weight if weight is not None else F.lit(1.0)
    return top_k(lists.groupBy("question_id", "unit_id").agg(F.sum(w / (F.lit(k) + F.col("rank"))).alias("score")), limit)


def rerank(fused: DataFrame, questions: DataFrame, units: DataFrame, keep: int = 20) -> DataFrame:
    """Reorders fused hits by the share of the question's distinct words in the unit; ties by fused rank, then id."""
    q = questions.select("question_id", F.array_distinct(tokens(F.col("question"))).alias("q"))
    u = units.select("unit_id", F.array_distinct(tokens(F.col("retrieval_text"))).alias("u"))
    s = fused.select("question_id", "unit_id", F.col("rank").alias("fused_rank")).join(q, "question_id").join(u, "unit_id")
    s = s.withColumn("score", F.when(F.size("q") > 0, F.size(F.array_intersect("q", "u")) / F.size("q")).otherwise(0.0))
    return top_k(s.select("question_id", "unit_id", "fused_rank", "score"), keep, ties=["fused_rank", "unit_id"])


def occurrences(text: Column, part: Column) -> Column:
    """How often a part stands in a text, without overlaps."""
    return ((F.char_length(text) - F.char_length(F.replace(text, part, F.lit("")))) / F.char_length(part)).cast("long")


def search_concepts(concepts: DataFrame, searches: DataFrame) -> DataFrame:
    """(query_id, filename, score, rank, total_matches): word search as served, many searches in one plan.

    concepts: filename, concept_type, title, description, source, body. searches (a stated set): query_id, query, concept_type,
    source, result_limit. A document matches if its type equals and its source contains what is asked (empty asks nothing) and every
    word of the query stands in some field. Score: occurrences, 8 for the title, 4 description, 2 source, 1 body. Order: score,
    title, file; 1 to 100 results."""
    low = [F.lower(F.coalesce(c, F.lit(""))).alias("f_" + c) for c in ("title", "description", "source", "body")]
    c = concepts.select("filename", "concept_type", F.coalesce("title", F.lit("")).alias("title"), *low)
    words = F.filter(F.split(F.lower(F.trim("query")), r"\s+"), lambda w: w != "")
    q = searches.select("query_id", words.alias("words"), F.col("concept_type").alias("want_type"), F.lower("source").alias("want_source"), F.greatest(F.lit(1), F.least(F.col("result_limit"), F.lit(100))).alias("result_limit"))
    fields = ["f_title", "f_description", "f_source", "f_body"]
    m = c.join(q, ((F.col("want_type") == "") | (F.col("want_type") == F.col("concept_type"))) & ((F.col("want_source") == "") | F.col("f_source").contains(F.col("want_source"))))
    m = m.where(F.forall("words", lambda w: F.exists(F.array(*fields), lambda f: f.contains(w))))
    score = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + sum((k * occurrences(F.col(f), w) for k, f in zip((8, 4, 2, 1), fields)), F.lit(0)))
    found = m.select("query_id", "filename", "title", "result_limit", score.alias("score"))
    total = found.groupBy("query_id").agg(F.count("*").alias("total_matches"))
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "title", "filename"))).where(F.col("rank") <= F.col("result_limit"))
    return ranked.join(F.broadcast(total), "query_id").select("query_id", "filename", "score", "rank", "total_matches")  # a row a search
