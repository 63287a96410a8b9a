"""Near-duplicate texts: classes of equal texts, candidate pairs by sharded BK-trees, exact similarities, groups.

Texts are normalised and cut into sets of ``width``-character substrings. Equal texts form a class, and only its representative
goes on. A min-wise sketch of the set gives (a) a 128-bit code in which similar sets have a small Hamming distance and (b) the
shards: a text belongs to one shard for each band of ``ROWS`` sketch values, so that two texts at the threshold meet in a shard
with near certainty, whatever is between them. Shards are coarse: many texts in one only share a phrase. A BK-tree is built over
the codes of each shard with two or more texts; a query follows only the edges whose distance lies within the radius and tells the
similar texts from those. What it returns, and nothing else, is compared exactly.

A shard is read as a stretch of sorted rows. One with more than ``BLOCK`` texts isn't built in one task: it is cut into blocks,
and each pair of blocks is a task's group with a tree over one block, queried by the other, so that a hot shard is spread and
nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.windows import mixed, normalised, window_hashes
from inkwell.session import checkpoint

BANDS, ROWS = 42, 4  # two sets of similarity 0.6 meet with probability 0.997, of 0.65 with 0.9997
BITS, RADIUS = 128, 45  # at similarity 0.6 the distance is 25.6 on average, with deviation 4.5; between unrelated sets 64 with 5.7
BLOCK = 512
SHARD_ROWS = 500_000  # rows of shards a task reads, about
COPIES = 1_000  # members of a class of equal texts that meet in one task


class BKTree:
    """Integers by Hamming distance; children are keyed by their distance to the parent. Equal codes share a node."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.items: list[list] = []
        self.edges: list[dict[int, int]] = []

    def _new(self, code: int, item) -> int:
        self.codes.append(code)
        self.items.append([item])
        self.edges.append({})
        return len(self.codes) - 1

    def add(self, code: int, item) -> None:
        if not self.codes:
            self._new(code, item)
            return
        at = 0
        while True:
            d = (self.codes[at] ^ code).bit_count()
            if d == 0:
                self.items[at].append(item)
                return
            down = self.edges[at].get(d)
            if down is None:
                self.edges[at][d] = self._new(code, item)
                return
            at = down

    def within(self, code: int, radius: int) -> Iterator:
        open_nodes = [0] if self.codes else []
        while open_nodes:
            at = open_nodes.pop()
            d = (self.codes[at] ^ code).bit_count()
            if d <= radius:
                yield from self.items[at]
            open_nodes += [child for e, child in self.edges[at].items() if d - radius <= e <= d + radius]


def sketches(texts: list[str], width: int, values: int = BANDS * ROWS, passes: int = ROWS) -> np.ndarray:
    """Min-wise values, one row a text: in each pass the windows are thrown into bins by one hash and each bin keeps its
    smallest; an empty bin takes the next full one's, marked by the way gone."""
    bins = values // passes
    h, doc, _ = window_hashes(texts, width)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.empty((len(texts), values), np.uint64)
    for k in range(passes):
        m = mixed(h, k + 1)
        slot = ((m >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        low = np.full(len(texts) * bins, none, np.uint64)
        np.minimum.at(low, doc * bins + slot.astype(np.int64), m * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16))
        low = low.reshape(len(texts), bins)
        part = low.copy()
        for step in range(1, bins):
            empty = part == none
            if not empty.any():
                break
            moved = np.roll(low, -step, 1)
            take = empty & (moved != none)
            part[take] = moved[take] + np.uint64(step * 0x1000003)
        out[:, k * bins : (k + 1) * bins] = part
    return out


def shard_rows(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower and upper 64 bits of the code, band keys) of each text."""
    s = sketches(texts, width)
    bits = mixed(s[:, :BITS].copy(), 99) & np.uint64(1)
    low, high = ((bits[:, k : k + 64] << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64) for k in (0, 64))
    keys = np.zeros((len(texts), BANDS), np.uint64)
    spread = s.reshape(len(texts), ROWS, BANDS)  # the values of a band come from different passes
    for r in range(ROWS):
        keys = mixed(keys ^ spread[:, r, :], r + 11)
    return low, high, mixed(keys ^ np.arange(BANDS, dtype=np.uint64), 3)


def _kept(batch: pa.RecordBatch, least: int) -> tuple[list[str], list[str], np.ndarray]:
    """Keys, normalised texts and classes of a batch's long enough rows."""
    import xxhash

    kept = [(k, t) for k, t in zip(batch.column(0).to_pylist(), map(normalised, batch.column(1).to_pylist())) if len(t) >= least]
    cls = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for _, t in kept], np.uint64)
    return [k for k, _ in kept], [t for _, t in kept], cls.view(np.int64)


def classes(rows: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(key, cls) of each row whose normalised text has at least ``least`` characters; equal texts have one cls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, _, cls = _kept(batch, least)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(cls)], ["key", "cls"])

    return _given(rows, key, text).mapInArrow(run, "key string, cls long").distinct()


def _given(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))


def coded(rows: DataFrame, key: str, text: str, least: int, width: int) -> DataFrame:
    """(cls, low, high, bands) of each class, once a partition of the input, so copies cost no sketches and no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                _, texts, cls = _kept(whole.slice(at, 1000), least)
                new = []
                for k, c in enumerate(cls.tolist()):
                    if c not in seen:
                        seen.add(c)
                        new.append(k)
                low, high, keys = shard_rows([texts[k] for k in new], width)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(new) + 1, dtype=np.int32) * BANDS), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(cls[new]), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), bands], ["cls", "low", "high", "bands"])

    return _given(rows, key, text).mapInArrow(run, "cls long, low long, high long, bands array<long>")


def _codes(low: np.ndarray, high: np.ndarray) -> list[int]:
    """Codes as positive numbers: Python counts the bits of a number's absolute value."""
    return [h << 64 | x for x, h in zip(low.view(np.uint64).tolist(), high.view(np.uint64).tolist())]


def candidates(sketched: DataFrame, texts: int) -> DataFrame:
    """Distinct (a, b), a < b, of classes whose codes lie within the radius in a common shard. ``texts``, about the number of
    texts, sets the number of tasks."""
    rows = sketched.select("cls", "low", "high", F.explode("bands").alias("shard"))
    tasks = max(int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-texts * BANDS // SHARD_ROWS))
    # copies of one text from several partitions follow each other here and count once
    rows = rows.repartition(tasks, "shard").sortWithinPartitions("shard", "cls")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of small shards (block null), and the rows of large ones with the number of their block."""
        shard, members = None, []
        n = 0
        out: list[tuple] = []

        def pairs_of(members: list[tuple[int, int]]) -> None:
            tree = BKTree()
            for cls, code in members:
                for other in tree.within(code, RADIUS):
                    out.append((other, cls, None, None, None))
                tree.add(code, cls)

        def rows_of(members: list[tuple[int, int]]) -> None:
            block = (n - 1) // BLOCK
            mask = (1 << 64) - 1
            for cls, code in members:
                low, high = code & mask, code >> 64
                out.append((cls, low - (low >> 63 << 64), int(shard), block, high - (high >> 63 << 64)))

        def done() -> None:
            if n <= BLOCK:
                if len(members) > 1:
                    pairs_of(members)
            else:
                rows_of(members)

        for batch in batches:
            cls, low, high, key = (batch.column(i).to_numpy() for i in range(4))
            if not len(key):
                continue
            # only stretches of two or more rows matter, and the batch's last, which may go on
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends = np.concatenate([starts[1:], [len(key)]])
            matter = (ends - starts > 1) | (ends == len(key)) | (starts == 0)
            for s, e in zip(starts[matter].tolist(), ends[matter].tolist()):
                if key[s] != shard:
                    done()
                    shard, members, n = key[s], [], 0
                for c, d in zip(cls[s:e].tolist(), _codes(low[s:e], high[s:e])):
                    if members and members[-1][0] == c:
                        continue
                    if len(members) == BLOCK:  # too many: the block goes out as rows, numbered
                        rows_of(members)
                        members = [(c, d)]
                    else:
                        members.append((c, d))
                    n += 1
            if len(out) > 20_000:
                yield as_batch(out)
                out = []
        done()
        yield as_batch(out)

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        cols = [[r[i] for r in out] for i in range(5)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "shard", "block", "high"])

    first = checkpoint(rows.select("cls", "low", "high", "shard").mapInArrow(shards, "a long, b long, shard long, block long, high long"))
    small = first.where("block is null").select("a", "b")
    large = first.where("block is not null").select(F.col("a").alias("cls"), F.col("b").alias("low"), "high", "shard", "block")
    last = large.groupBy("shard").agg(F.max("block").alias("last"))
    # block i is the tree of the groups (i, j) for j >= i, and queries those of (j, i)
    met = large.join(last, "shard").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    met = met.select("cls", "low", "high", "shard", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("tree"), (F.col("block") >= F.col("other")).alias("query"))

    def pair_of_blocks(table: pa.Table) -> pa.Table:
        tree = BKTree()
        cls, code = table.column("cls").to_pylist(), _codes(table.column("low").to_numpy(), table.column("high").to_numpy())
        for c, d, t in zip(cls, code, table.column("tree").to_pylist()):
            if t:
                tree.add(d, c)
        found = [(min(o, c), max(o, c)) for c, d, q in zip(cls, code, table.column("query").to_pylist()) if q for o in tree.within(d, RADIUS) if o != c]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    hot = met.groupBy("shard", "i", "j").applyInArrow(pair_of_blocks, "a long, b long")
    return small.unionByName(hot).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(rows: DataFrame, members: DataFrame, key: str, text: str, threshold: float, width: int, least: int) -> DataFrame:
    """(a, b, similarity) of the classes at or above the threshold, counted exactly on the representatives' texts."""
    pairs = checkpoint(candidates(coded(rows, key, text, least, width), members.count()))
    reps = members.groupBy("cls").agg(F.min("key").alias("key"))
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    texts = reps.join(wanted, "cls").join(_given(rows, key, text), "key").dropDuplicates(["cls"]).select("cls", "text")
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached, grams = None, set()
        for batch in batches:
            keep, sims = [], []
            for k, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if y != cached:  # rows come in order of b
                    cached, grams = y, substrings(normalised(y), width)
                other = substrings(normalised(x), width)
                common = len(grams & other)
                sim = common / max(1, len(grams) + len(other) - common)
                if sim >= threshold:
                    keep.append(k)
                    sims.append(sim)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(sims, pa.float64())], ["a", "b", "similarity"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, similarity double")


def substrings(text: str, width: int) -> set[str]:
    return {text[i : i + width] for i in range(len(text) - width + 1)}


def similar_pairs(rows: DataFrame, key: str = "block_id", text: str = "content", threshold: float = 0.6, width: int = 12, least: int = 200) -> DataFrame:
    """(left, right) keys, smaller first, of all pairs of rows whose substring sets' similarity reaches the threshold.

    Equal normalised texts count. Null keys and texts and texts under ``least`` normalised characters have no pairs; a key that
    comes twice counts once; further columns are not read; an empty table gives no rows.
    """
    least = max(least, width)
    members = checkpoint(classes(rows, key, text, least))
    near = links(rows, members, key, text, threshold, width, least)
    # a class of many copies is cut into parts of about COPIES members, and the parts meet in pairs
    parts = members.groupBy("cls").agg(F.ceil(F.count("*") / COPIES).cast("int").alias("parts"))
    cut = members.join(parts, "cls").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    side = lambda c, k: cut.select(F.col("cls").alias(c), F.col("part").alias("part_" + c), F.col("key").alias(k))
    spread = lambda df, c: df.join(parts.withColumnRenamed("cls", c), c).withColumn("part_" + c, F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    across = spread(spread(near.select("a", "b"), "a").join(side("a", "x"), ["a", "part_a"]), "b").join(side("b", "y"), ["b", "part_b"])
    copies = cut.join(members.groupBy("cls").count().where("count > 1").select("cls"), "cls")
    met = copies.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cls", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") <= F.col("other")).alias("first"), (F.col("part") >= F.col("other")).alias("second"))
    same = met.where("first").select("cls", "i", "j", F.col("key").alias("x")).join(met.where("second").select("cls", "i", "j", F.col("key").alias("y")), ["cls", "i", "j"]).where("i < j or x < y")
    out = across.select("x", "y").unionByName(same.select("x", "y"))
    return out.select(F.least("x", "y").alias("left"), F.greatest("x", "y").alias("right"))


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(cls, group): the smallest cls of each connected component.

    Every round takes each node's smallest neighbouring label and then the label of that label (pointer jumping), so rounds grow
    with the logarithm of a component's length; each round is checkpointed. Rounds end when nothing changes."""
    both = checkpoint(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpoint(nodes.select("cls", F.col("cls").alias("label")).distinct())
    for _ in range(most_rounds):
        near = both.join(labels, both.b == labels.cls).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.cls == near.a, "left").select("cls", F.least("label", F.coalesce("near", "label")).alias("to"), F.col("label").alias("old"))
        jump = step.select(F.col("cls").alias("to"), F.col("to").alias("far"))
        after = checkpoint(step.join(jump, "to", "left").select("cls", F.least(F.col("to"), F.coalesce("far", F.col("to"))).alias("label"), "old"))
        labels = after.select("cls", "label")
        if not after.where("label < old").limit(1).count():
            return labels.withColumnRenamed("label", "group")
    raise RuntimeError("components: not settled")


def groups(rows: DataFrame, key: str = "block_id", text: str = "content", threshold: float = 0.6, width: int = 12, least: int = 200) -> DataFrame:
    """One row a key with its class of equal texts, its group, the class' number of links to other classes, and copies."""
    least = max(least, width)
    members = checkpoint(classes(rows, key, text, least))
    near = checkpoint(links(rows, members, key, text, threshold, width, least))
    ends = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls")))
    degree = ends.groupBy("cls").agg(F.count("*").alias("links"))
    grouped = components(degree.select("cls"), near)
    size = members.groupBy("cls").agg(F.count("*").alias("copies"), F.min("key").alias("class_id"))
    name = size.select(F.col("cls").alias("group"), F.col("class_id").alias("group_id"))
    per = size.join(degree, "cls", "left").join(grouped, "cls", "left").withColumn("group", F.coalesce("group", "cls")).join(name, "group")
    return members.join(per.select("cls", "class_id", "group_id", F.coalesce("links", F.lit(0).cast("long")).alias("links"), "copies"), "cls").drop("cls")


def found(blocks: DataFrame) -> DataFrame:
    pairs = similar_pairs(blocks.where("block_type = 'text'"))
    return pairs.select(F.col("left").alias("left_block_id"), F.col("right").alias("right_block_id"))


def block_groups(blocks: DataFrame, atoms: DataFrame) -> DataFrame:
    """(item_table, item_key, class_id, group_id, links, copies) of the text blocks and the evidence atoms made from them, in
    common groups; rows under 200 normalised characters have none."""
    b = blocks.where("block_type = 'text'").select(F.concat(F.lit("blocks:"), "block_id").alias("block_id"), "content")
    a = atoms.where("block_type = 'text'").select(F.concat(F.lit("evidence_atoms:"), "atom_id").alias("block_id"), F.col("text").alias("content"))
    cut = lambda c: F.split(c, ":", 2)
    return groups(b.unionByName(a)).select(cut("key")[0].alias("item_table"), cut("key")[1].alias("item_key"), "class_id", "group_id", "links", "copies")
