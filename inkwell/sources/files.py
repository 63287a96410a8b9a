"""Readers and writers of the file formats around the engine: parser output, sidecars, JSON lines, front matter, assets.

Schemas are always given, never inferred; bad rows are either rejected with their place or kept apart, by choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = "block_id string, block_type string, content string, page_number int, heading_path array<string>, evidence_eligible boolean, content_hash string"
SIDECAR = f"schema_version string, status string, document_id string, source_file string, blocks array<struct<{BLOCK.replace(' ', ':').replace(',:', ',')}>>"
CONTENT_ITEM = "type string, text string, content string, text_level int, level int, heading_level int, page_idx int, bbox array<int>, img_path string, image_caption array<string>, table_body string, list_items array<string>"
PAGE = "schema_version string, status string, page_idx int, attempts int, content string, model string, finish_reason string, completion_tokens int"
GOLD = "question_id string, question string, question_type string, answerable boolean, required_facts array<struct<fact_id:string,claim:string,weight:double,critical:boolean>>, forbidden_facts array<struct<fact_id:string,claim:string,weight:double,critical:boolean>>, evidence_sets array<array<string>>, reference_answer string"


def content_lists(spark: SparkSession, root: str) -> DataFrame:
    """(folder, path) of the content list to read in each folder below root: the prefixed legacy name first, then the plain, then
    version 2."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*content_list*.json").load(root).select("path")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rank = F.when(name.rlike(r".+_content_list\.json$"), 1).when(name == "content_list.json", 2).when(name.rlike(r"_v2\.json$"), 3)
    f = f.withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1)).withColumn("rank", rank).where("rank is not null")
    return f.withColumn("k", F.row_number().over(W.partitionBy("folder").orderBy("rank", "path"))).where("k = 1").select("folder", "path")


def parsed_blocks(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Items of content lists (a flat array of items, or an array of pages' arrays) as blocks in their order, without empty ones."""
    flat = f"array<struct<{CONTENT_ITEM.replace(', ', ',').replace(' ', ':')}>>"
    raw = spark.read.option("wholetext", "true").text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    nested = F.flatten(F.from_json("value", f"array<{flat}>"))
    items = F.when(F.col("value").rlike(r"^\s*\[\s*\["), nested).otherwise(F.from_json("value", flat))
    x = raw.select("path", F.posexplode(items).alias("reading_order", "i")).select("path", "reading_order", "i.*")
    text = F.coalesce(F.nullif(F.trim("text"), F.lit("")), F.nullif(F.trim("content"), F.lit("")), F.nullif(F.trim("table_body"), F.lit("")), F.nullif(F.array_join("list_items", "\n"), F.lit("")), F.nullif(F.array_join("image_caption", " "), F.lit("")))
    level = F.coalesce(*[F.when(F.col(c).between(1, 6), F.col(c)) for c in ("text_level", "level", "heading_level")])
    kind = F.when((F.col("type") == "text") & level.isNotNull(), "title").otherwise(F.col("type"))
    x = x.select("path", "reading_order", "page_idx", "bbox", F.col("img_path").alias("asset_path"), kind.alias("block_type"), text.alias("content"), F.when(kind == "title", F.coalesce(level, F.lit(1))).alias("heading_level"))
    digest = F.sha2(F.concat_ws("\x1f", "path", F.col("reading_order").cast("string"), F.coalesce("content", F.lit(""))), 256)
    return x.where("content is not null or asset_path is not null").withColumn("block_id", F.concat(F.lit("blk-"), F.substring(digest, 1, 20)))


def structure_sidecars(spark: SparkSession, root: str) -> DataFrame:
    """Eligible, non-empty blocks of pages from 1 on, of complete sidecars. Fails if a document or a block comes twice."""
    s = spark.read.schema(SIDECAR).option("multiLine", "true").option("mode", "FAILFAST").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.structure.json").json(root).where("status = 'ready' or status = 'complete'")
    b = s.select("document_id", "source_file", F.explode("blocks").alias("b")).select("document_id", "source_file", "b.*")
    b = b.where("evidence_eligible and trim(coalesce(content, '')) <> '' and page_number >= 1")
    return unique(b, ["document_id", "block_id"])


def page_records(spark: SparkSession, root: str) -> DataFrame:
    """Complete page records; files that can't be parsed are passed over."""
    r = spark.read.schema(PAGE + ", _corrupt string").option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", "true").json(root)
    return r.where("_corrupt is null and status = 'complete'").drop("_corrupt")


def gold_questions(spark: SparkSession, path: str) -> DataFrame:
    """Gold questions of JSON lines; a line that breaks the schema or a repeated id fails the read."""
    return unique(spark.read.schema(GOLD).option("mode", "FAILFAST").json(path), ["question_id"])


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, unless a key comes twice or holds a null: then the query fails and names it."""
    n = F.count("*").over(W.partitionBy(*keys))
    said = F.concat(F.lit("key is null or not unique: "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    checked = df.withColumn("_n", n)
    return checked.where(F.when((F.col("_n") > 1) | null, F.raise_error(said).cast("boolean")).otherwise(True)).drop("_n")


def front_matter(text: Column) -> tuple[Column, Column]:
    """(YAML head, body) of a Markdown text; the head is null without one."""
    head = F.nullif(F.regexp_extract(text, r"(?s)\A---[ \t]*\n(.*?)\n---[ \t]*(?:\n|\z)", 1), F.lit(""))
    return head, F.regexp_replace(text, r"(?s)\A---[ \t]*\n.*?\n---[ \t]*(?:\n|\z)", "")


def front_matter_fields(head: Column) -> Column:
    """The plain ``key: value`` lines of a head as a map; lists and nested values stay text."""
    lines = F.filter(F.split(head, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^([\w-]+):", 1).alias("k"), F.regexp_replace(F.trim(F.regexp_replace(x, r"^[\w-]+:", "")), r"^[\"']|[\"']$", "").alias("v")))
    return F.map_from_entries(pairs)


def file_blocks(text: Column) -> Column:
    """Named documents of one response: array of (name, body) between ``=== FILE: name ===`` and ``=== END ===``."""
    whole = F.regexp_extract_all(text, F.lit(r"(?s)(=== FILE: [^\n]+? ===\n.*?\n=== END ===)"), 1)
    return F.transform(whole, lambda x: F.struct(F.regexp_extract(x, r"=== FILE: ([^\n]+?) ===", 1).alias("name"), F.regexp_extract(x, r"(?s)===\n(.*)\n=== END ===", 1).alias("body")))


def append_lines(df: DataFrame, path: str) -> None:
    """Adds rows to a directory of JSON lines; the job's commit makes them visible at once or not at all."""
    df.write.mode("append").json(path)


def write_new(df: DataFrame, path: str, keys: list[str]) -> int:
    """Appends only rows whose keys the parquet table at ``path`` lacks, and says how many; a table that isn't there is begun."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    fresh = df.join(spark.read.parquet(path).select(*keys), keys, "left_anti") if there else df
    fresh = fresh.dropDuplicates(keys).persist()
    n = fresh.count()
    if n or not there:
        fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside the old table, then renames: readers see the old rows or the new, never half of them."""
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(path + ".new")
    if fs.exists(path_of(path)):
        fs.delete(path_of(path + ".old"), True)
        fs.rename(path_of(path), path_of(path + ".old"))
    if not fs.rename(path_of(path + ".new"), path_of(path)):
        raise OSError(f"rename failed: {path}")
    fs.delete(path_of(path + ".old"), True)


def articles(blocks: DataFrame) -> DataFrame:
    """(document_id, markdown): a document's blocks in order as Markdown, ids in the head. A document's blocks are one row."""
    mark = F.when(F.col("block_type") == "title", F.concat(F.repeat(F.lit("#"), F.coalesce("heading_level", F.lit(1))), F.lit(" "))).otherwise("")
    lines = blocks.where("trim(coalesce(content, '')) <> ''").groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("page_idx", "reading_order", "block_id", F.concat(mark, "content").alias("t")))).alias("b"))
    body = F.array_join(F.transform("b", lambda x: x["t"]), "\n\n")
    head = F.concat(F.lit("---\ndocument_id: "), "document_id", F.lit("\nblocks: "), F.size("b").cast("string"), F.lit("\n---\n\n"))
    return lines.select("document_id", F.concat(head, body).alias("markdown"))


def write_if_changed(df: DataFrame, path: str, keys: list[str]) -> bool:
    """Replaces the parquet table at ``path`` only if its rows differ; says whether it did. Rows are compared by counts and sums
    of row hashes, so nothing is collected; the order of rows doesn't matter."""
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    if path_of(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path_of(path)):
        old = spark.read.parquet(path)
        if sorted(old.columns) == sorted(df.columns) and _print(old, sorted(df.columns)) == _print(df, sorted(df.columns)):
            return False
    replace_table(df.dropDuplicates(keys), path)
    return True


def _print(df: DataFrame, columns: list[str]) -> tuple:
    h = F.sha2(F.to_json(F.struct(*columns)), 256)
    part = lambda k: F.sum(F.conv(F.substring(h, k, 12), 16, 10).cast("decimal(38,0)"))
    return tuple(df.distinct().agg(F.count("*"), part(1), part(13), part(25)).first())


def append_log(df: DataFrame, path: str, day: str) -> None:
    """Adds entries to the log of a day (``day`` names a date column): a directory a day, committed at once."""
    df.withColumn("log_day", F.col(day).cast("date")).write.mode("append").partitionBy("log_day").json(path)


class FolderWriter:
    """Writes assets into a folder all executors share, each beside its place first and then renamed; bytes that are already there
    aren't written again. Any object with ``put(name, content) -> uri`` can stand in its place, such as one for an object store."""

    def __init__(self, folder: str):
        self.folder = folder

    def put(self, name: str, content: bytes) -> str:
        import os
        import uuid

        name = os.path.normpath("/" + name).lstrip("/")  # a name can't lead out of the folder
        to = os.path.join(self.folder, name)
        os.makedirs(os.path.dirname(to), exist_ok=True)
        if not (os.path.exists(to) and os.path.getsize(to) == len(content) and open(to, "rb").read() == content):  # noqa: SIM115
            beside = f"{to}.{uuid.uuid4().hex}"
            try:
                with open(beside, "wb") as f:
                    f.write(content)
                os.replace(beside, to)
            finally:
                if os.path.exists(beside):
                    os.remove(beside)
        return f"file://{to}"


def write_assets(assets: DataFrame, writer, name: str = "asset_path", content: str = "content") -> DataFrame:
    """(name, uri, sha256, error) of each asset after ``writer.put`` in the tasks; one that fails is a row with its error. Written
    lazily: an action on the result writes. Null names and contents are errors; a task that is run again writes the same bytes."""
    import hashlib

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = []
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows.append((n, writer.put(n, c), hashlib.sha256(c).hexdigest(), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((n, None, None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], ["name", "uri", "sha256", "error"])

    return assets.select(name, F.col(content).cast("binary").alias("c")).mapInArrow(run, "name string, uri string, sha256 string, error string")


def document_ir(spark: SparkSession, path: str) -> DataFrame:
    """Persisted documents (JSON lines) in the typed form they had; a line that isn't one stops the read."""
    schema = "document_id string, source_file string, source_sha256 string, title string, parser string, parser_output string, page_count int, processed_at timestamp, blocks array<struct<" + BLOCK.replace(", ", ",").replace(" ", ":") + ">>"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
