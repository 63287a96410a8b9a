import json

import pytest
from pyspark.sql import functions as F

from inkwell.sources import files as S
from inkwell.streaming import telemetry as T


def test_content_lists_and_blocks(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    items = [{"type": "text", "text": "Head", "text_level": 1, "page_idx": 0}, {"type": "text", "text": " "}, {"type": "image", "img_path": "x.png", "image_caption": ["A", "map"], "page_idx": 1}]
    (a / "r_content_list.json").write_text(json.dumps(items))
    (a / "content_list.json").write_text("[]")
    (b / "content_list_v2.json").write_text(json.dumps([[items[0]], [items[2]]]))
    found = {r.folder.rsplit("/", 1)[1]: r.path.rsplit("/", 1)[1] for r in S.content_lists(spark, str(tmp_path)).collect()}
    assert found == {"a": "r_content_list.json", "b": "content_list_v2.json"}
    got = S.parsed_blocks(spark, [str(a / "r_content_list.json"), str(b / "content_list_v2.json")]).collect()
    assert sorted((r.block_type, r.content, r.heading_level, r.asset_path) for r in got) == sorted([("title", "Head", 1, None), ("image", "A map", None, "x.png")] * 2, key=str)
    assert len({r.block_id for r in got}) == 4


def test_sidecars_and_gates(spark, tmp_path):
    doc = {"schema_version": "v1", "status": "ready", "document_id": "d", "source_file": "f", "blocks": [{"block_id": "1", "block_type": "text", "content": "x", "page_number": 1, "heading_path": [], "evidence_eligible": True, "content_hash": "h"}, {"block_id": "2", "block_type": "title", "content": "t", "page_number": 1, "evidence_eligible": False}, {"block_id": "3", "block_type": "text", "content": " ", "page_number": 1, "evidence_eligible": True}]}
    (tmp_path / "d.structure.json").write_text(json.dumps(doc))
    assert [r.block_id for r in S.structure_sidecars(spark, str(tmp_path)).collect()] == ["1"]
    (tmp_path / "e.structure.json").write_text(json.dumps(doc))
    with pytest.raises(Exception, match="not unique"):
        S.structure_sidecars(spark, str(tmp_path)).collect()


def test_page_records_pass_over_corrupt_files(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"status": "complete", "page_idx": 1, "content": "x"}))
    (tmp_path / "2.json").write_text("{broken")
    (tmp_path / "3.json").write_text(json.dumps({"status": "failed", "page_idx": 3}))
    assert [r.page_idx for r in S.page_records(spark, str(tmp_path)).collect()] == [1]


def test_gold_questions(spark, tmp_path):
    line = {"question_id": "q", "question": "?", "answerable": True, "evidence_sets": [["A"], ["B", "C"]], "required_facts": [{"fact_id": "f", "claim": "c", "weight": 1.0, "critical": True}]}
    (tmp_path / "g.jsonl").write_text(json.dumps(line) + "\n")
    assert S.gold_questions(spark, str(tmp_path / "g.jsonl")).first().evidence_sets == [["A"], ["B", "C"]]
    (tmp_path / "h.jsonl").write_text((json.dumps(line) + "\n") * 2)
    with pytest.raises(Exception, match="not unique"):
        S.gold_questions(spark, str(tmp_path / "h.jsonl")).collect()
    (tmp_path / "i.jsonl").write_text('{"question_id": 1, "answerable": "maybe"}\n')
    with pytest.raises(Exception):
        S.gold_questions(spark, str(tmp_path / "i.jsonl")).collect()


def test_front_matter_and_file_blocks(spark):
    df = spark.createDataFrame([("---\ntitle: 'A b'\ntype: Topic\n---\n# Body\n",), ("no head",), ("=== FILE: a.md ===\nx\ny\n=== END ===\n=== FILE: b.md ===\nz\n=== END ===",)], "t string")
    head, body = S.front_matter(F.col("t"))
    r = df.select(head.alias("h"), body.alias("b"), S.front_matter_fields(head).alias("m"), S.file_blocks(F.col("t")).alias("f")).collect()
    assert r[0].m == {"title": "A b", "type": "Topic"} and r[0].b == "# Body\n" and r[1].h is None and r[1].b == "no head"
    assert [tuple(x) for x in r[2].f] == [("a.md", "x\ny"), ("b.md", "z")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    path = str(tmp_path / "t")
    assert S.write_new(df, path, ["k"]) == 2 and S.write_new(df, path, ["k"]) == 0
    S.replace_table(spark.createDataFrame([(9, "z")], "k int, v string"), path)
    assert [r.k for r in spark.read.parquet(path).collect()] == [9]
    S.append_lines(df, str(tmp_path / "l"))
    S.append_lines(df, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 6


def test_articles(spark):
    b = spark.createDataFrame([("d", "1", 0, 0, "title", 2, "Head"), ("d", "2", 0, 1, "text", None, "Body"), ("d", "3", 1, 0, "text", None, None)], "document_id string, block_id string, page_idx int, reading_order int, block_type string, heading_level int, content string")
    assert S.articles(b).first().markdown == "---\ndocument_id: d\nblocks: 2\n---\n\n## Head\n\nBody"


def run(spark, df, tmp_path, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_windows_equal_the_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(src).schema
    (tmp_path / "in").mkdir()
    spark.read.parquet(src).repartition(3).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got = {(r.started, r.event_type): r.n for r in run(spark, T.windowed(stream), tmp_path, "w", "complete")}
    want = {(r.started, r.event_type): r.n for r in T.windowed(spark.read.parquet(src)).collect()}
    assert got == want
    assert len(run(spark, T.once(stream.withColumn("at", F.col("ts").cast("timestamp")), "event_id", "at", "400 days"), tmp_path, "o")) == spark.read.parquet(src).select("event_id").distinct().count()


def test_latencies(spark, tmp_path):
    rows = [("r1", "2024-01-01 00:00:01", "event", None), ("r1", "2024-01-01 00:00:03", "content", 2), ("r1", "2024-01-01 00:00:05", "done", 1), ("r2", "2024-01-01 00:00:02", "content", 7)]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "request_id string, ts string, kind string, tokens int").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema("request_id string, ts timestamp, kind string, tokens int").parquet(src)
    out = {r.request_id: r for r in run(spark, T.latencies(stream), tmp_path, "l")}
    r = out["r1"]
    assert (r.first_content - r.first_event, r.last_event - r.first_event, r.tokens, r.events, r.done) == (2.0, 4.0, 3, 3, True)


def test_write_if_changed(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert S.write_if_changed(df, path, ["id"]) and not S.write_if_changed(df.orderBy("v").repartition(3), path, ["id"])
    more = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert S.write_if_changed(more, path, ["id"]) and {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "b")}
    empty = spark.createDataFrame([], "id int, v string")
    assert S.write_if_changed(empty, str(tmp_path / "e"), ["id"]) and not S.write_if_changed(empty, str(tmp_path / "e"), ["id"])


def test_dated_log(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-02"), ("b", "2024-01-03")], "entry string, at string")
    S.append_log(df, str(tmp_path / "log"), "at")
    S.append_log(df, str(tmp_path / "log"), "at")
    got = spark.read.json(str(tmp_path / "log"))
    assert got.count() == 4 and got.where("log_day = '2024-01-03'").select("entry").distinct().first()[0] == "b"


def test_assets_are_written_once_and_failures_are_rows(spark, tmp_path):
    df = spark.createDataFrame([("x/a.png", bytearray(b"1")), ("../out.png", bytearray(b"2")), (None, bytearray(b"3")), ("n", None)], "asset_path string, content binary")
    for _ in range(2):
        out = {r.name: r for r in S.write_assets(df, S.FolderWriter(str(tmp_path / "f"))).collect()}
        assert out["x/a.png"].uri.endswith("f/x/a.png") and out["../out.png"].uri.endswith("f/out.png") and out[None].error and out["n"].error
    assert sorted(p.name for p in (tmp_path / "f").rglob("*") if p.is_file()) == ["a.png", "out.png"]


def test_documents_are_read_back_typed(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"document_id": "d", "page_count": 2, "processed_at": "2024-01-02T03:04:05", "blocks": [{"block_id": "b", "heading_path": ["h"]}]}) + "\n")
    r = S.document_ir(spark, str(tmp_path / "d.json")).first()
    assert r.page_count == 2 and r.blocks[0].heading_path == ["h"] and r.title is None
    (tmp_path / "e.json").write_text("{no\n")
    with pytest.raises(Exception):
        S.document_ir(spark, str(tmp_path / "e.json")).collect()


def test_sentence_batches(spark):
    df = spark.createDataFrame([("a", "一。二！三？四；"), ("n", None), ("e", "")], "k string, t string")
    assert [(r.k, r.batch, r.sentences) for r in T.sentence_batches(df, "k", "t", 3).orderBy("batch").collect()] == [("a", 0, ["一。", "二！", "三？"]), ("a", 1, ["四；"])]


def test_keyed_sink_adds_a_key_once(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for k, rows in enumerate(([("a", 1), ("b", 2)], [("b", 3), ("c", 4)])):
        (src / f"{k}.json").write_text("\n".join(json.dumps({"id": i, "v": v}) for i, v in rows))
    stream = spark.readStream.schema("id string, v int").option("maxFilesPerTrigger", 1).json(str(src))
    q = T.keyed_sink(stream, out, ["id"], str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    got = [r.id for r in spark.read.parquet(out).collect()]
    assert sorted(got) == ["a", "b", "c"]
