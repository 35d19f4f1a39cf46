import json
import shutil
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import a4_pages, page_of, words_df
from inkveil.functions.keys import provenance
from inkveil.operators import audit, metadata, raster
from inkveil.params import RuleParams, RuleSet
from inkveil.plans.job import run_batch
from inkveil.plans.pipeline import Redactor
from inkveil.plans.queries import registered
from inkveil.sources import events, images, objects, outputs, rules, words
from inkveil.streaming.redact import job_stream, object_stream, redaction_stream, work_item_stream

BLANK = RuleSet(page1_regions=(), page2_regions=())


def notification(*records):
    return json.dumps({"Records": [
        {"eventSource": source, "s3": {"bucket": {"name": bucket} if bucket is not None else {},
                                       "object": {"key": key} if key is not None else {}}}
        for source, bucket, key in records]})


def events_df(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "event_id BIGINT, body STRING")


def test_work_items(spark):
    body = notification(
        ("aws:s3", "b", "a+b%20c.PDF"), ("aws:sqs", "b", "x.pdf"), (None, "b", "x.pdf"), ("aws:s3", "", "x.pdf"),
        ("aws:s3", None, "x.pdf"), ("aws:s3", "b", None), ("aws:s3", "b", ""), ("aws:s3", "b", "x.txt"),
        ("aws:s3", "b", "y%2Epdf"), ("aws:s3", "b", "y%2Epdf"))
    df = events_df(spark, body, '{"start_after": null, "batch_id": 0}', "not json", '{"Records": []}')
    items = events.pdf_work_items(events.event_records(df)).collect()
    assert [(r.event_id, r.pos, r.bucket, r.key) for r in items] == [
        (0, 0, "b", "a b c.PDF"), (0, 8, "b", "y.pdf"), (0, 9, "b", "y.pdf")]


def test_event_files(spark, tmp_path):
    body = json.dumps(json.loads(notification(("aws:s3", "b", "x.pdf"))), indent=2)
    (tmp_path / "e.json").write_text(body)
    items = events.pdf_work_items(events.event_records(events.read_events(spark, str(tmp_path)))).collect()
    assert [(r.bucket, r.key) for r in items] == [("b", "x.pdf")]


def store(root):
    for name, content in {"b/in/x.pdf": b"%PDF-1.4 abc", "b/y.PDF": b"no", "b/z.txt": b"%PDF-"}.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def test_objects_join_work_items(spark, tmp_path):
    store(tmp_path)
    items = spark.createDataFrame(
        [(1, 0, "b", "in/x.pdf"), (1, 1, "b", "y.PDF"), (1, 2, "b", "gone.pdf")],
        "event_id BIGINT, pos INT, bucket STRING, key STRING")
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        found = objects.with_content(items, objects.read_objects(spark, root)).collect()
        assert {(r.key, r.length, r.error) for r in found} == {
            ("in/x.pdf", 12, None), ("y.PDF", 2, "content is not a PDF"), ("gone.pdf", None, "object not found")}


def test_rule_files(spark, tmp_path):
    (tmp_path / "labels.json").write_text('{"label": "A:", "action": "redact"}\n{"label": "B:", "action": "keep"}\n')
    got = rules.merge_labels(rules.read_rules(spark, str(tmp_path / "labels.json"), rules.LABEL_SCHEMA))
    assert {(r.label, r.action) for r in got.collect()} == {("A:", "redact"), ("B:", "keep")}


def test_word_and_page_tables_round_trip(spark, tmp_path):
    rows = page_of("Nome: Ana", "x")
    outputs.write_batch(words_df(spark, rows), str(tmp_path / "w"), 1)
    outputs.write_batch(a4_pages(spark, (1, 1)), str(tmp_path / "p"), 1)
    assert sorted(map(tuple, words.read_words(spark, str(tmp_path / "w")).drop("batch_id").collect())) == sorted(rows)
    assert words.read_pages(spark, str(tmp_path / "p")).count() == 1


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", {"k": "v"}), (2, "c", {})], "id BIGINT, bucket STRING, meta MAP<STRING,STRING>")
    for _ in range(2):
        outputs.write_batch(df, str(tmp_path), 5, ("bucket",))
    outputs.write_batch(df.filter("id = 1"), str(tmp_path), 6, ("bucket",))
    back = spark.read.parquet(str(tmp_path))
    assert sorted((r.id, r.batch_id, r.bucket) for r in back.collect()) == [(1, 5, "b"), (1, 6, "b"), (2, 5, "c")]
    assert back.filter("id = 1 AND batch_id = 5").first().meta == {"k": "v"}


def test_layout_of_text(spark):
    text = " ".join(f"w{i}" for i in range(1250))
    docs = spark.createDataFrame([(1, text), (2, " \n "), (3, "")], "doc_id BIGINT, text STRING")
    placed = words.text_words(docs).collect()
    assert len(placed) == 1250 and {r.page_no for r in placed} == {1, 2, 3}
    assert {(r.doc_id, r.page_no) for r in words.text_pages(docs).collect()} == {(1, 1), (1, 2), (1, 3)}
    last = max(placed, key=lambda r: r.word_idx)
    assert (last.x0, last.y0, last.x1) == (36 + 52 * 9, 36 + 12 * 4 + ((1249 * 7) % 5) * 0.0625, 504 + 25)


def test_metadata(spark):
    meta = {"title": "t", "author": "a", "format": "PDF", "modDate": "d", "custom": "c"}
    df = spark.createDataFrame([(1, meta, "<x/>")], "doc_id BIGINT, meta MAP<STRING,STRING>, xmp STRING")
    row = metadata.clear_metadata(df).first()
    assert row.meta == {"title": "", "author": "", "format": "PDF", "modDate": "", "custom": "c"} and row.xmp == ""


def test_provenance(spark):
    df = spark.createDataFrame([("b", "k.pdf")], "b STRING, k STRING")
    assert df.select(provenance(F.col("b"), F.col("k"), 1700).alias("p")).first().p == {
        "original-bucket": "b", "original-key": "k.pdf", "processing-timestamp": "1700", "anonymized": "true"}


def results_df(spark, *statuses):
    rows = [(0, n, s, "b", f"{n}.pdf", "o" if s == "success" else None, f"k{n}" if s == "success" else None,
             5 if s == "success" else None, 3 if s == "success" else None, None if s == "success" else "bad")
            for n, s in enumerate(statuses)]
    return spark.createDataFrame(
        rows, "event_id BIGINT, pos INT, status STRING, input_bucket STRING, input_key STRING, output_bucket STRING, "
              "output_key STRING, input_size BIGINT, output_size BIGINT, error STRING")


def test_summary_and_response(spark):
    event = events_df(spark, "{}")
    for statuses, code, counts in ((("success", "error", "success"), 207, (3, 2, 1)),
                                   (("success",) * 3, 200, (3, 3, 0)), ((), 200, (0, 0, 0)), ((None,), 207, (1, 0, 1))):
        row = audit.batch_summary(event, results_df(spark, *statuses)).first()
        assert (row.status_code, (row.total_files, row.successful, row.failed)) == (code, counts)
    row = audit.batch_response(event, results_df(spark, "success", "error")).first()
    body = json.loads(row.body)
    assert row.status_code == 207 and body["summary"] == {"total_files": 2, "successful": 1, "failed": 1}
    assert [r["input_key"] for r in body["results"]] == ["0.pdf", "1.pdf"]
    assert body["results"][1] == {"status": "error", "input_bucket": "b", "input_key": "1.pdf", "error": "bad"}
    empty = audit.batch_response(event, results_df(spark)).first()
    assert json.loads(empty.body) == {"message": "No PDF files to process"}


def test_blank_texts_have_no_pages_under_either_setting(spark):
    docs = spark.createDataFrame([(1, " \n "), (2, ""), (3, None), (4, "a")], "doc_id BIGINT, text STRING")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            assert [(r.doc_id, r.page_no) for r in words.text_pages(docs).collect()] == [(4, 1)]
            assert [r.doc_id for r in words.text_words(docs).collect()] == [4]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_every_kind_of_error_is_a_row(spark, tmp_path):
    rows = [r for d in range(1, 8) for r in page_of("a  b", "CRM 1", doc=d)]  # two blanks leave a blank word
    bounds = a4_pages(spark, *[(d, 1) for d in range(1, 8) if d != 4], (5, 2), (6, 2))
    docs = spark.createDataFrame([(d, "a", "content is not a PDF" if d == 3 else None) for d in range(1, 8)],
                                 "doc_id BIGINT, text STRING, error STRING")
    items = spark.createDataFrame([(0, n, "b", f"{n}.pdf", n) for n in (1, 2, 3, 4, 5, 7, 99)],
                                  "event_id BIGINT, pos INT, bucket STRING, key STRING, doc_id BIGINT")
    kind = "doc_id BIGINT, page_no INT, width INT, height INT, nChannels INT, data BINARY, error STRING"
    pictures = spark.createDataFrame([(7, 2, None, None, None, None, images.UNREADABLE), (1, 2, 2, 2, 1, bytearray(b"\xff" * 4), None)], kind)
    for region, error in (((0.5, 0.5, 0.25, 0.25), rules.OUT_OF_ORDER), ((0.0, 0.0, 5e6, 1.0), rules.TOO_LARGE)):
        redactor = Redactor(RuleSet(page1_regions=(), page2_regions=(region,)), RuleParams(), 100)
        job = run_batch(redactor, items, docs, words_df(spark, rows), bounds, f"{tmp_path}/{error[:12]}", 1, 1700, pictures)
        assert {r.pos: r.error for r in job.audit.collect()} == {
            1: None, 2: None, 3: "content is not a PDF", 4: "PDF must have at least 1 page", 5: error,
            7: "page image is not readable", 99: "object not found"}
        first = job.audit.where("pos = 2").first()
        assert (first.n_words_in, first.n_words_removed) == (4, 2)  # blank words count on neither side
        assert {r.doc_id for r in job.images.collect()} == {1}


def test_objects_carry_their_content(spark, tmp_path):
    rows = page_of("Nome: Ana", "b c", doc=1)
    items = spark.createDataFrame([(0, n, "b", f"{n}.pdf", 1) for n in (1, 2)],
                                  "event_id BIGINT, pos INT, bucket STRING, key STRING, doc_id BIGINT")
    docs = spark.createDataFrame([(1, "x")], "doc_id BIGINT, text STRING")
    run_batch(Redactor(BLANK, RuleParams(), 100), items, docs, words_df(spark, rows), a4_pages(spark, (1, 1)), str(tmp_path), 3, 86400 * 2)
    back = spark.read.parquet(f"{tmp_path}/objects").collect()
    assert {(r.pos, r.doc_id, r.content, r.content_type, str(r.ingest_date), r.output_bucket, r.batch_id) for r in back} == {
        (n, 1, "Nome:\nb c", "text/plain; charset=utf-8", "1970-01-03", "anonymized", 3) for n in (1, 2)}


def test_rules_from_files_reach_the_engine(spark, tmp_path):
    (tmp_path / "labels.json").write_text('{"label": "Nome:", "action": "redact"}\n{"label": "Nome:", "action": "keep"}\n'
                                          '{"label": "CPF:", "action": "redact"}\n')
    (tmp_path / "tokens.json").write_text('{"token": "CRM"}\n{"token": "CRM"}\n')
    (tmp_path / "regions.json").write_text('{"page_no": 1, "region_id": 0, "r0": 0.0, "r1": 0.5, "r2": 1.0, "r3": 1.0}\n')
    found = rules.RuleTables.read(spark, str(tmp_path))
    assert found.search_terms == ("crm",)
    rows = page_of("Nome: Ana", "CPF: 1", "q CRM 5")
    got = {r.line_text for r in Redactor(found, RuleParams(), 100).text(words_df(spark, rows), a4_pages(spark, (1, 1))).collect()}
    assert got == {"Nome: Ana", "CPF:", "q"}


def test_unreadable_images_are_rows(spark, tmp_path):
    png(tmp_path / "a.png", 4, 4)
    (tmp_path / "b.png").write_bytes(b"no image")
    got = {r.path.rsplit("/", 1)[-1]: r for r in images.read_rasters(spark, str(tmp_path)).collect()}
    assert got["a.png"].error is None and got["a.png"].width == 4
    assert got["b.png"].error == images.UNREADABLE and got["b.png"].data is None


def test_batch_job(spark, tmp_path):
    text = {1: ["Nome: Ana", "CRM 1"], 2: ["a b"]}
    rows = [r for d, lines in text.items() for r in page_of(*lines, doc=d)]
    rows += [r for p in (2, 3, 4) for r in page_of("x", doc=2, page=p)]
    bounds = a4_pages(spark, (1, 1), (2, 1), (2, 2), (2, 3), (2, 4))
    docs = spark.createDataFrame([(1, "Nome: Ana\nCRM 1"), (2, "a b"), (3, "")], "doc_id BIGINT, text STRING")
    items = spark.createDataFrame([(0, n, "b", f"d/{n}.pdf", n) for n in (1, 2, 3, 4)],
                                  "event_id BIGINT, pos INT, bucket STRING, key STRING, doc_id BIGINT")
    job = run_batch(Redactor(BLANK, RuleParams(), 100), items, docs, words_df(spark, rows), bounds, str(tmp_path), 1, 1700)
    got = {r.pos: r for r in job.audit.collect()}
    assert {n: (r.status, r.error) for n, r in got.items()} == {
        1: ("success", None), 2: ("success", None), 3: ("error", "PDF must have at least 1 page"),
        4: ("error", "object not found")}
    assert (got[1].n_words_in, got[1].n_words_removed, got[1].n_boxes, got[1].output_size) == (4, 3, 3, 5)
    assert (got[2].n_pages, got[2].n_pages_dropped, got[2].n_words_removed) == (4, 2, 0)
    assert got[3].output_key is None and got[1].output_key.startswith("d/anonymized_")
    stored = {r.pos: r for r in job.objects.collect()}
    assert set(stored) == {1, 2} and stored[1].output_key == got[1].output_key
    assert stored[1].metadata == {"original-bucket": "b", "original-key": "d/1.pdf",
                                  "processing-timestamp": "1700", "anonymized": "true"}
    assert job.seconds == round(job.seconds, 3) > 0


def test_grid_burn(spark):
    df = spark.createDataFrame([([1.0] * 16,)], "p ARRAY<FLOAT>")
    box = F.expr("array(named_struct('px0', 1, 'py0', 1, 'px1', 2, 'py1', 9))")
    burned = df.select(raster.burn_grid(F.col("p"), 4, box).alias("p")).first().p
    assert [i for i, v in enumerate(burned) if v == 0] == [5, 6, 9, 10, 13, 14]


def png(path, width, height):
    """A white RGB image."""
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))
    rows = b"".join(b"\0" + b"\xff" * 3 * width for _ in range(height))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
                     + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


def test_image_burn(spark, tmp_path):
    png(tmp_path / "a.png", 40, 20)
    png(tmp_path / "b.png", 8, 8)
    pages = images.read_rasters(spark, str(tmp_path))
    regions = spark.createDataFrame([(2, 0, 0.1, 0.25, 0.5, 0.5), (2, 1, 0.9, 0.9, 400.0, 250.0), (2, 2, 5.0, 5.0, 6.0, 6.0)],
                                    rules.REGION_SCHEMA)
    burned = {r.path.rsplit("/", 1)[-1]: r for r in raster.burn_images(pages, images.image_boxes(pages, regions)).collect()}
    for name, w, h in (("a.png", 40, 20), ("b.png", 8, 8)):
        r = burned[name]
        black = {(i // r.nChannels % w, i // r.nChannels // w) for i, v in enumerate(bytes(r.data)) if v == 0}
        expected = {(x, y) for x in range(w) for y in range(h)
                    if (int(.1 * w) <= x <= int(.5 * w) and int(.25 * h) <= y <= int(.5 * h))
                    or (x >= int(.9 * w) and y >= int(.9 * h))}
        assert black == expected and len(r.data) == w * h * r.nChannels


def test_a_page_of_20_megapixels_is_burned(spark):
    w, h = 5000, 4001
    boxes = [(0, 10, 0, 40, 4000), (0, 4990, 3999, 6000, 9000), (1, 0, 0, 0, 0)]
    pages = spark.range(1).select(F.lit(0).alias("path"), F.lit(w).alias("width"), F.lit(h).alias("height"), F.lit(1).alias("nChannels"),
                                  F.unhex(F.repeat(F.lit("FF"), w * h)).alias("data"))
    found = raster.burn_images(pages, spark.createDataFrame(boxes, "path INT, px0 INT, py0 INT, px1 INT, py1 INT")).first()
    pixels = np.frombuffer(bytes(found.data), np.uint8).reshape(h, w)
    expected = np.full((h, w), 255, np.uint8)
    expected[:, 10:41] = 0
    expected[3999:, 4990:] = 0
    assert (pixels == expected).all()


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    texts = [(1, "Nome: Ana CPF 7"), (2, "a b c"), (3, "x CRM 1")]
    schema = "doc_id BIGINT, text STRING"
    source, out = tmp_path / "in", str(tmp_path / "out")
    redactor = Redactor(BLANK, RuleParams(), words.TextLayout().words_per_page)

    def redact(docs):
        return redactor.text(words.text_words(docs), words.text_pages(docs))

    def run():
        redaction_stream(spark, str(source), "*.parquet", schema, redact,
                         lambda df, n: outputs.write_batch(df, out, n), str(tmp_path / "ckpt"), 1).awaitTermination()

    spark.createDataFrame(texts[:2], schema).coalesce(1).write.parquet(str(source))
    run()
    spark.createDataFrame(texts[2:], schema).coalesce(1).write.mode("append").parquet(str(source))
    run()
    run()
    got = {(r.doc_id, r.line_text) for r in spark.read.parquet(out).collect()}
    batch = {(r.doc_id, r.line_text) for r in redact(spark.createDataFrame(texts, schema)).collect()}
    assert got == batch == {(1, "Nome:"), (2, "a b c"), (3, "x")}


@pytest.mark.parametrize("files", [1, 3])
def test_stream_reads_a_table_of_one_file_or_of_a_folder_of_files(spark, tmp_path, files):
    texts = [(n, f"a b{n} the: x y") for n in range(7)] + [(7, None), (8, " ")]
    table = tmp_path / "documents.parquet"
    written = table if files > 1 else tmp_path / "written"
    spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(files).write.parquet(str(written))
    if files == 1:
        shutil.copy(next(written.glob("part-*")), table)
    assert table.is_dir() == (files > 1)
    streamed, batch = [sorted(registered()[name](spark, str(tmp_path)).collect()) for name in ("stream_redacted_text", "redacted_text")]
    assert streamed == batch and {r[0] for r in streamed} == set(range(7))


def memory_stream(spark, tmp_path, bodies):
    rows = [(n, b, f"2024-01-01 00:0{n}:00") for n, b in enumerate(bodies)]
    spark.createDataFrame(rows, "event_id BIGINT, body STRING, t STRING") \
        .withColumn("event_time", F.to_timestamp("t")).drop("t").coalesce(1).write.parquet(str(tmp_path / "ev"))
    return spark.readStream.schema("event_id BIGINT, body STRING, event_time TIMESTAMP").parquet(str(tmp_path / "ev"))


def drain(df, name, tmp_path):
    df.writeStream.format("memory").queryName(name).trigger(availableNow=True) \
        .option("checkpointLocation", str(tmp_path / name)).start().awaitTermination()
    return df.sparkSession.table(name).collect()


def test_notification_stream(spark, tmp_path):
    body = notification(("aws:s3", "b", "x.pdf"), ("aws:s3", "b", "y.txt"))
    stream = memory_stream(spark, tmp_path, [body, body])
    assert [r.key for r in drain(work_item_stream(stream), "repeats", tmp_path)] == ["x.pdf", "x.pdf"]
    assert [r.key for r in drain(work_item_stream(stream, "1 hour"), "once", tmp_path)] == ["x.pdf"]


def arrive(spark, folder, number, body):
    spark.createDataFrame([(number, body, f"2024-01-01 00:0{number}:00")], "event_id BIGINT, body STRING, t STRING") \
        .withColumn("event_time", F.to_timestamp("t")).drop("t").coalesce(1).write.mode("append").parquet(folder)


def test_notifications_to_objects_over_batches_and_a_restart(spark, tmp_path):
    folder = str(tmp_path / "ev")
    texts = {"x.pdf": (1, "Nome: Ana"), "y.pdf": (2, "b c")}
    table = spark.createDataFrame([(k, d, t) for k, (d, t) in texts.items()], "key STRING, doc_id BIGINT, text STRING")

    def load(items):
        named = items.join(table.select("key", "doc_id"), "key", "left")
        docs = table.join(items.select("key").distinct(), "key", "left_semi").select("doc_id", "text")
        return named, docs, words.text_words(docs), words.text_pages(docs)

    def run(name, window):
        stream = spark.readStream.schema("event_id BIGINT, body STRING, event_time TIMESTAMP").parquet(folder)
        job_stream(work_item_stream(stream, window), load, Redactor(BLANK, RuleParams(), 600), str(tmp_path / name),
                   str(tmp_path / f"{name}-checkpoint"), lambda: 1700).awaitTermination()
        return [(r.output_key, r.content) for r in spark.read.parquet(str(tmp_path / name / "objects")).collect()]

    arrive(spark, folder, 1, notification(("aws:s3", "b", "x.pdf")))
    first = run("all", None), run("once", "1 hour")
    assert first[0] == first[1] and [c for _, c in first[0]] == ["Nome:"]
    arrive(spark, folder, 2, notification(("aws:s3", "b", "x.pdf"), ("aws:s3", "b", "y.pdf"), ("aws:s3", "b", "gone.pdf")))
    again, once = run("all", None), run("once", "1 hour")
    assert sorted(c for _, c in again) == ["Nome:", "Nome:", "b c"] and len({k for k, _ in again}) == 2
    assert sorted(once) == sorted(set(again))  # the repeat is dropped although it came in another batch, after a restart
    errors = spark.read.parquet(str(tmp_path / "once" / "audit")).where("status = 'error'").collect()
    assert [(r.input_key, r.error) for r in errors] == [("gone.pdf", "object not found")]


def small_job(spark, root, batch_id, doc_id=1):
    items = spark.createDataFrame([(0, doc_id, "b", f"{doc_id}.pdf", doc_id), (0, 9, "b", "gone.pdf", 99)],
                                  "event_id BIGINT, pos INT, bucket STRING, key STRING, doc_id BIGINT")
    docs = spark.createDataFrame([(doc_id, "x", {"title": "t", "custom": "c"}, "<x/>")],
                                 "doc_id BIGINT, text STRING, meta MAP<STRING,STRING>, xmp STRING")
    return run_batch(Redactor(BLANK, RuleParams(), 100), items, docs, words_df(spark, page_of("Nome: Ana b", doc=doc_id)),
                     a4_pages(spark, (doc_id, 1)), root, batch_id, 1700)


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def seen(table):
        found = outputs.committed(spark, root, table)
        return found if found is None else sorted(r.batch_id for r in found.select("batch_id").distinct().collect())

    def fails(*args):
        raise OSError("between audit and objects")

    assert seen("audit") is None
    with monkeypatch.context() as patch:
        patch.setattr("inkveil.plans.job.output_objects", fails)
        with pytest.raises(OSError):
            small_job(spark, root, 1)
    assert spark.read.parquet(f"{root}/audit").count() == 2  # the first tables are written, but nobody sees them
    assert seen("audit") is None and seen("objects") is None
    small_job(spark, root, 1)
    assert seen("audit") == seen("objects") == seen("metrics") == [1]
    with monkeypatch.context() as patch:
        patch.setattr("inkveil.plans.job.output_objects", fails)
        with pytest.raises(OSError):
            small_job(spark, f"{root}/", 2, 2)
    assert seen("audit") == seen("objects") == [1]
    small_job(spark, f"{root}/", 2, 2)
    assert seen("audit") == seen("objects") == [1, 2] and seen("images") is None
    assert outputs.committed(spark, root, "objects").where("batch_id = 2").count() == 1


def test_stored_objects_carry_cleared_metadata(spark, tmp_path):
    row = small_job(spark, str(tmp_path), 1).objects.first()
    assert row.document_meta == {"title": "", "custom": "c"} and row.document_xmp == ""


def test_images_and_metrics_of_a_stream_over_batches_and_a_restart(spark, tmp_path):
    folder, root = str(tmp_path / "ev"), str(tmp_path / "out")
    names = {"x.pdf": 1, "y.pdf": 2, "z.pdf": 3}
    table = spark.createDataFrame([(k, d, f"Nome: a{d} b") for k, d in names.items()], "key STRING, doc_id BIGINT, text STRING")
    white = bytearray(b"\xff" * 48)
    pictures = spark.createDataFrame(
        [(1, 2, 4, 4, 3, white, None), (2, 2, None, None, None, None, images.UNREADABLE), (3, 2, 4, 4, 3, white, None)],
        "doc_id BIGINT, page_no INT, width INT, height INT, nChannels INT, data BINARY, error STRING")
    redactor = Redactor(RuleSet(page1_regions=(), page2_regions=((0.25, 0.25, 0.5, 0.5),)), RuleParams(), 600)

    def load(items):
        named = items.join(table.select("key", "doc_id"), "key", "left")
        docs = table.join(items.select("key").distinct(), "key", "left_semi").select("doc_id", "text")
        return (named, docs, words.text_words(docs), words.text_pages(docs), pictures.join(docs.select("doc_id"), "doc_id"))

    def run():
        stream = spark.readStream.schema("event_id BIGINT, body STRING, event_time TIMESTAMP").parquet(folder)
        job_stream(work_item_stream(stream), load, redactor, root, str(tmp_path / "checkpoint"), lambda: 1700).awaitTermination()

    arrive(spark, folder, 1, notification(("aws:s3", "b", "x.pdf"), ("aws:s3", "b", "y.pdf")))
    run()
    arrive(spark, folder, 2, notification(("aws:s3", "b", "z.pdf"), ("aws:s3", "b", "gone.pdf")))
    run()
    run()
    streamed = {r.doc_id: bytes(r.data) for r in outputs.committed(spark, root, "images").collect()}
    items = table.select(F.lit(0).cast("bigint").alias("event_id"), F.col("doc_id").cast("int").alias("pos"),
                         F.lit("b").alias("bucket"), "key", "doc_id")
    batch = run_batch(redactor, items, table.select("doc_id", "text"), words.text_words(table), words.text_pages(table),
                      str(tmp_path / "batch"), 0, 1700, pictures)
    assert streamed == {r.doc_id: bytes(r.data) for r in batch.images.collect()}
    assert set(streamed) == {1, 3} and streamed[1].count(0) == 3 * 4  # columns and rows 1 and 2
    metrics = {(r.batch_id, r.metric): r.value for r in outputs.committed(spark, root, "metrics").collect()}
    assert metrics[0, "items"] == 2 and metrics[0, "successes"] == 1 and metrics[0, f"error: {images.UNREADABLE}"] == 1
    assert metrics[1, "items"] == 2 and metrics[1, "error: object not found"] == 1 and metrics[1, "n_words_removed"] == 2
    assert (2, "items") not in metrics and metrics[1, "seconds"] > 0


def test_object_stream(spark, tmp_path):
    store(tmp_path / "s")
    found = drain(object_stream(spark, str(tmp_path / "s")).select("path", "length"), "objects", tmp_path)
    assert sorted(r.path.rsplit("/", 1)[-1] for r in found) == ["x.pdf", "y.PDF"]
