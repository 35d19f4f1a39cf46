"""The registered queries: every operator over the whole given tables.

The given tables hold prose, so words are laid out from `documents` on a page grid, notifications are
built from `pages`, and the rule profile below uses frequent words as labels.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.functions.geometry import pixel
from inkveil.functions.keys import output_key, provenance
from inkveil.operators import apply, audit, detect, lines, metadata, pages, raster, regions
from inkveil.params import RuleParams, RuleSet
from inkveil.plans.job import BatchTables, run_batch
from inkveil.plans.pipeline import Redactor
from inkveil.session import scratch_dir, tune
from inkveil.sources import events, objects, rules, words
from inkveil.sources.outputs import write_batch
from inkveil.streaming.redact import redaction_stream

LAYOUT = words.TextLayout(colon_every=37)
RULES = RuleSet(
    redact_labels=("the:", "de:", "der:", "is:"),
    keep_labels=("of:", "la:", "and:"),
    register_tokens=("that", "that:", "que"),
    page1_regions=((0.375, 0.25, 0.625, 0.5), (50, 50, 200, 80)),
    page2_regions=((0.125, 0.125, 0.375, 0.25), (0.75, 0.5, 0.5, 0.625), (100, 200, 400, 250)),
)
PARAMS = RuleParams(output_bucket="anonymized")
# Labels of several words, some of which overlap in the texts.
MULTIWORD = replace(RULES, redact_labels=(*RULES.redact_labels, "of the:", "the the the:", "de  la:"),
                    keep_labels=(*RULES.keep_labels, "the of:", "and the:", "to the:"))
MULTIWORD_PARAMS = replace(PARAMS, multiword_labels=True)
FOLD_PARAMS = RuleParams(line_tolerance=0.15)
SPLIT_PARAMS = RuleParams(line_tolerance=0.15, page_split_rows=100)
BATCH_TIME = 1_700_000_000
# Of the work items one in eleven names an object that is not there, and one a document without words.
NOT_THERE, BLANK, ONE_IN = 3, 7, 11
# Grid boxes (columns and rows, inclusive) burned into the 8 x 8 embedding rasters.
GRID_WIDTH, GRID_REGION = 8, (0.25, 0.125, 0.625, 0.375)

_JOBS: dict[tuple[str, str], BatchTables] = {}

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def by_document(documents: DataFrame) -> DataFrame:
    """Texts hashed by doc_id before they multiply into words.

    This is the only large shuffle: whatever is computed per document, page or line afterwards
    finds its rows together. Adaptive execution sizes its partitions.
    """
    return documents.repartition("doc_id")


def target(page: Column) -> Column:
    """The id of the document or object that the notification of a page names."""
    return F.when(page % ONE_IN == NOT_THERE, page + 10**12).when(page % ONE_IN == BLANK, -page - 1).otherwise(page)


class Scenario:
    """The tables and operators the queries share, for one session and directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: RuleParams = PARAMS,
                 page_rows: int | None = LAYOUT.words_per_page, rule_set: RuleSet = RULES):
        self.spark, self.sf_dir, self.params, self.rule_set = tune(spark), sf_dir, params, rule_set
        self.redactor = Redactor(rule_set, params, page_rows)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def texts(self) -> DataFrame:
        return by_document(self.table("documents").select("doc_id", "text"))

    def words(self) -> DataFrame:
        return words.text_words(self.texts(), LAYOUT)

    def pages(self) -> DataFrame:
        return words.text_pages(self.texts(), LAYOUT)

    def tokens(self) -> DataFrame:
        return self.redactor.tokens(self.words())

    def marked(self) -> DataFrame:
        return self.redactor.marked_tokens(self.words())

    def regions(self) -> DataFrame:
        return rules.region_table(self.spark, RULES)

    def plan(self) -> DataFrame:
        return self.redactor.plan(self.words(), self.pages())

    def events(self) -> DataFrame:
        """One notification per ten pages, its records in page order, as JSON text."""
        c = F.col
        kind = c("page_id") % 7
        host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
        path = F.regexp_extract("url", "^[a-z]+://[^/]+/([^?#]*)", 1)
        stem = F.concat(F.lit("in/"), path, F.lit("_"), c("page_id").cast("string"))
        key = (F.when(kind == 1, F.concat(stem, F.lit(".PDF")))
               .when(kind == 2, F.concat(stem, F.lit(".txt")))
               .when(kind == 5, F.concat(F.lit("in/a+b%20c/"), path, F.lit("_"), c("page_id").cast("string"),
                                         F.lit(".pdf")))
               .otherwise(F.concat(stem, F.lit(".pdf"))))
        bucket = F.when(kind == 6, F.lit("")).otherwise(host)
        record = F.concat(
            F.lit('{"eventSource":"'), F.when(kind == 3, "aws:sqs").otherwise("aws:s3"),
            F.lit('","s3":{"bucket":{"name":"'), bucket, F.lit('"},"object":{'),
            F.when(kind == 4, F.lit("")).otherwise(F.concat(F.lit('"key":"'), key, F.lit('"'))), F.lit("}}}"))
        ordered = F.array_sort(F.collect_list(F.struct("page_id", record.alias("r"))))
        return (
            self.table("pages").groupBy(F.floor(c("page_id") / 10).alias("event_id"))
            .agg(F.array_join(F.transform(ordered, lambda x: x["r"]), ",").alias("rs"))
            .select("event_id", F.concat(F.lit('{"Records":['), "rs", F.lit("]}")).alias("body"))
        )

    def items(self) -> DataFrame:
        return events.pdf_work_items(events.event_records(self.events()))

    def named_items(self) -> DataFrame:
        """Work items with the document that each names: its id comes from the end of the key."""
        return self.items().withColumn("doc_id", target(F.regexp_extract("key", "_([0-9]+)[.][^.]*$", 1).cast("bigint")))

    def stored(self) -> DataFrame:
        """All documents, and one without words for each page that asks for one."""
        blank = self.table("pages").where(F.col("page_id") % ONE_IN == BLANK)
        return self.table("documents").select("doc_id", "text").unionByName(
            blank.select(target(F.col("page_id")).alias("doc_id"), F.lit(" \n").alias("text")))

    def document_metadata(self) -> DataFrame:
        meta = F.create_map(F.lit("title"), "source", F.lit("author"), "lang", F.lit("producer"), F.lit("p"),
                            F.lit("format"), F.lit("PDF")).alias("meta")
        return self.table("documents").select("doc_id", meta, F.lit("<x/>").alias("xmp"))

    def contents(self) -> DataFrame:
        """The object behind each page: its html, a PDF by its first bytes unless it comes from a blog."""
        magic = F.when(F.contains("url", F.lit("blog.")), F.lit("")).otherwise(F.lit("%PDF-"))
        return self.table("pages").select(F.col("page_id").alias("page"), F.concat(magic, "html").alias("value"))

    def job(self) -> BatchTables:
        """The tables of one run of the batch job, which the queries about it share in a session."""
        run = (self.spark.sparkContext.applicationId, self.sf_dir)
        if run not in _JOBS:
            items = self.named_items()
            checked = objects.check(self.contents().withColumn("content", F.encode("value", "UTF-8")))
            checked = checked.select(target(F.col("page")).alias("doc_id"), "error").where("error is not null")
            wanted = by_document(self.stored().join(items.select("doc_id").distinct(), "doc_id", "left_semi"))
            known = self.document_metadata()
            documents = wanted.join(checked, "doc_id", "left").join(known, "doc_id", "left")
            _JOBS[run] = run_batch(
                self.redactor, items, documents, words.text_words(wanted, LAYOUT),
                words.text_pages(wanted, LAYOUT), scratch_dir(self.spark, "job"), 0, BATCH_TIME)
        return _JOBS[run]

    def results(self) -> DataFrame:
        return self.job().audit


def _counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def event_records(s: Scenario) -> DataFrame:
    return events.event_records(s.events())


def pdf_work_items(s: Scenario) -> DataFrame:
    return s.items()


def object_scan(s: Scenario) -> DataFrame:
    """Work items joined to objects read back as files: one is written first for every page that an item names."""
    root = scratch_dir(s.spark, "objects")
    named = s.named_items().withColumnRenamed("doc_id", "page")
    wanted = s.contents().join(named.select("page"), "page", "left_semi")
    wanted.repartition("page").write.partitionBy("page").text(root)
    stored = objects.read_files(s.spark, root, "*.txt").select(F.col("page").cast("bigint"), "length", "content")
    contents = stored.join(named.select("page", "bucket", "key"), "page").drop("page")
    return objects.with_content(s.items(), contents).select(
        "event_id", "pos", "bucket", "key", "length", F.md5("content").alias("content_md5"), "error")


def doc_words(s: Scenario) -> DataFrame:
    return s.words()


def word_filter(s: Scenario) -> DataFrame:
    """Blank words dropped: the texts cut at single blanks, so that runs of blanks leave blank words."""
    cut = s.texts().select("doc_id", F.posexplode(F.split("text", " ")).alias("word_idx", "text"))
    return lines.non_blank(cut)


def reading_order(s: Scenario) -> DataFrame:
    return lines.reading_order(s.words()).select("doc_id", "page_no", "word_idx", "band", F.col("ord").cast("bigint"))


def reading_order_split(s: Scenario) -> DataFrame:
    return lines.reading_order_split(s.words()).select("doc_id", "page_no", "word_idx", "band", "ord")


def line_segments(s: Scenario) -> DataFrame:
    return s.tokens().select("doc_id", "page_no", "word_idx", "line_no")


def line_tokens(s: Scenario) -> DataFrame:
    return _counts(lines.with_line_length(s.tokens()), "pos", "line_len") \
        .select("doc_id", "page_no", "line_no", "pos", "line_len", "word_idx", "text")


def line_boxes(s: Scenario) -> DataFrame:
    return lines.line_boxes(s.tokens(), s.params)


def line_text(s: Scenario) -> DataFrame:
    return lines.line_text(s.tokens())


def label_hits(s: Scenario) -> DataFrame:
    hits = detect.label_hits(s.words(), rules.label_table(s.spark, RULES))
    return hits.filter(F.col("action").isNotNull()).select("doc_id", "page_no", "word_idx", "text", "action")


def label_hits_multiword(s: Scenario) -> DataFrame:
    return detect.multiword_hits(s.tokens(), rules.label_table(s.spark, s.rule_set))


def value_spans(s: Scenario) -> DataFrame:
    return _counts(detect.value_spans(s.marked()), "label_pos", "start_pos", "end_pos")


def value_boxes(s: Scenario) -> DataFrame:
    return _counts(detect.value_boxes(s.marked(), s.params), "label_pos")


def register_hits(s: Scenario) -> DataFrame:
    return detect.register_hits(s.words(), RULES.search_terms) \
        .select("doc_id", "page_no", "word_idx", "text", "x0", "y0", "x1", "y1")


def register_tail_boxes(s: Scenario) -> DataFrame:
    return _counts(detect.register_tail_boxes(s.marked(), s.params), "pos")


def signature_lines(s: Scenario) -> DataFrame:
    return detect.signature_lines(s.marked(), s.params)


def rule_tables(s: Scenario) -> DataFrame:
    """The label lists of the profile and the languages of the documents as labels, merged."""
    langs = s.table("documents").select(F.concat("lang", F.lit(":")).alias("label"), F.lit("redact").alias("action"))
    return rules.merge_labels(rules.label_lists(s.spark, RULES).unionByName(langs))


def fixed_boxes(s: Scenario) -> DataFrame:
    return regions.fixed_boxes(s.pages(), s.regions())


def pixel_boxes(s: Scenario) -> DataFrame:
    return regions.pixel_boxes(regions.raster_pages(s.pages(), s.params), s.regions())


def raster_burn(s: Scenario) -> DataFrame:
    """Embeddings as square grids of pixels, with a relative region blacked out."""
    side = F.sqrt(F.size("embedding")).cast("int")
    x0, y0, x1, y1 = (pixel(F.lit(float(r)), side) for r in GRID_REGION)
    box = F.array(F.struct(x0.alias("px0"), y0.alias("py0"), x1.alias("px1"), y1.alias("py1")))
    burned = raster.burn_grid(F.col("embedding"), GRID_WIDTH, box)
    return s.table("embeddings").select("vec_id", F.posexplode(burned).alias("idx", "v")) \
        .select("vec_id", "idx", F.col("v").cast("double").alias("v"))


def redaction_plan(s: Scenario) -> DataFrame:
    return s.plan()


def removed_words(s: Scenario) -> DataFrame:
    w = lines.non_blank(pages.text_page(s.words()))
    return apply.removed_words(w, s.plan()).select("doc_id", "page_no", "word_idx", "text")


def kept_words(s: Scenario) -> DataFrame:
    return s.redactor.kept(s.words(), s.pages()).select("doc_id", "page_no", "word_idx", "text")


def page_routing(s: Scenario) -> DataFrame:
    docs = by_document(s.stored())
    return pages.page_routing(docs, words.text_pages(docs, LAYOUT))


def page_policy(s: Scenario) -> DataFrame:
    return pages.page_policy(s.pages())


def published_pages(s: Scenario) -> DataFrame:
    return s.redactor.publish(s.words(), s.pages())


def redacted_text(s: Scenario) -> DataFrame:
    """Flagship: what remains of the text page of every document, line by line."""
    return s.redactor.text(s.words(), s.pages())


def output_keys(s: Scenario) -> DataFrame:
    return s.items().select("event_id", "pos", output_key(F.col("bucket"), F.col("key")).alias("output_key"))


def provenance_rows(s: Scenario) -> DataFrame:
    entry = F.explode(provenance(F.col("bucket"), F.col("key"), BATCH_TIME)).alias("name", "value")
    return s.items().select("event_id", "pos", entry)


def metadata_cleared(s: Scenario) -> DataFrame:
    return metadata.clear_metadata(s.document_metadata()).select("doc_id", "xmp", F.explode("meta").alias("name", "value"))


def audit_rows(s: Scenario) -> DataFrame:
    return s.results()


def stored_objects(s: Scenario) -> DataFrame:
    """What the job stores: the redacted lines under the output key of each work item."""
    return s.job().objects.select("event_id", "pos", "doc_id", "output_bucket", "output_key", "content_type", "content",
                                  F.col("ingest_date").cast("string").alias("ingest_date"))


def stored_metadata(s: Scenario) -> DataFrame:
    """The metadata of the documents behind the stored objects, cleared, name by name."""
    return s.job().objects.select(
        "event_id", "pos", F.col("document_xmp").alias("xmp"), F.explode("document_meta").alias("name", "value"))


def batch_metrics(s: Scenario) -> DataFrame:
    """What the job counted, without the time it took."""
    return s.job().metrics.where("metric <> 'seconds'")


def published_rasters(s: Scenario) -> DataFrame:
    """Embeddings as gray images of second pages, with the regions of the profile burned, by pixel."""
    side = F.sqrt(F.size("embedding")).cast("int")
    levels = F.transform("embedding", lambda v: F.lpad(F.hex((F.abs(v.cast("double")) * 100).cast("bigint") % 256), 2, "0"))
    images = s.table("embeddings").select(
        F.col("vec_id").alias("doc_id"), F.lit(2).alias("page_no"), side.alias("width"), side.alias("height"),
        F.lit(1).alias("nChannels"), F.unhex(F.array_join(levels, "")).alias("data"))
    burned = raster.published_images(images, s.regions())
    pixel_ = F.posexplode(F.split(F.regexp_replace(F.hex("data"), "(..)(?!$)", "$1 "), " ")).alias("idx", "level")
    return burned.select("doc_id", "page_no", "width", "height", pixel_).withColumn("level", F.conv("level", 16, 10).cast("int"))


def redaction_plan_of_tables(s: Scenario) -> DataFrame:
    """Boxes by rules that come as tables: the profile, and the languages of the documents as labels."""
    langs = s.table("documents").select(F.concat("lang", F.lit(":")).alias("label"), F.lit("redact").alias("action"))
    read = rules.RuleTables.merged(rules.label_lists(s.spark, RULES).unionByName(langs), rules.token_table(s.spark, RULES), s.regions())
    return Redactor(read, s.params, LAYOUT.words_per_page).plan(s.words(), s.pages())


def batch_summary(s: Scenario) -> DataFrame:
    return audit.batch_summary(s.events(), s.results())


def batch_response(s: Scenario) -> DataFrame:
    return audit.batch_response(s.events(), s.results())


def stream_redacted_text(s: Scenario) -> DataFrame:
    """The flagship as a stream over the document files, run until all input is processed.

    The table is one file or a folder of files: a path with a pattern, even of one name, stands for either.
    """
    out = scratch_dir(s.spark, "stream")

    def redact(docs: DataFrame) -> DataFrame:
        texts = by_document(docs)
        return s.redactor.text(words.text_words(texts, LAYOUT), words.text_pages(texts, LAYOUT))

    query = redaction_stream(
        s.spark, f"{s.sf_dir.rstrip('/')}/documents[.]parquet", "*", "doc_id BIGINT, text STRING", redact,
        lambda df, batch_id: write_batch(df, f"{out}/text", batch_id), f"{out}/checkpoint")
    query.awaitTermination()
    return s.spark.read.parquet(f"{out}/text").select("doc_id", "page_no", "line_no", "line_text")


def _on(query: Callable[[Scenario], DataFrame], **options) -> Query:
    return lambda spark, sf_dir: query(Scenario(spark, sf_dir, **options))


def registered() -> dict[str, Query]:
    plain = (
        event_records, pdf_work_items, object_scan, doc_words, word_filter, reading_order, reading_order_split, line_segments,
        line_tokens, line_boxes, line_text, label_hits, value_spans, value_boxes, register_hits,
        register_tail_boxes, signature_lines, rule_tables, fixed_boxes, pixel_boxes, raster_burn,
        redaction_plan, removed_words, kept_words, page_routing, page_policy, published_pages, redacted_text,
        output_keys, metadata_cleared, batch_summary, batch_response, stream_redacted_text, stored_objects,
        stored_metadata, batch_metrics,
        published_rasters, redaction_plan_of_tables,
    )
    named = {q.__name__: _on(q) for q in plain}
    named["provenance"] = _on(provenance_rows)
    named["audit"] = _on(audit_rows)
    # The same operators with a tolerance at which lines are folded word by word, and with pages of
    # unknown size, most of which are then large enough for the split plan.
    named["line_segments_fold"] = _on(line_segments, params=FOLD_PARAMS)
    named["redacted_text_fold"] = _on(redacted_text, params=FOLD_PARAMS)
    named["label_hits_multiword"] = _on(label_hits_multiword, params=MULTIWORD_PARAMS, rule_set=MULTIWORD)
    named["value_spans_multiword"] = _on(value_spans, params=MULTIWORD_PARAMS, rule_set=MULTIWORD)
    named["line_tokens_split"] = _on(line_tokens, params=SPLIT_PARAMS, page_rows=None)
    return named
