"""One result row per work item, and totals per notification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.functions.keys import output_key
from inkveil.operators.pages import NO_PAGES
from inkveil.params import RuleParams
from inkveil.session import union_all
from inkveil.sources.objects import MISSING

# The messages of a response.
NOTHING_TO_DO = "No PDF files to process"
COMPLETED = "PDF processing completed"
MEASURES = ["input_size", "output_size", "n_pages", "n_words_in", "n_words_removed", "n_boxes"]


def document_measures(documents: DataFrame, pages: DataFrame, tokens: DataFrame, boxes: DataFrame,
                      published: DataFrame, page_errors: DataFrame) -> DataFrame:
    """Sizes and counts per document: (doc_id, MEASURES, problem). Tokens are the non-blank words of the text page.

    documents: (doc_id, text, error); page_errors: (doc_id, error). Each table is reduced to one row per document
    before the join.
    """
    joined = documents.select("doc_id", F.octet_length("text").cast("bigint").alias("input_size"),
                              F.col("error").alias("content_error"))
    one = F.count(F.lit(1))
    for part in (
        pages.groupBy("doc_id").agg(F.max("page_no").cast("bigint").alias("n_pages")),
        tokens.groupBy("doc_id").agg(one.alias("n_words_in")),
        boxes.groupBy("doc_id").agg(one.alias("n_boxes")),
        published.groupBy("doc_id").agg(F.sum("n_words").alias("n_words_out"),
                                        F.sum(F.octet_length("text")).alias("output_size")),
        page_errors.groupBy("doc_id").agg(F.min("error").alias("page_error")),
    ):
        joined = joined.join(part, "doc_id", "left")
    zero = F.lit(0).cast("bigint")
    counted = joined.withColumns({
        c: F.coalesce(c, zero) for c in ("n_pages", "n_words_in", "n_words_out", "n_boxes", "output_size")})
    problem = F.coalesce("content_error", F.when(F.col("n_pages") == 0, F.lit(NO_PAGES)), "page_error")
    return counted.withColumn("n_words_removed", F.col("n_words_in") - F.col("n_words_out")) \
        .select("doc_id", *MEASURES, problem.alias("problem"))


def audit(items: DataFrame, measures: DataFrame, params: RuleParams) -> DataFrame:
    """Work items (event_id, pos, bucket, key, doc_id) with the outcome of their document.

    A document that is missing, is no PDF, has no pages, or has a page that cannot be read or burned becomes an
    error row; nothing raises.
    """
    c = F.col
    error = F.when(c("n_pages").isNull(), F.lit(MISSING)).otherwise(c("problem"))
    ok = error.isNull()

    def on_success(value: Column) -> Column:
        return F.when(ok, value)

    dropped = F.greatest(c("n_pages") - 2, F.lit(0).cast("bigint"))
    return items.join(measures, "doc_id", "left").select(
        "event_id", "pos",
        F.when(ok, "success").otherwise("error").alias("status"),
        c("bucket").alias("input_bucket"), c("key").alias("input_key"),
        on_success(F.lit(params.output_bucket)).alias("output_bucket"),
        on_success(output_key(c("bucket"), c("key"))).alias("output_key"),
        *[on_success(c(m)).alias(m) for m in MEASURES],
        on_success(dropped).alias("n_pages_dropped"),
        error.alias("error"),
    )


def batch_metrics(results: DataFrame, seconds: float) -> DataFrame:
    """(metric, value) of a batch: items, successes, errors by their message, totals of the measures, and its seconds.

    They come from the audit table, not from what passes by while it is made, so a task that runs twice counts once.
    """
    c, zero = F.col, F.lit(0).cast("bigint")
    sums = {"items": F.count(F.lit(1)), "successes": F.count_if(c("status") == "success"),
            **{m: F.coalesce(F.sum(m), zero) for m in (*MEASURES, "n_pages_dropped")}}
    totals = results.agg(*[f.alias(name) for name, f in sums.items()])
    listed = totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), c(name).cast("double").alias("value")) for name in sums],
        F.struct(F.lit("seconds").alias("metric"), F.lit(float(seconds)).alias("value")))))
    errors = results.where(c("error").isNotNull()).groupBy(F.concat(F.lit("error: "), "error").alias("metric")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    return union_all(listed, errors)


def batch_summary(events: DataFrame, results: DataFrame) -> DataFrame:
    """Totals and status code per notification; whatever is not a success counts as failed."""
    ok = F.col("status") == "success"
    totals = results.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(ok).alias("successful"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"))
    return with_status(events.select("event_id").join(totals, "event_id", "left"))


def with_status(totals: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return totals.withColumns({c: F.coalesce(c, zero) for c in ("total_files", "successful", "failed")}) \
        .withColumn("status_code", F.when(F.col("failed") == 0, 200).otherwise(207)) \
        .withColumn("message", F.when(F.col("total_files") == 0, NOTHING_TO_DO).otherwise(COMPLETED))


def batch_response(events: DataFrame, results: DataFrame) -> DataFrame:
    """(event_id, status_code, body JSON) per notification, its results in record order.

    A body holds the records of one notification, as the notification itself does.
    """
    row = F.struct("pos", F.struct(
        "status", "input_bucket", "input_key", "output_bucket", "output_key",
        "input_size", "output_size", "error").alias("r"))
    listed = results.groupBy("event_id").agg(F.transform(
        F.array_sort(F.collect_list(row)), lambda x: x["r"]).alias("results"))
    full = F.to_json(F.struct(
        "message", F.struct("total_files", "successful", "failed").alias("summary"), "results"))
    empty = F.to_json(F.struct("message"))
    return batch_summary(events, results).join(listed, "event_id", "left").select(
        "event_id", "status_code",
        F.when(F.col("total_files") == 0, empty).otherwise(full).alias("body"))
