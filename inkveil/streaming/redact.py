"""Files or notifications that keep arriving."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkveil.plans.job import run_batch
from inkveil.plans.pipeline import Redactor
from inkveil.sources.events import event_records, pdf_work_items
from inkveil.sources.objects import FILE_SCHEMA, PDF_GLOB


def redaction_stream(spark: SparkSession, folder: str, glob: str, schema: str,
                     transform: Callable[[DataFrame], DataFrame],
                     write: Callable[[DataFrame, int], object], checkpoint: str,
                     files_per_trigger: int = 1000, keep_running: bool = False) -> StreamingQuery:
    """Runs a batch transform on the Parquet files that arrive in a folder.

    Each micro-batch is an ordinary DataFrame, so the stream needs no state. A replayed batch has the
    same id and contents; `write` gets the id so that it can replace what an earlier attempt left.
    """
    source = (
        spark.readStream.format("parquet").schema(schema)
        .option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        write(transform(batch).observe("redacted", F.count(F.lit(1)).alias("rows")), batch_id)

    writer = source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if not keep_running:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def object_stream(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """New PDF objects below a folder: (path, modificationTime, length, content)."""
    return (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("pathGlobFilter", PDF_GLOB).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(root)
    )


def work_item_stream(events: DataFrame, repeat_window: str | None = None) -> DataFrame:
    """Work items of a stream of notifications (event_id, body, event_time).

    Repeats are kept, as in batch. With repeat_window, a (bucket, key) that comes again within that
    time is dropped, and state is kept no longer than that.
    """
    if repeat_window is None:
        return pdf_work_items(event_records(events))
    timed = events.withWatermark("event_time", repeat_window)
    parsed = event_records(timed.withColumn("event_id", F.struct("event_id", "event_time")))
    items = pdf_work_items(parsed).select("event_id.event_id", "event_id.event_time", "pos", "bucket", "key")
    return items.dropDuplicatesWithinWatermark(["bucket", "key"])


def job_stream(items: DataFrame, load: Callable[[DataFrame], tuple[DataFrame, ...]],
               redactor: Redactor, root: str, checkpoint: str, epoch_seconds: Callable[[], int] = lambda: int(time.time()),
               keep_running: bool = False) -> StreamingQuery:
    """From work items to stored objects: each micro-batch of items is a run of the batch job below root.

    items: a stream as work_item_stream makes it. load(items) joins them to the stored objects and gives (items with
    doc_id, documents, words, pages) and, where pages are rendered, the images of the same documents. A micro-batch that
    is repeated after a failure replaces its own folders, and the output key of a (bucket, key) is the same in every
    batch. Each micro-batch is committed as a whole (sources.outputs.committed), with its metrics as a table. How much a
    micro-batch takes is set on the source (maxFilesPerTrigger).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        named, documents, words, pages, *images = load(batch.select("event_id", "pos", "bucket", "key"))
        run_batch(redactor, named, documents, words, pages, root, batch_id, epoch_seconds(), *images)

    writer = items.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if not keep_running:
        writer = writer.trigger(availableNow=True)
    return writer.start()
