"""A batch job in stages, each written as a table before the next one reads it.

The stage tables cut the lineage: a lost executor costs the tasks of one stage, a restarted batch
overwrites its own folders, and the boxes are computed once although several later stages need them.
A batch is committed behind its last table; `sources.outputs.committed` reads the tables of committed batches only.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.operators.apply import kept_words
from inkveil.operators.audit import audit, batch_metrics, document_measures
from inkveil.operators.metadata import clear_metadata
from inkveil.operators.pages import published_pages, raster_page, text_page
from inkveil.operators.raster import published_images
from inkveil.operators.regions import raster_pages
from inkveil.plans.pipeline import Redactor
from inkveil.sources.images import image_errors
from inkveil.sources.outputs import COMMITTED, OPEN, mark_batch, output_objects, write_batch
from inkveil.sources.rules import page_errors


@dataclass(frozen=True)
class BatchTables:
    redactions: DataFrame
    published: DataFrame
    audit: DataFrame
    objects: DataFrame
    images: DataFrame | None
    metrics: DataFrame
    seconds: float


def run_batch(redactor: Redactor, items: DataFrame, documents: DataFrame, words: DataFrame,
              pages: DataFrame, root: str, batch_id: int, epoch_seconds: int,
              images: DataFrame | None = None) -> BatchTables:
    """Redacts the documents (doc_id, text, error, meta, xmp) behind work items (event_id, pos, bucket, key, doc_id).

    error is what the check of the content found (sources.objects), or null; the column may be missing, as may meta and
    xmp, the document's metadata, which is stored cleared. images are page images (doc_id, page_no, width, height,
    nChannels, data, error), where there are any. Writes tokens, redactions, published, images, audit, objects and
    metrics below root, and commits the batch. epoch_seconds is the time of the batch.
    """
    started, spark, folders, root = time.monotonic(), items.sparkSession, {}, root.rstrip("/")
    mark_batch(spark, root, batch_id, folders, OPEN)

    def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = write_batch(df, f"{root}/{name}", batch_id, partition_by)
        folders[name] = path.removeprefix(f"{root}/")
        return spark.read.schema(df.schema).parquet(path)

    if "error" not in documents.columns:
        documents = documents.withColumn("error", F.lit(None).cast("string"))
    regions = redactor.tables(items.sparkSession).regions
    tokens = redactor.by_page(stage(redactor.marked_tokens(text_page(words)), "tokens"))
    boxes = stage(redactor.plan_of(tokens, pages), "redactions")
    published = stage(published_pages(kept_words(tokens, boxes, redactor.dense_rows), pages, redactor.params), "published")
    errors = page_errors(raster_pages(raster_page(pages), redactor.params), regions)
    rasters = None
    if images is not None:
        errors = errors.unionAll(image_errors(images))
        rasters = stage(published_images(images, regions), "images")
    measures = document_measures(documents, pages, tokens, boxes, published, errors)
    results = stage(audit(items, measures, redactor.params), "audit")
    cleared = clear_metadata(documents.select("doc_id", "meta", "xmp")) if {"meta", "xmp"} <= set(documents.columns) else None
    objects = stage(output_objects(results, items, published, epoch_seconds, cleared), "objects", ("ingest_date", "output_bucket"))
    metrics = stage(batch_metrics(results, round(time.monotonic() - started, 3)), "metrics")
    mark_batch(spark, root, batch_id, folders, COMMITTED)
    return BatchTables(boxes, published, results, objects, rasters, metrics, round(time.monotonic() - started, 3))
