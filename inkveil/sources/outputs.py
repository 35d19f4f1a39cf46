"""Writing results so that a repeated batch replaces itself, and is seen as a whole or not at all.

A batch writes several tables. Its manifest (batches/batch_id=N below the root) lists their folders: it is opened before
the first table is touched and committed behind the last one. `committed` reads the tables of committed batches alone, so
a batch that failed between two tables, or is being repeated, shows none of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.functions.keys import provenance

CONTENT_TYPE = "text/plain; charset=utf-8"


MANIFEST = "table STRING, folder STRING, state STRING"
OPEN, COMMITTED = "open", "committed"


def output_objects(results: DataFrame, items: DataFrame, published: DataFrame, epoch_seconds: int,
                   cleared: DataFrame | None = None) -> DataFrame:
    """What is stored for each successful work item: where, its content and content type, its provenance, and the
    metadata of its document.

    The content are the published lines of the text page in order. A document that several items name is put together
    once. ingest_date is the day of the batch in UTC. cleared: (doc_id, meta, xmp) as clear_metadata leaves them; both
    are null for documents that are not in it.
    """
    c = F.col
    lines = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    content = published.where("kind = 'text'").groupBy("doc_id").agg(
        F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("content"))
    stored = results.filter(c("status") == "success").join(items.select("event_id", "pos", "doc_id"), ["event_id", "pos"])
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), epoch_seconds // 86400), "yyyy-MM-dd")
    whole = stored.join(content, "doc_id", "left")
    if cleared is None:
        whole = whole.withColumns({"meta": F.lit(None).cast("map<string,string>"), "xmp": F.lit(None).cast("string")})
    else:
        whole = whole.join(cleared.select("doc_id", "meta", "xmp"), "doc_id", "left")
    return whole.select(
        "event_id", "pos", "doc_id", "output_bucket", "output_key", F.lit(CONTENT_TYPE).alias("content_type"),
        F.coalesce("content", F.lit("")).alias("content"), day.alias("ingest_date"),
        provenance(c("input_bucket"), c("input_key"), epoch_seconds).alias("metadata"),
        c("meta").alias("document_meta"), c("xmp").alias("document_xmp"))


def write_batch(df: DataFrame, root: str, batch_id: int | str, partition_by: tuple[str, ...] = ()) -> str:
    """Write one batch as Parquet to its own folder; rerunning the batch overwrites only that folder."""
    path = f"{root.rstrip('/')}/batch_id={batch_id}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def mark_batch(spark: SparkSession, root: str, batch_id: int | str, folders: dict[str, str], state: str) -> None:
    """Writes the manifest of a batch: its tables' folders (relative to the root), open or committed."""
    rows = [(table, folder, state) for table, folder in folders.items()] or [(None, None, state)]
    write_batch(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{root.rstrip('/')}/batches", batch_id)


def committed(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """A table of all committed batches below a root, with their batch_id; None where there is none yet."""
    root = root.rstrip("/")
    manifests = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batches")
    if not manifests.getFileSystem(spark._jsc.hadoopConfiguration()).exists(manifests):
        return None
    listed = spark.read.schema(MANIFEST).parquet(f"{root}/batches").where(
        (F.col("state") == COMMITTED) & (F.col("table") == table))
    folders = sorted(r.folder for r in listed.select("folder").collect())  # a row a batch
    return spark.read.option("basePath", f"{root}/{table}").parquet(*[f"{root}/{f}" for f in folders]) if folders else None
