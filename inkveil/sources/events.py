"""Object-created notifications -> work items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.functions.text import url_decode

EVENT_SCHEMA = (
    "Records ARRAY<STRUCT<eventSource: STRING, "
    "s3: STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING>>>>"
)
OBJECT_STORE_SOURCE = "aws:s3"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """One event per JSON file: (path, body). Whole files, so events may span several lines."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("event_id"), F.col("value").alias("body"))


def event_records(events: DataFrame) -> DataFrame:
    """(event_id, body JSON) -> one row per record in event order; a missing list gives no rows."""
    parsed = F.from_json("body", EVENT_SCHEMA)
    return (
        events.select("event_id", F.posexplode(parsed["Records"]).alias("pos", "r"))
        .select("event_id", "pos",
                F.col("r.eventSource").alias("event_source"),
                F.col("r.s3.bucket.name").alias("bucket"),
                F.col("r.s3.object.key").alias("raw_key"))
    )


def pdf_work_items(records: DataFrame) -> DataFrame:
    """Records that name a PDF in the object store. Repeats are kept, as each one is a request."""
    return (
        records
        .filter(F.col("event_source") == OBJECT_STORE_SOURCE)
        .filter((F.length("bucket") > 0) & (F.length("raw_key") > 0))
        .withColumn("key", url_decode(F.col("raw_key")))
        .filter(F.lower("key").endswith(".pdf"))
        .select("event_id", "pos", "bucket", "key")
    )
