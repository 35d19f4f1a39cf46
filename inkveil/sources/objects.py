"""Object contents as a table, and their join to work items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PDF_GLOB = "*.[pP][dD][fF]"
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
PDF_MAGIC = b"%PDF-"
MISSING = "object not found"
NOT_A_PDF = "content is not a PDF"


def read_files(spark: SparkSession, root: str, glob: str = PDF_GLOB) -> DataFrame:
    """Files below a folder (path, modificationTime, length, content, partition columns).

    The glob prunes the listing; content is only read where a query uses it.
    """
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)


def read_objects(spark: SparkSession, root: str, glob: str = PDF_GLOB) -> DataFrame:
    """Objects laid out as <root>/<bucket>/<key...>: (bucket, key, length, content)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob) \
        .option("recursiveFileLookup", "true").load(root)
    # File systems spell the scheme differently (file:/x, file:///x), so cut behind the root's own path.
    own_path = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.substring_index("path", own_path + "/", -1)
    return files.select(
        F.substring_index(below, "/", 1).alias("bucket"),
        F.regexp_extract(below, "^[^/]*/(.*)$", 1).alias("key"), "length", "content")


def check(objects: DataFrame) -> DataFrame:
    """Adds error: what is wrong with the content, or null."""
    magic = F.substring("content", 1, len(PDF_MAGIC))
    return objects.withColumn("error", F.when(F.col("content").isNull(), F.lit(MISSING))
                              .when(magic != F.lit(PDF_MAGIC), F.lit(NOT_A_PDF)))


def with_content(items: DataFrame, objects: DataFrame) -> DataFrame:
    """Left join of work items to contents. A missing or unreadable object becomes an error row."""
    return check(items.join(objects, ["bucket", "key"], "left"))
