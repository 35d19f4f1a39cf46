"""Document metadata clearing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The metadata keys that are blanked.
CLEARED_KEYS = (
    "title", "author", "subject", "keywords", "creator", "producer", "creationDate", "modDate", "trapped",
)


def clear_metadata(documents: DataFrame) -> DataFrame:
    """Blanks the nine standard keys of meta and empties xmp; other keys stay."""
    return (
        documents
        .withColumn("meta", F.transform_values(
            "meta", lambda k, v: F.when(k.isin(*CLEARED_KEYS), F.lit("")).otherwise(v)))
        .withColumn("xmp", F.lit(""))
    )
