"""Object keys and provenance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def object_id(bucket: Column, key: Column) -> Column:
    """26 characters fixed by (bucket, key), so a retried or replayed task writes the same object."""
    return F.upper(F.substring(F.sha2(F.concat_ws("/", bucket, key), 256), 1, 26))


def output_key(bucket: Column, key: Column, prefix: str = "anonymized") -> Column:
    """<folder>/<prefix>_<id>.<text after the last dot of the whole key, or pdf>."""
    base = F.substring_index(key, "/", -1)
    folder = F.substring(key, F.lit(1), F.length(key) - F.length(base))
    ext = F.when(F.instr(key, ".") > 0, F.substring_index(key, ".", -1)).otherwise(F.lit("pdf"))
    return F.concat(folder, F.lit(f"{prefix}_"), object_id(bucket, key), F.lit("."), ext)


def provenance(bucket: Column, key: Column, epoch_seconds: int) -> Column:
    """The metadata stored with an output object. The time is one literal per batch."""
    return F.create_map(
        F.lit("original-bucket"), bucket,
        F.lit("original-key"), key,
        F.lit("processing-timestamp"), F.lit(str(int(epoch_seconds))),
        F.lit("anonymized"), F.lit("true"),
    )
