"""Row keys, folds and shared folders for the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = -(2**63)


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id`, `_th` (a hash of the text) and `_text`: what tells two rows apart.

    A null id is an id of its own. Rows that repeat both id and text have one key, and whatever an operator
    finds for it holds for each of them.
    """
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_th"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row as it is in `_row`, beside its key: extra columns, whatever their names, meet no other."""
    key = (F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *key)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def most_frequent(counts: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the greatest counts, at most `most` of them and all of equal count or none.

    A histogram of counts (4,096 rows at most) gives the least count to keep, so nothing is sorted and no task takes
    more rows than it has.
    """
    step = F.floor(F.log2(count) * 64)
    sizes = sorted(((r.step, r.n) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for at, n in sizes:
        total += n
        if total > most:
            break
        least = at
    return counts.where(step >= least) if least is not None else counts.where("false")


def discard(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder that no table to come reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
