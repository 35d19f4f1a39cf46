"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

# Words are shuffled once on (doc_id, page_no). With this setting off, joins and aggregates on
# (doc_id, page_no, ...) reuse that partitioning instead of shuffling the words a second time.
#
# Spark 4.1 lets a union claim the partitioning its inputs share, but adaptive execution may then change one
# input alone, and a join or aggregate above would meet the wrong partitions. The last setting stops that.
RUNTIME_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.unionOutputPartitioning": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans are designed for. Needed before any operator's result is computed."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name. The session must be tuned, as its plan must make no assumption about where the rows are."""
    if first.sparkSession.conf.get("spark.sql.unionOutputPartitioning", "true") != "false":
        raise RuntimeError("call inkveil.session.tune(spark) first")
    return reduce(DataFrame.unionByName, others, first)


def local_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("inkveil")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared spark.checkpoint.dir.

    Only a local master may do without that setting: executors of a cluster share no other folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="inkveil-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str, plain: bool = False) -> DataFrame:
    """The rows written once below the shared folder and read back: lineage ends, lost executors lose nothing.

    plain: for a table that a join may broadcast. Spark goes by the size of its files, which encodings can make a
    hundredth of that of the rows; without them the files are about as large as the rows are.
    """
    path = scratch_dir(df.sparkSession, purpose)
    options = {"compression": "none", "parquet.enable.dictionary": "false"} if plain else {}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
