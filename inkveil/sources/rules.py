"""Rules as small tables.

Rule tables come from Arrow data or files, so Catalyst knows their size: it broadcasts them while
they are below spark.sql.autoBroadcastJoinThreshold and shuffles otherwise. No hint forces it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.functions.geometry import pixel
from inkveil.params import RuleSet

LABEL_SCHEMA = "label STRING, action STRING"
TOKEN_SCHEMA = "token STRING"
REGION_SCHEMA = "page_no INT, region_id INT, r0 DOUBLE, r1 DOUBLE, r2 DOUBLE, r3 DOUBLE"

REDACT, KEEP = "redact", "keep"


def read_rules(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A rule table from JSON lines."""
    return spark.read.schema(schema).json(path)


def label_lists(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """Both label lists as configured, repeats included."""
    labels = [*rules.redact_labels, *rules.keep_labels]
    actions = [REDACT] * len(rules.redact_labels) + [KEEP] * len(rules.keep_labels)
    return spark.createDataFrame(pa.table({"label": pa.array(labels, pa.string()),
                                           "action": pa.array(actions, pa.string())}))


def merge_labels(lists: DataFrame) -> DataFrame:
    """One row per label; a label in both lists is kept, never redacted."""
    return lists.groupBy("label").agg(F.min("action").alias("action"))


def label_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The merged labels of a rule set, as an exact-size local table."""
    return localized(merge_labels(label_lists(spark, rules)))


def localized(table: DataFrame, most: int = 100_000) -> DataFrame:
    """A rule table as a local one of exact size, or as it is where it has more than `most` rows."""
    rows = table.limit(most + 1).toArrow()
    return table if rows.num_rows > most else table.sparkSession.createDataFrame(rows)


def token_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    tokens = list(dict.fromkeys(rules.register_tokens))
    return spark.createDataFrame(pa.table({"token": pa.array(tokens, pa.string())}))


def region_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    rows = [(page, n, *map(float, r))
            for page, regions in ((1, rules.page1_regions), (2, rules.page2_regions))
            for n, r in enumerate(regions)]
    cols = list(zip(*rows)) if rows else [()] * 6
    types = [pa.int32(), pa.int32()] + [pa.float64()] * 4
    names = ["page_no", "region_id", "r0", "r1", "r2", "r3"]
    return spark.createDataFrame(pa.table({n: pa.array(c, t) for n, c, t in zip(names, cols, types)}))


@dataclass(frozen=True)
class RuleTables:
    """What to look for, as tables: labels (label, action), tokens (token) and regions."""

    labels: DataFrame
    tokens: DataFrame
    regions: DataFrame
    search_terms: tuple[str, ...]

    @classmethod
    def of(cls, spark: SparkSession, rules: RuleSet) -> RuleTables:
        return cls(label_table(spark, rules), token_table(spark, rules), region_table(spark, rules), rules.search_terms)

    @classmethod
    def merged(cls, labels: DataFrame, tokens: DataFrame, regions: DataFrame, most_tokens: int = 1000) -> RuleTables:
        """Rule tables as they were read. The tokens are search terms too, which are part of an expression: at most 1000."""
        listed = [r.token for r in tokens.select("token").distinct().limit(most_tokens + 1).collect() if r.token]
        if len(listed) > most_tokens:
            raise ValueError(f"more than {most_tokens} register tokens")
        terms = tuple(sorted({t.lower() for t in listed}))
        return cls(localized(merge_labels(labels)), localized(tokens.select("token").distinct()), localized(regions), terms)

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> RuleTables:
        """labels.json, tokens.json and regions.json below a folder, as JSON lines."""
        return cls.merged(*(read_rules(spark, f"{folder.rstrip('/')}/{name}.json", schema) for name, schema in (
            ("labels", LABEL_SCHEMA), ("tokens", TOKEN_SCHEMA), ("regions", REGION_SCHEMA))))


OUT_OF_ORDER = "region corners are out of order"
TOO_LARGE = "region is beyond the pixels of any image"


def _out_of_order() -> Column:
    return (F.col("r2") < F.col("r0")) | (F.col("r3") < F.col("r1"))


def page_errors(rasters: DataFrame, regions: DataFrame) -> DataFrame:
    """(doc_id, error): raster pages (doc_id, page_no, img_w, img_h) with a region that cannot be burned."""
    c = F.col
    edges = [(c("r0"), c("img_w")), (c("r1"), c("img_h")), (c("r2"), c("img_w")), (c("r3"), c("img_h"))]
    overflow = reduce(lambda a, b: a | b, [pixel(r, size).isNull() for r, size in edges])
    error = F.when(_out_of_order(), OUT_OF_ORDER).when(overflow, TOO_LARGE)
    return rasters.join(regions, "page_no").withColumn("error", error).where("error is not null").groupBy("doc_id").agg(
        F.min("error").alias("error"))
