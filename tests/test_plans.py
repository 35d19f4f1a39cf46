"""What the physical plans must look like at scale."""

import re

import pytest

from fixtures import page_of, words_df
from inkveil.params import RuleParams
from inkveil.plans.pipeline import Redactor
from inkveil.plans.queries import PARAMS, RULES, Scenario, registered
from inkveil.sources import rules

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keys(text):
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", text)]


@pytest.mark.parametrize("name", [
    "redaction_plan", "kept_words", "removed_words", "redacted_text", "published_pages", "signature_lines",
    "line_tokens", "line_tokens_split", "value_boxes", "fixed_boxes", "pixel_boxes", "page_routing",
    "register_hits", "label_hits", "pdf_work_items"])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(registered()[name](spark, SF))
    for operator in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "Arrow", "CollectLimit"):
        assert operator not in text


def test_words_are_segmented_once(spark):
    """Texts are hashed once before they become words; the flagship reads its segmented words from one table."""
    s = Scenario(spark, SF)
    marked = plan(s.marked())
    assert set(keys(marked)) == {"doc_id"} and marked.count("posexplode") == 1
    text = plan(s.redactor.text(s.words(), s.pages()))
    assert "posexplode" not in text


def test_the_session_must_be_tuned(spark):
    from inkveil.session import tune, union_all

    df = spark.range(1)
    spark.conf.set("spark.sql.unionOutputPartitioning", "true")
    try:
        with pytest.raises(RuntimeError):
            union_all(df, df)
    finally:
        tune(spark)
    assert union_all(df, df).count() == 2


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from inkveil.session import scratch_dir

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def session(master, **conf):
        return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))

    for master in ("spark://h:7077", "yarn", "k8s://h", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError):
            scratch_dir(session(master), "x")
    assert scratch_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs://h/c/"}), "x").startswith("hdfs://h/c/x-")


def test_register_words_do_not_meet_under_one_key(spark):
    """Without a broadcast, words that are no hit must not all have the same join key."""
    from pyspark.sql import functions as F

    from inkveil.operators.detect import marked_register

    words = spark.range(4000).selectExpr("id as doc_id", "1 as page_no", "id as word_idx", "if(id < 5, ' crm ', 'x') as text", "id < 5 as is_hit")
    tokens = spark.createDataFrame([("crm",)], "token string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = marked_register(words, tokens)
        assert found.where("is_register").count() == 5
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2000 and sum(sizes) == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_word_tables_are_shuffled_once_per_pass(spark):
    redactor = Redactor(RULES, PARAMS, 600)
    tokens = redactor.marked_tokens(words_df(spark, page_of("a b")))
    assert keys(plan(tokens)) == ["doc_id, page_no"]


def test_rules_are_broadcast_by_size_alone(spark):
    s = Scenario(spark, SF)
    assert plan(s.marked()).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(Scenario(spark, SF).marked())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unused_columns_are_not_read(spark):
    text = plan(registered()["register_hits"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    text = plan(registered()["metadata_cleared"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in text


def test_text_stays_out_of_the_detection_shuffle(spark):
    """Only flags about the text are shuffled with a word table when boxes are looked for."""
    from inkveil.operators.detect import text_redactions

    redactor = Redactor(RULES, RuleParams(), 600)
    df = text_redactions(redactor.marked_tokens(words_df(spark, page_of("a b"))), redactor.params)
    exchange = plan(df).split("Exchange hashpartitioning(doc_id")[1].split("\n")[1]
    assert "is_hit" in exchange and not re.search(r", text#\d+,|, text#\d+\]", exchange)


def test_rule_tables_have_their_real_size(spark):
    assert "LocalTableScan" in plan(rules.label_table(spark, RULES))
