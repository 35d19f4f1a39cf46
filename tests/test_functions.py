from pyspark.sql import functions as F

from inkveil.functions.geometry import pixel, raster_size, tenths
from inkveil.functions.keys import output_key
from inkveil.functions.text import WHITESPACE, contains_any, is_blank, norm_label, strip, url_decode
from inkveil.params import RuleParams


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_rounding_is_pythons(spark):
    ys = [0.25, 0.35, 2.45, 0.15, 0.45, 10.125, 10.375, 36.1875, 0.05, -0.25, -0.35, 100.65, 2.675, 0.0]
    ys += [n / 20 for n in range(400)] + [n / 16 for n in range(64)]
    df = spark.createDataFrame([(y,) for y in ys], "y DOUBLE")
    got = values(df, (tenths(F.col("y")) / 10).alias("r"))
    assert [g + 0.0 for g in got] == [round(y, 1) + 0.0 for y in ys]


def test_whitespace_is_pythons(spark):
    assert set(WHITESPACE) == {c for c in map(chr, range(0x11000)) if c.isspace()}
    texts = ["", " ", "  ", "　x ", "\tCRM\n", "​", "a b", "\x1c"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert values(df, strip(F.col("t"))) == [t.strip() for t in texts]
    assert values(df, is_blank(F.col("t"))) == [not t.strip() for t in texts]


def test_labels_end_in_one_colon(spark):
    df = spark.createDataFrame([("Nome",), ("Nome:",), ("a:b",)], "t STRING")
    assert values(df, norm_label(F.col("t"))) == ["Nome:", "Nome:", "a:b:"]


def test_search_ignores_case_and_needs_only_the_shortest_terms(spark):
    df = spark.createDataFrame([("CRM/SP",), ("xcrm:",), ("C RM",), ("crn",)], "t STRING")
    assert values(df, contains_any(F.col("t"), ["CRM", "crm:", "crm"])) == [True, True, False, False]
    assert values(df, contains_any(F.col("t"), [])) == [False] * 4


def test_url_decoding(spark):
    cases = {"a+b%20c.PDF": "a b c.PDF", "a%zz+b%.pdf": "a%zz b%.pdf", "a%41%": "aA%", "%C3%A9": "é", "é+": "é ",
             "plain": "plain"}
    df = spark.createDataFrame([(k,) for k in cases], "k STRING")
    assert values(df, url_decode(F.col("k"))) == list(cases.values())


def test_output_keys(spark):
    cases = {"dir.v1/file": "dir.v1/anonymized_<id>.v1/file", "p/q": "p/anonymized_<id>.pdf",
             "a/b/c.PDF": "a/b/anonymized_<id>.PDF", "x.pdf": "anonymized_<id>.pdf", "e.": "anonymized_<id>.",
             "/lead.pdf": "/anonymized_<id>.pdf", "d/.hidden.pdf": "d/anonymized_<id>.pdf"}
    df = spark.createDataFrame([("b", k) for k in cases], "b STRING, k STRING")
    keys = values(df, output_key(F.col("b"), F.col("k")))
    masked = values(spark.createDataFrame([(k,) for k in keys], "k STRING"),
                    F.regexp_replace("k", "anonymized_[0-9A-F]{26}", "anonymized_<id>"))
    assert masked == list(cases.values())
    assert values(df, output_key(F.col("b"), F.col("k"))) == keys
    other = values(df, output_key(F.lit("c"), F.col("k")))
    assert not set(other) & set(keys)


def test_pixels_are_truncated_and_rasters_cover_the_page(spark):
    df = spark.range(1)
    assert values(df, pixel(F.lit(0.02), F.lit(1818))) == [36]
    assert values(df, pixel(F.lit(100.0), F.lit(10))) == [1000]
    assert values(df, raster_size(F.lit(595.0), 72)) == [595]
    assert values(df, raster_size(F.lit(595.0), 150)) == [1240]
    assert values(df, raster_size(F.lit(842.0), 150)) == [1755]


def test_profiles_and_environment():
    assert RuleParams() == RuleParams.profile("default")
    assert RuleParams.profile("deployed").prevline_tolerance == 20
    params = RuleParams.from_env({"LINE_TOLERANCE": "3", "DPI_PAGE2_RENDER": "150", "OTHER": "x"})
    assert (params.line_tolerance, params.dpi, params.padding) == (3.0, 150, 1.0)
