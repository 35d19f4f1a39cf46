"""Registered queries against DuckDB at the smallest scale: one per operator family.

oracle_check.py compares all of them at any scale.
"""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from inkveil.plans.oracle import statements
from inkveil.plans.queries import registered
from oracle_check import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [
    "pdf_work_items", "object_scan", "reading_order", "line_segments_fold", "line_tokens_split", "value_spans",
    "register_tail_boxes", "signature_lines", "pixel_boxes", "raster_burn", "published_pages", "redacted_text",
    "batch_response", "audit", "provenance", "metadata_cleared",
    "stored_objects", "published_rasters", "redaction_plan_of_tables", "page_routing"])
def test_equals_duckdb(spark, duck, name):
    assert difference(queries()[name](spark, SF).toPandas(), duck.execute(oracle_sql()[name]).df()) is None


def test_every_query_has_sql():
    assert set(registered()) == set(statements())
    assert set(registered()) <= set(queries()) and set(statements()) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "page_no", "line_no", "line_text"]
