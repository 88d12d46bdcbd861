"""Generated-code size guard: the queries whose fused stage once grew past
HotSpot's 8,000-byte JIT limit (and ran interpreted, several times slower)
must stay below it."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from codegen_report import JIT_LIMIT, max_method_size  # noqa: E402

from table_dirs import SF_SMALL  # noqa: E402


@pytest.mark.parametrize("name", ["scl_number_format", "pipe_mentions_from_responses",
                                  "scl_json_lenient", "pipe_page_ledger"])
def test_fused_stage_stays_jit_compilable(spark, name):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # plan every stage up front
    try:
        size = max_method_size(spark, E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert 0 < size <= JIT_LIMIT, size
