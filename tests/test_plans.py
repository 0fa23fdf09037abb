"""Physical plans of the queries that work on the tables directly."""

import re
from pathlib import Path

import pytest

from parity import basics
from parity.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DIRECT = sorted(name for name, query in QUERIES.items() if query.__module__ == basics.__name__)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables")


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DIRECT)
def test_no_pairs_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInArrow", "MapInPandas"):
        assert operator not in text


ONE_TASK = {
    "agg_max_id", "dq_row_count", "dq_fact_null_keys", "dq_duplicate_keys", "dq_duplicate_keys_later", "surrogate_ids"
}


@pytest.mark.parametrize("name", DIRECT)
def test_one_task_only_sees_totals(spark, name):
    text = plan(spark, name)
    assert ("SinglePartition" in text) == (name in ONE_TASK)
    if name in ONE_TASK:
        above = text.split("SinglePartition")[1]
        assert re.search(r"partial_(max|count)|HashAggregate\(keys=\[_bucket", above)


SHUFFLE_FREE = [
    "fact_lookup_two",
    "fact_lookup_three",
    "filter_period",
    "filter_dropna_subset",
    "proj_struct_fields",
    "scalar_br_number",
    "union_by_name_three",
]


@pytest.mark.parametrize("name", SHUFFLE_FREE)
def test_no_shuffle(spark, name):
    assert "hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("fact_lookup_two", {"o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"}),
        ("dq_duplicate_keys", {"l_orderkey", "l_linenumber"}),
        ("proj_rename", {"o_orderkey", "o_orderstatus", "o_orderpriority"}),
        ("agg_max_id", {"c_custkey"}),
    ],
)
def test_scans_read_the_needed_columns(spark, name, columns):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, name))
    assert columns in [{re.sub(r"#\d+L?", "", column) for column in scan.split(",")} for scan in scans]


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(o_orderdate,1998-03-01T00:00" in plan(spark, "filter_period")
