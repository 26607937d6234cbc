"""Plans are the ones wanted: filters and columns reach the scan, limits and groups stay distributed."""

from __future__ import annotations

import contextlib
import io

import pytest

from planquill.plans import all_queries

QUERIES = all_queries()[0]


def plan(spark, folder, name) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, folder).explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    ("name", "there", "absent"),
    [
        ("w_scan_point", ["EqualTo(c_custkey,42)", "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>"], ["Exchange"]),
        ("w_scan_covering", ["LessThan(o_orderkey,500)", "ReadSchema: struct<o_orderkey:bigint>"], ["Exchange"]),
        ("w_scan_bitmap_or", ["Or(LessThan(l_partkey,40),EqualTo(l_suppkey,3))"], []),
        ("w_topk_desc", ["TakeOrderedAndProject"], ["Exchange"]),
        ("w_window_topn_per_group", ["WindowGroupLimit"], []),
        ("w_exists_correlated", ["LeftSemi"], ["CartesianProduct", "NestedLoop"]),
        ("w_join_anti", ["LeftAnti"], ["CartesianProduct", "NestedLoop"]),
        ("w_join_merge", ["SortMergeJoin"], []),
        ("w_join_hash", ["ShuffledHashJoin"], []),
        ("w_append_partitions", ["orders-by-year", "ReadSchema: struct<>"], ["Union"]),
        ("w_partition_prune", ["PartitionFilters", "= 1995)", "GreaterThan(o_totalprice,1000.0)"], ["Union"]),
        ("w_agg_partial_final", ["partial_count(1)", "HashAggregate"], ["SortAggregate"]),
        ("w_shape_join_agg", ["In(o_orderstatus, [F,O])", "GreaterThan(c_acctbal,0.0)"], ["CartesianProduct"]),
        ("w_shape_very_complex", ["WindowGroupLimit"], ["CartesianProduct", "NestedLoop", "Python"]),
        ("p_template_cap", ["TakeOrderedAndProject", "partial_min"], ["Python"]),
        ("p_latency_by_plan", ["ReadSchema: struct<value:double,props:string>"], ["Python"]),
    ],
)
def test_plan(spark, small, name, there, absent):
    text = plan(spark, small, name)
    for x in there:
        assert x in text, f"{x}\n{text}"
    for x in absent:
        assert x not in text, f"{x}\n{text}"


def test_only_folds_run_python(spark, small):
    """Of all queries over tables and log, only the sequential folds leave the JVM."""
    assert {n for n in QUERIES if "Python" in (p := plan(spark, small, n)) or "Pandas" in p or "Arrow" in p} == {"p_rotate_size", "p_rotate_size_after", "p_rotate_age"}
