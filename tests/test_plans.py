"""Guards on the physical plans of the headline queries (scale properties)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name, capsys):
    E.queries()[name](spark, SF).explain()
    return capsys.readouterr().out


def test_filter_pushed_into_scan_and_columns_pruned(spark, capsys):
    p = plan(spark, "filter_contains", capsys)
    assert re.search(r"PushedFilters: \[[^\]]*StringContains\(event_type,error\)", p)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in p


def test_wordcount_plan(spark, capsys):
    p = plan(spark, "wordcount_top100", capsys)
    assert "TakeOrderedAndProject(limit=100" in p             # top-k, no global sort
    assert "BroadcastHashJoin" in p and "LeftAnti" in p       # stop list map-side
    assert "partial_count" in p                               # combine before the shuffle
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p  # only the needed columns
    assert not re.search(r"\bSort \[", p)                     # no full sort of the counts


def test_curve_window_is_partitioned_by_bucket(spark, capsys):
    p = plan(spark, "eval_roc", capsys)
    # the cumulative window over scores runs per bucket ...
    assert re.search(r"Window \[.*windowspecdefinition\(bucket#\d+, score#\d+ DESC", p)
    # ... and the only single-partition exchange feeds the bounded bucket-offset table
    singles = p.count("Exchange SinglePartition")
    assert singles <= 1
    assert "partial_sum" in p


@pytest.mark.parametrize("name", ["group_checksum", "session_query_rank", "term_frequency"])
def test_hot_key_aggregations_are_partial(spark, capsys, name):
    p = plan(spark, name, capsys)
    assert re.search(r"HashAggregate\(keys=\[[^\]]+\], functions=\[(partial_)(count|sum)", p)
