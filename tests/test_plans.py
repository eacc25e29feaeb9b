"""Plan-shape checks of registered queries: pushdown, pruning, shuffle counts."""

import re

import __spark_entry__ as entry
from tests.conftest import SF_SMALL, plan


def _plan(spark, name):
    return plan(entry.queries()[name](spark, SF_SMALL))


def _scans(text, table):
    return [line for line in text.splitlines() if "FileScan parquet" in line and f"/{table}.parquet" in line]


def test_fk_orphans_prunes(spark):
    text = _plan(spark, "fk_orphans")
    assert all("ReadSchema: struct<doc_id:bigint>" in s for t in ("documents", "labels") for s in _scans(text, t))


def test_measures_read_whole_tables_once(spark):
    text = _plan(spark, "union_measures")
    events, lines = _scans(text, "events"), _scans(text, "lineitem")
    assert len(events) == len(lines) == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in events[0] and "PushedFilters: []" in events[0]
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in lines[0]


def test_conform_reads_the_raw_table_once(spark):
    for name in ("conform_clean", "conform_quarantine", "conform_clean_docs"):
        text = _plan(spark, name)  # the distinct rows were stored: the plan reads only these
        assert not _scans(text, "lineitem") and not _scans(text, "documents")


def test_union_combine_adds_no_shuffle(spark):
    # one hash exchange on the keys per input aggregate, none for the combine
    assert len(re.findall(r"Exchange hashpartitioning\(_groupingexpression", _plan(spark, "union_measures"))) == 3


def test_event_fact_shuffles_only_the_offsets(spark):
    text = _plan(spark, "fct_events")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^,)]*)", text)
    assert exchanges and all(e.startswith("_pid") for e in exchanges)


def test_slug_and_lengths_are_narrow(spark):
    for name in ("slug_key", "length_violations", "length_violations_all", "compound"):
        assert "Exchange" not in _plan(spark, name), name
