"""What the plans must and must not hold."""

import pytest
from conftest import FOLDER

from restock.queries import CATALOGUE

LAZY = sorted(
    set(CATALOGUE)
    - {"doc_detail", "doc_enrich", "run_day", "sync_tables", "carry_over_store_c", "cdc_stream", "cdc_emit_json", "sync_catalog_plan", "sync_day"}
)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(CATALOGUE[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan


def test_filters_reach_the_scan(spark):
    plan = physical(CATALOGUE["scan_day_slice"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1998-07-01" in plan
    assert "l_extendedprice" not in plan
    assert "GreaterThanOrEqual(o_orderdate,2001-07-29" in physical(CATALOGUE["filter_changed_docs"](spark, FOLDER))


def test_dedupe_reads_its_input_once(spark):
    plan = physical(CATALOGUE["dedupe_orders"](spark, FOLDER))
    assert plan.count("lineitem.parquet") == 1


def test_messages_are_parsed_once(spark, tables):
    """The envelope and its two maps, and nothing again for each use."""
    from restock.queries import _events

    plan = physical(_events(tables))
    assert plan.count("from_json") <= 5 and plan.count("map_entries") <= 16


@pytest.fixture
def written(monkeypatch):
    """The plans of everything that is written as Parquet on the way to a result."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **options):
        if isinstance(self._df, DataFrame):
            plans.append(physical(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    return plans


@pytest.mark.parametrize("name", ["doc_detail", "doc_enrich", "carry_over_store_c", "run_day", "cdc_stream", "publish_incremental"])
def test_no_cross_join_on_the_way(spark, written, name):
    written.append(physical(CATALOGUE[name](spark, FOLDER)))
    assert len(written) > 3
    for plan in written:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert bad not in plan
    scans = sum(plan.count("lineitem.parquet") for plan in written)
    assert scans <= {"doc_detail": 5, "doc_enrich": 4, "carry_over_store_c": 5, "run_day": 9}.get(name, 4), (name, scans)
