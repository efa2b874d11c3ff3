"""Every registered query agrees with its SQL on the given tables and has a sound plan."""

import os

import pytest
from harness import run_one
from pyspark.sql.readwriter import DataFrameWriter

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = queries(), oracle_sql()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """Physical plans of everything a query writes on its way."""
    seen, write = [], DataFrameWriter.parquet

    def spy(self, *args, **kwargs):
        seen.append(plan(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return seen


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, plans, name):
    def run(*args):
        df = QUERIES[name](*args)
        plans.append(plan(df))
        return df

    result = run_one(spark, SF, name, run, ORACLES.get(name))
    assert result.startswith(("ok ", "rows ")) and not result.endswith(" 0"), result
    for text in plans:
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
        assert "BatchEvalPython" not in text  # no row-at-a-time Python


def test_entry(spark):
    assert entry(spark).count() == 175


def test_scans_are_pruned(spark):
    text = plan(QUERIES["count_image"](spark, SF))
    columns = text.split("ReadSchema: ")[1]
    assert "l_orderkey" in columns and "l_shipdate" not in columns and "l_suppkey" not in columns


def test_one_slice_reads_one_folder(spark):
    from tissueloom.plans import bindings as bind
    from tissueloom.sources import tables
    from tissueloom.sources.storage import fresh_path

    path = fresh_path(spark, "matrix")
    tables.write_matrix(path, counts=bind.counts(spark, SF))
    back = tables.scan_matrix(spark, path, "counts", "slice string, cell bigint, gene string, cnt bigint")
    text = plan(back.filter("slice = 'L3-early_a_S03' and cnt > 4"))
    assert "PartitionFilters: [isnotnull(slice" in text and "GreaterThan(cnt,4)" in text


def test_top_n_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["rank_markers"](spark, SF))
