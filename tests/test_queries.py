"""Every registered query against DuckDB, and the shape of the plans."""

import pytest

import __spark_entry__ as entry_points
from motorpool.dictionaries import STARTER_BRANDS, alias_table
from motorpool.operators.normalize import normalize, parse_rows, valid_brands
from motorpool.operators.vehicles import fleet_cells
from motorpool.plans.registry import QUERIES
from motorpool.plans.scenario import scenario, stored_raw
from motorpool.schemas import NORM
from tests.checks import compare, connect


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_sql():
    # optional packages may register more, with or without SQL
    assert set(QUERIES) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, small, duck, name):
    assert compare(QUERIES[name](spark, small), duck, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["marca", "uf", "frota"] and rows.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark, small):
    for name, build in QUERIES.items():
        text = plan(build(spark, small))
        assert "Python" not in text and "ArrowEval" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_period_scan_prunes_partitions_and_columns(spark, small):
    text = plan(scenario(spark, small).warehouse.read(NORM, 202506).select("uf", "frota"))
    assert "PartitionFilters: [isnotnull(report_period" in text
    assert "ReadSchema: struct<uf:string,frota:int>" in text


def test_normalisation_does_not_shuffle_the_rows(spark, small):
    text = plan(normalize(stored_raw(spark, small), STARTER_BRANDS, alias_table(spark)))
    assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") == 2


def test_the_parse_is_not_repeated(spark, small):
    """Filters on the brand must not drag copies of the dictionary pattern into the scan filter."""
    for rows in (
        normalize(stored_raw(spark, small), STARTER_BRANDS, alias_table(spark)),
        valid_brands(parse_rows(stored_raw(spark, small), STARTER_BRANDS, alias_table(spark))),
    ):
        assert plan(rows).count("FIAT\\ ALLIS|") == 1
    assert len(plan(fleet_cells(normalize(stored_raw(spark, small), STARTER_BRANDS, alias_table(spark))))) < 40_000


def test_too_many_valid_brands_still_join_whole(spark, small):
    """With broadcasts off the same query runs as shuffle joins and gives the same rows."""
    wide = normalize(stored_raw(spark, small), STARTER_BRANDS, alias_table(spark)).count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert normalize(stored_raw(spark, small), STARTER_BRANDS, alias_table(spark)).count() == wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
