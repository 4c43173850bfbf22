"""Plans of the registered queries, and their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from check_oracle import TABLES, normal
from seriema.catalogue import ORACLES, QUERIES

PATH = "/root/testdata/sf0.001"
# The queries of the time-series library; those of seriema.llm have tests of their own.

pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="no test tables")

# The runs over the layers are checked in test_pipeline.
SLOW = {n for n in QUERIES if n.startswith(("i10", "i11", "l04", "k01"))}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{PATH}/{name}.parquet'")
    return con


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "bcdefghj"))
def test_matches_sql(spark, duck, name):
    got = normal(QUERIES[name](spark, PATH).toArrow())
    want = normal(duck.execute(ORACLES[name]).to_arrow_table())
    assert got == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, PATH))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in text, name


# Keyed operators: a single partition only for the one row of an aggregate without keys.
@pytest.mark.parametrize("name", sorted(
    n for n in QUERIES if n.startswith(("g0", "g11", "g12", "g13", "g14", "g15", "g16", "g17", "f01", "f02", "d03"))
))
def test_keyed_operators_use_all_tasks(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, PATH)), name


@pytest.mark.parametrize("name", ["c08_duplicates_keep_first", "g16_change_since_nth", "g17_trend", "h02_latest_row"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, PATH))
    shuffle = text.index("Exchange hashpartitioning")
    assert "row_number(), " in text and "Partial" in text[shuffle:]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["b04_between_dates"](spark, PATH))
    assert "o_custkey" not in text and "o_orderdate" in text.split("PushedFilters")[1][:200]


@pytest.mark.parametrize("name", ["g04_variations", "g13_financial_metrics", "i04_cambio"])
def test_measures_share_one_shuffle_by_series(spark, name):
    """One exchange for the period aggregate, one for all windows."""
    assert plan(QUERIES[name](spark, PATH)).count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["f05_group_std_per_row", "g11_year_to_date_percent_raw_rows", "g18_min_max_scale_per_series"])
def test_small_statistics_leave_the_rows_in_place(spark, name):
    assert "BroadcastHashJoin" in plan(QUERIES[name](spark, PATH))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("f02", "i04", "e02", "d03"))))
def test_rows_are_not_sorted_before_they_are_reduced(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, PATH)), name
