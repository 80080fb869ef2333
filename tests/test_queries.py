"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_python_and_no_cross_joins(spark):
    for name, build in QUERIES.items():
        plan = build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
            assert word not in plan, (name, word)


def test_known_values(spark):
    """Values worked out by hand for the smallest scale."""
    run = {name: build for name, build in QUERIES.items()}
    grid = run["grid_cells"](spark, SF).selectExpr("sum(count) n", "count(*) c", "sum(distinct_points) p").first()
    assert tuple(grid) == (1000, 35, 157)
    pairs = run["pair_stats"](spark, SF).first()
    assert (pairs["pairs"], round(pairs["pairs"] * pairs["same_species_rate"])) == (843, 142)
    assert {r["band"]: r["points"] for r in run["point_histogram"](spark, SF).collect() if r["points"]} == {
        "1": 142, "11-50": 2, ">50": 13}
    assert run["missing_species"](spark, SF).count() == 80 and run["type_counts"](spark, SF).count() == 24
    assert run["within_total"](spark, SF).first()["total"] == 427
    assert run["geonear"](spark, SF).agg({"distance_m": "min"}).first()[0] == 2320.1


def test_profile_totals_parse_the_lines_once(spark):
    plan = QUERIES["profile_totals"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan
