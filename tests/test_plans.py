"""T5 plan guards and the driver contract (entry / queries / oracle_sql)."""

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from oracle_check import rows_of
from tidemark import catalog
from tidemark.sources.driver import TABLES

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def test_contract_keys_match():
    own = set(catalog.QUERIES)
    assert own <= set(se.queries()) and own == set(se.oracle_sql()) & own
    assert set(se.oracle_sql()) <= set(se.queries())
    assert catalog.FLAGSHIP in se.queries()


def test_entry_runs_on_smallest_tables(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 83 and df.columns == ["line", "period", "metric", "value", "value_date"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def one_row_side(lines, at):
    """The node that makes a side of the join on line ``at`` of a plan one row: an aggregate without keys, or None."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        below.append(line)
    starts = [k for k, line in enumerate(below) if depth(line) == depth(below[0])]
    for k, start in enumerate(starts):
        side = below[start:starts[k + 1] if k + 1 < len(starts) else None]
        nodes = [x for x in side if not any(n in x for n in ("+- BroadcastExchange", "BroadcastQueryStage", "Project", "InputAdapter", "WholeStage"))]
        # a final plan shows a broadcast that it uses twice at its first use only
        if nodes and ("Aggregate(keys=[]" in nodes[0] or "ReusedExchange" in nodes[0] and "IdentityBroadcastMode" in nodes[0]):
            return nodes[0]
    return None


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle_and_plan_guards(spark, duck, name):
    df = se.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    want_cols = [x[0] for x in res.description]
    assert sorted(df.columns) == sorted(want_cols), name
    assert rows_of(df.columns, got) == rows_of(want_cols, res.fetchall()), name
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in PYTHON_NODES:
        assert node not in plan, (name, node)
    assert "CartesianProduct" not in plan, name
    # the only nested-loop joins put one row, an aggregate without keys, beside the period list
    lines = plan.split("\n")
    sides = [one_row_side(lines, at) for at, line in enumerate(lines) if "BroadcastNestedLoopJoin" in line]
    assert all(sides) and (not sides or any("Aggregate" in x for x in sides)), (name, sides)


def test_scan_prunes_columns_and_drops_no_rows(spark):
    plan = catalog.QUERIES["parsed_forecasts"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "value:double" not in read and "event_type" not in read
    assert "PushedFilters: []" in plan     # every event is a post


def test_filters_reach_the_scan(spark):
    plan = catalog.QUERIES["code_violations"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role)" in plan
