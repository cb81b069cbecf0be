"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as project
from cases import plan
from check import differences
from flowgauge.plans import catalogue, oracle

FOLDER = "/root/testdata/sf0.001"


def test_every_sql_belongs_to_a_query():
    # what differs between libraries of trees is checked in test_models
    assert set(catalogue.QUERIES) - set(oracle.oracle_sql()) == {"model_search_errors", "model_importances", "model_cards"}
    assert set(oracle.oracle_sql()) <= set(catalogue.QUERIES)
    assert set(project.oracle_sql()) <= set(project.queries())


@pytest.mark.parametrize("name", sorted(project.oracle_sql()))
def test_query_equals_sql(spark, name):
    frame = project.queries()[name](spark, FOLDER)
    steps = plan(frame)
    for unwanted in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in steps
    outcome, rows = differences(frame, FOLDER, name)
    assert outcome == "equal"
    assert rows > 0


def test_entry(spark):
    df = project.entry(spark)
    assert df.count() == 125
    assert len(df.columns) == 24
