"""Every registered query against its SQL counterpart, and the shape of its plan."""

import contextlib
import io

import pytest

from checks.compare import database, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_PATHS = {"distance_reference_ellipsoid", "missing_distances_ellipsoid"}


@pytest.fixture(scope="module")
def con():
    return database(SF)


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    if name not in PYTHON_PATHS:
        assert "EvalPython" not in plan and "InPandas" not in plan
    else:
        assert plan.count("ArrowEvalPython") == 1
