"""Every query against its SQL, over whole tables at the smallest scale."""

from pathlib import Path

import pytest
from compare import connect, mismatch

from tidemark.workload.oracles import oracles
from tidemark.workload.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
ORACLES = oracles()
# No SQL equal: random rows, or fitted models. Checked by their own tests.
ROWS_ONLY = {"sample_bernoulli", "cv_scores", "feature_importance"}
# Their models are judged by lr_gradient and dtc_best_split, and by test_models.
ROWS_ONLY |= {f"predict_{a}" for a in ("gbt", "rfc", "dtc", "lr", "svc")}
# No row-at-a-time or batched Python, and no join without a key.
BANNED = ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "MapInArrow")


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


def test_every_query_is_covered():
    assert set(QUERIES) == set(ORACLES) | ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    result = QUERIES[name](spark, str(SF))
    assert mismatch(result, con, ORACLES[name]) is None
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BANNED if b in plan]


@pytest.mark.parametrize("name", ["sample_bernoulli", "cv_scores"])
def test_rows_only_query_runs(spark, name):
    rows = QUERIES[name](spark, str(SF)).collect()
    assert name == "sample_bernoulli" or rows


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
