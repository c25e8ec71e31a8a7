"""Every registered query against its SQL twin, on the smallest data."""

import importlib
from pathlib import Path

import pytest

import __spark_entry__
import check
from inkspan.plans.oracles import ORACLES
from inkspan.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


def test_entry(spark):
    found = importlib.reload(__spark_entry__).entry(spark)
    assert found.columns == ["item_id", "rank", "chunk", "score"]
    assert found.count() > 0


def test_all_queries_have_a_twin():
    # Indexes that are fitted to the rows have none; test_search asks for their recall.
    assert set(QUERIES) - set(ORACLES) == {"index_choice", "pq_recall"} and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    found = __spark_entry__.queries()[name](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    ours = found.toPandas()
    theirs = db.execute(__spark_entry__.oracle_sql()[name]).df()
    assert check.difference(ours, theirs) is None
