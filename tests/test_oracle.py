"""Every registered query on the smallest folder: equal to its SQL twin, or at least not empty."""

import pytest

import __spark_entry__ as E
from tests.compare import check, connect

FOLDER = "/root/testdata/sf0.001"
# long-running model jobs are covered by their own tests on small fixtures
SLOW = {"sac", "sac_modularity", "sac_similarity", "als_sweep", "fusion_words", "fusion_link", "node_vectors", "forecast_mse", "compare_spread", "pagerank_converged"}
# inputs that the smallest folder does not have
EMPTY = {"subgraph"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SLOW))
def test_query(spark, con, name):
    msg = check(spark, con, FOLDER, name, E.queries()[name], E.oracle_sql().get(name))
    assert msg == "" or (name in EMPTY and msg == "no rows")


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "total_plays", "mean_plays"]
    assert df.count() == 3


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
