"""Every query against its SQL on the smallest tables; invariants for the rest."""

import pytest
from compare import difference, duck

import __spark_entry__ as contract
import oracles
from feedback_loom import catalog

ORACLES = oracles.oracle_sql()
KMEANS = ["analysis_outputs", "cluster_error_sweep", "clustered_texts", "analyze_feedback"]


def test_every_query_has_sql_or_needs_a_fit():
    assert set(catalog.QUERIES) - set(ORACLES) == set(KMEANS)
    assert set(ORACLES) <= set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    got = contract.queries()[name](spark, folder).toPandas()
    assert difference(got, duck(folder).execute(ORACLES[name]).df()) is None


def test_sweep_is_a_whole_curve(spark, folder):
    rows = contract.queries()["cluster_error_sweep"](spark, folder).orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 21))
    assert sum(r.is_elbow for r in rows) == 1
    assert rows[-1].sse < rows[0].sse
    assert abs(rows[0].residual) < 1e-9 and abs(rows[-1].residual) < 1e-9


def test_clusters_cover_all_texts(spark, folder):
    rows = contract.queries()["clustered_texts"](spark, folder).orderBy("cluster").collect()
    assert [r.cluster for r in rows] == list(range(len(rows)))
    assert sum(r.comment_cnt for r in rows) == 200
    assert abs(sum(r.comment_pct for r in rows) - 1) < 1e-9
