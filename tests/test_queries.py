"""Every registered query against its oracle on the smallest tables."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

MODEL_QUERIES = {"silhouette_sweep", "kmeans_clusters", "kmeans_profiles", "pca_coords", "pca_centroids",
                 "model_comparison", "risk_predictions", "feature_importance", "model_roc"}


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


def test_only_model_queries_lack_an_oracle():
    own = {q for q in queries() if not re.match(r"op\d+_|pipeline$", q)}  # the others have tests of their own
    assert own - set(oracle_sql()) == MODEL_QUERIES
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, small_dir, name):
    df = queries()[name](spark, small_dir)
    result = compare(df.columns, [tuple(r) for r in df.collect()], con, oracle_sql()[name])
    assert result.startswith("ok"), result


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 20 and df.count() > 0


def test_no_python_worker_in_plans(spark, small_dir):
    for name in ("panel_metrics", "header_row", "promote_header", "cast_numeric", "roc_points"):
        plan = queries()[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name
