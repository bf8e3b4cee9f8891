"""Clustering and classification: invariants, and brute force where there is one."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelforge.operators import analytics as A
from panelforge.operators import clustering as K
from panelforge.operators import risk as R
from panelforge.operators.panel import DEFAULT
from panelforge.plans import driver_tables as D
from panelforge.session import stage


@pytest.fixture(scope="module")
def panel(spark):
    return stage(D.labelled_panel(spark, "/root/testdata/sf0.01"), "test-panel")


@pytest.fixture(scope="module")
def segmentation(panel):
    return K.segment(panel, ks=range(3, 5))


@pytest.fixture(scope="module")
def study(panel):
    return R.study(panel, D.TRAIN_YEARS, D.TEST_YEARS, models=("LogisticRegression", "RandomForest"))


def test_segmentation(panel, segmentation):
    assert [k for k, _ in segmentation.scores] == [3, 4]
    assert all(-1 <= s <= 1 for _, s in segmentation.scores) and segmentation.k == K.best_k(segmentation.scores)
    entities = K.entity_features(panel).count()
    out = segmentation.clusters
    assert out.count() == entities == out.select("entity_id").distinct().count()
    assert out.filter("cluster_label IS NULL OR PC1 IS NULL OR PC2 IS NULL").count() == 0
    assert {r[0] for r in out.select("cluster").distinct().collect()} == set(range(segmentation.k))
    assert segmentation.profiles.count() == segmentation.k
    assert K.centroids(out).count() == segmentation.k


def test_segmentation_is_repeatable(panel, segmentation):
    again = K.segment(panel, k=segmentation.k)
    assert rows(again.clusters.select("entity_id", "cluster"), "entity_id") == rows(segmentation.clusters.select("entity_id", "cluster"), "entity_id")


def test_best_k_takes_the_first_of_equals():
    assert K.best_k([(3, 0.2), (4, 0.5), (5, 0.5)]) == 4


def test_profile_labels():
    rows_ = [{"cluster": i, "avg_grad_rate": g, "avg_growth": w, "avg_staff_load": l}
             for i, (g, w, l) in enumerate([(0.5, 0, 1), (0.1, 9, 9), (0.9, 1, 1), (0.4, 5, 2), (0.3, 1, 8)])]
    assert K.label_profiles(rows_) == {0: K.STABLE, 1: K.AT_RISK, 2: K.EFFICIENT, 3: K.GROWING, 4: K.LOADED}
    assert set(K.label_profiles(rows_[:2]).values()) == {K.AT_RISK, K.EFFICIENT}


def test_lookup_and_crosstab(spark):
    df = spark.createDataFrame([(0, "a"), (0, "b"), (7, "a"), (7, None), (None, "a")], "cluster int, sector string")
    assert [r[2] for r in rows(K.attach_labels(df, {0: "zero"}), "cluster", "sector")] == [None, "zero", "zero", None, None]
    assert rows(K.crosstab(df, "cluster", "sector"), "cluster") == [(0, 1, 1), (7, 1, 0)]


def test_constant_profile_is_zero(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (1, 3.0, 5.0), (2, 2.0, 5.0)], "cluster int, a double, b double")
    assert rows(K.normalised_profiles(df, ["a", "b"]), "cluster") == [(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 0.5, 0.0)]


def test_study(spark, panel, study):
    table = study.comparison(spark).collect()
    assert [r["best"] for r in table] == [True, False] and table[0]["model"] == study.winner
    for r in table:
        assert all(0 <= r[c] <= 1 for c in ("auc_roc", "accuracy", "f1_score", "f1_positive"))
    predictions = study.predictions()
    assert predictions.columns == [*DEFAULT.keys, "at_risk", "prediction", "winner"]
    assert {r[0] for r in predictions.select("prediction").distinct().collect()} <= {0.0, 1.0}
    assert {r[0] for r in predictions.select("year").distinct().collect()} <= set(D.TEST_YEARS)
    importance = study.importance(spark).collect()
    assert len(importance) == 7 and {r["model"] for r in importance} == {"RandomForest"}
    assert importance == sorted(importance, key=lambda r: -r["importance"])


def test_metrics_match_the_library(study):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    for name, scored in study.scored.items():
        mine = next(m for m in study.metrics if m["model"] == name)
        for metric, key in (("accuracy", "accuracy"), ("f1", "f1_score")):
            library = MulticlassClassificationEvaluator(labelCol="at_risk", metricName=metric).evaluate(scored)
            assert abs(library - mine[key]) < 1e-9


def test_roc_is_monotone_and_matches_brute_force(study):
    roc = study.roc()
    assert roc.count() == 200
    for name, scored in study.scored.items():
        data = [(r["score"], r["at_risk"]) for r in scored.select("score", "at_risk").collect()]
        pos, neg = sum(y for _, y in data), sum(1 - y for _, y in data)
        points = rows(roc.filter(F.col("model") == name).select("threshold", "FPR", "TPR"), "threshold")
        assert [p[0] for p in points] == [i / 99 for i in range(100)]
        for t, fpr, tpr in points:
            assert tpr == sum(y for s, y in data if s >= t) / pos and fpr == sum(1 - y for s, y in data if s >= t) / neg
        assert all(a[1] >= b[1] and a[2] >= b[2] for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("scores", [[i / 99 for i in range(100)], [0.0, 1.0], [0.5], [1 / 3, 2 / 3, 0.07 * 3]])
def test_roc_at_threshold_boundaries(spark, scores):
    df = spark.createDataFrame([(s, i % 2) for i, s in enumerate(scores)], "score double, y int")
    pos, neg = sum(i % 2 for i in range(len(scores))), sum(1 - i % 2 for i in range(len(scores)))
    for t, fpr, tpr, _ in rows(R.roc_points(df, "y"), "threshold"):
        hits = [i % 2 for i, s in enumerate(scores) if s >= t]
        assert tpr == (sum(hits) / pos if pos else 0.0) and fpr == ((len(hits) - sum(hits)) / neg if neg else 0.0)


def test_intervention_from_models(segmentation, study):
    ranked = A.intervention_priority(segmentation.clusters, study.predictions())
    risky = {r[0] for r in study.predictions().filter("prediction = 1").select("entity_id").distinct().collect()}
    clustered = {r[0] for r in segmentation.clusters.select("entity_id").collect()}
    assert {r["entity_id"] for r in ranked.collect()} == risky & clustered
    assert A.labelled_clusters(segmentation.clusters).filter("cluster_label NOT LIKE '%Riesgo%'").count() == 0


@pytest.mark.parametrize("name", R.MODELS)
def test_models_score_after_an_observed_write(spark, panel, name):
    """A session that has observed a query once holds state that no task can take; models must not refer to it."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3
    study = R.study(panel, D.TRAIN_YEARS, D.TEST_YEARS, models=[name])
    assert study.metrics[0]["model"] == name and 0 <= study.metrics[0]["auc_roc"] <= 1
    assert study.roc().count() == 100
