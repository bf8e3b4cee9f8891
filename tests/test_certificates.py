"""Certificates of fitted models: they hold for the library's models and fail for spoilt ones."""

import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from panelforge.operators import certificates as Z
from panelforge.operators import clustering as K
from panelforge.operators import risk as R
from panelforge.session import stage


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in range(5)]
        data.append((i, int(x[0] + x[1] * x[2] + rng.gauss(0, 0.3) > 0), Vectors.dense(x)))
    return stage(spark.createDataFrame(data, ["id", "y", "features"]), "certified")


@pytest.mark.parametrize("name", ["RandomForest", "GBT"])
def test_tree_scores_equal_the_library(spark, rows, name):
    model = R.classifier(name, "y").fit(rows)
    nodes = stage(Z.tree_nodes(model, spark), "nodes")
    assert nodes.select("tree").distinct().count() == len(model.trees)
    score = Z.forest_score() if name == "RandomForest" else Z.boosted_score()
    mine = Z.tree_values(rows, nodes, vector_to_array("features")).select("id", score.alias("mine"))
    theirs = R.detached(model, spark).transform(rows).select("id", vector_to_array("probability")[1].alias("p"))
    off = mine.join(theirs, "id").agg(F.count("*").alias("n"), F.max(F.abs(F.col("mine") - F.col("p"))).alias("off")).first()
    assert off["n"] == 400 and off["off"] < 1e-12


def test_walk_of_a_given_tree(spark):
    nodes = spark.createDataFrame([(0, 1.0, 2, 0, 0, 1.0, 1, 2, None), (0, 1.0, 2, 1, None, None, None, None, 5.0),
                                   (0, 1.0, 2, 2, 1, 0.0, 3, 4, None), (0, 1.0, 2, 3, None, None, None, None, 6.0),
                                   (0, 1.0, 2, 4, None, None, None, None, 7.0), (1, 2.0, 2, 0, None, None, None, None, 3.0)], Z.NODES)
    x = [([1.0, 9.0],), ([1.1, 0.0],), ([2.0, 0.1],), ([math.nan, -1.0],), ([5.0, math.nan],)]
    out = Z.tree_values(spark.createDataFrame(x, "x array<double>"), nodes, "x").collect()
    assert [[tuple(v) for v in r["tree_values"]] for r in out] == [
        [(1.0, v), (2.0, 3.0)] for v in (5.0, 6.0, 7.0, 6.0, 7.0)]


def test_gradient_is_level_at_the_optimum_only(rows):
    from pyspark.ml.classification import LogisticRegression

    model = LogisticRegression(labelCol="y", regParam=0.1, standardization=False, tol=1e-10).fit(rows)
    w, b = model.coefficients.toArray().tolist(), model.intercept
    slopes = {r.slot: r.gradient for r in Z.logistic_gradient(rows, "features", "y", w, b, 0.1).collect()}
    assert sorted(slopes) == [-1, 0, 1, 2, 3, 4] and max(map(abs, slopes.values())) < 1e-5

    # the same by differences of the loss itself
    data = [(r.y, r.features.toArray()) for r in rows.collect()]

    def loss(w_, b_):
        m = [b_ + float(sum(c * v for c, v in zip(w_, x))) for _, x in data]
        return sum(math.log1p(math.exp(-z if y else z)) for (y, _), z in zip(data, m)) / len(data) + 0.05 * sum(c * c for c in w_)

    off = [w[0] + 0.2, *w[1:]]
    wrong = {r.slot: r.gradient for r in Z.logistic_gradient(rows, "features", "y", off, b, 0.1).collect()}
    for slot in range(5):
        up, down = ([c + d * (i == slot) for i, c in enumerate(off)] for d in (1e-5, -1e-5))
        assert math.isclose(wrong[slot], (loss(up, b) - loss(down, b)) / 2e-5, abs_tol=1e-6)
    assert abs(wrong[0]) > 1e-2


def test_nearest_centres_and_their_offsets(spark):
    data = [(0, [0.0, 0.0]), (0, [0.0, 2.0]), (1, [10.0, 0.0]), (0, [9.0, 0.0])]
    df = spark.createDataFrame([(c, Vectors.dense(x)) for c, x in data], ["cluster", "features_scaled"]).withColumn("cluster", F.col("cluster").cast("int"))
    centres = [[3.0, 2.0 / 3], [10.0, 0.0]]
    found = Z.nearest_centres(df, centres).collect()
    assert [r["nearest"] for r in found] == [0, 0, 1, 1] and found[3]["far_own"] > found[3]["far_nearest"] == 1.0
    offsets = {r["cluster"]: (r["n"], r["offset"]) for r in Z.centre_offsets(df, [[3.0, 2.0 / 3], [10.0, 4.0]]).collect()}
    assert offsets[0][0] == 3 and offsets[0][1] < 1e-9 and offsets[1] == (1, 4.0)


def test_eigenvectors_of_the_library(rows):
    scaled = stage(rows.withColumnRenamed("features", "features_scaled"), "pca")
    matrix = stage(Z.covariance(scaled, "features_scaled"), "matrix")
    model = K.fit_pca(scaled)
    vectors = model.pc.toArray().T.tolist()
    told = {r["component"]: r for r in Z.eigen_residuals(matrix, vectors).collect()}
    total = matrix.where("i = j").agg(F.sum("v")).first()[0]
    for i, share in enumerate(model.explainedVariance.toArray()):
        assert told[i + 1]["residual"] < 1e-9 and abs(told[i + 1]["length"] - 1) < 1e-9
        assert math.isclose(told[i + 1]["eigenvalue"] / total, share, rel_tol=1e-9)
    spoilt = Z.eigen_residuals(matrix, [[1.0, 0.0, 0.0, 0.0, 0.0]]).first()
    assert spoilt["residual"] > 1e-3
