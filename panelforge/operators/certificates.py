"""What a fitted model must satisfy, computed from the rows and the model's numbers alone.

A tree ensemble becomes a table of nodes that built-in expressions walk, so its scores can be recomputed anywhere.
A logistic regression is right where the gradient of its loss is zero, K-Means where every entity is nearest to its own
centre and every centre is the mean of its members, principal components where the covariance turns none of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import shared_dir

#: Nodes of a tree are numbered from 0, the root, without gaps; leaves have no feature. Rows with a value up to
#: ``threshold`` go left. ``value`` is what a leaf gives, ``depth`` the most steps from any root to a leaf.
NODES = "tree int, weight double, depth int, node int, feature int, threshold double, left int, right int, value double"


# --- trees ---


def tree_nodes(model, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted random forest or gradient-boosted ensemble with continuous features, from its saved form.

    A forest's leaf gives the share of class 1 among its rows, each tree weighing the same; a boosted tree's leaf
    its prediction, with the tree's weight.
    """
    path = shared_dir(spark, "trees")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    boosted = "GBT" in type(model).__name__
    votes = F.col("impurityStats")
    value = F.col("prediction") if boosted else F.get(votes, F.lit(1)) / F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    leaf = F.col("leftChild") < 0
    return saved.select(
        F.col("treeID").cast("int").alias("tree"), F.get(weights, F.col("treeID").cast("int")).alias("weight"),
        F.lit(model.getOrDefault("maxDepth")).alias("depth"), F.col("id").cast("int").alias("node"), F.when(~leaf, F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(~leaf, F.col("leftChild")).cast("int").alias("left"), F.when(~leaf, F.col("rightChild")).cast("int").alias("right"),
        F.when(leaf, value).alias("value"))


def tree_values(rows: DataFrame, nodes: DataFrame, features: str | Column, to: str = "tree_values") -> DataFrame:
    """Add an array with the (weight, value) that each tree of ``nodes`` gives a row, by number of the tree.

    The ensemble goes along as one value: trees are few and bounded by their depth, whatever the rows. ``features`` is
    an array of numbers; a NaN goes right, as it isn't up to any threshold.
    """
    branch = F.struct("node", "feature", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.array_sort(F.collect_list(branch)).alias("nodes"),
                                      F.max("depth").alias("depth"))
    ensemble = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"),
                         F.max("depth").alias("depth")).select(F.struct("trees", "depth")).scalar()
    x = F.col(features) if isinstance(features, str) else features

    def step(here: Column) -> Column:
        value = F.get("_x", here["feature"])
        return (F.when(here["feature"].isNull(), here["node"])
                .when((value <= here["threshold"]) & ~F.isnan(value), here["left"]).otherwise(here["right"]))

    def leaf(tree: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.col("_e.depth")), F.lit(0), lambda at, _: step(F.get(tree["nodes"], at)))

    def value(tree: Column) -> Column:
        return F.struct(tree["weight"].alias("weight"), F.get(tree["nodes"], leaf(tree))["value"].alias("value"))

    return rows.withColumns({"_e": ensemble, "_x": x}).withColumn(to, F.transform("_e.trees", value)).drop("_e", "_x")


def forest_score(values: str = "tree_values") -> Column:
    """Probability of class 1 of a random forest: the mean of its trees' shares."""
    return F.aggregate(values, F.lit(0.0), lambda a, t: a + t["value"]) / F.size(values)


def boosted_score(values: str = "tree_values") -> Column:
    """Probability of class 1 of boosted trees: the logistic of twice their weighted sum."""
    return 1 / (1 + F.exp(-2 * F.aggregate(values, F.lit(0.0), lambda a, t: a + t["weight"] * t["value"])))


# --- logistic regression ---


def logistic_gradient(rows: DataFrame, features: str, label: str, coefficients: Sequence[float], intercept: float,
                      ridge: float) -> DataFrame:
    """(slot, gradient): derivative of the mean log loss plus ``ridge`` / 2 * squares, per coefficient; slot -1 is the
    intercept's, which isn't penalised. One aggregation over the exploded features; 0 everywhere at the optimum."""
    w = F.array(*[F.lit(float(c)) for c in coefficients])
    x = vector_to_array(features)
    margin = F.aggregate(F.zip_with("_x", w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.lit(float(intercept))
    error = 1 / (1 + F.exp(-margin)) - F.col(label)
    slots = rows.select(x.alias("_x"), label).select(error.alias("_e"), F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("_x"))).alias("_i", "_v"))
    penalty = F.coalesce(F.get(w, F.col("slot")), F.lit(0.0)) * F.when(F.col("slot") < 0, 0.0).otherwise(float(ridge))
    return (slots.groupBy((F.col("_i") - 1).alias("slot")).agg(F.avg(F.col("_e") * F.col("_v")).alias("g"))
            .select("slot", (F.col("g") + F.when(F.col("slot") < 0, 0.0).otherwise(penalty)).alias("gradient")))


# --- K-Means ---


def _squared_distance(x: Column, centre: Sequence[float]) -> Column:
    parts = F.zip_with(x, F.array(*[F.lit(float(c)) for c in centre]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def nearest_centres(clustered: DataFrame, centres: Sequence[Sequence[float]], features: str = "features_scaled",
                    cluster: str = "cluster") -> DataFrame:
    """Add ``nearest``, the centre closest to each row (the first on ties), and both squared distances."""
    x = vector_to_array(features)
    far = F.array(*[F.struct(_squared_distance(F.col("_x"), c).alias("far"), F.lit(i).alias("nearest")) for i, c in enumerate(centres)])
    found = clustered.withColumn("_x", x).withColumn("_f", far)
    return found.select(*clustered.columns, F.array_min("_f")["nearest"].alias("nearest"), F.array_min("_f")["far"].alias("far_nearest"),
                        F.get("_f", F.col(cluster))["far"].alias("far_own"))


def centre_offsets(clustered: DataFrame, centres: Sequence[Sequence[float]], features: str = "features_scaled",
                   cluster: str = "cluster") -> DataFrame:
    """(cluster, n, offset): rows of each cluster, and how far its centre is from the mean of their features."""
    at = F.create_map(*[c for i, centre in enumerate(centres) for c in (F.lit(i), F.array(*[F.lit(float(v)) for v in centre]))])
    slots = clustered.select(cluster, F.posexplode(vector_to_array(features)).alias("i", "v"))
    means = slots.groupBy(cluster, "i").agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    gap = F.col("m") - F.get(F.element_at(at, F.col(cluster)), F.col("i"))
    return means.groupBy(cluster).agg(F.max("n").alias("n"), F.sqrt(F.sum(gap * gap)).alias("offset"))


# --- principal components ---


def covariance(rows: DataFrame, features: str) -> DataFrame:
    """(i, j, v): the sample covariance of the entries of a vector, the sums made before the shuffle."""
    x = vector_to_array(features)
    wide = rows.select(x.alias("_x"))
    pairs = wide.select("_x", F.posexplode("_x").alias("i", "a")).select("i", "a", F.posexplode("_x").alias("j", "b"))
    return pairs.groupBy("i", "j").agg(F.covar_samp("a", "b").alias("v"))


def eigen_residuals(matrix: DataFrame, vectors: Sequence[Sequence[float]]) -> DataFrame:
    """(component, eigenvalue, length, residual) for unit vectors of a symmetric matrix of (i, j, v).

    The eigenvalue is the vector's Rayleigh quotient, the residual the greatest entry of matrix times vector less
    eigenvalue times vector: 0 for an eigenvector.
    """
    spark = matrix.sparkSession
    entries = spark.createDataFrame([(k + 1, i, float(v)) for k, vector in enumerate(vectors) for i, v in enumerate(vector)],
                                    "component int, i int, w double")
    turned = (matrix.join(entries.withColumnRenamed("i", "j"), "j").groupBy("component", "i").agg(F.sum(F.col("v") * F.col("w")).alias("t"))
              .join(entries, ["component", "i"]))
    values = turned.groupBy("component").agg((F.sum(F.col("t") * F.col("w")) / F.sum(F.col("w") * F.col("w"))).alias("eigenvalue"),
                                             F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return (turned.join(values, "component").groupBy("component", "eigenvalue", "length")
            .agg(F.max(F.abs(F.col("t") - F.col("eigenvalue") * F.col("w"))).alias("residual")))
