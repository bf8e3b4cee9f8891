"""Clustering and risk queries on the supplier panel; some take a given cluster or prediction."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.operators import analytics as A
from panelforge.operators import certificates as Z
from panelforge.operators import clustering as K
from panelforge.operators import risk as R
from panelforge.operators.panel import DEFAULT, complete_cases
from panelforge.plans import driver_tables as D
from panelforge.session import shared_dir, stage
from panelforge.sources.delimited import export_tables

FEATURES = DEFAULT.cluster_features
DIMENSIONS = [f"e{i}" for i in range(64)]
#: Farthest that a centre of converged clusters may be from the mean of its members, in deviations; steepest slope
#: of a loss that counts as level.
CENTRE_OFF, STEEPEST = 0.05, 1e-3
GIVEN_LABELS = {0: K.EFFICIENT, 1: K.GROWING, 2: K.AT_RISK, 3: K.STABLE, 4: K.LOADED}


def _entities(spark, sf_dir):
    return K.entity_features(D.lagged_panel(spark, sf_dir))


def standardise(spark, sf_dir):
    scaled = K.standardise(stage(_entities(spark, sf_dir), "entities"), FEATURES)
    z = vector_to_array("features_scaled")
    return scaled.select("entity_id", *[A.rounded(z[i]).alias(f"z_{c}") for i, c in enumerate(FEATURES)])


def _scaled(spark, sf_dir):
    return stage(K.standardise(stage(_entities(spark, sf_dir), "entities"), FEATURES), "scaled")


def silhouette_sweep(spark, sf_dir):
    return K.sweep_frame(spark, K.silhouette_sweep(_scaled(spark, sf_dir)))


def kmeans_clusters(spark, sf_dir):
    """Entities with the cluster of the best k, its label and their coordinates."""
    return K.segment(D.lagged_panel(spark, sf_dir)).clusters


def kmeans_profiles(spark, sf_dir):
    return K.segment(D.lagged_panel(spark, sf_dir), k=5).profiles


def pca_coords(spark, sf_dir):
    scaled = _scaled(spark, sf_dir)
    return K.pca_coordinates(K.fit_kmeans(scaled, 5).transform(scaled)).drop("features_scaled")


def pca_centroids(spark, sf_dir):
    return K.centroids(pca_coords(spark, sf_dir))


def _vectors(spark, sf_dir):
    """Leading dimensions of the embeddings, with their label as a given cluster."""
    return D.table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("cluster"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(DIMENSIONS)])


def cluster_profile(spark, sf_dir):
    profile = K.cluster_profiles(_vectors(spark, sf_dir), DIMENSIONS)
    return profile.select("cluster", *[A.rounded(F.col(f"avg_{c}")).alias(f"avg_{c}") for c in DIMENSIONS])


def profile_minmax(spark, sf_dir):
    columns = [f"avg_{c}" for c in DIMENSIONS]
    scaled = K.normalised_profiles(K.cluster_profiles(_vectors(spark, sf_dir), DIMENSIONS), columns)
    return scaled.select("cluster", *[A.rounded(F.col(c)).alias(c) for c in columns])


def label_lookup(spark, sf_dir):
    rows = D.table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster"))
    return K.attach_labels(rows, GIVEN_LABELS)


def _given_clusters(spark, sf_dir):
    """Entities with their means and a cluster by their number."""
    means = _entities(spark, sf_dir).withColumn("cluster", (F.col("entity_id") % 5).cast("int"))
    return K.attach_labels(means, GIVEN_LABELS)


def cluster_sector_crosstab(spark, sf_dir):
    return K.crosstab(stage(_given_clusters(spark, sf_dir), "given"), "cluster", "sector")


def silhouette_given(spark, sf_dir):
    """Silhouette of given clusters on the scaled features, as the sweep measures those that it fits."""
    scaled = _scaled(spark, sf_dir).withColumn("cluster", (F.col("entity_id") % 5).cast("int"))
    return spark.createDataFrame([(round(K.silhouette(scaled), 6),)], "silhouette double")


def kmeans_sums(spark, sf_dir):
    """Per feature, entities and the squares within and between the clusters found: together those of all entities."""
    rows = stage(K.segment(D.lagged_panel(spark, sf_dir), k=5).clusters, "clusters")
    groups = rows.groupBy("cluster").agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in FEATURES
                                                                   for n, f in (("avg", F.avg), ("var", F.var_pop))])
    means = rows.agg(*[F.avg(c).alias(f"all_{c}") for c in FEATURES])
    both = groups.select("*", *[means.select(f"all_{c}").scalar().alias(f"all_{c}") for c in FEATURES])
    sums = both.agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * (F.col(f"var_{c}") + F.pow(F.col(f"avg_{c}") - F.col(f"all_{c}"), 2)))
                                             .alias(c) for c in FEATURES])
    long = sums.unpivot("n", FEATURES, "feature", "squares")
    return long.select("feature", "n", A.rounded(F.col("squares") / F.col("n")).alias("mean_square"))


def kmeans_nearest(spark, sf_dir):
    """Whether the clusters found are K-Means': entities nearer to another centre, centres away from their members' mean."""
    scaled = _scaled(spark, sf_dir)
    model = K.fit_kmeans(scaled, 5)
    centres = [c.tolist() for c in model.clusterCenters()]
    rows = stage(Z.nearest_centres(model.transform(scaled), centres), "nearest")
    found = rows.agg(F.count("*").alias("n"), F.count_distinct("cluster").alias("n_clusters"),
                     F.count_if((F.col("nearest") != F.col("cluster")) & (F.col("far_own") > F.col("far_nearest"))).alias("n_nearer_elsewhere"))
    off = Z.centre_offsets(rows, centres).agg(F.count_if(F.col("offset") > CENTRE_OFF).alias("n_centres_off"))
    return found.select("*", off.scalar().alias("n_centres_off"))


def pca_eigen(spark, sf_dir):
    """The components themselves: the covariance turns none of them, and stretches each by its variance."""
    scaled = _scaled(spark, sf_dir)
    vectors = K.fit_pca(scaled).pc.toArray().T.tolist()
    told = Z.eigen_residuals(stage(Z.covariance(scaled, "features_scaled"), "covariance"), vectors)
    return told.select("component", A.rounded(F.col("eigenvalue")).alias("eigenvalue"),
                       (F.abs(F.col("length") - 1) < 1e-9).alias("is_unit"), (F.col("residual") < 1e-9).alias("is_eigenvector"))


def pca_moments(spark, sf_dir):
    """Variances of both components and their covariance, which is none: the two largest eigenvalues of the features."""
    at = pca_coords(spark, sf_dir)
    return at.agg(A.rounded(F.var_samp("PC1")).alias("var_1"), A.rounded(F.var_samp("PC2")).alias("var_2"),
                  F.abs(A.rounded(F.covar_samp("PC1", "PC2"))).alias("covariance"))


def largest_entities(spark, sf_dir):
    return K.largest_labels(_entities(spark, sf_dir), "enrolled").select(
        "entity_id", "short_name", A.rounded(F.col("enrolled")).alias("enrolled"))


def _given_predictions(spark, sf_dir):
    """The label in place of a prediction."""
    return D.labelled_panel(spark, sf_dir).withColumn("prediction", F.col("at_risk").cast("double"))


def temporal_split(spark, sf_dir):
    rows = complete_cases(D.labelled_panel(spark, sf_dir), [*DEFAULT.model_features, "at_risk", "year"])
    train, test = R.temporal_split(rows, D.TRAIN_YEARS, D.TEST_YEARS)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part", "at_risk").agg(
        F.count("*").alias("n"), F.min("year").alias("from_year"), F.max("year").alias("to_year"))


def encode_categories(spark, sf_dir):
    """Category index by frequency and the slots of its one-hot vector."""
    rows = stage(D.metrics_panel(spark, sf_dir).select("entity_id", "year", "sector", "character"), "categories")
    coded = Pipeline(stages=R.feature_stages()[:2]).fit(rows).transform(rows)

    def slot(c):
        hot = vector_to_array(f"{c}_ohe")
        return [F.col(f"{c}_idx").cast("int").alias(f"{c}_index"), F.size(hot).alias(f"{c}_slots"),
                (F.array_position(hot, 1.0) - 1).cast("int").alias(f"{c}_hot")]

    return coded.select("entity_id", "year", *slot("sector"), *slot("character"))


def roc_points(spark, sf_dir):
    """ROC of a given score: the share of units that are not shipped yet."""
    scored = D.labelled_panel(spark, sf_dir).withColumn("score", 1 - F.col("retention"))
    return R.roc_points(scored, "at_risk", model="share")


def _share_scored(spark, sf_dir):
    """The label with a given score that has ties."""
    rows = D.labelled_panel(spark, sf_dir).filter(F.col("retention").isNotNull() & F.col("at_risk").isNotNull())
    return rows.withColumn("rawPrediction", F.round(1 - F.col("retention"), 2))


def auc_given(spark, sf_dir):
    """Area under the ROC curve of a given score."""
    area = R.area_under_roc(stage(_share_scored(spark, sf_dir), "scored"), "at_risk")
    return spark.createDataFrame([(round(area, 6),)], "auc double")


def comparison_given(spark, sf_dir):
    """Comparison and winner of five given models, the sectors, by the AUC of one score in each."""
    rows = stage(_share_scored(spark, sf_dir).withColumn("prediction", (F.col("gap") > 1500).cast("int")), "scored")
    names = [r[0] for r in rows.select("sector").distinct().orderBy("sector").collect()]  # a handful
    study = R.RiskStudy(DEFAULT, metrics=[R.evaluate(rows.filter(F.col("sector") == n), n, "at_risk") for n in names])
    return study.comparison(spark).select("model", "best", *[
        A.rounded(F.col(c)).alias(c) for c in ("auc_roc", "accuracy", "f1_score", "f1_positive")])


def confusion_counts(spark, sf_dir):
    guessed = D.labelled_panel(spark, sf_dir).withColumn("prediction", (F.col("gap") > 1500).cast("int"))
    return R.rates(R.confusion(guessed, "at_risk"))


def risk_by_dept(spark, sf_dir):
    return A.risk_by_department(_given_predictions(spark, sf_dir))


def risk_ranking(spark, sf_dir):
    return A.risk_ranking(_given_predictions(spark, sf_dir))


def intervention_priority(spark, sf_dir):
    ranked = A.intervention_priority(_given_clusters(spark, sf_dir), _given_predictions(spark, sf_dir))
    return ranked.select("entity_id", "entity_name", "sector", "department", "cluster_label", "years_at_risk",
                         "last_year", "mark", *[A.rounded(F.col(c)).alias(c) for c in ("grad_rate", "growth")])


def risk_cluster_entities(spark, sf_dir):
    return A.labelled_clusters(_given_clusters(spark, sf_dir)).select("entity_id", "entity_name", "sector", "department")


def exported_outputs(spark, sf_dir):
    """Outputs written as CSV with byte order marks and read again: columns, rows and a sum of each table."""
    root = shared_dir(spark, "outputs")
    panel = D.labelled_panel(spark, sf_dir)
    tables = {"clusters": _given_clusters(spark, sf_dir).select("entity_id", "entity_name", "cluster", "cluster_label"),
              "predictions": panel.select("entity_id", "year", "at_risk"),
              "panel": panel.select("entity_id", "entity_name", "year", "department", "enrolled")}
    export_tables(tables, root, bom=True)
    sums = {"clusters": "cluster", "predictions": "at_risk", "panel": "year"}
    read = {n: spark.read.option("header", True).option("escape", '"').csv(f"{root}/{n}") for n in tables}
    rows = [df.agg(F.lit(n).alias("name"), F.lit("|".join(df.columns)).alias("columns"), F.count("*").alias("n"),
                   F.sum(F.col(sums[n]).cast("long")).alias("total"), F.sum(F.col("entity_id").cast("long")).alias("ids"))
            for n, df in read.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _models(spark, sf_dir):
    """One staged panel, its clusters and its risk study: the chain that a user runs."""
    panel = stage(D.labelled_panel(spark, sf_dir), "labelled")
    return panel, K.segment(panel), R.study(panel, D.TRAIN_YEARS, D.TEST_YEARS)


def model_priorities(spark, sf_dir):
    """The intervention list, risk by department and ranking of the models' own clusters and predictions, by what must hold."""
    _, found, study = _models(spark, sf_dir)
    told = stage(study.predictions(), "predictions")
    risky = told.where("prediction = 1")
    ranked = stage(A.intervention_priority(found.clusters, told).withColumn("place", F.monotonically_increasing_id()), "ranked")
    order = Window.orderBy("place")  # a row per entity at risk
    falls = (F.lag("years_at_risk").over(order) >= F.col("years_at_risk")) | F.lag("place").over(order).isNull()
    clustered = found.clusters.select("entity_id")
    listed = ranked.withColumn("falls", falls).agg(
        F.count("*").alias("n"), F.count_distinct("entity_id").alias("d"), F.every("falls").alias("falls"),
        F.sum("years_at_risk").alias("years"), F.every(F.col("last_year").isin(D.TEST_YEARS)).alias("in_test"),
        F.every(F.col("cluster_label").isNotNull()).alias("labelled")).first()
    expected = risky.join(clustered, "entity_id", "left_semi").agg(F.count_distinct("entity_id").alias("n"), F.count("*").alias("years")).first()
    departments = A.risk_by_department(risky).collect()
    return spark.createDataFrame([
        ("clustered entities", clustered.count(), True), ("predicted rows", told.count(), True),
        ("listed entities are the clustered ones at risk", 0, (listed.n, listed.d, listed.years or 0) == (expected.n, expected.n, expected.years)),
        ("listed by falling years at risk", 0, bool(listed.falls)), ("last years are test years", 0, bool(listed.in_test)),
        ("all have a label", 0, bool(listed.labelled)),
        ("departments by falling counts", 0, [d.n for d in departments] == sorted((d.n for d in departments), reverse=True))],
        "name string, n bigint, holds boolean")


def exported_models(spark, sf_dir):
    """All outputs of the models written as CSV with byte order marks and read again: columns, rows, whether none was lost."""
    root = shared_dir(spark, "models")
    panel, found, study = _models(spark, sf_dir)
    tables = {"institutional_clusters": found.clusters.drop("PC1", "PC2"), "cluster_profiles": found.profiles,
              "pca_coords": found.clusters, "silhouette_scores": K.sweep_frame(spark, found.scores), "panel": panel,
              "risk_predictions": study.predictions(), "model_comparison": study.comparison(spark),
              "feature_importance": study.importance(spark), "roc_data": study.roc()}
    tables = {n: stage(df, n) for n, df in tables.items()}
    export_tables(tables, root, bom=True)
    rows = []
    for name, df in tables.items():
        read = spark.read.option("header", True).option("escape", '"').csv(f"{root}/{name}")
        n = df.count() if name not in ("cluster_profiles", "silhouette_scores") else None
        rows.append((name, n, read.columns == df.columns and read.count() == df.count()))
    best = max(study.metrics, key=lambda m: m["auc_roc"])
    marked = [r for r in tables["model_comparison"].collect() if r.best]
    rows.append(("winner", len(marked), marked[0].model == best["model"] == tables["risk_predictions"].first().winner))
    rows.append(("best k", None, tables["silhouette_scores"].orderBy(F.desc("silhouette"), "k").first().k == found.k
                 == tables["cluster_profiles"].count()))
    return spark.createDataFrame(rows, "name string, n bigint, whole boolean")


def _study(spark, sf_dir, **options):
    return R.study(D.labelled_panel(spark, sf_dir), D.TRAIN_YEARS, D.TEST_YEARS, **options)


def model_comparison(spark, sf_dir):
    return _study(spark, sf_dir).comparison(spark)


def risk_predictions(spark, sf_dir):
    return _study(spark, sf_dir).predictions()


def feature_importance(spark, sf_dir):
    return _study(spark, sf_dir, models=("RandomForest", "GBT"), measure=False).importance(spark)


def model_roc(spark, sf_dir):
    return _study(spark, sf_dir).roc()


def _given_trees(spark):
    """Three trees over the features of the clusters: a stump, one of two levels, one with a leaf at the root's left."""
    leaf, at = (None, None, None, None), {c: i for i, c in enumerate(FEATURES)}
    trees = [(1.0, [(at["retention"], 0.8, 1, 2, None), (*leaf, 0.9), (*leaf, 0.2)]),
             (0.5, [(at["gap"], 1500.0, 1, 4, None), (at["growth"], 0.0, 2, 3, None), (*leaf, 0.7), (*leaf, 0.1),
                    (at["staff_load"], 20.0, 5, 6, None), (*leaf, 0.4), (*leaf, 0.6)]),
             (0.25, [(at["enrolled"], 1000.0, 1, 2, None), (*leaf, -0.5), (at["grad_rate"], 0.5, 3, 4, None), (*leaf, 0.3), (*leaf, 0.8)])]
    return spark.createDataFrame([(i, weight, 2, j, *node) for i, (weight, nodes) in enumerate(trees) for j, node in enumerate(nodes)], Z.NODES)


def tree_scores(spark, sf_dir):
    """Scores of given trees, walked as a table of nodes."""
    rows = complete_cases(D.lagged_panel(spark, sf_dir), FEATURES)
    x = F.array(*[F.col(c).cast("double") for c in FEATURES])
    scored = Z.tree_values(rows, _given_trees(spark), x)
    return scored.select("entity_id", "year", A.rounded(Z.forest_score()).alias("forest"), A.rounded(Z.boosted_score()).alias("boosted"))


def logistic_optimum(spark, sf_dir):
    """Whether the regression found its optimum: the greatest derivative of its loss by any coefficient is none."""
    train, _ = R.encode(D.labelled_panel(spark, sf_dir), D.TRAIN_YEARS, D.TEST_YEARS)
    model = R.classifier("LogisticRegression", "at_risk").fit(train)
    slopes = Z.logistic_gradient(train, "features", "at_risk", model.coefficients.toArray().tolist(), model.intercept,
                                 model.getOrDefault("regParam"))
    worst = slopes.agg((F.max(F.abs("gradient")) < STEEPEST).alias("is_optimum"), (F.count("*") - 1).alias("n_slots"))
    rows = train.agg(F.count("*").alias("n_rows"), F.sum(F.col("at_risk").cast("bigint")).alias("n_at_risk"))
    return rows.select("*", *[worst.select(c).scalar().alias(c) for c in worst.columns])


def importance_order(spark, sf_dir):
    """Importances of both ensembles: of all features, in falling order, none negative, at most 1 together."""
    told = stage(feature_importance(spark, sf_dir).withColumn("place", F.monotonically_increasing_id()), "importance")
    before = F.lag("importance").over(Window.partitionBy("model").orderBy("place"))
    return (told.withColumn("falls", F.coalesce(before >= F.col("importance"), F.lit(True)))
            .groupBy("model").agg(F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"),
                                  F.every("falls").alias("is_in_order"),
                                  ((F.min("importance") >= 0) & (F.sum("importance") <= 1 + 1e-9)).alias("is_a_share")))


def queries() -> dict:
    return {
        "standardise": standardise,
        "silhouette_sweep": silhouette_sweep,
        "kmeans_clusters": kmeans_clusters,
        "kmeans_profiles": kmeans_profiles,
        "pca_coords": pca_coords,
        "pca_centroids": pca_centroids,
        "cluster_profile": cluster_profile,
        "profile_minmax": profile_minmax,
        "label_lookup": label_lookup,
        "cluster_sector_crosstab": cluster_sector_crosstab,
        "largest_entities": largest_entities,
        "temporal_split": temporal_split,
        "encode_categories": encode_categories,
        "roc_points": roc_points,
        "silhouette_given": silhouette_given,
        "kmeans_sums": kmeans_sums,
        "kmeans_nearest": kmeans_nearest,
        "pca_moments": pca_moments,
        "pca_eigen": pca_eigen,
        "tree_scores": tree_scores,
        "logistic_optimum": logistic_optimum,
        "importance_order": importance_order,
        "model_priorities": model_priorities,
        "exported_models": exported_models,
        "auc_given": auc_given,
        "comparison_given": comparison_given,
        "confusion_counts": confusion_counts,
        "risk_by_dept": risk_by_dept,
        "risk_ranking": risk_ranking,
        "intervention_priority": intervention_priority,
        "risk_cluster_entities": risk_cluster_entities,
        "exported_outputs": exported_outputs,
        "model_comparison": model_comparison,
        "risk_predictions": risk_predictions,
        "feature_importance": feature_importance,
        "model_roc": model_roc,
    }
