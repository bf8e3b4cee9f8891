"""Segmentation of entities: scaled features, K-Means, silhouette, PCA, profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.numbers import min_max
from panelforge.functions.text import short_label
from panelforge.operators.panel import DEFAULT, PanelSpec, complete_cases
from panelforge.session import stage

SEED = 42
MAX_ITERATIONS = 50
K_RANGE = range(3, 8)

# Labels of the five profiles.
EFFICIENT = "🟢 Alta eficiencia"
GROWING = "🟡 Crecimiento acelerado"
AT_RISK = "🔴 Riesgo académico"
STABLE = "🔵 Pequeña estable"
LOADED = "🟠 Alta docencia / baja eficiencia"


def entity_features(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Historical mean of every feature per entity, over its complete rows."""
    s = spec
    rows = complete_cases(panel, s.cluster_features)
    return rows.groupBy(*s.attributes).agg(*[F.avg(c).alias(c) for c in s.cluster_features])


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``features_scaled``: the columns as a vector with mean 0 and sample deviation 1."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="features_raw", handleInvalid="skip").transform(df)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features_scaled", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled).drop("features_raw")


def fit_kmeans(scaled: DataFrame, k: int) -> KMeansModel:
    return KMeans(featuresCol="features_scaled", predictionCol="cluster", k=k, seed=SEED,
                  maxIter=MAX_ITERATIONS).fit(scaled)


def silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="features_scaled",
                               metricName="silhouette").evaluate(clustered)


def silhouette_sweep(scaled: DataFrame, ks: Iterable[int] = K_RANGE) -> list[tuple[int, float]]:
    """(k, score to 4 places) for every k; ``scaled`` should be staged, as each k reads it anew."""
    return [(k, round(silhouette(fit_kmeans(scaled, k).transform(scaled)), 4)) for k in ks]


def sweep_frame(spark: SparkSession, scores: Sequence[tuple[int, float]]) -> DataFrame:
    return spark.createDataFrame(list(scores), "k int, silhouette double")


def best_k(scores: Sequence[tuple[int, float]]) -> int:
    """The k with the highest score, the first on ties."""
    return max(scores, key=lambda s: (s[1], -s[0]))[0]


def fit_pca(scaled: DataFrame) -> PCAModel:
    return PCA(inputCol="features_scaled", outputCol="_pca", k=2).fit(scaled)


def pca_coordinates(scaled: DataFrame) -> DataFrame:
    """Add the first two principal components as ``PC1`` and ``PC2``."""
    at = vector_to_array("_pca")
    return fit_pca(scaled).transform(scaled).withColumns({"PC1": at[0], "PC2": at[1]}).drop("_pca")


def centroids(coordinates: DataFrame) -> DataFrame:
    return coordinates.groupBy("cluster").agg(F.avg("PC1").alias("PC1"), F.avg("PC2").alias("PC2")).orderBy("cluster")


def cluster_profiles(clustered: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return clustered.groupBy(cluster).agg(*[F.avg(c).alias(f"avg_{c}") for c in columns]).orderBy(cluster)


def normalised_profiles(profiles: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Profile columns scaled to [0, 1] over the clusters; a constant column is 0."""
    ends = profiles.agg(F.struct(*[F.min(c).alias(f"lo_{c}") for c in columns],
                                 *[F.max(c).alias(f"hi_{c}") for c in columns])).scalar()
    return profiles.withColumn("_ends", ends).select(
        cluster, *[min_max(c, F.col(f"_ends.lo_{c}"), F.col(f"_ends.hi_{c}")).alias(c) for c in columns])


def label_profiles(profiles: Sequence[Mapping], spec: PanelSpec = DEFAULT) -> dict[int, str]:
    """A label per cluster from its profile, as K-Means numbers clusters arbitrarily.

    Lowest graduation rate is the risk profile, highest the efficient one; of the others the fastest
    growing, then the most loaded, then the rest. Takes one row per cluster.
    """
    rows = sorted(profiles, key=lambda r: r["cluster"])
    labels: dict[int, str] = {}

    def take(label: str, column: str, highest: bool) -> None:
        left = [r for r in rows if r["cluster"] not in labels]
        if left:
            sign = 1 if highest else -1
            chosen = max(left, key=lambda r: (sign * r[f"avg_{column}"], -r["cluster"]))
            labels[chosen["cluster"]] = label

    take(AT_RISK, spec.grad_rate, False)
    take(EFFICIENT, spec.grad_rate, True)
    take(GROWING, spec.growth, True)
    take(LOADED, spec.load, True)
    return {r["cluster"]: labels.get(r["cluster"], STABLE) for r in rows}


def attach_labels(df: DataFrame, labels: Mapping[int, str], key: str = "cluster",
                  name: str = "cluster_label") -> DataFrame:
    """Dictionary lookup as a literal map; a key without an entry gives NULL."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(key)))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of ``row`` by ``column``, 0 where a pair is absent; rows without a key are left out."""
    known = df.dropna(how="any", subset=[row, column])
    return known.groupBy(row).pivot(column, list(values) if values else None).count().fillna(0)


def largest_labels(df: DataFrame, volume: str, n: int = 8, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The ``n`` largest entities with a shortened name."""
    top = df.orderBy(F.desc(volume), spec.entity).limit(n)
    return top.withColumn("short_name", short_label(spec.name, 25, ellipsis=True))


@dataclass
class Segmentation:
    """Clustered entities with labels, coordinates and the scores of the sweep."""

    clusters: DataFrame
    profiles: DataFrame
    scores: list[tuple[int, float]]
    k: int


def segment(panel: DataFrame, k: int | None = None, spec: PanelSpec = DEFAULT,
            ks: Iterable[int] = K_RANGE) -> Segmentation:
    """The whole segmentation; ``k=None`` takes the best silhouette."""
    entities = stage(entity_features(panel, spec), "entities")  # fitting reads it, and so does scaling
    scaled = stage(standardise(entities, spec.cluster_features), "scaled")
    scores = silhouette_sweep(scaled, ks) if k is None else []
    k = k or best_k(scores)
    clustered = stage(fit_kmeans(scaled, k).transform(scaled), "clustered")
    profiles = cluster_profiles(clustered, spec.cluster_features)
    labels = label_profiles(profiles.collect(), spec)  # k rows
    coordinates = pca_coordinates(clustered).drop("features_scaled")
    return Segmentation(attach_labels(coordinates, labels), attach_labels(profiles, labels), scores, k)
