"""Risk classification: encoded features, three classifiers, their metrics and ROC points."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.numbers import guarded_ratio
from panelforge.operators.panel import DEFAULT, PanelSpec, complete_cases
from panelforge.session import shared_dir, stage

SEED = 42
THRESHOLDS = 100
# Years of the education panel for training and for testing.
TRAIN_YEARS = list(range(2013, 2022))
TEST_YEARS = list(range(2022, 2025))
MODELS = ("RandomForest", "GBT", "LogisticRegression")


def temporal_split(df: DataFrame, train: Sequence[int], test: Sequence[int],
                   spec: PanelSpec = DEFAULT) -> tuple[DataFrame, DataFrame]:
    year = F.col(spec.year)
    return df.filter(year.isin(list(train))), df.filter(year.isin(list(test)))


def feature_stages(spec: PanelSpec = DEFAULT) -> list:
    """Index and one-hot encode the categories, assemble with the numbers, scale."""
    categories = spec.model_categories
    indexed, encoded = [f"{c}_idx" for c in categories], [f"{c}_ohe" for c in categories]
    return [
        StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=[*spec.model_features, *encoded], outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def classifier(name: str, label: str):
    """The three classifiers with their fixed settings."""
    if name == "RandomForest":
        return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=100, maxDepth=6, seed=SEED)
    if name == "GBT":
        return GBTClassifier(labelCol=label, featuresCol="features", maxIter=50, maxDepth=5, seed=SEED)
    if name == "LogisticRegression":
        return LogisticRegression(labelCol=label, featuresCol="features", maxIter=100, regParam=0.1, elasticNetParam=0.0)
    raise ValueError(f"unknown model: {name!r}")


def encode(panel: DataFrame, train: Sequence[int], test: Sequence[int],
           spec: PanelSpec = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Feature stages fitted once, on the training years; both parts staged for all classifiers."""
    rows = complete_cases(panel, [*spec.model_features, spec.label, spec.year])
    train_rows, test_rows = temporal_split(rows, train, test, spec)
    fitted = Pipeline(stages=feature_stages(spec)).fit(train_rows)
    keep = [*spec.keys, spec.label, "features"]
    return tuple(stage(fitted.transform(part).select(*keep), "encoded") for part in (train_rows, test_rows))


def detached(model, spark: SparkSession):
    """The model written to the shared folder and read back.

    A fitted forest keeps its training summary, and with it the session, which can't go with a task;
    a model that was read keeps neither.
    """
    path = shared_dir(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def score(model, test: DataFrame) -> DataFrame:
    """Predictions with the probability of class 1 as ``score``, staged for the metrics."""
    scored = model.transform(test).withColumn("score", vector_to_array("probability")[1])
    return stage(scored.drop("features", "probability"), "scored")


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, F1 of class 1 and F1 weighted by class size, from the four counts."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def f1(hit):
        return F.coalesce(guarded_ratio(2 * hit, 2 * hit + fp + fn), F.lit(0.0))

    return counts.select(
        "*", guarded_ratio(tp + tn, n).alias("accuracy"), f1(tp).alias("f1_positive"),
        guarded_ratio(f1(tp) * (tp + fn) + f1(tn) * (tn + fp), n).alias("f1_weighted"))


def area_under_roc(scored: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC").evaluate(scored)


def evaluate(scored: DataFrame, name: str, label: str) -> dict:
    row = rates(confusion(scored, label)).first()
    return {"model": name, "auc_roc": area_under_roc(scored, label), "accuracy": row["accuracy"],
            "f1_score": row["f1_weighted"], "f1_positive": row["f1_positive"]}


def roc_points(scored: DataFrame, label: str, score: str = "score", model: str = "model",
               n: int = THRESHOLDS) -> DataFrame:
    """TPR and FPR at ``n`` even thresholds of [0, 1], a score at the threshold counting as positive.

    Every row falls into one of n + 1 bins, counted before the shuffle; the counts at or above a
    threshold are a running sum over the bins. A NULL or NaN score reaches no threshold, but its row
    stays in the totals.
    """
    last = n - 1
    s, guess = F.col(score), F.floor(F.col(score) * last).cast("int")
    # the product may round across a threshold, so the guess is checked against its neighbours
    bin_of = (F.when(s >= (guess + 1) / F.lit(last), guess + 1)
              .when(s < guess / F.lit(last), guess - 1).otherwise(guess))
    known = s.isNotNull() & ~F.isnan(s)
    binned = (scored.select(F.when(known, F.least(bin_of, F.lit(last))).otherwise(F.lit(-1)).alias("bin"), F.col(label).alias("_y"))
              .groupBy("bin").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg")))
    steps = scored.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    # at most n + 1 rows from here on
    counts = binned.join(steps, "bin", "full").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (counts
            .select("bin", *[F.sum(c).over(w).alias(a) for c, w, a in (
                ("pos", above, "tp"), ("neg", above, "fp"), ("pos", everything, "p"), ("neg", everything, "n"))])
            .filter("bin >= 0")
            .select((F.col("bin") / F.lit(last)).alias("threshold"),
                    F.coalesce(guarded_ratio("fp", "n"), F.lit(0.0)).alias("FPR"),
                    F.coalesce(guarded_ratio("tp", "p"), F.lit(0.0)).alias("TPR"),
                    F.lit(model).alias("model")))


def feature_importance(model, name: str, spec: PanelSpec = DEFAULT) -> list[tuple[str, float, str]]:
    """Importance of the numeric features, largest first; none for a linear model."""
    if not hasattr(model, "featureImportances"):
        return []
    weights = model.featureImportances.toArray()[:len(spec.model_features)]
    rows = [(f, float(w), name) for f, w in zip(spec.model_features, weights)]
    return sorted(rows, key=lambda r: -r[1])


@dataclass
class RiskStudy:
    """Fitted models, their scored test rows and metrics; the winner has the highest AUC."""

    spec: PanelSpec
    models: dict = field(default_factory=dict)
    scored: dict[str, DataFrame] = field(default_factory=dict)
    metrics: list[dict] = field(default_factory=list)

    @property
    def winner(self) -> str:
        return max(self.metrics, key=lambda m: m["auc_roc"])["model"]  # the first of equals

    def comparison(self, spark: SparkSession) -> DataFrame:
        rows = sorted(self.metrics, key=lambda m: -m["auc_roc"])
        return spark.createDataFrame(
            [{**m, "best": m["model"] == self.winner} for m in rows],
            "model string, auc_roc double, accuracy double, f1_score double, f1_positive double, best boolean")

    def predictions(self) -> DataFrame:
        best = self.scored[self.winner]
        return best.select(*self.spec.keys, self.spec.label, "prediction").withColumn("winner", F.lit(self.winner))

    def importance(self, spark: SparkSession) -> DataFrame:
        rows = [r for name, m in self.models.items() for r in feature_importance(m, name, self.spec)]
        return spark.createDataFrame(rows, "feature string, importance double, model string")

    def roc(self) -> DataFrame:
        return reduce(DataFrame.unionByName,
                      [roc_points(df, self.spec.label, model=name) for name, df in self.scored.items()])


def study(panel: DataFrame, train: Sequence[int] = TRAIN_YEARS, test: Sequence[int] = TEST_YEARS,
          spec: PanelSpec = DEFAULT, models: Iterable[str] = MODELS, measure: bool = True) -> RiskStudy:
    """Fit the classifiers on the training years and measure them on the test years."""
    train_rows, test_rows = encode(panel, train, test, spec)
    result = RiskStudy(spec)
    for name in models:
        result.models[name] = detached(classifier(name, spec.label).fit(train_rows), panel.sparkSession)
        if measure:
            result.scored[name] = score(result.models[name], test_rows)
            result.metrics.append(evaluate(result.scored[name], name, spec.label))
    return result
