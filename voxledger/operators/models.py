"""Classifiers, calibration, projections and explanations with Spark ML."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .evaluate import binary_metrics, roc_auc
from .prep import fit_preparation
from .relational import distinct_labels, real_vs
from ..session import checkpointed
from .scale import global_position

# Display names of the runs.
MODEL_NAMES = ["Logistic Regression", "Regularized Logistic Regression", "Random Forest",
               "Calibrated Logistic Regression", "Calibrated Random Forest"]


def assembled(df: DataFrame, columns: list[str], label: str = "target") -> DataFrame:
    """audio_id, real_or_fake, label (when there is one) and a feature vector."""
    keep = [c for c in ("audio_id", "real_or_fake", label) if c in df.columns]
    out = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error").transform(df)
    return out.select(*keep, "features")


# --- binary classifiers ------------------------------------------------------------------

def logistic(train: DataFrame, c: float = 1.0, label: str = "target", max_iter: int = 1000) -> Model:
    """L2 logistic regression with inverse strength ``c`` on columns that are already scaled.

    Spark minimises the mean loss, so the penalty is 1 / (c n).
    """
    n = train.count()
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, standardization=False,
                              elasticNetParam=0.0, regParam=1.0 / (c * max(n, 1))).fit(train)


#: Rows of one task of tree training.
TREE_TASK_ROWS = 500_000


def dealt_to_cores(rows: DataFrame) -> DataFrame:
    """At most two partitions a core, or as many as large tables need.

    While a forest grows, every partition sends the class counts of all open
    nodes, so the sum sent is partitions times nodes, however few rows each has.
    """
    return rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TREE_TASK_ROWS)))


def random_forest(train: DataFrame, trees: int = 100, seed: int = 42, label: str = "target", depth: int = 10) -> Model:
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, seed=seed, maxDepth=depth).fit(dealt_to_cores(train))


def gradient_boosting(train: DataFrame, rounds: int = 100, seed: int = 42, label: str = "target", depth: int = 3) -> Model:
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, seed=seed, maxDepth=depth).fit(train)


def dense_net(train: DataFrame, hidden: tuple[int, ...] = (64, 32, 16), classes: int = 2, seed: int = 42,
              label: str = "target", max_iter: int = 100) -> Model:
    width = len(train.select("features").first()["features"])
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=[width, *hidden, classes],
                                          seed=seed, maxIter=max_iter).fit(train)


def score(df: DataFrame, model: Model, label: str = "target") -> DataFrame:
    """audio_id, real_or_fake, y, p (class 1) and pred."""
    out = model.transform(df)
    cols = [F.col(c) for c in ("audio_id", "real_or_fake") if c in df.columns]
    if label in df.columns:
        cols.append(F.col(label).cast("int").alias("y"))
    return out.select(*cols, vector_to_array("probability")[1].alias("p"), F.col("prediction").cast("int").alias("pred"))


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float = 0.0) -> DataFrame:
    """The same for a logistic model as a plain projection over named columns."""
    z = reduce(lambda a, b: a + b, [F.col(c) * float(w) for c, w in weights.items()]) + float(intercept)
    p = 1 / (1 + F.exp(-z))
    return df.select("audio_id", "real_or_fake", p.alias("p"), (p > 0.5).cast("int").alias("pred"))


def margin(df: DataFrame, model: Model) -> Column:
    """Score to calibrate: the decision value of a logistic model, the probability of any other."""
    logit = type(model).__name__.startswith("LogisticRegression")
    return vector_to_array("rawPrediction" if logit else "probability")[1]


class Calibrated:
    """Sigmoid over the score of a fitted model (Platt 1999)."""

    def __init__(self, base: Model, slope: float, offset: float):
        self.base, self.slope, self.offset = base, slope, offset

    def score(self, df: DataFrame, label: str = "target") -> DataFrame:
        out = self.base.transform(df)
        p = 1 / (1 + F.exp(-(margin(out, self.base) * self.slope + self.offset)))
        cols = [F.col(c) for c in ("audio_id", "real_or_fake") if c in df.columns]
        if label in df.columns:
            cols.append(F.col(label).cast("int").alias("y"))
        return out.select(*cols, p.alias("p"), (p > 0.5).cast("int").alias("pred"))


def calibrate(base: Model, train: DataFrame, label: str = "target") -> Calibrated:
    """Fit the sigmoid on smoothed targets: positives (N+ + 1) / (N+ + 2), negatives 1 / (N- + 2).

    A soft target t is the row twice, as class 1 with weight t and class 0 with 1 - t.
    """
    out = base.transform(train)
    rows = out.select(margin(out, base).alias("_s"), F.col(label).cast("int").alias("_y"))
    n = rows.agg(F.count_if(F.col("_y") == 1).alias("p"), F.count_if(F.col("_y") == 0).alias("q")).first()
    t = F.when(F.col("_y") == 1, (n["p"] + 1) / (n["p"] + 2)).otherwise(1 / (n["q"] + 2))
    soft = rows.select("_s", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), t.alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - t).alias("w")))).alias("z"))
    soft = soft.select(array_to_vector(F.array("_s")).alias("features"), "z.label", "z.w")
    fit = LogisticRegression(weightCol="w", regParam=0.0, maxIter=200, tol=1e-9).fit(soft)
    return Calibrated(base, float(fit.coefficients[0]), float(fit.intercept))


def train_all(train: DataFrame, trees: int = 100) -> dict[str, Model | Calibrated]:
    """The five models of a training round."""
    lr, l2 = logistic(train), logistic(train, 1.0)
    rf = random_forest(train, trees)
    return dict(zip(MODEL_NAMES, [lr, l2, rf, calibrate(lr, train), calibrate(rf, train)]))


def evaluate_all(models: dict[str, Model | Calibrated], test: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC, one row per model."""
    parts = [(m.score(test) if isinstance(m, Calibrated) else score(test, m)).select(F.lit(n).alias("model"), "y", "p", "pred")
             for n, m in models.items()]
    rows = checkpointed(reduce(lambda a, b: a.unionByName(b), parts))  # every model scores every row once
    return binary_metrics(rows, ["model"]).join(roc_auc(rows, ["model"]), "model")


# --- more than two classes ------------------------------------------------------------------

def indexed(df: DataFrame, label: str = "real_or_fake") -> tuple[DataFrame, list[str]]:
    model = StringIndexer(inputCol=label, outputCol="class_index", stringOrderType="alphabetAsc").fit(df)
    return model.transform(df), list(model.labels)


def one_vs_rest_logistic(train: DataFrame, label: str = "class_index") -> Model:
    return OneVsRest(classifier=LogisticRegression(maxIter=100, standardization=False), featuresCol="features", labelCol=label).fit(train)


def multiclass_forest(train: DataFrame, trees: int = 100, seed: int = 42, label: str = "class_index") -> Model:
    return random_forest(train, trees, seed, label)


def multiclass_net(train: DataFrame, classes: int, seed: int = 42, label: str = "class_index", max_iter: int = 100) -> Model:
    return dense_net(train, classes=classes, seed=seed, label=label, max_iter=max_iter)


def one_vs_real_sweep(df: DataFrame, columns: list[str], label: str = "real_or_fake") -> DataFrame:
    """A logistic model per fake version against the real recordings; metrics per version.

    The loop is over the class list; the rows are assembled and kept once.
    """
    rows = assembled(df, columns, label).withColumn("target", F.when(F.col(label) == "R", 0).otherwise(1)).persist()
    parts = []
    for version in [v for v in distinct_labels(rows, label) if v != "R"]:
        sub = real_vs(rows, version, label)
        parts.append(score(sub, logistic(sub)).select(F.lit(version).alias("version"), "y", "p", "pred"))
    scored = checkpointed(reduce(lambda a, b: a.unionByName(b), parts))  # every model scores its rows once
    rows.unpersist()
    return binary_metrics(scored, ["version"]).join(roc_auc(scored, ["version"]), "version")


# --- projections and clusters -----------------------------------------------------------------

def prepared(df: DataFrame, columns: list[str]) -> DataFrame:
    """Imputed, scaled and assembled."""
    return assembled(fit_preparation(df, columns).transform(df), columns)


def pca(df: DataFrame, columns: list[str], k: int = 2) -> DataFrame:
    """First k components of imputed, scaled columns with the label; the largest loading is positive."""
    rows = prepared(df, columns)
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(rows)
    load = model.pc.toArray()
    sign = np.sign(load[np.abs(load).argmax(axis=0), np.arange(k)])
    arr = vector_to_array("pc")
    return model.transform(rows).select("audio_id", "real_or_fake",
                                        *[(arr[i] * float(sign[i])).alias(f"PC{i + 1}") for i in range(k)])


def kernel_pca(df: DataFrame, columns: list[str], k: int = 2, gamma: float | None = None, features: int = 256,
               seed: int = 42) -> DataFrame:
    """RBF kernel PCA through random Fourier features (Rahimi & Recht 2007) and linear PCA on them."""
    rows = prepared(df, columns).withColumn("_x", vector_to_array("features"))
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2 * (gamma or 1 / len(columns))), (len(columns), features))
    b = rng.uniform(0, 2 * np.pi, features)

    @F.pandas_udf("array<double>")
    def lift(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.sqrt(2 / features) * np.cos(np.stack(x.to_list()) @ w + b)))

    lifted = rows.select("audio_id", "real_or_fake", array_to_vector(lift("_x")).alias("lifted"))
    model = PCA(k=k, inputCol="lifted", outputCol="pc").fit(lifted)
    arr = vector_to_array("pc")
    return model.transform(lifted).select("audio_id", "real_or_fake", *[arr[i].alias(f"PC{i + 1}") for i in range(k)])


def kmeans_table(df: DataFrame, columns: list[str], k: int = 2, seed: int = 42) -> DataFrame:
    """Label by cluster counts after k-means on prepared columns."""
    rows = prepared(df, columns)
    out = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows).transform(rows)
    side = F.when(F.col("real_or_fake") == "R", "R").otherwise("F")
    return out.groupBy(side.alias("label"), "cluster").agg(F.count(F.lit(1)).alias("n"))


# --- importances -------------------------------------------------------------------------------

def importances(model: Model, columns: list[str], spark, k: int | None = 10) -> DataFrame:
    """Forest importances, or signed coefficients of a logistic model, largest first."""
    values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = spark.createDataFrame([(c, float(v)) for c, v in zip(columns, values.toArray())], "feature string, importance double")
    out = rows.orderBy(F.col("importance").desc(), "feature")
    return out.limit(k) if k else out


def rf_important(train: DataFrame, columns: list[str], trees: int = 100, seed: int = 42) -> DataFrame:
    """Features with a positive forest importance, largest first."""
    return importances(random_forest(train, trees, seed), columns, train.sparkSession, None).where(F.col("importance") > 0)


def lr_importance(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coefficients of a logistic model on scaled columns, ordered by size."""
    rows = prepared(df, columns).withColumn("target", F.when(F.col("real_or_fake") == "R", 0).otherwise(1))
    out = importances(logistic(rows), columns, df.sparkSession, None)
    return out.orderBy(F.abs("importance").desc(), "feature")


def permutation_importance(df: DataFrame, columns: list[str], model: Model, permute: list[str] | None = None,
                           seed: int = 42, label: str = "target") -> DataFrame:
    """Loss of accuracy when one column is replaced by another row's values, per column, in one pass.

    Rows are numbered under two hash orders; pairing equal numbers is a random
    one-to-one assignment of rows to donors.
    """
    permute = permute or columns
    rows = df.select("audio_id", label, F.array(*columns).alias("_x"))

    def numbered(salt: str) -> DataFrame:
        h = F.md5(F.concat(F.col("audio_id").cast("string"), F.lit(f"|{seed}|{salt}")))
        return global_position(rows.withColumn("_h", h), ["_h", "audio_id"], "_pos")

    own = numbered("own").select("_pos", label, "_x")
    donor = numbered("donor").select("_pos", F.col("_x").alias("_d"))
    at = {c: columns.index(c) for c in permute}
    swapped = [F.struct(F.lit(None).cast("string").alias("feature"), F.col("_x").alias("_v"))]
    for c, j in at.items():
        mixed = F.concat(F.slice("_x", 1, j), F.slice("_d", j + 1, 1), F.slice("_x", j + 2, len(columns)))
        swapped.append(F.struct(F.lit(c).alias("feature"), mixed.alias("_v")))
    long = own.join(donor, "_pos").select(label, F.explode(F.array(*swapped)).alias("z")).select(
        label, "z.feature", array_to_vector("z._v").alias("features"))
    hit = (F.col("prediction") == F.col(label)).cast("double")
    acc = model.transform(long).groupBy("feature").agg(F.avg(hit).alias("accuracy"))
    base = acc.where(F.col("feature").isNull()).first()["accuracy"]
    return acc.where(F.col("feature").isNotNull()).select("feature", (F.lit(base) - F.col("accuracy")).alias("importance"))
