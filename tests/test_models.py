import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from voxledger.operators import evaluate as ev, models as ml, prep
from voxledger.plans import fixtures as fx

COLS = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def data(spark):
    d = spark.range(600, numPartitions=4).select(F.col("id").cast("string").alias("audio_id"), *[F.randn(i + 1).alias(c) for i, c in enumerate(COLS)])
    y = F.col("x0") * 2 + F.col("x1") - F.col("x2") + F.randn(99) * 0.5 > 0
    d = d.withColumn("real_or_fake", F.when(~y, "R").when(F.pmod(F.col("audio_id").cast("int"), F.lit(2)) == 0, "F01").otherwise("F02"))
    return d.withColumn("target", F.when(F.col("real_or_fake") == "R", 0).otherwise(1)).persist()


def test_five_models_separate_the_classes(data):
    rows = ml.assembled(data, COLS).persist()
    models = ml.train_all(rows, trees=10)
    got = {r["model"]: r for r in ml.evaluate_all(models, rows).collect()}
    assert set(got) == set(ml.MODEL_NAMES)
    assert all(r["roc_auc"] > 0.9 for r in got.values())
    cal = models["Calibrated Logistic Regression"]
    assert cal.slope > 0
    lr = models["Logistic Regression"]
    plain = ml.score_linear(data, dict(zip(COLS, lr.coefficients.toArray())), lr.intercept)
    both = plain.select("audio_id", F.col("p").alias("q")).join(ml.score(rows, lr), "audio_id")
    assert both.where(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_permutation_importance_finds_the_signal(data):
    rows = ml.assembled(data, COLS)
    model = ml.logistic(rows)
    got = {r["feature"]: r["importance"] for r in ml.permutation_importance(data, COLS, model).collect()}
    assert max(got, key=got.get) == "x0" and got["x0"] > 0.1 and abs(got["x5"]) < 0.05


def test_importances_and_sweep(data, spark):
    first = ml.lr_importance(data.drop("target"), COLS).first()["feature"]
    assert first == "x0"
    sweep = ml.one_vs_real_sweep(data.drop("target"), COLS).collect()
    assert {r["version"] for r in sweep} == {"F01", "F02"} and all(r["roc_auc"] > 0.85 for r in sweep)
    assert ml.kmeans_table(data, COLS).agg(F.sum("n")).first()[0] == 600


def test_projections(data):
    p = ml.pca(data, COLS, 2).agg(F.variance("PC1").alias("a"), F.variance("PC2").alias("b")).first()
    assert p["a"] >= p["b"] > 0
    assert ml.kernel_pca(data, COLS, features=64).columns == ["audio_id", "real_or_fake", "PC1", "PC2"]


def test_shap_sums_to_the_margin(spark, sf):
    f = fx.feat_emb(spark, sf)
    w = {"e0": 2.0, "e1": -1.0}
    mean = f.agg(F.avg("e0"), F.avg("e1")).first()
    out = ev.linear_shap(f, w).join(f.select("audio_id", F.col("e0").alias("a"), F.col("e1").alias("b")), "audio_id")
    bad = out.where(F.abs(F.col("e0") + F.col("e1") - (2 * (F.col("a") - mean[0]) - (F.col("b") - mean[1]))) > 1e-9)
    assert bad.count() == 0


def test_saved_state_scores_like_the_fitted_one(spark, sf):
    from voxledger.plans import q_models as qm
    from voxledger.plans.catalog import QUERIES

    got = {r["audio_id"]: (r["predicted"], r["probability"]) for r in QUERIES["m16_predict_pipeline"](spark, sf).collect()}
    train, batch, state, kept = qm._prepared_sides(spark, sf)
    fit, held = (ml.assembled(prep.prepare(side, state, kept), kept) for side in (train, batch))
    want = {r["audio_id"]: (r["pred"], r["p"]) for r in ml.score(held, ml.logistic(fit)).collect()}
    assert set(got) == set(want)
    for k, (pred, p) in want.items():
        assert got[k][0] == pred and abs(got[k][1] - p) < 1e-6 and 0 <= p <= 1


def test_training_round_has_five_models(spark, sf):
    from voxledger.plans.catalog import QUERIES

    rows = QUERIES["m15_train_pipeline"](spark, sf).collect()
    assert sorted(r["model"] for r in rows) == sorted(ml.MODEL_NAMES)
    assert all(0 <= r[c] <= 1 for r in rows for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))


def test_forest_grows_on_two_tasks_a_core(spark, monkeypatch):
    """Every partition sends the counts of all open nodes, so many small partitions must not reach the trees."""
    cores, seen = spark.sparkContext.defaultParallelism, []
    rows = spark.range(400).selectExpr("cast(id % 2 as double) as target", "array(cast(id as double), cast(id % 7 as double)) as x")
    rows = rows.select("target", array_to_vector("x").alias("features")).repartition(cores * 8)
    fit = ml.RandomForestClassifier.fit
    monkeypatch.setattr(ml.RandomForestClassifier, "fit", lambda self, df: seen.append((df.rdd.getNumPartitions(), df.count())) or fit(self, df))
    ml.random_forest(rows, 2, depth=2)
    assert seen == [(2 * cores, 400)]
    monkeypatch.setattr(ml, "TREE_TASK_ROWS", 10)
    assert ml.dealt_to_cores(rows).rdd.getNumPartitions() == min(max(40, 2 * cores), cores * 8)
