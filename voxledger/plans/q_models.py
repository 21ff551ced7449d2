"""M: models and projections; P10, P11, E10, E12 importances."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from ..operators import models as ml, prep, relational as rel
from ..operators.scale import spread_small
from ..sources import features as feat
from . import fixtures as fx
from .q_sources import shared_folder
from .q_stats import r
from .registry import query, rounded


def _features(spark, sf):
    return spread_small(rel.binary_target(fx.feat_emb(spark, sf)))


def _split(spark, sf):
    """Assembled train and test rows; a recording is on one side only."""
    rows = rel.hash_split(ml.assembled(_features(spark, sf), fx.EMB), 0.2, 42)
    return rows.where(~F.col("is_test")).drop("is_test").persist(), rows.where("is_test").drop("is_test")


@query("m01_logistic")
def m01(spark, sf):
    train, test = _split(spark, sf)
    return ml.score(test, ml.logistic(train))


@query("m02_l2_logistic")
def m02(spark, sf):
    train, test = _split(spark, sf)
    return ml.score(test, ml.logistic(train, 1.0))


@query("m03_random_forest")
def m03(spark, sf):
    train, test = _split(spark, sf)
    return ml.score(test, ml.random_forest(train, 100))


@query("m04_calibrate")
def m04(spark, sf):
    train, test = _split(spark, sf)
    lr, rf = ml.logistic(train), ml.random_forest(train, 100)
    a = ml.calibrate(lr, train).score(test).withColumn("model", F.lit("logistic"))
    return a.union(ml.calibrate(rf, train).score(test).withColumn("model", F.lit("forest")))


@query("m05_gradient_boosting")
def m05(spark, sf):
    train, test = _split(spark, sf)
    return ml.score(test, ml.gradient_boosting(train, 100))


def _multi(spark, sf):
    base = fx.feat_emb(spark, sf).join(fx.score_k(spark, sf).select("audio_id", F.col("y").cast("string").alias("k")), "audio_id")
    rows, labels = ml.indexed(ml.assembled(spread_small(base), fx.EMB, "k"), "k")
    rows = rel.hash_split(rows, 0.2, 42)
    return rows.where(~F.col("is_test")).drop("is_test").persist(), rows.where("is_test").drop("is_test"), labels


@query("m06_one_vs_rest_logistic")
def m06(spark, sf):
    train, test, _ = _multi(spark, sf)
    out = ml.one_vs_rest_logistic(train).transform(test)
    return out.select("audio_id", "class_index", F.col("prediction").alias("pred"))


@query("m07_multiclass_forest")
def m07(spark, sf):
    train, test, _ = _multi(spark, sf)
    return ml.multiclass_forest(train, 100).transform(test).select("audio_id", "class_index", F.col("prediction").alias("pred"))


@query("m08_dense_net")
def m08(spark, sf):
    train, test = _split(spark, sf)
    return ml.score(test, ml.dense_net(train))


@query("m09_multiclass_net")
def m09(spark, sf):
    train, test, labels = _multi(spark, sf)
    model = ml.multiclass_net(train, len(labels))
    return model.transform(test).select("audio_id", "class_index", F.col("prediction").alias("pred"))


@query("m10_one_vs_real_sweep")
def m10(spark, sf):
    return ml.one_vs_real_sweep(spread_small(fx.feat_emb(spark, sf)), fx.EMB)


@query("m11_pca")
def m11(spark, sf):
    return ml.pca(spread_small(fx.feat_emb(spark, sf)), fx.EMB, 3)


@query("m12_kernel_pca")
def m12(spark, sf):
    return ml.kernel_pca(spread_small(fx.feat_emb(spark, sf)), fx.EMB)


@query("m13_kmeans")
def m13(spark, sf):
    return ml.kmeans_table(spread_small(fx.feat_emb(spark, sf)), fx.EMB)


@query("m14_score", "score", f"SELECT audio_id, real_or_fake, {r('p', 'p')}, pred::BIGINT AS pred FROM score")
def m14(spark, sf):
    return rounded(ml.score_linear(fx.feat_emb(spark, sf), {c: 4.0 for c in fx.EMB}))


@query("p10_rf_important")
def p10(spark, sf):
    train, _ = _split(spark, sf)
    return ml.rf_important(train, fx.EMB, 100)


@query("p11_lr_importance")
def p11(spark, sf):
    return ml.lr_importance(_features(spark, sf).drop("target"), fx.EMB)


@query("e10_top_importances")
def e10(spark, sf):
    train, _ = _split(spark, sf)
    a = ml.importances(ml.logistic(train), fx.EMB, spark).withColumn("model", F.lit("logistic"))
    return a.union(ml.importances(ml.random_forest(train, 100), fx.EMB, spark).withColumn("model", F.lit("forest")))


@query("e12_permutation_importance")
def e12(spark, sf):
    f = _features(spark, sf)
    model = ml.logistic(ml.assembled(f, fx.EMB))
    return ml.permutation_importance(f, fx.EMB, model)


def _prepared_sides(spark, sf):
    """Train and test tables, the preparation fitted on train, and the columns kept on train."""
    rows = rel.hash_split(spread_small(fx.feat_emb(spark, sf)), 0.2, 42)
    train, test = rows.where(~F.col("is_test")).drop("is_test"), rows.where("is_test").drop("is_test")
    state = prep.fit_preparation(train, fx.EMB)
    kept = prep.select_features(state.transform(train), fx.EMB)
    return train, test, state, kept


@query("m15_train_pipeline")
def m15(spark, sf):
    """Split, preparation, selection, the five models of a round, their metrics on the held-out side."""
    train, test, state, kept = _prepared_sides(spark, sf)
    fit, held = (ml.assembled(prep.prepare(side, state, kept), kept) for side in (train, test))
    fit = fit.persist()
    out = ml.evaluate_all(ml.train_all(fit), held)
    fit.unpersist()
    return out


@query("m16_predict_pipeline")
def m16(spark, sf):
    """State and model are saved, loaded again, and score a new batch into a prediction table."""
    train, batch, state, kept = _prepared_sides(spark, sf)
    path = shared_folder(spark, "round")
    feat.save_pipeline(state, kept, path, spark)
    ml.logistic(ml.assembled(prep.prepare(train, state, kept), kept)).write().overwrite().save(f"{path}/model")
    loaded, selected = feat.load_pipeline(spark, path)
    model = LogisticRegressionModel.load(f"{path}/model")
    feat.write_predictions(ml.score(ml.assembled(prep.prepare(batch, loaded, selected), selected), model), f"{path}/predictions")
    return spark.read.parquet(f"{path}/predictions")
