"""Drift against a stored profile equals the two-table test and does not shuffle the training rows."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxledger.operators import drift as dr


def long_rows(spark, values):
    return spark.createDataFrame([(f, float(v) if v is not None else None) for f, vs in values.items() for v in vs], "feature string, value double")


def report(df):
    return {r["feature"]: (r["ks_statistic"], r["p_value"], r["drifted"]) for r in df.collect()}


def both_ways(spark, tmp_path, train, new, block=7):
    t, n = long_rows(spark, train), long_rows(spark, new)
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    dr.save_profile(t, path, 4, block)
    got = report(dr.ks_against_profile(n, dr.open_profile(spark, path, 4)))
    sides = t.select(F.lit("train").alias("side"), "*").union(n.select(F.lit("new").alias("side"), "*"))
    return got, report(dr.ks_drift_long(sides))


def test_equal_to_two_tables(spark, tmp_path):
    rng = np.random.default_rng(4)
    train = {"a": rng.integers(0, 40, 300), "b": rng.standard_normal(200), "same": [1.0] * 50, "above": [0.0, 1.0], "odd": [None, float("nan"), 2.0],
             "only train": [1.0], "none": [None], "minus zero": [0.0, -0.0, 1.0]}
    new = {"a": rng.integers(20, 60, 100), "b": rng.standard_normal(500) + 0.3, "same": [1.0] * 9, "above": [5.0, 6.0], "odd": [1.0, float("nan"), 3.0],
           "only new": [1.0], "none": [1.0], "minus zero": [-0.0, 0.0, 0.0]}
    got, want = both_ways(spark, tmp_path, train, new)
    assert got == want and set(got) == {"a", "b", "same", "above", "odd", "minus zero"}
    got, want = both_ways(spark, tmp_path, train, {"a": [-1000.0, 39.0, 39.0, 1000.0], "b": [-99.0]}, 1000)
    assert got == want


def test_empty_sides(spark, tmp_path):
    assert both_ways(spark, tmp_path, {"a": [1.0]}, {}) == ({}, {})
    assert both_ways(spark, tmp_path, {"a": [None]}, {"a": [1.0]}) == ({}, {})


def test_many_values_in_one_block_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dr, "BLOCK_VALUES", 16)
    got, want = both_ways(spark, tmp_path, {"a": [0.0, 1.0]}, {"a": np.linspace(0, 1, 500)}, 1000)
    assert got == want


def shuffled(spark, work) -> int:
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "shuffled")
    work()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    ids = {k for j in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(j).stageIds}
    out = 0
    for k in ids:
        try:
            out += sc._jsc.sc().statusStore().lastStageAttempt(k).shuffleWriteBytes()
        except Exception as e:  # a skipped stage has no attempt
            assert "NoSuchElement" in str(e)
    return out


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_shuffle_follows_the_batch_alone(spark, tmp_path, broadcast):
    """Twenty times the training rows: the batch shuffles no more than a little for the blocks it touches."""
    new = spark.range(300).select(F.lit("f").alias("feature"), (F.rand(1) * 1e6).alias("value"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        sizes = []
        for n in (3_000, 60_000):
            path = f"{tmp_path}/{n}"
            dr.save_profile(spark.range(n).select(F.lit("f").alias("feature"), (F.rand(2) * 1e6).alias("value")), path, 8, 1000)
            profile = dr.open_profile(spark, path, 8)
            sizes.append(shuffled(spark, lambda: dr.ks_against_profile(new, profile).collect()))
        assert sizes[1] < 1.6 * sizes[0] and sizes[1] < 60_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
