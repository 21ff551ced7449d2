"""The paths meant for large groups give the same rows as the plain ones."""

import numpy as np
from pyspark.sql import Window as W, functions as F

from voxledger.operators import relational as rel, stats as st
from voxledger.operators.scale import exact_quantiles, global_position, position_in_group, running_sums
from voxledger.plans import fixtures as fx


def hot(spark, n=3000):
    """Two thirds of the rows in one group."""
    return spark.range(n, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, (F.col("id") % 30).cast("string")).otherwise("hot").alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(100000)).alias("v"), F.lit(1).alias("one"), "id")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_running_sums_equal_a_window(spark):
    d = hot(spark).groupBy("g", "v").agg(F.sum("one").alias("n"))
    for group in (["g"], []):
        src = d if group else d.groupBy("v").agg(F.sum("n").alias("n"))
        keys = W.partitionBy(*(group or [F.lit(0)]))
        small = src.select("*", F.sum("n").over(keys.orderBy("v").rowsBetween(W.unboundedPreceding, 0)).alias("c"),
                           F.sum("n").over(keys).alias("t"))
        large = running_sums(src, group, ["v"], {"c": "n"}, {"t": "n"})
        assert rows(small) == rows(large.select(small.columns))
        assert len(rows(large)) == src.count()


def test_global_position_is_dense(spark):
    out = global_position(hot(spark), ["v", "id"])
    got = [r["pos"] for r in out.orderBy("v", "id").collect()]
    assert got == list(range(3000))


def test_position_in_group(spark):
    d = hot(spark).withColumn("coarse", F.floor(F.col("v") / 1000))
    out = position_in_group(d, ["g"], "coarse", ["v", "id"]).toPandas()
    for _, part in out.groupby("g"):
        assert part.sort_values(["v", "id"])["pos"].tolist() == list(range(len(part)))


def test_exact_quantiles(spark):
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["g"]: [r[k] for k in probs] for r in exact_quantiles(hot(spark), ["g"], "v", probs).collect()}
    for g, part in hot(spark).toPandas().groupby("g"):
        assert np.allclose(got[g], np.quantile(part["v"], list(probs.values())))


def test_correlation_over_pairs_of_present_values(spark, sf):
    f = fx.feat_line(spark, sf)
    cols = ["qty", "price", "const", "quasi", "dup_qty", "corr_price", "miss"]
    want = f.select(*cols).toPandas().corr()
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in st.correlation_matrix(f.repartition(7), cols).collect()}
    assert len(got) == 21
    for (a, b), v in got.items():
        assert (v is None) == bool(np.isnan(want.loc[a, b])), (a, b)
        assert v is None or abs(v - want.loc[a, b]) < 1e-9


def test_partition_count_does_not_matter(spark, sf):
    f = fx.feat_line(spark, sf)
    one, many = (st.compare_classes(f.repartition(n), ["qty", "price", "miss"]).orderBy("feature").toPandas() for n in (1, 13))
    assert np.allclose(one.drop(columns="feature"), many.drop(columns="feature"), equal_nan=True)


def test_stratified_split_is_exact_and_stable(spark, sf):
    f = fx.feat_line(spark, sf).select("audio_id", "real_or_fake")
    a, b = (rel.stratified_split(f.repartition(n), 0.2, 7) for n in (2, 9))
    assert rows(a) == rows(b)
    for r in a.groupBy("real_or_fake").agg(F.count_if("is_test").alias("k"), F.count("*").alias("n")).collect():
        assert r["k"] == int(np.floor(0.2 * r["n"] + 0.5))


def test_a_recording_is_a_month_of_a_user(spark, sf):
    sizes = fx.sig_user(spark, sf).select("audio_id", F.size("samples").alias("n")).toPandas()
    want = fx.table(spark, sf, "events").groupBy("user_id", F.month("ts")).count().toPandas()
    assert sorted(sizes["n"]) == sorted(want["count"]) and sizes["audio_id"].is_unique


def test_grouped_split_keeps_groups_and_shares(spark):
    """Whole groups; shares of pure classes within half of the largest group; nulls are one group; partitions do not matter."""
    d = spark.range(6000).select(
        "id", F.when(F.col("id") % 50 == 0, None).otherwise((F.col("id") % 150).cast("string")).alias("g"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("F01").alias("real_or_fake"))
    a, b = (rel.grouped_stratified_split(d.repartition(n), "g", 0.3, 5) for n in (2, 9))
    assert a.columns == [*d.columns, "is_test"]
    got = a.collect()
    assert sorted(map(str, got)) == sorted(map(str, b.collect())) and len(got) == 6000
    sides, sizes = {}, {}
    for r in got:
        sides.setdefault(r.g, set()).add(r.is_test)
        sizes[r.g] = sizes.get(r.g, 0) + 1
    assert all(len(s) == 1 for s in sides.values()) and sizes[None] == 120
    for c in ("R", "F01"):  # groups without null hold one class
        mine = [r.is_test for r in got if r.real_or_fake == c]
        assert abs(sum(mine) - 0.3 * len(mine)) <= max(sizes.values())
    assert rel.grouped_stratified_split(d.limit(0), "g").count() == 0
