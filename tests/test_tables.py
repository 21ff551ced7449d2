"""Relational, preparation, evaluation and run-table rules."""

import pytest
from pyspark.sql import functions as F

from voxledger.operators import drift as dr, evaluate as ev, prep, relational as rel, runs as rn
from voxledger.plans import fixtures as fx
from voxledger.sources import features as feat, recordings as rec


def test_unknown_names_are_errors(spark, sf):
    with pytest.raises(ValueError):
        rec.scan_dataset(spark.range(1).withColumn("corpus", F.lit("a")), "b", ("a",))
    with pytest.raises(ValueError):
        rec.assign_shards(spark.range(97 * 89).select(F.col("id").cast("string").alias("audio_id")), 90, 96)
    with pytest.raises(ValueError, match="missing feature columns: nope"):
        rel.align_columns(fx.feat_line(spark, sf), ["qty", "nope"])
    sizes = spark.range(1).select(rec.even_shard_size(F.lit(1000), 90, 110), rec.even_shard_size(F.lit(97 * 89), 90, 96)).first()
    assert tuple(sizes) == (100, None)


def test_shards_keep_ids_whole(spark, tmp_path):
    d = spark.range(600).select((F.col("id") % 200).cast("string").alias("audio_id"))
    out = rec.assign_shards(d)
    per = out.groupBy("audio_id").agg(F.countDistinct("partition_id").alias("k")).agg(F.max("k")).first()[0]
    sizes = {r["n"] for r in out.groupBy("partition_id").agg(F.countDistinct("audio_id").alias("n")).collect()}
    assert per == 1 and sizes == {100}
    rec.write_shards(out, str(tmp_path / "s"))
    assert rec.scan_partition(spark.read.parquet(str(tmp_path / "s")), 1).count() == 300


def test_resume_is_idempotent(spark):
    d = spark.range(30).select("id", (F.col("id") % 3).alias("partition_id"))
    done = d.where("partition_id < 2")
    todo = rec.resume_shards(d, done)
    assert {r["partition_id"] for r in todo.collect()} == {2}
    assert rec.resume_shards(d, done.union(todo.select("id", "partition_id"))).count() == 0


def test_split_never_splits_a_group(spark, sf):
    s = rel.hash_split(fx.sig_ev(spark, sf), 0.3, 1)
    assert s.groupBy("audio_id").agg(F.countDistinct("is_test").alias("k")).where("k > 1").count() == 0


def test_sorted_order(spark, sf):
    rows = rel.sort_real_first(fx.sig_ev(spark, sf).select("audio_id", "real_or_fake"), "audio_id").collect()
    keys = [(r["real_or_fake"] != "R", r["real_or_fake"], r["audio_id"]) for r in rows]
    assert keys == sorted(keys)
    files = spark.createDataFrame([("train/F01_p1.wav",), ("train/SSB1.wav",), ("train/p2.wav",), ("train/p1.wav",)], "path string")
    assert [r["path"] for r in rel.sort_files(files).collect()] == ["train/p1.wav", "train/p2.wav", "train/SSB1.wav", "train/F01_p1.wav"]


def test_id_file_map(spark):
    d = spark.createDataFrame([('{"a": {"train": "u/1"}, "b": {"train": "u/2"}}',)], "value string")
    assert sorted(map(tuple, rec.id_file_map(d).collect())) == [("a", "u/1"), ("b", "u/2")]


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"xy")
    df = rec.read_recordings(spark, str(tmp_path))
    assert bytes(df.first()["content"]) == b"xy"


def test_preparation_state_survives_saving(spark, sf, tmp_path):
    f = fx.feat_line(spark, sf)
    cols = ["qty", "miss", "const"]
    state = prep.fit_preparation(f, cols)
    feat.save_pipeline(state, cols, str(tmp_path / "p"), spark)
    loaded, names = feat.load_pipeline(spark, str(tmp_path / "p"))
    a, b = prep.prepare(f, state, cols), prep.prepare(f, loaded, names)
    assert a.exceptAll(b).count() == 0
    one = prep.prepare(f.limit(1), loaded, names).first()  # one row uses the fitted statistics
    assert one["const"] == 0.0 and one["qty"] != 0.0
    stats = a.agg(F.avg("miss"), F.stddev_pop("miss")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9


def test_quasi_constant_paths_agree(spark, sf):
    f = fx.feat_line(spark, sf)
    for t in (0.56, 0.9, 0.99, 0.999):
        slow = {r["feature"] for r in prep.top_value_share(f, fx.FEATURES).where(F.col("top_share") > t).collect()}
        assert set(prep.quasi_constant_columns(f, fx.FEATURES, t)) == slow
    assert "disc" in prep.quasi_constant_columns(f, fx.FEATURES, 0.05)


def test_duplicates_in_repeated_rows(spark):
    d = spark.createDataFrame([(str(i), i * 1.0, i * i * 1.0, i * i * 1.0, i * 1.0, None) for i in range(6)],
                              "audio_id string, a double, b double, c double, d double, e double")
    for twice in (d, d.union(d)):
        assert prep.duplicate_columns(twice, ["a", "b", "c", "d", "e"]) == ["c", "d"]
    one_hash = prep._candidate_pairs({c: {"hash": 0} for c in "abcde"}, list("abcde"))  # as if all hashes met
    assert sorted(prep._equal_pairs(d, one_hash, prep._verify(d, {}, one_hash)[1])) == [("a", "d"), ("b", "c")]


def test_greedy_selection_order(spark):
    d = spark.range(200).select(*[(F.rand(s) + F.col("id") * k).alias(n) for n, s, k in
                                  (("a", 1, 1.0), ("b", 2, 1.0), ("c", 3, 0.0), ("d", 4, 1.0))])
    assert prep.correlated_greedy(d, ["a", "b", "c", "d"]) == ["c", "d"]


def test_auc_is_antisymmetric(spark, sf):
    s = fx.score(spark, sf)
    a = ev.roc_auc(s).first()[0]
    b = ev.roc_auc(s.withColumn("p", 1 - F.col("p"))).first()[0]
    assert a + b == pytest.approx(1.0)
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    assert ev.roc_auc(tied).first()[0] == 0.5


def test_zero_division_gives_zero(spark):
    d = spark.createDataFrame([(1, 0), (1, 0)], "y int, pred int")
    assert ev.binary_metrics(d).first().asDict() == {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_ks_of_equal_samples(spark, sf):
    f = fx.feat_line(spark, sf).select(F.col("qty").alias("qty_mean"), F.col("price").alias("price_mean"), "tax")
    rows = dr.ks_drift(f, f).collect()
    assert {r["feature"] for r in rows} == {"qty_mean", "price_mean"}
    assert all(r["ks_statistic"] == 0 and r["p_value"] == 1 and not r["drifted"] for r in rows)
    out = dr.drift_summary(dr.ks_drift(f, f), 3).collect()
    assert len(out) == 1 and out[0]["status"] == "no drift" and out[0]["batch"] == 3


def test_promotion_rules(spark):
    v = spark.createDataFrame([("m", 1, 0.7, "Staging"), ("m", 2, 0.8, "None"), ("n", 1, 0.6, "None"),
                               ("q", 1, 0.9, "Staging"), ("q", 2, 0.5, "None")], "model string, version int, auc double, stage string")
    got = {(r["model"], r["version"]): r["stage"] for r in rn.promote_to_staging(v).collect()}
    assert got[("m", 2)] == "Staging" and got[("n", 1)] == "Staging" and got[("q", 2)] == "None"
    prod = {(r["model"], r["version"]): r["stage"] for r in rn.promote_to_production(rn.promote_to_staging(v)).collect()}
    assert [k for k, s in prod.items() if s == "Production"] == [("q", 1)]


def test_upsert_resumes_known_runs(spark):
    log = spark.sql("SELECT 'a_1' run_name, 'id1' run_id, timestamp'2024-01-01' ts, 0.5 auc")
    new = spark.sql("SELECT * FROM VALUES ('a_1', timestamp'2024-01-02', 0.6), ('b_1', timestamp'2024-01-02', 0.7) t(run_name, ts, auc)")
    out = {r["run_name"]: r for r in rn.upsert_run(log, new).collect()}
    assert out["a_1"]["run_id"] == "id1" and out["a_1"]["resumed"] and not out["b_1"]["resumed"]
    again = log.unionByName(rn.upsert_run(log, new).drop("resumed"))
    assert rn.current_runs(again).count() == 2
