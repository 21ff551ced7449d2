"""Streams fed in three parts equal the batch operator; late rows are dropped."""

from pyspark.sql import functions as F

from voxledger.operators import drift as dr
from voxledger.plans import fixtures as fx
from voxledger.plans.q_streams import arrivals, part_of, samples
from voxledger.streaming import streams as xs


def replay(spark, tmp_path, src, op):
    base = str(tmp_path)
    far = spark.sql("SELECT timestamp'2030-01-01' ts, 'flush' audio_id, 1e9 x")
    all_rows = src.withColumn("part", part_of(F.col("ts"))).unionByName(far.withColumn("part", F.lit(3)))

    def run():
        return xs.to_files(op(xs.file_stream(spark, f"{base}/in", src.schema)), f"{base}/out", f"{base}/state")

    arrivals(all_rows, f"{base}/in", ["a", "b", "c", "d"], F.col("part"), run)
    return sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").collect())


def rounded(rows):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows]


def test_pause_sessions_equal_batch(spark, sf, tmp_path):
    src = samples(spark, sf)
    op = lambda d: xs.pause_sessions_stream(d, "6 hours", 900.0, "13 hours")
    want = sorted(tuple(r) for r in op(src).collect())
    got = replay(spark, tmp_path, src, op)
    assert len(want) > 10 and rounded(got) == rounded(want)


def test_windowed_stats_equal_batch(spark, sf, tmp_path):
    src = samples(spark, sf)
    op = lambda d: xs.windowed_stats_stream(d, "1 day")
    want = sorted(tuple(r) for r in op(src).collect())
    assert str(rounded(replay(spark, tmp_path, src, op))) == str(rounded(want))


def test_late_rows_are_dropped(spark, tmp_path):
    base = str(tmp_path)
    schema = "ts timestamp, audio_id string, x double"
    parts = [("2024-01-01 00:00:00", 1.0), ("2024-01-03 00:00:00", 1.0), ("2024-01-01 00:00:01", 5.0), ("2024-01-09 00:00:00", 1.0)]

    def run():
        s = xs.windowed_stats_stream(xs.file_stream(spark, f"{base}/in", schema), "1 day")
        return xs.to_files(s, f"{base}/out", f"{base}/state")

    for k, (ts, x) in enumerate(parts):
        spark.sql(f"SELECT timestamp'{ts}' ts, 'a' audio_id, {x}D x").write.parquet(f"{base}/in/{k}")
        run().awaitTermination()
    first = spark.read.parquet(f"{base}/out").orderBy("start").first()
    assert first["n"] == 1 and first["max"] == 1.0


def test_drift_stream_restart_adds_nothing(spark, sf, tmp_path):
    base = str(tmp_path)
    d = fx.drift(spark, sf)
    dr.save_profile(d.where("side = 'train'"), f"{base}/profile", 4, 100)
    profile = dr.open_profile(spark, f"{base}/profile", 4)
    new = d.where("side = 'new'").select("feature", "value")
    new.write.parquet(f"{base}/in/a")
    for _ in range(2):
        xs.drift_stream(xs.file_stream(spark, f"{base}/in", new.schema), profile, f"{base}/out", f"{base}/state").awaitTermination()
    rows = spark.read.parquet(f"{base}/out/*").collect()
    assert len(rows) == 5 and [r["feature"] for r in rows if r["drifted"]] == ["error_mean"]
