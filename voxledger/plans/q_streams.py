"""X: streaming jobs, fed with the events table in three arriving parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import drift as dr, models as ml
from ..streaming import pauses as xp, streams as xs
from . import fixtures as fx
from .q_drift import KS
from .q_frames import H_, W_, interval_sql, level_sql
from .q_sources import shared_folder
from .q_stats import KEYS, r
from .registry import query, rounded

CUTS = ("2024-01-11", "2024-01-21")


def arrivals(df: DataFrame, folder: str, names: list[str], part, run) -> None:
    """Write part 0, 1, 2 and let the stream catch up after each one."""
    for k, name in enumerate(names):
        df.where(part == k).write.mode("overwrite").parquet(f"{folder}/{name}")
        q = run()
        q.awaitTermination()


def samples(spark, sf):
    return fx.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("audio_id"), F.col("value").alias("x"))


def with_end(rows: DataFrame) -> DataFrame:
    """The rows with their part, and a last arrival far ahead that closes every window and session before it.

    Its own windows stay open, so nothing of it comes out.
    """
    far = rows.agg((F.max("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts")).select(
        "ts", F.lit("end of input").alias("audio_id"), F.lit(1e9).alias("x"), F.lit(3).alias("part"))
    return rows.withColumn("part", part_of(F.col("ts"))).unionByName(far)


def part_of(ts):
    lit = lambda d: F.lit(d).cast("timestamp")
    return F.when(ts < lit(CUTS[0]), 0).when(ts < lit(CUTS[1]), 1).otherwise(2)


@query("x01_score_stream", "score", f"SELECT audio_id, real_or_fake, {r('p', 'p')}, pred::BIGINT AS pred FROM score")
def x01(spark, sf):
    base = shared_folder(spark, "score-stream")
    f = fx.feat_emb(spark, sf)
    scorer = lambda d: ml.score_linear(d, {c: 4.0 for c in fx.EMB})

    def run():
        s = xs.file_stream(spark, f"{base}/in", f.schema)
        return xs.to_files(xs.score_stream(s, scorer), f"{base}/out", f"{base}/state")

    arrivals(f, f"{base}/in", [f"iteration_{k + 1}.parquet" for k in range(3)], F.pmod(F.col("audio_id").cast("int"), F.lit(3)), run)
    return rounded(spark.read.parquet(f"{base}/out"))


@query("x02_drift_stream", "drift", "e3 AS (SELECT event_type || '_mean' AS feature, CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value, "
       "(ts >= TIMESTAMP '2024-01-21')::INT + (ts >= TIMESTAMP '2024-01-26')::INT AS batch FROM events WHERE ts >= TIMESTAMP '2024-01-16'), "
       "sides AS (SELECT b AS batch, 'train' AS side, feature, value FROM drift, range(3) t(b) WHERE side = 'train' "
       "UNION ALL SELECT batch, 'new', feature, value FROM e3), " +
       KS.replace("FROM drift GROUP BY 1, 2", "FROM sides GROUP BY 1, 2, batch").replace("SELECT feature, value, count", "SELECT batch || '|' || feature AS feature, value, count")
       + f" SELECT split_part(feature, '|', 1)::BIGINT AS batch, split_part(feature, '|', 2) AS feature, {r('d', 'ks_statistic')}, {r('p', 'p_value')}, p < 0.03 AS drifted FROM kp")
def x02(spark, sf):
    base = shared_folder(spark, "drift-stream")
    dr.save_profile(fx.drift(spark, sf).where("side = 'train'"), f"{base}/profile", 8, 256)
    profile = dr.open_profile(spark, f"{base}/profile", 8)
    ev = fx.table(spark, sf, "events").where(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    new = ev.select(F.concat("event_type", F.lit("_mean")).alias("feature"),
                    F.when(F.col("event_type") == "error", F.col("value") * 2).otherwise(F.col("value")).alias("value"),
                    F.when(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 0)
                    .when(F.col("ts") < F.lit("2024-01-26").cast("timestamp_ntz"), 1).otherwise(2).alias("part"))
    schema = new.drop("part").schema

    def run():
        return xs.drift_stream(xs.file_stream(spark, f"{base}/in", schema), profile, f"{base}/out", f"{base}/state")

    arrivals(new, f"{base}/in", ["a", "b", "c"], F.col("part"), run)
    return rounded(spark.read.parquet(f"{base}/out/*"))


@query("x03_pause_sessions_stream", sql=f"""
    WITH f AS (SELECT user_id::VARCHAR AS audio_id, time_bucket(INTERVAL 6 hour, ts) + INTERVAL 6 hour - INTERVAL 1 microsecond AS t, avg(value * value) AS p
        FROM events GROUP BY 1, 2 HAVING avg(value * value) < 900),
    b AS (SELECT *, CASE WHEN t - lag(t) OVER w < INTERVAL 13 hour THEN 0 ELSE 1 END AS nw FROM f WINDOW w AS (PARTITION BY audio_id ORDER BY t)),
    r AS (SELECT *, sum(nw) OVER (PARTITION BY audio_id ORDER BY t) AS run FROM b)
    SELECT audio_id, min(t) AS start, max(t) + INTERVAL 13 hour AS "end", count(*) AS n_frames, {r('max(p)', 'max_power')} FROM r GROUP BY audio_id, run""")
def x03(spark, sf):
    base = shared_folder(spark, "pause-stream")
    s = samples(spark, sf)

    def run():
        st = xs.file_stream(spark, f"{base}/in", s.schema)
        return xs.to_files(xs.pause_sessions_stream(st, "6 hours", 900.0, "13 hours"), f"{base}/out", f"{base}/state")

    arrivals(with_end(s), f"{base}/in", ["a", "b", "c", "d"], F.col("part"), run)
    out = spark.read.parquet(f"{base}/out")
    return rounded(out.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("end", F.col("end").cast("timestamp_ntz")))


def timed_samples(spark, sf) -> DataFrame:
    """The samples of every recording of ``sig_user`` with their times."""
    rows = fx.timed_user(spark, sf)
    return rows.select("audio_id", "real_or_fake", "ts", "n", "x", part_of(F.col("ts")).alias("part"))


RULE = xp.PauseRule(16, W_, H_, -2.5, 0.6, 0.6)


@query("x05_pause_stream", "samp_user", f"""{level_sql()}, {interval_sql(f'max(db) OVER (PARTITION BY {KEYS}) - 2.5', 0.6, 0.6)}
    SELECT {KEYS}, {r('s', 'start')}, {r('e', 'end')}, {r('e - s', 'duration')} FROM i3 WHERE q""")
def x05(spark, sf):
    base = shared_folder(spark, "pause-automaton")
    xp.use_state_store(spark)
    rows = timed_samples(spark, sf)
    far = rows.agg((F.max("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts")).select(
        F.lit("end of input").alias("audio_id"), F.lit("R").alias("real_or_fake"), "ts", F.lit(0).alias("n"), F.lit(1.0).alias("x"), F.lit(3).alias("part"))
    schema = rows.drop("part").schema

    def run():
        st = xs.file_stream(spark, f"{base}/in", schema)
        return xs.to_files(xp.pause_stream(st, RULE, 40 * 86400.0), f"{base}/out", f"{base}/state")

    arrivals(rows.unionByName(far), f"{base}/in", ["a", "b", "c", "d"], F.col("part"), run)
    return rounded(spark.read.parquet(f"{base}/out").drop("recording_start"))


SK = "CASE WHEN min(x) < max(x) THEN sqrt(count(*)) * sum(d*d*d) / pow(sum(d*d), 1.5) END"
KU = "CASE WHEN min(x) < max(x) THEN count(*) * sum(d*d*d*d) / pow(sum(d*d), 2) - 3 END"


@query("x04_windowed_stats_stream", sql=f"""
    WITH w AS (SELECT user_id::VARCHAR AS audio_id, value AS x, time_bucket(INTERVAL 1 day, ts) - to_days(k::INT) AS s FROM events, range(2) t(k)),
    d AS (SELECT *, x - avg(x) OVER (PARTITION BY audio_id, s) AS d FROM w)
    SELECT audio_id, s AS start, s + INTERVAL 2 day AS "end", count(*) AS n, {r('avg(x)', 'mean', 9)}, {r('stddev_pop(x)', 'std_dev')}, {r('min(x)', 'min', 9)}, {r('max(x)', 'max', 9)},
    {r(SK, 'skewness')}, {r(KU, 'kurtosis')} FROM d GROUP BY audio_id, s""")
def x04(spark, sf):
    base = shared_folder(spark, "stats-stream")
    s = samples(spark, sf)

    def run():
        st = xs.file_stream(spark, f"{base}/in", s.schema)
        return xs.to_files(xs.windowed_stats_stream(st, "2 days", "1 day"), f"{base}/out", f"{base}/state")

    arrivals(with_end(s), f"{base}/in", ["a", "b", "c", "d"], F.col("part"), run)
    out = spark.read.parquet(f"{base}/out")
    cols = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")]
    return rounded(rounded(out.select("audio_id", *cols, "n", "mean", F.sqrt("variance").alias("std_dev"), "min", "max", "skewness", "kurtosis"),
                           4, keep=("mean", "min", "max")), 9, keep=("std_dev", "skewness", "kurtosis"))
