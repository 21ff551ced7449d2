"""Structured Streaming forms of scoring, drift, pauses and windowed statistics.

Each job reads a folder of arriving files and runs to the end of what is there
(``availableNow``) or as long as it is kept; progress lives in the checkpoint
folder, so a restarted job continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.drift import Profile, ks_against_profile
from ..sources.recordings import batch_number


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return reader.option("recursiveFileLookup", "true").load(path)


def to_files(stream: DataFrame, out: str, checkpoint: str, now: bool = True) -> StreamingQuery:
    """Append rows to Parquet files; the sink's own log makes each micro-batch count once."""
    w = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(availableNow=True).start() if now else w.start()


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score every arriving row; the batch number comes from the file name."""
    named = stream.withColumn("_file", F.col("_metadata.file_path"))
    return scorer(named.withColumn("batch", batch_number(F.col("_file"))).drop("_file"))


def drift_stream(stream_long: DataFrame, profile: Profile, out: str, checkpoint: str, p_limit: float = 0.03,
                 now: bool = True) -> StreamingQuery:
    """KS report of each micro-batch of (feature, value) rows against the stored training profile.

    A micro-batch looks its own values up in the profile's blocks; the training
    table is neither counted nor shuffled again. A repeated micro-batch
    overwrites its own folder, so a restart adds nothing twice.
    """

    def report(batch: DataFrame, batch_id: int) -> None:
        (ks_against_profile(batch, profile, p_limit).withColumn("batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{out}/report-{batch_id:08d}"))

    w = stream_long.writeStream.foreachBatch(report).option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True).start() if now else w.start()


def windowed_stats_stream(samples: DataFrame, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(ts, audio_id, x) -> statistics of tumbling or sliding windows; rows later than ``late`` are dropped."""
    win = F.window("ts", size, slide) if slide else F.window("ts", size)
    watermarked = samples.withWatermark("ts", late) if samples.isStreaming else samples
    g = watermarked.groupBy("audio_id", win.alias("w")).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("variance"), F.min("x").alias("min"),
        F.max("x").alias("max"), F.skewness("x").alias("_s"), F.kurtosis("x").alias("_k"))
    varied = F.col("min") < F.col("max")
    return g.select("audio_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "mean", "variance", "min", "max",
                    F.when(varied, F.col("_s")).alias("skewness"), F.when(varied, F.col("_k")).alias("kurtosis"))


def pause_sessions_stream(samples: DataFrame, frame: str, floor: float, gap: str, late: str = "10 minutes") -> DataFrame:
    """Runs of quiet frames: frames are time windows whose mean square stays below ``floor``.

    The frame step reduces a busy recording to one row per frame before the
    session step keeps state per recording.
    """
    watermarked = samples.withWatermark("ts", late) if samples.isStreaming else samples
    frames = watermarked.groupBy("audio_id", F.window("ts", frame).alias("w")).agg(F.avg(F.col("x") * F.col("x")).alias("power"))
    # window_time lies just before the end of the frame and keeps the watermark
    quiet = frames.where(F.col("power") < floor).select("audio_id", F.window_time("w").alias("ts"), "power")
    s = quiet.groupBy("audio_id", F.session_window("ts", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("n_frames"), F.max("power").alias("max_power"))
    return s.select("audio_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n_frames", "max_power")
