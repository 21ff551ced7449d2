"""Checks of single recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import dsp
from .frames import KEEP, level_frames, merge_runs


def dominant_frequency(df: DataFrame, min_sr_ratio: float = 2.0) -> DataFrame:
    """Strongest frequency, and whether the rate is at least ``min_sr_ratio`` times that."""
    f = df.select(*KEEP, "sampling_rate", dsp.dominant_of("samples", "sampling_rate").alias("dominant_hz"))
    return f.select(*KEEP, "dominant_hz",
                    (F.col("sampling_rate") >= min_sr_ratio * F.col("dominant_hz")).alias("compliant"))


def clipping(df: DataFrame, threshold: float = 0.98) -> DataFrame:
    return df.select(*KEEP, F.exists("samples", lambda x: F.abs(x) >= threshold).alias("clipped"))


def long_silence(df: DataFrame, top_db: float = 20.0, min_s: float = 0.5, window: int = 2048, step: int = 512) -> DataFrame:
    """Longest silent gap per recording and whether it reaches ``min_s``; none counts as 0."""
    lv = level_frames(df, window, step, short=True)  # a recording shorter than a frame has one row without level
    loud = F.max("db").over(W.partitionBy(*KEEP))
    runs = merge_runs(lv.withColumn("silent", F.coalesce(F.col("db") <= loud - top_db, F.lit(False))), "silent", "frame_idx")
    longest = F.coalesce(F.max(F.when(F.col("silent"), F.col("end") - F.col("start"))), F.lit(0.0))
    return runs.groupBy(*KEEP).agg(longest.alias("longest")).select(
        *KEEP, "longest", (F.col("longest") >= min_s).alias("has_long_silence"))


def snr_db(df: DataFrame, n_fft: int = 2048, hop: int | None = None) -> DataFrame:
    """10 log10(mean |S|^2 / var |S|) over all frames and bins."""
    return df.select(*KEEP, dsp.snr_of("samples", n_fft, hop or max(n_fft // 4, 1)).alias("snr_db"))


def artifact_counts(df: DataFrame, clip: float = 0.99, top_db: float = 20.0, height: float = 0.6,
                    window: int = 2048, step: int = 512) -> DataFrame:
    """Clipped samples, non-silent intervals and high peaks."""
    direct = df.select(*KEEP, F.size(F.filter("samples", lambda x: F.abs(x) > clip)).cast("bigint").alias("clipping"),
                       dsp.peaks_of("samples", height)["n_peaks"].alias("compression"))
    lv = level_frames(df, window, step)
    loud = F.max("db").over(W.partitionBy(*KEEP))
    runs = merge_runs(lv.withColumn("silent", F.col("db") <= loud - top_db), "silent", "frame_idx")
    voiced = runs.groupBy(*KEEP).agg(F.count_if(~F.col("silent")).alias("reverberation"))
    return direct.join(voiced, list(KEEP), "left").select(
        *KEEP, "clipping", F.coalesce("reverberation", F.lit(0)).alias("reverberation"), "compression")


def audio_properties(df: DataFrame) -> DataFrame:
    return df.select(*KEEP, "sampling_rate", (F.size("samples") / F.col("sampling_rate")).alias("duration"))
