"""Time-domain operators on ``samples`` arrays.

Everything that stays inside one recording is an array expression or an Arrow
UDF, so there is no shuffle. Only runs of frames (silences, pauses) go through
windows, on one row per frame and partitioned by recording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import dsp

KEEP = ("audio_id", "real_or_fake")
ZERO = 1e-10  # a sample this small has no sign
POWER_FLOOR = 1e-10


# --- array expressions -------------------------------------------------------------

def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean_square(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x) / F.nullif(F.size(a), F.lit(0))


def rms(a: Column) -> Column:
    return F.sqrt(mean_square(a))


def crossings(a: Column) -> Column:
    """Number of sign changes between neighbours."""
    n = F.size(a)
    change = F.zip_with(F.slice(a, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(a, F.lit(2), F.greatest(n - 1, F.lit(0))),
                        lambda x, y: ((x < -ZERO) != (y < -ZERO)).cast("bigint"))
    return F.when(n < 2, F.lit(0).cast("bigint")).otherwise(
        F.aggregate(change, F.lit(0).cast("bigint"), lambda s, x: s + x))


def peak_abs(a: Column) -> Column:
    return F.array_max(F.transform(a, lambda x: F.abs(x)))


def power_db(ms: Column, ref: float = 1.0) -> Column:
    return 10 * F.log10(F.greatest(ms, F.lit(POWER_FLOOR)) / ref)


# --- frames ------------------------------------------------------------------------

def frames(df: DataFrame, window: int | Column, step: int | Column, *, col: str = "samples",
           keep: tuple[str, ...] = KEEP, ragged: bool = False, short: bool = False) -> DataFrame:
    """floor((n - w) / s) + 1 windows per recording, no padding; none when n < w.

    ``ragged`` starts a window at every step and keeps the short ones at the end.
    ``short`` keeps a recording without any window as one row with nulls.
    """
    w = F.lit(window) if isinstance(window, int) else window
    s = F.lit(step) if isinstance(step, int) else step
    room = F.size(col) - (F.lit(1) if ragged else w)
    starts = F.when(room >= 0, F.sequence(F.lit(0), F.floor(room / s).cast("int")))
    rows = df if short else df.where(room >= 0)
    cut = rows.select(*keep, F.col(col).alias("_x"), w.alias("_w"), s.alias("_s"),
                      (F.explode_outer(starts) if short else F.explode(starts)).alias("frame_idx"))
    return cut.select(*keep, "frame_idx", F.slice("_x", F.col("frame_idx") * F.col("_s") + 1, F.col("_w")).alias("frame"))


#: Seconds of the intensity track: one value each step, over a window that holds some periods of the lowest pitch.
LEVEL_WINDOW, LEVEL_STEP = 0.064, 0.016


def seconds(span: float, rate: str = "sampling_rate") -> Column:
    """Samples of a span in seconds at the recording's own rate, one at least."""
    return F.greatest(F.round(F.lit(float(span)) * F.col(rate)).cast("int"), F.lit(1))


def frame_measure(df: DataFrame, name: str, measure, window: int, step: int, *, ragged: bool = False,
                  keep: tuple[str, ...] = KEEP) -> DataFrame:
    f = frames(df, window, step, keep=keep, ragged=ragged)
    return f.select(*keep, "frame_idx", measure(F.col("frame")).alias(name))


def rms_energy(df: DataFrame, window: int = 2048, step: int = 512) -> DataFrame:
    return frame_measure(df, "rms", rms, window, step)


def zero_crossing_rate(df: DataFrame, window: int = 2048, step: int = 512) -> DataFrame:
    return frame_measure(df, "zcr", lambda a: crossings(a) / F.size(a), window, step)


def zero_crossings(df: DataFrame) -> DataFrame:
    return df.select(*KEEP, crossings(F.col("samples")).alias("zero_crossings"))


def crest_factor(df: DataFrame, window: int = 2048, step: int = 512) -> DataFrame:
    """max(x) / rms of full frames."""
    return frame_measure(df, "crest", lambda a: F.array_max(a) / F.nullif(rms(a), F.lit(0.0)), window, step)


def crest_factor_abs(df: DataFrame, window: int = 1024, step: int = 512) -> DataFrame:
    """max|x| / rms, short frames at the end kept."""
    return frame_measure(df, "crest", lambda a: peak_abs(a) / F.nullif(rms(a), F.lit(0.0)), window, step, ragged=True)


def peaks(df: DataFrame, height: float | None = None) -> DataFrame:
    """Count and mean height of strict local maxima."""
    return df.select(*KEEP, dsp.peaks_of("samples", height).alias("p")).select(*KEEP, "p.*")


def rolling(df: DataFrame, window: int = 3) -> DataFrame:
    """Means of the rolling mean and of the rolling sample deviation."""
    n = F.size("samples")
    starts = F.when(n >= window, F.sequence(F.lit(1), n - window + 1))

    def spread(a: Column) -> Column:
        m = total(a) / window
        return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / (window - 1))

    cut = lambda i: F.slice("samples", i, F.lit(window))
    return df.select(
        *KEEP, (total(F.transform(starts, lambda i: total(cut(i)) / window)) / F.size(starts)).alias("rolling_mean"),
        (total(F.transform(starts, lambda i: spread(cut(i)))) / F.size(starts)).alias("rolling_std"))


def autocorr(df: DataFrame, lag: int = 1) -> DataFrame:
    """Pearson r of the signal with itself ``lag`` samples later."""
    n = F.size("samples") - lag
    a, b = F.slice("samples", F.lit(1), n), F.slice("samples", F.lit(lag + 1), n)
    paired = df.where(n >= 2).select(*KEEP, a.alias("a"), b.alias("b")).select(
        *KEEP, "a", "b", (total(F.col("a")) / F.size("a")).alias("ma"), (total(F.col("b")) / F.size("b")).alias("mb"))
    da, db = F.transform("a", lambda x: x - F.col("ma")), F.transform("b", lambda x: x - F.col("mb"))
    cross = total(F.zip_with(da, db, lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(da, lambda x: x * x)) * total(F.transform(db, lambda x: x * x)))
    return paired.select(*KEEP, (cross / F.nullif(norm, F.lit(0.0))).alias("autocorr"))


def value_entropy(df: DataFrame) -> DataFrame:
    """Shannon entropy (nats) of the value counts."""
    return df.select(*KEEP, dsp.entropy_of("samples").alias("entropy"))


def peak_normalize(df: DataFrame) -> DataFrame:
    """x / max|x|; a silent recording stays as it is."""
    top = df.withColumn("_top", F.coalesce(F.nullif(peak_abs(F.col("samples")), F.lit(0.0)), F.lit(1.0)))
    return top.select(*[F.transform("samples", lambda x: x / F.col("_top")).alias("samples") if c == "samples" else F.col(c)
                        for c in df.columns])


def time_axis(df: DataFrame) -> DataFrame:
    """One (t, x) row per sample."""
    return (df.select(*KEEP, "sampling_rate", F.posexplode("samples").alias("n", "x"))
            .select(*KEEP, (F.col("n") / F.col("sampling_rate")).alias("t"), "x"))


def resample(df: DataFrame, target_sr: int = 16000) -> DataFrame:
    """Windowed-sinc interpolation to a common rate; recordings at that rate pass unchanged."""
    new = F.when(F.col("sampling_rate") == target_sr, F.col("samples")).otherwise(
        dsp.resample_of(F.when(F.col("sampling_rate") != target_sr, F.col("samples")), "sampling_rate", target_sr))
    return df.select(*[new.alias(c) if c == "samples" else F.lit(target_sr).alias(c) if c == "sampling_rate" else F.col(c)
                       for c in df.columns])


# --- runs of quiet frames ------------------------------------------------------------

def level_frames(df: DataFrame, window: int | Column, step: int | Column, ref: float = 1.0, short: bool = False) -> DataFrame:
    """(recording, frame_idx, start, end, db): frame i stands for samples [i step, (i + 1) step), the last one for the rest."""
    sized = df.withColumn("_n", F.size("samples")).withColumn("_sr", F.col("sampling_rate"))
    sized = sized.withColumn("_wide", F.lit(window) if isinstance(window, int) else window)
    sized = sized.withColumn("_hop", F.lit(step) if isinstance(step, int) else step)
    f = frames(sized, F.col("_wide"), F.col("_hop"), keep=(*KEEP, "_n", "_sr", "_wide", "_hop"), short=short)
    last = F.floor((F.col("_n") - F.col("_wide")) / F.col("_hop"))
    end = F.when(F.col("frame_idx") == last, F.col("_n")).otherwise((F.col("frame_idx") + 1) * F.col("_hop"))
    return f.select(*KEEP, "frame_idx", (F.col("frame_idx") * F.col("_hop") / F.col("_sr")).alias("start"),
                    (end / F.col("_sr")).alias("end"), (F.col("_n") / F.col("_sr")).alias("duration_total"),
                    power_db(mean_square(F.col("frame")), ref).alias("db"))


def merge_runs(df: DataFrame, flag: str, order: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Neighbouring rows with an equal flag become one interval. One recording's frames per group."""
    w = W.partitionBy(*KEEP).orderBy(order)
    new = F.coalesce((F.col(flag) != F.lag(flag).over(w)).cast("int"), F.lit(0))
    marked = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return marked.groupBy(*KEEP, "_run").agg(
        F.first(flag).alias(flag), F.min("start").alias("start"), F.max("end").alias("end"),
        *[F.first(c).alias(c) for c in carry]).drop("_run")


def silences(df: DataFrame, top_db: float = 30.0, window: int = 2048, step: int = 512) -> DataFrame:
    """Intervals at least ``top_db`` below the loudest frame, a silent end included."""
    lv = level_frames(df, window, step)
    loud = F.max("db").over(W.partitionBy(*KEEP))
    runs = merge_runs(lv.withColumn("silent", F.col("db") <= loud - top_db), "silent", "frame_idx")
    return runs.where("silent").select(*KEEP, "start", "end", (F.col("end") - F.col("start")).alias("duration"))


def sounding_intervals(levels: DataFrame, threshold: Column, min_silent: float, min_sounding: float,
                       carry: tuple[str, ...] = ()) -> DataFrame:
    """Silent and sounding intervals; short silent ones are absorbed first, then short sounding ones."""
    runs = merge_runs(levels.withColumn("silent", F.col("db") < threshold), "silent", "frame_idx", carry)
    long_enough = lambda t: F.round(F.col("end") - F.col("start"), 9) >= t
    runs = merge_runs(runs.withColumn("silent", F.col("silent") & long_enough(min_silent)), "silent", "start", carry)
    runs = runs.withColumn("silent", F.col("silent") | ~long_enough(min_sounding))
    return merge_runs(runs, "silent", "start", carry)


def intensity_pauses(df: DataFrame, floor_db: float = -25.0, min_silent: float = 0.1, min_sounding: float = 0.1,
                     window: float = LEVEL_WINDOW, step: float = LEVEL_STEP) -> DataFrame:
    """Pauses more than ``-floor_db`` below the loudest frame, after merging of short runs; ``window`` and ``step`` in seconds."""
    lv = level_frames(df, seconds(window), seconds(step)).withColumn("_top", F.max("db").over(W.partitionBy(*KEEP)))
    iv = sounding_intervals(lv, F.col("_top") + floor_db, min_silent, min_sounding)
    return iv.where("silent").select(*KEEP, "start", "end", (F.col("end") - F.col("start")).alias("duration"))
