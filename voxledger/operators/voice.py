"""Pitch, pulses, formants, jitter, shimmer and speech rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import runs, voice as vo
from ..functions.describe import peak_positions, summary_of
from ..functions.dsp import per_recording
from .frames import KEEP, LEVEL_STEP, LEVEL_WINDOW, mean_square, power_db, seconds, total

F0_LOW, F0_HIGH = 65.406391, 2093.004522  # the notes C2 and C7 in Hz
SOUND_REF = 4e-10  # (2e-5 Pa) squared
SPEECH_PITCH = (30.0, 450.0, 0.02, 0.25)  # lowest and highest pitch, step and threshold of the voicing gate


def _mean(a: Column) -> Column:
    return total(a) / F.nullif(F.size(a), F.lit(0))


def _sample_std(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: (x - _mean(a)) * (x - _mean(a)))) / F.nullif(F.size(a) - 1, F.lit(0)))


def f0_track(df: DataFrame, fmin: float = F0_LOW, fmax: float = F0_HIGH, step: float = 0.01,
             threshold: float = 0.45) -> DataFrame:
    """(frame_idx, t, f0, strength) rows; unvoiced frames have f0 = 0."""
    p = df.select(*KEEP, vo.pitch_of("samples", "sampling_rate", fmin, fmax, step, threshold).alias("p"))
    rows = p.select(*KEEP, F.posexplode(F.arrays_zip("p.t", "p.f0", "p.r")).alias("frame_idx", "z"))
    return rows.select(*KEEP, "frame_idx", F.col("z.t").alias("t"), F.col("z.f0").alias("f0"), F.col("z.r").alias("strength"))


def mean_hnr(pitch: str) -> Column:
    """Mean 10 log10(r / (1 - r)) over the voiced frames of a pitch struct column."""
    voiced = F.filter(F.arrays_zip(f"{pitch}.f0", f"{pitch}.r"), lambda z: z["f0"] > 0)
    return _mean(F.transform(voiced, lambda z: 10 * F.log10(z["r"] / (1 - z["r"]))))


def hnr_db(df: DataFrame, fmin: float = 75.0, fmax: float = 500.0, step: float = 0.01, threshold: float = 0.45) -> DataFrame:
    p = df.select(*KEEP, vo.pitch_of("samples", "sampling_rate", fmin, fmax, step, threshold).alias("p"))
    return p.select(*KEEP, mean_hnr("p").alias("hnr"))


def pitch_summary(df: DataFrame, fmin: float = 75.0, fmax: float = 500.0, step: float = 0.01, threshold: float = 0.45) -> DataFrame:
    p = df.select(*KEEP, vo.pitch_of("samples", "sampling_rate", fmin, fmax, step, threshold)["f0"].alias("_f"))
    v = p.select(*KEEP, F.filter("_f", lambda x: x > 0).alias("_v"))
    return v.select(*KEEP, _mean(F.col("_v")).alias("f0_mean"), _sample_std(F.col("_v")).alias("f0_stdev"))


def formant_means(tracks: str) -> list[Column]:
    """Mean and deviation of F1 to F3 from a formant struct column."""
    out = []
    for k in (1, 2, 3):
        present = F.filter(f"{tracks}.f{k}", lambda x: ~F.isnan(x))
        out += [_mean(present).alias(f"F{k}_mean"), _sample_std(present).alias(f"F{k}_stdev")]
    return out


def formants(df: DataFrame, **options) -> DataFrame:
    f = df.select(*KEEP, vo.formants_of("samples", "sampling_rate", **options).alias("f"))
    return f.select(*KEEP, *formant_means("f"))


def pulses(df: DataFrame, fmin: float = 75.0, fmax: float = 500.0, step: float = 0.01) -> DataFrame:
    """Glottal pulses as (i, t, period, amp) rows; the first period is null."""
    p = df.select(*KEEP, vo.pulses_of("samples", "sampling_rate", fmin, fmax, step).alias("p"))
    # the previous time comes out of the array, so no window is needed
    rows = p.select(*KEEP, "p", F.posexplode("p.t").alias("i", "t"))
    before = F.when(F.col("i") > 0, F.get("p.t", F.col("i") - 1))
    return rows.select(*KEEP, "i", "t", (F.col("t") - before).alias("period"), F.get("p.amp", F.col("i")).alias("amp"))


def formants_at_pulses(df: DataFrame, fmin: float = 75.0, fmax: float = 500.0, step: float = 0.0025, ceiling: float = 5000.0,
                       pulse_step: float = 0.01) -> DataFrame:
    """Mean and median of F1 to F4 over pulses, each read at its nearest frame."""
    both = df.select(*KEEP, vo.pulses_of("samples", "sampling_rate", fmin, fmax, pulse_step).alias("p"),
                     vo.formants_of("samples", "sampling_rate", step=step, ceiling=ceiling).alias("f"))
    t0 = F.get("f.t", F.lit(0))
    gap = F.coalesce(F.nullif(F.get("f.t", F.lit(1)) - t0, F.lit(0.0)), F.lit(step))
    near = lambda t: F.greatest(F.lit(0), F.least(F.round((t - t0) / gap).cast("int"), F.size("f.t") - 1))

    def at_pulses(k: int) -> Column:
        read = F.transform("p.t", lambda t: F.get(f"f.f{k}", near(t)))
        return F.filter(read, lambda v: v.isNotNull() & ~F.isnan(v)).alias(f"_f{k}")

    at = both.select(*KEEP, *[at_pulses(k) for k in (1, 2, 3, 4)])
    s = at.select(*KEEP, *[summary_of(f"_f{k}", ["mean", "50th_percentile"]).alias(f"s{k}") for k in (1, 2, 3, 4)])
    return s.select(*KEEP, *[c for k in (1, 2, 3, 4) for c in (
        F.col(f"s{k}.mean").alias(f"f{k}_mean"), F.col(f"s{k}.`50th_percentile`").alias(f"f{k}_median"))])


# --- perturbation of pulse tables ------------------------------------------------------

def _neighbours(df: DataFrame, keys: tuple[str, ...], lo: float, hi: float, factor: float) -> DataFrame:
    """ok: period within bounds; link: ok on both sides and no jump larger than ``factor``."""
    w = W.partitionBy(*keys).orderBy("i")
    ok = F.coalesce(F.col("period").between(lo, hi), F.lit(False))
    a = df.withColumn("ok", ok).withColumn("prev", F.lag("period").over(w)).withColumn("prev_ok", F.lag("ok").over(w))
    ratio = F.greatest("period", "prev") / F.nullif(F.least("period", "prev"), F.lit(0.0))
    return a.withColumn("link", F.coalesce(F.col("ok") & F.col("prev_ok") & (ratio <= factor), F.lit(False)))


def _spread(df: DataFrame, keys, col: str, joined: str, points: int, name: str) -> DataFrame:
    """|x_i - mean of the ``points`` values around i| where all of them are joined to each other."""
    h = points // 2
    order = W.partitionBy(*keys).orderBy("i")
    around = order.rowsBetween(-h, h)
    links = F.sum(F.col(joined).cast("int")).over(order.rowsBetween(-h + 1, h))
    full = (F.count(col).over(around) == points) & (links == points - 1)
    return df.withColumn(name, F.when(full, F.abs(F.col(col) - F.avg(col).over(around))))


def _jitter_steps(df: DataFrame, keys, lo: float, hi: float, factor: float) -> DataFrame:
    n = _neighbours(df, keys, lo, hi, factor)
    n = n.withColumn("_j1", F.when(F.col("link"), F.abs(F.col("period") - F.col("prev"))))
    for k in (3, 5):
        n = _spread(n, keys, "period", "link", k, f"_j{k}")
    return n


def _shimmer_steps(df: DataFrame, keys, lo: float, hi: float, amp_factor: float) -> DataFrame:
    before = F.lag("amp").over(W.partitionBy(*keys).orderBy("i"))
    a = df.withColumn("amp_prev", before)
    ratio = F.greatest("amp", "amp_prev") / F.nullif(F.least("amp", "amp_prev"), F.lit(0.0))
    joined = F.col("period").between(lo, hi) & (F.col("amp") > 0) & (F.col("amp_prev") > 0) & (ratio <= amp_factor)
    a = a.withColumn("amp_link", F.coalesce(joined, F.lit(False)))
    a = a.withColumn("_s1", F.when(F.col("amp_link"), F.abs(F.col("amp") - F.col("amp_prev")))).withColumn(
        "_sdb", F.when(F.col("amp_link"), F.abs(20 * F.log10(F.col("amp") / F.col("amp_prev")))))
    for k in (3, 5, 11):
        a = _spread(a, keys, "amp", "amp_link", k, f"_s{k}")
    return a


def _jitter_aggs() -> list[Column]:
    t = F.nullif(F.avg(F.when(F.col("ok"), F.col("period"))), F.lit(0.0))
    return [(F.avg("_j1") / t).alias("jitter_local"), F.avg("_j1").alias("jitter_absolute"),
            (F.avg("_j3") / t).alias("jitter_rap"), (F.avg("_j5") / t).alias("jitter_ppq5"),
            (3 * F.avg("_j3") / t).alias("jitter_ddp")]


def _shimmer_aggs() -> list[Column]:
    m = F.nullif(F.avg("amp"), F.lit(0.0))
    return [(F.avg("_s1") / m).alias("shimmer_local"), F.avg("_sdb").alias("shimmer_db"),
            (F.avg("_s3") / m).alias("shimmer_apq3"), (F.avg("_s5") / m).alias("shimmer_apq5"),
            (F.avg("_s11") / m).alias("shimmer_apq11"), (3 * F.avg("_s3") / m).alias("shimmer_dda")]


def jitter(pulse_rows: DataFrame, lo: float = 0.0001, hi: float = 0.02, factor: float = 1.3,
           keys: tuple[str, ...] = KEEP) -> DataFrame:
    """local, rap, ppq5, ddp relative to the mean period, and the absolute value in seconds."""
    return _jitter_steps(pulse_rows, keys, lo, hi, factor).groupBy(*keys).agg(*_jitter_aggs())


def shimmer(pulse_rows: DataFrame, lo: float = 0.0001, hi: float = 0.02, amp_factor: float = 1.6,
            keys: tuple[str, ...] = KEEP) -> DataFrame:
    """local, dB, apq3, apq5, apq11 and dda; neighbours must be one valid period and no amplitude jump apart."""
    return _shimmer_steps(pulse_rows, keys, lo, hi, amp_factor).groupBy(*keys).agg(*_shimmer_aggs())


def perturbation(pulse_rows: DataFrame, lo: float = 0.0001, hi: float = 0.02, factor: float = 1.3,
                 amp_factor: float = 1.6, keys: tuple[str, ...] = KEEP) -> DataFrame:
    """Jitter and shimmer over one sort of the pulses."""
    steps = _shimmer_steps(_jitter_steps(pulse_rows, keys, lo, hi, factor), keys, lo, hi, amp_factor)
    return steps.groupBy(*keys).agg(*_jitter_aggs(), *_shimmer_aggs())


# --- rates from the intensity track ------------------------------------------------------

def power_array(window: float, step: float, samples: str = "samples", rate: str = "sampling_rate") -> Column:
    """Mean square of every frame as an array; ``window`` and ``step`` in seconds."""
    n, w, s = F.size(samples), seconds(window, rate), seconds(step, rate)
    starts = F.when(n >= w, F.sequence(F.lit(0), F.floor((n - w) / s).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: mean_square(F.slice(samples, k * s + 1, w)))


def level_array(window: float, step: float, ref: float = SOUND_REF, samples: str = "samples", rate: str = "sampling_rate") -> Column:
    """dB of every frame as an array; ``window`` and ``step`` in seconds, so the rate of the recording does not matter."""
    return F.transform(power_array(window, step, samples, rate), lambda p: power_db(p, ref))


def loud_rate(levels: str, duration: Column, share: float = 0.3) -> Column:
    loud = F.filter(levels, lambda x: x > share * F.array_max(levels))
    return F.size(loud) / F.nullif(duration, F.lit(0.0))


def speaking_rate(df: DataFrame, window: float = LEVEL_WINDOW / 2, step: float = LEVEL_STEP / 2, share: float = 0.3) -> DataFrame:
    """Frames whose intensity exceeds ``share`` of the maximum, per second; ``window`` and ``step`` in seconds."""
    lv = df.select(*KEEP, (F.size("samples") / F.col("sampling_rate")).alias("_d"), level_array(window, step).alias("_l"))
    return lv.select(*KEEP, loud_rate("_l", F.col("_d"), share).alias("speaking_rate"))


def _quantile(sorted_array: Column, q: float) -> Column:
    h = (F.size(sorted_array) - 1) * q
    lo = F.floor(h).cast("int")
    a, b = F.get(sorted_array, lo), F.get(sorted_array, F.ceil(h).cast("int"))
    return a + (h - lo) * (b - a)


SPEECH = ["voicedcount", "npause", "originaldur", "intensity_duration", "speakingrate", "articulationrate", "asd", "totalpauseduration"]


def with_speech(df: DataFrame, levels: str, pitch: str | None, window: float, step: float, silence_db: float = -25.0,
                min_dip: float = 2.0, min_pause: float = 0.3, min_sounding: float = 0.1, samples: str = "samples",
                rate: str = "sampling_rate") -> DataFrame:
    """``df`` with the columns SPEECH from an array of levels and a struct of pitch arrays; no row leaves its recording.

    All are null where there is no level.
    """
    sr, n, wide, hop = F.col(rate), F.size(samples), seconds(window, rate), seconds(step, rate)
    lv = df.withColumn("_sorted", F.sort_array(levels))
    lv = lv.withColumn("_cut", _quantile(F.col("_sorted"), 0.99) + silence_db)
    lv = lv.withColumn("_thr", F.greatest(F.col("_cut"), F.array_min(levels)))
    # peaks: above both neighbours (a plateau counts at its midpoint) and above the threshold
    lv = lv.withColumns({"_pk": per_recording("array<int>", lambda x: peak_positions(x).astype("int32"), levels),
                         "_iv": runs.silent_of(levels, F.col("_cut"), hop, n, rate, min_pause, min_sounding, silent=False)})
    lv = lv.withColumn("_pk", F.filter("_pk", lambda i: F.get(levels, i) > F.col("_thr")))
    dips = F.zip_with(
        F.slice("_pk", F.lit(1), F.greatest(F.size("_pk") - 1, F.lit(0))),
        F.slice("_pk", F.lit(2), F.greatest(F.size("_pk") - 1, F.lit(0))),
        lambda p, q: F.struct(p.alias("p"), (F.get(levels, p) - F.array_min(F.slice(levels, p + 1, q - p + 1)) > min_dip).alias("ok")))
    lv = lv.withColumn("_ok", F.transform(F.filter(dips, lambda d: d["ok"]), lambda d: d["p"] * hop / sr))
    if pitch:
        gap = F.get(f"{pitch}.t", F.lit(1)) - F.get(f"{pitch}.t", F.lit(0))
        near = lambda t: F.round((t + wide / 2 / sr - F.get(f"{pitch}.t", F.lit(0))) / gap).cast("int")
        inside = lambda t: F.greatest(F.lit(0), F.least(near(t), F.size(f"{pitch}.t") - 1))
        lv = lv.withColumn("_ok", F.filter("_ok", lambda t: F.coalesce(
            F.when(F.size(f"{pitch}.t") > 1, F.get(f"{pitch}.f0", inside(t)) > 0), F.lit(False))))
    spans = F.arrays_zip("_iv.start", "_iv.end")
    lv = lv.withColumn("_speak", F.aggregate(spans, F.lit(0.0), lambda s, v: s + v["end"] - v["start"]))
    inner = F.size(F.filter("_ok", lambda t: F.exists(spans, lambda v: (t >= v["start"]) & (t < v["end"])))).cast("double")
    v, speak, dur = F.col("voicedcount"), F.col("_speak"), F.col("originaldur")
    lv = lv.withColumns({"voicedcount": inner, "npause": (F.size("_iv.start") - 1).cast("double"), "originaldur": n / sr,
                         "intensity_duration": F.size(levels) * hop / sr})
    lv = lv.withColumns({"speakingrate": v / F.nullif(dur, F.lit(0.0)), "articulationrate": v / F.nullif(speak, F.lit(0.0)),
                         "asd": speak / F.nullif(v, F.lit(0.0)), "totalpauseduration": dur - speak})
    some = F.size(levels) > 0
    return lv.select(*df.columns, *[F.when(some, F.col(c)).alias(c) for c in SPEECH])


def speech_rate(df: DataFrame, window: float = LEVEL_WINDOW, step: float = LEVEL_STEP, *, silence_db: float = -25.0, min_dip: float = 2.0,
                min_pause: float = 0.3, min_sounding: float = 0.1, voicing: bool = True) -> DataFrame:
    """Syllable nuclei (de Jong & Wempe 2009): voiced intensity peaks, pauses and the rates from them.

    A peak counts when it exceeds the threshold, the level dips by more than
    ``min_dip`` before the next such peak, it lies in a sounding interval and,
    with ``voicing``, the pitch track is voiced there. ``window`` and ``step``
    are in seconds.
    """
    cols = [*KEEP, "sampling_rate", "samples", level_array(window, step).alias("_l")]
    if voicing:
        cols.append(vo.pitch_of("samples", "sampling_rate", *SPEECH_PITCH).alias("_p"))
    # the filter is on the samples: one on the levels would compute them twice
    lv = df.where(F.size("samples") >= seconds(window)).select(*cols)
    out = with_speech(lv, "_l", "_p" if voicing else None, window, step, silence_db, min_dip, min_pause, min_sounding)
    return out.select(*KEEP, *SPEECH)
