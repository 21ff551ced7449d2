"""One wide row of summary features per recording."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dsp, runs, voice as fv
from ..functions.describe import MEASURES, summaries_of, summary_of
from . import voice as vo
from .scale import spread_small
from .frames import KEEP, LEVEL_STEP, LEVEL_WINDOW, crossings, power_db, resample, rms, seconds

# Feature names by group.
GROUPS = {
    "spectral": ["spectral_centroid", "spectral_bandwidth", "spectral_contrast", "spectral_flatness",
                 "spectral_rolloff", "zero_crossing_rate", "mfccs", "chroma_stft", "spectral_flux"],
    "prosodic": ["f0", "energy", "speaking_rate", "pauses", "formants"],
    "voice_quality": ["jitter", "shimmer", "hnr", "speech_rate"],
}
TRACKS = ["spectral_centroid", "spectral_bandwidth", "spectral_contrast", "spectral_flatness", "spectral_rolloff", "spectral_flux"]
ORDER = ["spectral_centroid", "spectral_bandwidth", "spectral_contrast", "spectral_flatness", "spectral_rolloff",
         "zero_crossing_rate", "spectral_flux", "f0", "energy"]
PERTURBATION = {"jitter": ["jitter_local", "jitter_rap", "jitter_ppq5"],
                "shimmer": ["shimmer_local", "shimmer_apq3", "shimmer_apq5", "shimmer_dda"]}
FORMANTS = [f"F{k}_{m}" for k in (1, 2, 3) for m in ("mean", "stdev")]
N_MFCC, N_CHROMA = 13, 12


@dataclass(frozen=True)
class Options:
    n_fft: int = 2048
    hop: int = 512
    target_sr: int | None = 16000
    n_mels: int = 128
    contrast_fmin: float = 200.0
    contrast_bands: int = 6
    f0_low: float = vo.F0_LOW
    f0_high: float = vo.F0_HIGH
    pitch_low: float = 75.0
    pitch_high: float = 500.0
    pitch_step: float = 0.01
    level_window: float = LEVEL_WINDOW
    level_step: float = LEVEL_STEP
    rate_window: float = LEVEL_WINDOW / 2
    rate_step: float = LEVEL_STEP / 2
    pause_db: float = -25.0
    min_silent: float = 0.1
    min_sounding: float = 0.1
    formant_ceiling: float = 5500.0
    formant_count: int = 5
    formant_window: float = 0.025
    formant_step: float = 0.025


def _frames(measure, n: int, hop: int) -> Column:
    size = F.size("samples")
    starts = F.when(size >= n, F.sequence(F.lit(0), F.floor((size - n) / hop).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: measure(F.slice("samples", k * hop + 1, F.lit(n))))


def feature_row(df: DataFrame, include: list[str] | None = None, opts: Options = Options(),
                measures: list[str] | None = None) -> DataFrame:
    """Summary features of the named groups or single features (all when None).

    Spectral features, pitch and energy read the resampled recording; rates,
    pauses, formants and voice quality read it at its own rate, with windows
    in seconds. Everything is worked out on the recording's own row, in one
    scan without a join: tracks first, then runs of frames and pulses, then
    summaries. One spectrum serves all spectral features, one pitch track
    harmonicity, jitter and shimmer, one level track pauses and speech rate.
    """
    want = {f for g in (include or list(GROUPS)) for f in GROUPS.get(g, [g])}
    names = measures or MEASURES
    known = {f for fs in GROUPS.values() for f in fs}
    if want - known:
        raise ValueError(f"unknown features: {', '.join(sorted(want - known))}")
    df = spread_small(df.select(*KEEP, "samples", "sampling_rate"))
    own = df.withColumn("_own", F.col("samples")).withColumn("_own_sr", F.col("sampling_rate"))
    src = resample(own, opts.target_sr) if opts.target_sr else own

    # tracks of the resampled recording
    at: dict[str, Column] = {}
    arrays: dict[str, str] = {}
    track_names = [t for t in TRACKS if t in want]
    matrices = [m for f, m in (("mfccs", "mfcc"), ("chroma_stft", "chroma")) if f in want]
    if track_names or matrices:
        at["_t"] = dsp.spectral_of("samples", "sampling_rate", track_names, matrices, opts.n_fft, opts.hop, {
            "spectral_contrast": {"fmin": opts.contrast_fmin, "bands": opts.contrast_bands}, "mfcc": {"n": N_MFCC, "n_mels": opts.n_mels}})
        arrays |= {t: f"_t.{t}" for t in track_names}
    if "zero_crossing_rate" in want:
        at["_z"], arrays["zero_crossing_rate"] = _frames(lambda a: crossings(a) / F.size(a), opts.n_fft, opts.hop), "_z"
    if "f0" in want:
        at["_f0"], arrays["f0"] = fv.pitch_of("samples", "sampling_rate", opts.f0_low, opts.f0_high, opts.pitch_step, 0.45), "_f0.f0"
    if "energy" in want:
        at["_e"], arrays["energy"] = _frames(rms, opts.n_fft, opts.hop), "_e"
    # tracks of the recording at its own rate
    if "speaking_rate" in want:
        at["_l"] = vo.level_array(opts.rate_window, opts.rate_step, samples="_own", rate="_own_sr")
    if "formants" in want:
        at["_fm"] = fv.formants_of("_own", "_own_sr", step=opts.formant_step, count=opts.formant_count,
                                   ceiling=opts.formant_ceiling, window=opts.formant_window)
    if want & {"hnr", "jitter", "shimmer"}:
        at["_v"] = fv.voiced_of("_own", "_own_sr", opts.pitch_low, opts.pitch_high, opts.pitch_step)
    if want & {"pauses", "speech_rate"}:
        at["_pw"] = vo.power_array(opts.level_window, opts.level_step, "_own", "_own_sr")
    if "speech_rate" in want:
        at["_sp"] = fv.pitch_of("_own", "_own_sr", *vo.SPEECH_PITCH)
    rows = src.withColumns(at)

    # runs of frames and pulses
    if "pauses" in want:
        rows = rows.withColumn("_db", F.transform("_pw", lambda p: power_db(p)))
        quiet = runs.silent_of("_db", F.array_max("_db") + opts.pause_db, seconds(opts.level_step, "_own_sr"), F.size("_own"), "_own_sr",
                               opts.min_silent, opts.min_sounding)
        rows = rows.withColumn("_q", quiet)
        rows = rows.withColumn("_pause", F.zip_with("_q.end", "_q.start", lambda e, s: e - s))
    if want & {"jitter", "shimmer"}:
        rows = rows.withColumn("_pt", runs.perturbation_of("_v.pulse", "_v.amp", 0.0001, max(0.02, 2.0 / opts.pitch_low)))
    if "speech_rate" in want:
        rows = rows.withColumn("_sl", F.transform("_pw", lambda p: power_db(p, vo.SOUND_REF)))
        rows = vo.with_speech(rows, "_sl", "_sp", opts.level_window, opts.level_step, samples="_own", rate="_own_sr")

    # summaries as structs whose fields carry the final names
    out: dict[str, Column] = {}
    stars: list[str] = []
    for n in ORDER:
        if n in arrays:
            out[f"_s_{n}"] = summary_of(arrays[n], names, f"{n}_")
            stars.append(f"_s_{n}.*")
    for flag, name, n in (("mfccs", "mfcc", N_MFCC), ("chroma_stft", "chroma", N_CHROMA)):
        if flag in want:
            out[f"_s_{name}"] = summaries_of(f"_t.{name}", n, names, name)
            stars.append(f"_s_{name}.*")
    if "speaking_rate" in want:
        out["speaking_rate"] = vo.loud_rate("_l", F.size("_own") / F.col("_own_sr"))
        stars.append("speaking_rate")
    if "formants" in want:
        out |= dict(zip(FORMANTS, vo.formant_means("_fm")))
        stars += FORMANTS
    if "hnr" in want:
        out["hnr"] = vo.mean_hnr("_v")
        stars.append("hnr")
    if "pauses" in want:
        out["_s_pause"] = summary_of("_pause", names, "pause_")
        stars.append("_s_pause.*")
    stars += [f"_pt.{c}" for f, cs in PERTURBATION.items() if f in want for c in cs]
    stars += [c for c in vo.SPEECH if c != "originaldur" and "speech_rate" in want]
    return rows.withColumns(out).select(*KEEP, *stars)
