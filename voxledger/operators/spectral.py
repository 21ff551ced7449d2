"""Spectral operators. ``n_fft`` and ``hop`` default to 2048 and 512, Hann window, no padding.

A recording's spectrum is computed inside one Arrow task row and only the
track or matrix asked for comes back, so nothing here shuffles except the
overlay of two recordings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import describe, dsp
from .frames import KEEP

N_FFT, HOP = 2048, 512


def _positions(array: Column, kind: str = "array<double>") -> Column:
    """posexplode of an array that a UDF made.

    On a bare column Spark adds a not-empty filter and moves it below the
    projection, which would run the UDF a second time; an expression is left alone.
    """
    return F.posexplode(F.coalesce(array, F.array().cast(kind)))


def amplitude_spectrum(df: DataFrame) -> DataFrame:
    """spectrum ARRAY<STRUCT<hz, ampl>>; the axis runs evenly from 0 to sr / 2."""
    a = df.select(*KEEP, "sampling_rate", F.size("samples").alias("n"), dsp.amplitude_of("samples").alias("_a"))
    bins = F.size("_a")
    hz = lambda i: i * (F.col("sampling_rate") / 2) / F.greatest(bins - 1, F.lit(1))
    return a.select(*KEEP, "n", F.transform("_a", lambda x, i: F.struct(hz(i).alias("hz"), x.alias("ampl"))).alias("spectrum"))


def spectrum(df: DataFrame, kind: str = "amplitude") -> DataFrame:
    """Long (bin, hz, value) rows of one kind: amplitude, decibel, energy or power."""
    a = F.col("s.ampl")
    kinds = {"amplitude": a, "decibel": 20 * F.log10(F.nullif(a, F.lit(0.0))), "energy": a * a, "power": a * a / F.col("n")}
    if kind not in kinds:
        raise ValueError(f"unknown spectrum kind {kind!r}")
    long = amplitude_spectrum(df).select(*KEEP, "n", _positions(F.col("spectrum"), "array<struct<hz:double,ampl:double>>").alias("bin", "s"))
    return long.select(*KEEP, "bin", F.col("s.hz").alias("hz"), kinds[kind].alias("value"))


def _matrix_rows(df: DataFrame, matrix, index: str, value: str) -> DataFrame:
    rows = df.select(*KEEP, F.posexplode(matrix).alias("frame_idx", "_row"))
    return rows.select(*KEEP, "frame_idx", _positions(F.col("_row")).alias(index, value))


def spectrogram_db(df: DataFrame, n_fft: int = N_FFT, hop: int = HOP, top_db: float = 80.0) -> DataFrame:
    """Long (frame, bin, db) rows, dB against the recording's largest magnitude, cut ``top_db`` below."""
    m = df.select(*KEEP, dsp.magnitudes_of("samples", n_fft, hop).alias("_m"))
    top = F.greatest(F.array_max(F.transform("_m", lambda row: F.array_max(row))), F.lit(1e-5))
    return _matrix_rows(m.withColumn("_t", top), F.transform("_m", lambda row: F.transform(row, lambda a: F.greatest(
        20 * F.log10(F.greatest(a, F.lit(1e-5)) / F.col("_t")), F.lit(-top_db)))), "bin", "db")


def mel_spectrogram_db(df: DataFrame, n_mels: int = 128, n_fft: int = N_FFT, hop: int = HOP) -> DataFrame:
    return _matrix_rows(df, dsp.matrix_of("samples", "sampling_rate", "mel_db", n_fft, hop, n_mels=n_mels), "mel", "db")


def tracks(df: DataFrame, names: list[str], n_fft: int = N_FFT, hop: int = HOP, keep: tuple[str, ...] = KEEP,
           **options: dict) -> DataFrame:
    """One array column per named track; only those named are computed."""
    t = df.select(*keep, dsp.tracks_of("samples", "sampling_rate", names, n_fft, hop, options).alias("_t"))
    return t.select(*keep, "_t.*")


def track(df: DataFrame, name: str, n_fft: int = N_FFT, hop: int = HOP, **options) -> DataFrame:
    """One track as (frame_idx, value) rows."""
    return tracks(df, [name], n_fft, hop, **{name: options}).select(*KEEP, _positions(F.col(name)).alias("frame_idx", "value"))


def spectral_centroid(df, n_fft=N_FFT, hop=HOP, *, bins: bool = False) -> DataFrame:
    """In Hz, or as weighted bin index with ``bins``."""
    return track(df, "centroid_bin" if bins else "spectral_centroid", n_fft, hop)


def bin_to_freq(bin_col, n_bins: int, sr_col) -> Column:
    return bin_col * (sr_col / 2 / n_bins)


def spectral_bandwidth(df, n_fft=N_FFT, hop=HOP) -> DataFrame:
    return track(df, "spectral_bandwidth", n_fft, hop)


def spectral_contrast(df, n_fft=N_FFT, hop=HOP, fmin: float = 200.0, bands: int = 6) -> DataFrame:
    return track(df, "spectral_contrast", n_fft, hop, fmin=fmin, bands=bands)


def spectral_flatness(df, n_fft=N_FFT, hop=HOP) -> DataFrame:
    return track(df, "spectral_flatness", n_fft, hop)


def spectral_rolloff(df, pct: float = 0.85, n_fft=N_FFT, hop=HOP) -> DataFrame:
    return track(df, "spectral_rolloff", n_fft, hop, pct=pct)


def spectral_flux(df, n_fft=N_FFT, hop=HOP) -> DataFrame:
    """Row i compares frames i and i + 1."""
    return track(df, "spectral_flux", n_fft, hop)


def band_energy_ratio(df, split_hz: float = 2048.0, n_fft: int = 1024, hop: int = 512) -> DataFrame:
    return track(df, "band_energy_ratio", n_fft, hop, split_hz=split_hz)


def coefficients(df: DataFrame, name: str, n_fft: int = N_FFT, hop: int = HOP, **options) -> DataFrame:
    """(frame_idx, coef, value) rows of mfcc, chroma or tonnetz, coefficients counted from 1."""
    rows = _matrix_rows(df, dsp.matrix_of("samples", "sampling_rate", name, n_fft, hop, **options), "_c", "value")
    return rows.select(*KEEP, "frame_idx", (F.col("_c") + 1).alias("coef"), "value")


def mfcc(df, n: int = 13, n_mels: int = 128, n_fft=N_FFT, hop=HOP) -> DataFrame:
    return coefficients(df, "mfcc", n_fft, hop, n=n, n_mels=n_mels)


def chroma(df, n_fft=N_FFT, hop=HOP) -> DataFrame:
    return coefficients(df, "chroma", n_fft, hop)


def tonnetz(df, n_fft=N_FFT, hop=HOP) -> DataFrame:
    return coefficients(df, "tonnetz", n_fft, hop)


def welch_psd(df: DataFrame, segment: int = 256) -> DataFrame:
    """(bin, hz, psd) rows."""
    p = df.select(*KEEP, "sampling_rate", F.least(F.lit(segment), F.size("samples")).alias("_n"),
                  dsp.welch_of("samples", "sampling_rate", segment).alias("_p"))
    return (p.select(*KEEP, "sampling_rate", "_n", _positions(F.col("_p")).alias("bin", "psd"))
            .select(*KEEP, "bin", (F.col("bin") * F.col("sampling_rate") / F.col("_n")).alias("hz"), "psd"))


def band_stats(df: DataFrame, lo: float, hi: float, measures: list[str] | None = None) -> DataFrame:
    """Descriptive statistics of the amplitude bins whose true frequency k sr / n lies in [lo, hi]."""
    a = df.select(*KEEP, (F.col("sampling_rate") / F.size("samples")).alias("_step"), dsp.amplitude_of("samples").alias("_a"))
    band = F.filter("_a", lambda x, i: (i * F.col("_step")).between(lo, hi))
    s = a.select(*KEEP, describe.descriptive_of(band, measures).alias("s"))
    return s.select(*KEEP, *[F.col(f"s.`{m}`").alias(f"{m}_{lo:g}_{hi:g}Hz") for m in (measures or describe.DESCRIPTIVE)])


def fft_mean(df: DataFrame) -> DataFrame:
    """Mean of the whole transform: the first sample, without imaginary part, as the other samples cancel out; null without samples."""
    first = F.get("samples", F.lit(0)).cast("double")
    return df.select(*KEEP, first.alias("fft_real_mean"), F.when(first.isNotNull(), F.lit(0.0)).alias("fft_imag_mean"))


def spectrum_overlay(df: DataFrame) -> DataFrame:
    """Bins of every fake beside those of the real recording of its id; recordings meet before bins are spread."""
    s = amplitude_spectrum(df)
    real = s.where("real_or_fake = 'R'").select("audio_id", F.col("spectrum.ampl").alias("_real"))
    fake = s.where("real_or_fake <> 'R'").join(real, "audio_id", "left")
    return (fake.select(*KEEP, "_real", _positions(F.col("spectrum"), "array<struct<hz:double,ampl:double>>").alias("bin", "s"))
            .select(*KEEP, "bin", F.col("s.hz").alias("hz"), F.col("s.ampl").alias("ampl"),
                    F.get("_real", F.col("bin")).alias("real_ampl")))
