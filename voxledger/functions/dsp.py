"""Signal helpers: small NumPy functions on one recording, and their Arrow UDFs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from .describe import in_slices, peak_positions


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def per_recording(schema: str, fn, *cols: Column | str) -> Column:
    """Arrow UDF: ``fn(samples, *scalars)`` per row, null for null samples.

    With named fields in ``schema``, ``fn`` gives one value per field.
    """
    names = [p.strip().split(" ")[0].strip("`") for p in _split_fields(schema)]

    def rows(s: tuple[pd.Series, ...]) -> list:
        return [None if v[0] is None else fn(np.asarray(v[0], np.float64), *v[1:]) for v in zip(*s)]

    def one(*s: pd.Series) -> pd.Series:
        return pd.Series(rows(s), index=s[0].index)

    def several(*s: pd.Series) -> pd.DataFrame:
        out = [(None,) * len(names) if v is None else v for v in rows(s)]
        return pd.DataFrame({n: pd.Series([v[i] for v in out]) for i, n in enumerate(names)})

    struct = " " in schema.split("<")[0].strip()
    return in_slices(several if struct else one, schema)(*[_column(c) for c in cols])


def _split_fields(schema: str) -> list[str]:
    """Top-level fields of 'a bigint, b array<struct<x: double>>'."""
    out, depth, cur = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [*out, cur]


# --- plain signals ---------------------------------------------------------------------

def peaks_of(col, height: float | None = None) -> Column:
    def fn(x):
        h = x[peak_positions(x)]
        h = h if height is None else h[h >= height]
        return len(h), float(h.mean()) if len(h) else 0.0

    return per_recording("n_peaks bigint, mean_height double", fn, col)


def entropy_of(col) -> Column:
    def fn(x):
        share = np.unique(x, return_counts=True)[1] / max(len(x), 1)
        return float(-(share * np.log(share)).sum())

    return per_recording("double", fn, col)


SINC_ZEROS = 32


def sinc_resample(x: np.ndarray, sr: int, target: int) -> np.ndarray:
    """Band-limited interpolation with a Hann-windowed sinc (Smith & Gossett 1984)."""
    n_out = int(np.ceil(len(x) * target / sr))
    cut = min(1.0, target / sr)
    half = int(np.ceil(SINC_ZEROS / cut))
    taps = np.arange(-half + 1, half + 1)
    pad = np.concatenate((np.zeros(half), x, np.zeros(half + 1)))
    out = np.empty(n_out)
    for a in range(0, n_out, 8192):
        at = np.arange(a, min(a + 8192, n_out)) * (sr / target)
        base = np.floor(at).astype(np.int64)
        dist = taps[None, :] - (at - base)[:, None]
        kernel = cut * np.sinc(cut * dist) * (0.5 + 0.5 * np.cos(np.pi * np.clip(dist / half, -1, 1)))
        out[a:a + len(at)] = (pad[base[:, None] + taps[None, :] + half] * kernel).sum(axis=1)
    return out


def resample_of(col, sr, target: int) -> Column:
    return per_recording("array<double>", lambda x, r: sinc_resample(x, r, target), col, sr)


# --- short-time spectra ------------------------------------------------------------------

def framed(x: np.ndarray, n: int, hop: int) -> np.ndarray:
    if len(x) < n:
        return np.empty((0, n))
    return np.lib.stride_tricks.sliding_window_view(x, n)[::hop]


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def stft_magnitude(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """(frames, bins), Hann window, no padding."""
    return np.abs(np.fft.rfft(framed(x, n_fft, hop) * hann(n_fft), axis=1))


def dominant_of(col, sr) -> Column:
    def fn(x, r):
        if len(x) == 0:
            return None
        return float(np.fft.rfftfreq(len(x), 1 / r)[np.argmax(np.abs(np.fft.rfft(x)))])

    return per_recording("double", fn, col, sr)


def snr_of(col, n_fft: int, hop: int) -> Column:
    def fn(x):
        a = stft_magnitude(x, n_fft, hop)
        if a.size == 0 or a.var() == 0:
            return None
        return float(10 * np.log10(np.mean(a * a) / a.var()))

    return per_recording("double", fn, col)


# --- tracks over frames: each takes magnitudes (frames, bins) and bin frequencies ---------

def _share(a: np.ndarray) -> np.ndarray:
    t = a.sum(axis=1, keepdims=True)
    return np.divide(a, t, out=np.zeros_like(a), where=t > 0)


def centroid(a, hz):
    return (_share(a) * hz).sum(axis=1)


def bandwidth(a, hz):
    return np.sqrt((_share(a) * (hz - centroid(a, hz)[:, None]) ** 2).sum(axis=1))


def flatness(a, hz):
    p = np.maximum(a * a, 1e-10)
    return np.exp(np.log(p).mean(axis=1)) / p.mean(axis=1)


def rolloff(a, hz, pct=0.85):
    c = np.cumsum(a, axis=1)
    return hz[np.argmax(c >= pct * c[:, -1:], axis=1)]


def flux(a, hz):
    return np.sqrt((np.diff(a, axis=0) ** 2).sum(axis=1))


def centroid_bin(a, hz):
    return centroid(a, np.arange(a.shape[1], dtype=np.float64))


def band_ratio(a, hz, split_hz=2048.0):
    """Energy below the split bin over the energy from it on; the split uses bins per sr / 2."""
    b = int(np.floor(split_hz / (hz[-1] / a.shape[1])))
    high = (a[:, b:] ** 2).sum(axis=1)
    return np.divide((a[:, :b] ** 2).sum(axis=1), high, out=np.full(len(a), np.nan), where=high > 0)


def contrast(a, hz, fmin=200.0, bands=6, quantile=0.02):
    """Peak minus valley in dB per octave band (Jiang 2002); (frames * (bands + 1)), flattened."""
    edges = np.concatenate(([0.0], fmin * 2.0 ** np.arange(bands + 1)))
    out = np.zeros((bands + 1, len(a)))
    for k in range(bands + 1):
        hi = edges[k + 1] if k < bands else np.inf
        sub = np.sort(a[:, (hz >= edges[k]) & (hz <= hi)], axis=1)
        if sub.shape[1] == 0:
            continue
        m = max(1, int(round(quantile * sub.shape[1])))
        top, low = sub[:, -m:].mean(axis=1), sub[:, :m].mean(axis=1)
        out[k] = 10 * np.log10(np.maximum(top, 1e-10)) - 10 * np.log10(np.maximum(low, 1e-10))
    return out.ravel()


def _mel(hz):
    """Slaney scale: linear below 1 kHz, logarithmic above."""
    hz = np.asarray(hz, np.float64)
    return np.where(hz < 1000, hz * 3 / 200, 15 + 27 * np.log(np.maximum(hz, 1000) / 1000) / np.log(6.4))


def _hz(mel):
    return np.where(mel < 15, mel * 200 / 3, 1000 * np.exp((mel - 15) * np.log(6.4) / 27))


def mel_bank(hz: np.ndarray, n_mels: int) -> np.ndarray:
    """(bins, mels) triangles of equal area."""
    edge = _hz(np.linspace(0, _mel(hz[-1]), n_mels + 2))
    up = (hz[:, None] - edge[:-2]) / np.maximum(edge[1:-1] - edge[:-2], 1e-12)
    down = (edge[2:] - hz[:, None]) / np.maximum(edge[2:] - edge[1:-1], 1e-12)
    return np.maximum(0, np.minimum(up, down)) * 2 / np.maximum(edge[2:] - edge[:-2], 1e-12)


def to_db(power: np.ndarray, ref: float = 1.0, floor: float = 1e-10, top: float = 80.0) -> np.ndarray:
    db = 10 * np.log10(np.maximum(power, floor)) - 10 * np.log10(max(ref, floor))
    return np.maximum(db, db.max() - top) if db.size else db


def mel_db(a, hz, n_mels=128):
    """(frames, mels) dB against the largest value."""
    p = (a * a) @ mel_bank(hz, n_mels)
    return to_db(p, p.max() if p.size else 1.0)


def mfcc(a, hz, n=13, n_mels=128):
    """(frames, n) coefficients: orthonormal DCT-II of the mel dB (Davis & Mermelstein 1980)."""
    db = to_db((a * a) @ mel_bank(hz, n_mels))
    k, m = np.arange(n)[:, None], np.arange(n_mels)[None, :]
    basis = np.cos(np.pi * k * (2 * m + 1) / (2 * n_mels)) * np.sqrt(2 / n_mels)
    basis[0] /= np.sqrt(2)
    return db @ basis.T


def chroma(a, hz):
    """(frames, 12) power per pitch class, C first, scaled to a maximum of 1."""
    pitch = np.zeros((len(hz), 12))
    use = hz > 27.5
    pitch[np.flatnonzero(use), np.round(12 * np.log2(hz[use] / 440.0) + 69).astype(int) % 12] = 1
    c = (a * a) @ pitch
    top = c.max(axis=1, keepdims=True)
    return np.divide(c, top, out=np.zeros_like(c), where=top > 0)


def tonnetz(a, hz):
    """(frames, 6) tonal centroid (Harte 2006): circles of fifths, minor and major thirds."""
    c = _share(chroma(a, hz))
    ang = np.arange(12)[:, None] * np.pi * np.array([7 / 6, 3 / 2, 2 / 3])
    radius = np.array([1.0, 1.0, 0.5])
    basis = np.stack([radius * np.sin(ang), radius * np.cos(ang)], axis=2).reshape(12, 6)
    return c @ basis


TRACKS = {"spectral_centroid": centroid, "spectral_bandwidth": bandwidth, "spectral_flatness": flatness,
          "spectral_rolloff": rolloff, "spectral_flux": flux, "spectral_contrast": contrast,
          "centroid_bin": centroid_bin, "band_energy_ratio": band_ratio}
MATRICES = {"mel_db": mel_db, "mfcc": mfcc, "chroma": chroma, "tonnetz": tonnetz}


def _spectrum(x, sr, n_fft, hop):
    return stft_magnitude(x, n_fft, hop), np.fft.rfftfreq(n_fft, 1 / sr)


def tracks_of(col, sr, names: list[str], n_fft: int, hop: int, options: dict[str, dict] | None = None) -> Column:
    """Struct of one array per track; the short-time spectrum is computed once and stays in the worker."""
    opts = options or {}

    def fn(x, r):
        a, hz = _spectrum(x, r, n_fft, hop)
        if not len(a):
            return [np.empty(0)] * len(names)
        return [TRACKS[n](a, hz, **opts.get(n, {})) for n in names]

    return per_recording(", ".join(f"`{n}` array<double>" for n in names), fn, col, sr)


def matrix_of(col, sr, name: str, n_fft: int, hop: int, **options) -> Column:
    """array<array<double>>: one inner array per frame."""

    def fn(x, r):
        a, hz = _spectrum(x, r, n_fft, hop)
        return list(MATRICES[name](a, hz, **options)) if len(a) else []

    return per_recording("array<array<double>>", fn, col, sr)


def spectral_of(col, sr, tracks: list[str], matrices: list[str], n_fft: int, hop: int, options: dict[str, dict] | None = None) -> Column:
    """Struct of tracks (an array each) and matrices (an array per frame) from one short-time spectrum."""
    opts = options or {}

    def fn(x, r):
        a, hz = _spectrum(x, r, n_fft, hop)
        if not len(a):
            return [np.empty(0)] * len(tracks) + [[]] * len(matrices)
        return [TRACKS[n](a, hz, **opts.get(n, {})) for n in tracks] + [list(MATRICES[n](a, hz, **opts.get(n, {}))) for n in matrices]

    fields = [f"`{n}` array<double>" for n in tracks] + [f"`{n}` array<array<double>>" for n in matrices]
    return per_recording(", ".join(fields), fn, col, sr)


def magnitudes_of(col, n_fft: int, hop: int) -> Column:
    return per_recording("array<array<double>>", lambda x: list(stft_magnitude(x, n_fft, hop)), col)


def amplitude_of(col) -> Column:
    """2 |fft / n|, first n / 2 bins."""
    return per_recording(
        "array<double>", lambda x: 2 * np.abs(np.fft.fft(x) / max(len(x), 1))[:len(x) // 2] if len(x) else np.empty(0), col)


def welch_of(col, sr, segment: int = 256) -> Column:
    """One-sided density: mean of the squared spectra of half-overlapping, mean-free Hann segments."""

    def fn(x, r):
        n = min(segment, len(x))
        if n < 2:
            return np.empty(0)
        w, seg = hann(n), framed(x, n, n - n // 2)
        p = np.abs(np.fft.rfft((seg - seg.mean(axis=1, keepdims=True)) * w, axis=1)) ** 2 / (r * (w * w).sum())
        p[:, 1:(-1 if n % 2 == 0 else None)] *= 2
        return p.mean(axis=0)

    return per_recording("array<double>", fn, col, sr)
