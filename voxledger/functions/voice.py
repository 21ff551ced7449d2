"""Pitch, pulses and formants of one recording as NumPy helpers with Arrow UDFs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column

from .dsp import framed, hann, per_recording, sinc_resample

OCTAVE_COST = 0.01
SILENCE_SHARE = 0.03


def pitch_track(x, sr, fmin, fmax, step, threshold):
    """Times, F0 (0 = unvoiced) and periodicity by normalised autocorrelation (Boersma 1993)."""
    w, hop = max(int(round(3 * sr / fmin)), 4), max(int(round(step * sr)), 1)
    fr = framed(x, w, hop)
    if not len(fr):
        return np.empty(0), np.empty(0), np.empty(0)
    size = 1 << int(np.ceil(np.log2(2 * w)))
    win = hann(w + 1)[1:]

    def autocorr(v):
        return np.fft.irfft(np.abs(np.fft.rfft(v, size)) ** 2, size)[..., :w]

    ac = autocorr((fr - fr.mean(axis=1, keepdims=True)) * win)
    own = autocorr(win)
    r = np.divide(ac, ac[:, :1], out=np.zeros_like(ac), where=ac[:, :1] > 1e-20) / np.maximum(own / own[0], 1e-6)
    lo, hi = max(int(np.floor(sr / fmax)), 1), min(int(np.ceil(sr / fmin)), w // 2)
    lags = np.arange(lo, max(hi, lo) + 1)
    k = lo + np.argmax(r[:, lags] - OCTAVE_COST * np.log2(fmin * lags / sr), axis=1)
    at = np.arange(len(r))
    a, b, c = r[at, k - 1], r[at, k], r[at, np.minimum(k + 1, w - 1)]
    bend = a - 2 * b + c
    shift = np.where(bend < -1e-12, np.clip(0.5 * (a - c) / np.where(bend == 0, 1, bend), -0.5, 0.5), 0.0)
    strength = np.clip(b - 0.25 * (a - c) * shift, 0.0, 1 - 1e-6)
    loud = np.abs(fr - fr.mean(axis=1, keepdims=True)).max(axis=1) >= SILENCE_SHARE * max(np.abs(x).max(), 1e-20)
    f0 = np.where((strength >= threshold) & loud, sr / (k + shift), 0.0)
    return (at * hop + w / 2) / sr, f0, strength


def find_pulses(x, sr, fmin, fmax, step, threshold=0.45):
    t, f0, _ = pitch_track(x, sr, fmin, fmax, step, threshold)
    return pulses_on(x, sr, t, f0, step)


def pulses_on(x, sr, t, f0, step):
    """One extremum per period inside each voiced stretch of a pitch track, walked outwards from its strongest point."""
    voiced = np.flatnonzero(f0 > 0)
    if not len(voiced):
        return np.empty(0), np.empty(0)
    y = x if x.max() >= -x.min() else -x
    times, last = [], 0
    for run in np.split(voiced, np.flatnonzero(np.diff(voiced) > 1) + 1):
        begin = max(int((t[run[0]] - step / 2) * sr), last)
        end = min(int((t[run[-1]] + step / 2) * sr) + 1, len(x))
        if end - begin < 3:
            continue
        period = lambda p: sr / np.interp(p / sr, t[run], f0[run])
        first = begin + int(np.argmax(y[begin:end]))
        found = [first]
        for sign in (1, -1):
            p = first
            while True:
                step_n = period(p)
                a, b = sorted((p + sign * 0.8 * step_n, p + sign * 1.2 * step_n))
                a, b = int(np.ceil(a)), int(np.floor(b)) + 1
                if a < begin or b > end or b <= a:
                    break
                p = a + int(np.argmax(y[a:b]))
                found.append(p)
        times += sorted(found)
        last = end
    if not times:  # every voiced run is shorter than three samples
        return np.empty(0), np.empty(0)
    p = np.array(sorted(set(times)), dtype=np.int64)
    inner = np.clip(p, 1, len(x) - 2)
    a, b, c = y[inner - 1], y[inner], y[inner + 1]
    bend = a - 2 * b + c
    shift = np.where(bend < 0, np.clip(0.5 * (a - c) / np.where(bend == 0, 1, bend), -0.5, 0.5), 0.0)
    return (inner + shift) / sr, b - 0.25 * (a - c) * shift


def burg(fr: np.ndarray, order: int) -> np.ndarray:
    """Prediction polynomials (frames, order + 1) by Burg's recursion."""
    f, b = fr[:, 1:].copy(), fr[:, :-1].copy()
    a = np.zeros((len(fr), order + 1))
    a[:, 0] = 1
    for m in range(order):
        den = (f * f + b * b).sum(axis=1)
        k = np.divide(-2 * (f * b).sum(axis=1), den, out=np.zeros_like(den), where=den > 0)[:, None]
        a[:, :m + 2] += k * a[:, :m + 2][:, ::-1]
        f, b = (f + k * b)[:, 1:], (b + k * f)[:, :-1]
    return a


def formant_tracks(x, sr, step=0.025, count=5, ceiling=5500.0, window=0.025, emphasis=50.0):
    """Times and F1..F4 per frame, NaN where a formant is absent."""
    rate = min(2 * ceiling, float(sr))
    if rate < sr:
        x = sinc_resample(x, sr, rate)
    x = np.concatenate((x[:1], x[1:] - np.exp(-2 * np.pi * emphasis / rate) * x[:-1]))
    n, hop = int(round(2 * window * rate)), max(int(round(step * rate)), 1)
    fr = framed(x, n, hop)
    if not len(fr) or n <= 2 * count + 1:
        return np.empty(0), [np.empty(0)] * 4
    i = np.arange(n) - (n - 1) / 2
    a = burg(fr * np.exp(-12 * (i / n) ** 2), 2 * count)
    comp = np.zeros((len(a), 2 * count, 2 * count))
    comp[:, 0] = -a[:, 1:]
    comp[:, np.arange(1, 2 * count), np.arange(2 * count - 1)] = 1
    root = np.linalg.eigvals(comp)
    hz = np.where(root.imag > 0, np.angle(root) * rate / (2 * np.pi), np.nan)
    hz[(hz < 50) | (hz > rate / 2 - 50)] = np.nan
    hz = np.sort(hz, axis=1)[:, :4]
    return (np.arange(len(fr)) * hop + n / 2) / rate, [hz[:, k] for k in range(4)]


def pitch_of(col, sr, fmin, fmax, step, threshold) -> Column:
    return per_recording("t array<double>, f0 array<double>, r array<double>",
                         lambda x, rate: pitch_track(x, rate, fmin, fmax, step, threshold), col, sr)


def pulses_of(col, sr, fmin, fmax, step) -> Column:
    return per_recording("t array<double>, amp array<double>", lambda x, rate: find_pulses(x, rate, fmin, fmax, step), col, sr)


def voiced_of(col, sr, fmin, fmax, step, threshold=0.45) -> Column:
    """Pitch and the pulses found on it: one track for both."""

    def fn(x, rate):
        t, f0, r = pitch_track(x, rate, fmin, fmax, step, threshold)
        return t, f0, r, *pulses_on(x, rate, t, f0, step)

    return per_recording("t array<double>, f0 array<double>, r array<double>, pulse array<double>, amp array<double>", fn, col, sr)


def formants_of(col, sr, **options) -> Column:
    def fn(x, rate):
        t, f = formant_tracks(x, rate, **options)
        return t, *f

    return per_recording("t array<double>, " + ", ".join(f"f{k} array<double>" for k in (1, 2, 3, 4)), fn, col, sr)
