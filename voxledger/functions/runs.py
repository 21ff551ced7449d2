"""Runs of frames and pulses of one recording as arrays, without a row per frame."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column

from .dsp import per_recording


def merged(flag: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring runs with an equal flag become one."""
    first = np.concatenate([[0], np.flatnonzero(flag[1:] != flag[:-1]) + 1])
    return flag[first], start[first], end[np.append(first[1:], len(flag)) - 1]


def intervals(db: np.ndarray, threshold: float, step: int, n: int, rate: float, min_silent: float, min_sounding: float):
    """(silent, start, end) of the runs below and above a level, in seconds.

    Frame i stands for samples from i step to (i + 1) step, the last one for the
    rest. Short silent runs are absorbed first, then short sounding ones.
    """
    if not len(db) or threshold is None:
        return np.empty(0, bool), np.empty(0), np.empty(0)
    edge = np.arange(len(db) + 1) * step / rate
    edge[-1] = n / rate
    return absorbed(db < threshold, edge[:-1], edge[1:], min_silent, min_sounding)


def absorbed(flag: np.ndarray, start: np.ndarray, end: np.ndarray, min_silent: float, min_sounding: float):
    """Runs of equal flags; short silent ones are absorbed first, then short sounding ones."""
    flag, start, end = merged(flag, start, end)
    flag, start, end = merged(flag & (np.round(end - start, 9) >= min_silent), start, end)
    return merged(flag | (np.round(end - start, 9) < min_sounding), start, end)


def silent_of(levels: Column | str, threshold: Column, step: Column, n: Column, rate: Column | str, min_silent: float,
              min_sounding: float, silent: bool = True) -> Column:
    """struct(start, end) of arrays: the silent intervals of a level track, or the sounding ones."""

    def fn(db, cut, hop, size, sr):
        flag, start, end = intervals(db, cut, hop, size, sr, min_silent, min_sounding)
        return start[flag == silent], end[flag == silent]

    return per_recording("start array<double>, end array<double>", fn, levels, threshold, step, n, rate)


#: Measures of pulse tables, in the order of ``perturbation``.
PERTURBATION = ["jitter_local", "jitter_absolute", "jitter_rap", "jitter_ppq5", "jitter_ddp", "shimmer_local", "shimmer_db",
                "shimmer_apq3", "shimmer_apq5", "shimmer_apq11", "shimmer_dda"]


def _mean(x: np.ndarray) -> float:
    return float(x.mean()) if len(x) else np.nan


def _spread(x: np.ndarray, joined: np.ndarray, points: int) -> float:
    """Mean of |x_i - mean of the ``points`` values around i| where each is joined to the one before."""
    if len(x) < points:
        return np.nan
    around = np.lib.stride_tricks.sliding_window_view(x, points)
    links = np.lib.stride_tricks.sliding_window_view(joined[1:], points - 1).all(axis=1)
    full = links & ~np.isnan(around).any(axis=1)
    return _mean(np.abs(x[points // 2:len(x) - points // 2] - around.mean(axis=1))[full])


def perturbation(t: np.ndarray, amp: np.ndarray, lo: float, hi: float, factor: float, amp_factor: float) -> list[float]:
    """PERTURBATION of one recording's pulses; NaN where there is nothing to average."""
    if not len(t):
        return [np.nan] * len(PERTURBATION)
    period = np.concatenate([[np.nan], np.diff(t)])
    with np.errstate(all="ignore"):
        ok = (period >= lo) & (period <= hi)
        before, amp_before = np.concatenate([[np.nan], period[:-1]]), np.concatenate([[np.nan], amp[:-1]])
        ratio = np.fmax(period, before) / np.fmin(period, before)
        link = ok & np.concatenate([[False], ok[:-1]]) & (ratio <= factor)
        amp_ratio = np.fmax(amp, amp_before) / np.fmin(amp, amp_before)
        amp_link = ok & (amp > 0) & (amp_before > 0) & (amp_ratio <= amp_factor)
        mean_period, mean_amp = _mean(period[ok]), _mean(amp)
        mean_period, mean_amp = mean_period or np.nan, mean_amp or np.nan
        j1 = _mean(np.abs(period - before)[link])
        j3, j5 = (_spread(period, link, k) for k in (3, 5))
        s1, sdb = _mean(np.abs(amp - amp_before)[amp_link]), _mean(np.abs(20 * np.log10(amp / amp_before))[amp_link])
        s3, s5, s11 = (_spread(amp, amp_link, k) for k in (3, 5, 11))
    return [j1 / mean_period, j1, j3 / mean_period, j5 / mean_period, 3 * j3 / mean_period,
            s1 / mean_amp, sdb, s3 / mean_amp, s5 / mean_amp, s11 / mean_amp, 3 * s3 / mean_amp]


def perturbation_of(times: str, amps: str, lo: float, hi: float, factor: float = 1.3, amp_factor: float = 1.6) -> Column:
    return per_recording(", ".join(f"{n} double" for n in PERTURBATION),
                         lambda t, a: perturbation(t, np.asarray(a, np.float64), lo, hi, factor, amp_factor), times, amps)
