"""Summaries of one bounded array of samples or frame values, as Arrow UDFs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Output column names.
MEASURES = ["mean", "std", "var", "min", "max", "range", "25th_percentile", "50th_percentile",
            "75th_percentile", "skew", "kurtosis"]

DESCRIPTIVE = ["mean", "variance", "skewness", "kurtosis", "10th_percentile", "25th_percentile",
               "50th_percentile", "75th_percentile", "90th_percentile", "mean_peak_height"]

EXTENDED = ["mean", "std_dev", "variance", "min", "max", "median", "range", "skewness", "kurtosis",
            "quantile_10", "quantile_25", "quantile_50", "quantile_75", "quantile_90", "rolling_mean_3",
            "rolling_std_3", "num_peaks", "peak_heights", "entropy", "autocorrelation_lag1",
            "fft_real_mean", "fft_imag_mean"]


def sorted_quantiles(ordered: np.ndarray, probs: list[float]) -> np.ndarray:
    """Linear quantiles of rows that are sorted already; (rows, probs)."""
    h = (ordered.shape[1] - 1) * np.asarray(probs)
    lo = np.floor(h).astype(np.int64)
    a, b = ordered[:, lo], ordered[:, np.minimum(lo + 1, ordered.shape[1] - 1)]
    return a + (b - a) * (h - lo)


def shape_moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean, population variance, skewness and excess kurtosis of every row.

    The last two are NaN unless two values of the row differ.
    """
    mean = x.mean(axis=1)
    d = x - mean[:, None]
    d2 = d * d
    var = d2.mean(axis=1)
    safe = np.where(x.min(axis=1) < x.max(axis=1), var, np.nan)
    return mean, var, (d2 * d).mean(axis=1) / safe ** 1.5, (d2 * d2).mean(axis=1) / safe ** 2 - 3


def peak_positions(x: np.ndarray) -> np.ndarray:
    """Strict local maxima; a plateau counts once, at its midpoint. Ends never count."""
    if len(x) < 3:
        return np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    ends = np.concatenate((starts[1:], [len(x)])) - 1
    v = x[starts]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (starts[top] + ends[top]) // 2


def summary(x: np.ndarray) -> np.ndarray:
    """MEASURES of every row of a (rows, n) matrix."""
    mean, var, skew, kurt = shape_moments(x)
    o = np.sort(x, axis=1)
    q = sorted_quantiles(o, [0.25, 0.5, 0.75])
    lo, hi = o[:, 0], o[:, -1]
    return np.column_stack([mean, np.sqrt(var), var, lo, hi, hi - lo, q, skew, kurt])


def descriptive(x: np.ndarray) -> np.ndarray:
    """DESCRIPTIVE of every row."""
    q = sorted_quantiles(np.sort(x, axis=1), [0.1, 0.25, 0.5, 0.75, 0.9])
    mean, var, skew, kurt = shape_moments(x)
    height = np.zeros(len(x))
    for i, row in enumerate(x):
        p = peak_positions(row)
        height[i] = row[p].mean() if len(p) else 0.0
    return np.column_stack([mean, var, skew, kurt, q, height])


def _extended_row(x: np.ndarray) -> list[float]:
    roll = np.lib.stride_tricks.sliding_window_view(x, 3) if len(x) >= 3 else np.empty((0, 3))
    p = peak_positions(x)
    share = np.unique(x, return_counts=True)[1] / len(x)
    a, b = x[1:], x[:-1]
    lag1 = np.corrcoef(a, b)[0, 1] if len(a) > 1 and np.ptp(a) > 0 and np.ptp(b) > 0 else np.nan
    spec = np.fft.fft(x)
    return [roll.mean() if len(roll) else np.nan, roll.std(axis=1, ddof=1).mean() if len(roll) else np.nan,
            float(len(p)), x[p].mean() if len(p) else 0.0, float(-(share * np.log(share)).sum()), lag1,
            spec.real.mean(), spec.imag.mean()]


def extended(x: np.ndarray) -> np.ndarray:
    """EXTENDED of every row."""
    mean, var, skew, kurt = shape_moments(x)
    o = np.sort(x, axis=1)
    q = sorted_quantiles(o, [0.1, 0.25, 0.5, 0.75, 0.9])
    lo, hi = o[:, 0], o[:, -1]
    return np.column_stack([mean, np.sqrt(var), var, lo, hi, q[:, 2], hi - lo, skew, kurt, q,
                            np.array([_extended_row(r) for r in x]).reshape(len(x), 8)])


def by_length(arrays: list, fn, width: int) -> np.ndarray:
    """Apply a row-wise ``fn`` to arrays of any length, those of equal length together."""
    out = np.full((len(arrays), width), np.nan)
    sizes = np.array([0 if v is None else len(v) for v in arrays], np.int64)
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        with np.errstate(all="ignore"):
            out[at] = fn(np.stack([np.asarray(arrays[i], np.float64) for i in at]))
    return out


SLICE = 256  # rows of a batch that are Python objects at once


def in_slices(fn, schema: str):
    """Arrow UDF over a pandas function of rows: a batch stays in Arrow's form, and only a slice of it is Python objects."""
    kind = T.DataType.fromDDL(schema)
    target = to_arrow_type(kind)

    def packed(values: pd.Series, to: pa.DataType) -> pa.Array:
        return pa.Array.from_pandas(values, mask=values.isnull(), type=to)

    @F.arrow_udf(kind)
    def apply(*columns: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, max(len(columns[0]), 1), SLICE):
            out = fn(*[c.slice(at, SLICE).to_pandas() for c in columns])
            if isinstance(kind, T.StructType):
                parts.append(pa.StructArray.from_arrays([packed(out[f.name], f.type) for f in target], fields=list(target)))
            else:
                parts.append(packed(out, target))
        return pa.concat_arrays(parts)

    return apply


def _struct_udf(fn, names: list[str], keep: list[str], prefix: str = ""):
    cols = [prefix + n for n in keep]
    at = [names.index(n) for n in keep]

    def apply(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(by_length(s.to_list(), fn, len(names))[:, at], columns=cols)

    return in_slices(apply, ", ".join(f"`{n}` double" for n in cols))


def summary_of(col: Column | str, measures: list[str] | None = None, prefix: str = "") -> Column:
    return _struct_udf(summary, MEASURES, measures or MEASURES, prefix)(col)


def descriptive_of(col: Column | str, measures: list[str] | None = None) -> Column:
    return _struct_udf(descriptive, DESCRIPTIVE, measures or DESCRIPTIVE)(col)


def extended_of(col: Column | str, measures: list[str] | None = None) -> Column:
    return _struct_udf(extended, EXTENDED, measures or EXTENDED)(col)


def summaries_of(col: Column | str, n: int, measures: list[str] | None = None, name: str = "coef") -> Column:
    """(frames, n) matrix -> struct of ``{name}_{i}_{measure}``, coefficients counted from 1."""
    keep = measures or MEASURES
    at = [MEASURES.index(m) for m in keep]
    out = [f"{name}_{i + 1}_{m}" for i in range(n) for m in keep]

    def apply(s: pd.Series) -> pd.DataFrame:
        # every coefficient of every recording is one row of values over frames
        tracks = [None if m is None or not len(m) else np.stack([np.asarray(v, np.float64) for v in m]).T for m in s]
        flat = [None if t is None else t[i] for t in tracks for i in range(n)]
        return pd.DataFrame(by_length(flat, summary, len(MEASURES))[:, at].reshape(len(s), len(out)), columns=out)

    return in_slices(apply, ", ".join(f"`{c}` double" for c in out))(col)
