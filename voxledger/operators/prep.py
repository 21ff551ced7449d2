"""Imputation, scaling and removal of redundant feature columns.

Fitting reads one row of aggregates; applying is a projection with constants,
so it works on batch and streaming tables alike and never shuffles.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, functions as F

from .relational import align_columns, binary_target
from .scale import exact_quantiles
from .stats import correlation_matrix, to_long


def _present(c: str) -> Column:
    """NaN counts as missing."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def fit_means(train: DataFrame, columns: list[str]) -> dict[str, float]:
    row = train.agg(*[F.avg(_present(c)).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns if row[c] is not None}


def fill(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.select(*[F.coalesce(_present(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def impute_mean(train: DataFrame, columns: list[str], *apply_to: DataFrame) -> list[DataFrame]:
    """Fill with the means of ``train``, in every table given."""
    means = fit_means(train, columns)
    return [fill(t, means) for t in (apply_to or (train,))]


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text 'None' becomes missing, then exact medians fill."""
    clean = df.select(*[
        (F.nullif(F.col(c), F.lit("None")).cast("double") if dict(df.dtypes)[c] == "string" else _present(c)).alias(c)
        if c in columns else F.col(c) for c in df.columns])
    long = to_long(clean, columns, ())
    med = {r["feature"]: r["median"]
           for r in exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect()}
    return fill(clean, med)


def fit_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column."""
    row = df.agg(*[a for c in columns for a in (
        F.avg(_present(c)).alias(f"m_{c}"), F.stddev_pop(_present(c)).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def standardize(df: DataFrame, columns: list[str], state: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    state = state or fit_scale(df, columns)

    def scaled(c: str) -> Column:
        m, s = state[c]
        if m is None:
            return F.lit(None).cast("double").alias(c)
        return ((F.col(c) - m) / (s if s and s > 1e-12 * max(1.0, abs(m)) else 1.0)).alias(c)

    return df.select(*[scaled(c) if c in columns else F.col(c) for c in df.columns])


def fit_preparation(train: DataFrame, columns: list[str]) -> PipelineModel:
    """Mean imputation and scaling as one saved stage, fitted in one pass.

    After filling gaps with the mean, the mean stays and the squared deviation
    is spread over all rows, so the fitted deviation needs no second pass.
    """
    row = train.agg(F.count(F.lit(1)).alias("_n"), *[a for c in columns for a in (
        F.avg(_present(c)).alias(f"m_{c}"), F.stddev_pop(_present(c)).alias(f"s_{c}"),
        F.count(_present(c)).alias(f"n_{c}"))]).first()
    terms = []
    for c in columns:
        m, s, n = row[f"m_{c}"], row[f"s_{c}"], row[f"n_{c}"]
        if m is None:
            continue
        s = s * math.sqrt(n / row["_n"])
        s = s if s > 1e-12 * max(1.0, abs(m)) else 1.0
        terms.append(f"(coalesce(nanvl(cast(`{c}` as double), null), {m!r}D) - {m!r}D) / {s!r}D AS `{c}`")
    text = "SELECT audio_id, real_or_fake, " + ", ".join(terms) + " FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=text)])


def prepare(batch: DataFrame, state: PipelineModel, selected: list[str]) -> DataFrame:
    """Impute, scale and align a new batch with saved statistics, and add the target."""
    return binary_target(align_columns(state.transform(batch), selected))


# --- redundant columns ---------------------------------------------------------

def _profile(df: DataFrame, columns: list[str], id_col: str | None = None, middle: bool = False) -> dict[str, dict]:
    """One pass: range and mean of every column, and on request an order-free hash of
    (id, value) pairs and an approximate median."""
    aggs = []
    for c in columns:
        v = _present(c)
        aggs += [F.min(v).alias(f"lo_{c}"), F.max(v).alias(f"hi_{c}"), F.avg(v).alias(f"mean_{c}")]
        if id_col:
            aggs.append(F.sum(F.xxhash64(F.col(id_col), F.col(c)).cast("decimal(20,0)")).alias(f"hash_{c}"))  # repeated rows add up
        if middle:
            # within 1 % of the middle rank, which a value with over 55 % of the rows covers
            aggs.append(F.percentile_approx(v, 0.5, 100).alias(f"mid_{c}"))
    row = df.agg(*aggs).first().asDict()
    return {c: {k: row.get(f"{k}_{c}") for k in ("lo", "hi", "mean", "hash", "mid")} for c in columns}


def _constant(p: dict) -> bool:
    return p["lo"] is not None and p["lo"] == p["hi"]


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    prof = _profile(df, columns)
    return [c for c in columns if _constant(prof[c])]


def top_value_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of the commonest value among the non-null ones, per column."""
    long = to_long(df, columns, ()).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg((F.max("n") / F.sum("n")).alias("top_share"))


def _verify(df: DataFrame, middles: dict[str, float], pairs: list[tuple[str, str]]) -> tuple[dict[str, float], list[bool]]:
    """One pass: share of the candidate value per column, and which column pairs agree on every row."""
    aggs = [F.try_divide(F.count_if(_present(c) == m), F.count(_present(c))).alias(f"s_{c}") for c, m in middles.items()]
    aggs += [F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"p{k}") for k, (a, b) in enumerate(pairs)]
    if not aggs:
        return {}, []
    row = df.agg(*aggs).first()
    return {c: row[f"s_{c}"] or 0.0 for c in middles}, [row[f"p{k}"] == 0 for k in range(len(pairs))]


def quasi_constant_columns(df: DataFrame, columns: list[str], threshold: float = 0.99) -> list[str]:
    """Columns whose commonest value exceeds the threshold share.

    A value with more than half of the rows covers the middle ranks, so an
    approximate median must be that value; its share is then counted exactly,
    and the distinct values are never shuffled. Low thresholds count them all.
    """
    if threshold >= 0.55:
        prof = _profile(df, columns, middle=True)
        share, _ = _verify(df, {c: prof[c]["mid"] for c in columns if prof[c]["mid"] is not None}, [])
        hit = {c for c, s in share.items() if s > threshold}
    else:
        hit = {r[0] for r in top_value_share(df, columns).where(F.col("top_share") > threshold).collect()}
    return [c for c in columns if c in hit]


def _candidate_pairs(prof: dict[str, dict], columns: list[str]) -> list[tuple[str, str]]:
    """(first, later) columns with equal hashes; equality is transitive, so the first one is enough."""
    groups: dict[object, list[str]] = defaultdict(list)
    for c in columns:
        groups[prof[c]["hash"]].append(c)
    return [(g[0], c) for g in groups.values() for c in g[1:]]


def _equal_pairs(df: DataFrame, pairs: list[tuple[str, str]], same: list[bool]) -> list[tuple[str, str]]:
    """The equal ones of checked candidate pairs, and those among the columns that differ from their first one.

    Columns of one hash that differ from the first make a new class each
    pass; hashes that meet by chance only take more passes.
    """
    equal: list[tuple[str, str]] = []
    while pairs:
        rest: dict[str, list[str]] = defaultdict(list)
        for ok, (a, b) in zip(same, pairs):
            if ok:
                equal.append((a, b))
            else:
                rest[a].append(b)
        pairs = [(g[0], c) for g in rest.values() for c in g[1:]]
        _, same = _verify(df, {}, pairs)
    return equal


def duplicate_columns(df: DataFrame, columns: list[str], id_col: str = "audio_id") -> list[str]:
    """Columns equal to an earlier one: equal hashes first, then a row by row check."""
    pairs = _candidate_pairs(_profile(df, columns, id_col), columns)
    _, same = _verify(df, {}, pairs)
    drop = {b for _, b in _equal_pairs(df, pairs, same)}
    return [c for c in columns if c in drop]


def correlated_columns(df: DataFrame, columns: list[str], threshold: float = 0.9,
                       centre: dict[str, float] | None = None) -> list[str]:
    """Columns with |r| above the threshold to any earlier column, dropped or not."""
    hits = correlation_matrix(df, columns, centre).where(F.abs("r") > threshold)
    drop = {r[0] for r in hits.select("feature_b").distinct().collect()}
    return [c for c in columns if c in drop]


def correlated_greedy(df: DataFrame, columns: list[str], threshold: float = 0.6) -> list[str]:
    """Kept columns when each column, taken in order, removes the earlier ones it is correlated with.

    A column can only be removed by a later one, so it always takes its own turn
    first: it goes exactly when some later column is correlated with it.
    """
    hits = correlation_matrix(df, columns).where(F.abs("r") > threshold)
    drop = {r[0] for r in hits.select("feature_a").distinct().collect()}
    return [c for c in columns if c not in drop]


def select_features(train: DataFrame, columns: list[str], quasi: float = 0.99, corr: float = 0.9,
                    id_col: str = "audio_id") -> list[str]:
    """Names kept after constant, quasi-constant, duplicate and correlated columns go, learned on train.

    Three passes over the table: a profile, a check of the candidates it names,
    and the cross products of what is left.
    """
    if quasi < 0.55:
        raise ValueError("quasi must be at least 0.55; use quasi_constant_columns for lower thresholds")
    prof = _profile(train, columns, id_col, middle=True)
    kept = [c for c in columns if not _constant(prof[c])]
    pairs = _candidate_pairs(prof, kept)
    share, same = _verify(train, {c: prof[c]["mid"] for c in kept if prof[c]["mid"] is not None}, pairs)
    kept = [c for c in kept if share.get(c, 0.0) <= quasi]
    twins = {b for a, b in _equal_pairs(train, pairs, same) if a in kept}
    kept = [c for c in kept if c not in twins]
    gone = set(correlated_columns(train, kept, corr, {c: prof[c]["mean"] for c in kept}))
    return [c for c in kept if c not in gone]


def remove_redundant(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    kept = select_features(train, columns)
    return align_columns(train, kept), align_columns(test, kept), kept
