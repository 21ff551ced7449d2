"""Summary statistics and class comparison."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import describe
from ..functions.special import f_pvalue, normal_pvalue, t_pvalue
from .scale import exact_quantiles, join_lookup, running_sums, spread_small


def to_long(df: DataFrame, columns: list[str], ids: tuple[str, ...] = ("real_or_fake",)) -> DataFrame:
    """(ids, feature, value); always aggregate straight after this."""
    return df.select(*ids, *columns).unpivot(list(ids), columns, "feature", "value")


def summary_stats(df: DataFrame, col: str, measures: list[str] | None = None,
                  keep: tuple[str, ...] = ("audio_id", "real_or_fake")) -> DataFrame:
    """Eleven measures of an array column; no shuffle."""
    return df.select(*keep, describe.summary_of(col, measures).alias("s")).select(*keep, "s.*")


def summary_stats_long(df: DataFrame, keys: list[str], value: str,
                       measures: list[str] | None = None) -> DataFrame:
    """The same measures of a long table whose groups are bounded, such as one recording's frames."""
    v = F.col(value)
    varied = F.min(v) < F.max(v)
    agg = {"mean": F.avg(v), "std": F.stddev_pop(v), "var": F.var_pop(v), "min": F.min(v), "max": F.max(v),
           "range": F.max(v) - F.min(v), "25th_percentile": F.percentile(v, 0.25),
           "50th_percentile": F.percentile(v, 0.5), "75th_percentile": F.percentile(v, 0.75),
           "skew": F.when(varied, F.skewness(v)), "kurtosis": F.when(varied, F.kurtosis(v))}
    return df.groupBy(*keys).agg(*[agg[m].alias(m) for m in (measures or describe.MEASURES)])


def extended_stats(df: DataFrame, col: str = "samples",
                   keep: tuple[str, ...] = ("audio_id", "real_or_fake")) -> DataFrame:
    return df.select(*keep, describe.extended_of(col).alias("s")).select(*keep, "s.*")


def descriptive_stats(df: DataFrame, col: str = "samples",
                      keep: tuple[str, ...] = ("audio_id", "real_or_fake")) -> DataFrame:
    return df.select(*keep, describe.descriptive_of(col).alias("s")).select(*keep, "s.*")


def windowed_stats(df: DataFrame, *, window: int | None = None, step: int | None = None, col: str = "samples",
                   measures: list[str] | None = None,
                   keep: tuple[str, ...] = ("audio_id", "real_or_fake")) -> DataFrame:
    """descriptive_stats of every window, averaged; defaults are a tenth of the length, half overlap."""
    from .frames import frames

    w = F.lit(window) if window else F.floor(F.size(col) / 10).cast("int")
    s = F.lit(step) if step else F.greatest(F.floor(F.col("_w") / 2).cast("int"), F.lit(1))
    sized = spread_small(df).withColumn("_w", w).withColumn("_s", s).where(F.col("_w") > 0)
    cut = frames(sized, F.col("_w"), F.col("_s"), col=col, keep=keep)
    names = measures or describe.DESCRIPTIVE
    per = cut.select(*keep, describe.descriptive_of("frame", names).alias("s")).select(*keep, "s.*")
    return per.groupBy(*keep).agg(*[F.avg(m).alias(f"windowed_{m}_mean") for m in names])


def coefficient_stats(coefs: DataFrame, name: str, n_coefs: int, measures: list[str] | None = None) -> DataFrame:
    """(audio_id, coef, value) -> one row per recording with ``{name}_{coef}_{measure}`` columns."""
    per = summary_stats_long(coefs, ["audio_id", "coef"], "value", measures)
    names = measures or describe.MEASURES
    return per.groupBy("audio_id").agg(*[
        F.max(F.when(F.col("coef") == c, F.col(m))).alias(f"{name}_{c}_{m}")
        for c in range(1, n_coefs + 1) for m in names])


def property_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, exact median and population deviation of any columns."""
    long = to_long(df, columns, ()).where(F.col("value").isNotNull())
    moments = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std_dev"))
    return moments.join(exact_quantiles(long, ["feature"], "value", {"median": 0.5}), "feature")


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins from min to max, the last one closed; empty bins stay."""
    src = df.select(*([by] if by else []), F.col(col).alias("_v")).where(F.col("_v").isNotNull())
    bounds = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n")]
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))).cast("int")
    if by:
        edges = src.groupBy(by).agg(*bounds)
        placed = join_lookup(src, edges, by)
    else:  # one row, so its values become constants
        row = src.agg(*bounds).first()
        edges = df.sparkSession.createDataFrame([tuple(row)], "_lo double, _hi double, _n bigint")
        placed = src.select("*", F.lit(row["_lo"]).alias("_lo"), F.lit(row["_hi"]).alias("_hi"))
    keys = [by, "bin"] if by else ["bin"]
    counts = placed.select(*([by] if by else []), bin_no.alias("bin")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    grid = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce("_c", F.lit(0))
    return grid.join(counts, keys, "left").select(
        *keys, (F.col("_lo") + width * F.col("bin")).alias("lo"),
        (F.col("_lo") + width * (F.col("bin") + 1)).alias("hi"), n.alias("n"),
        (n / (F.col("_n") * F.nullif(width, F.lit(0.0)))).alias("density"))


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per class; an array column is exploded first."""
    if dict(df.dtypes)[value].startswith("array"):
        df = df.select(by, F.explode(value).alias(value))
    df = df.select(by, value).where(F.col(value).isNotNull())
    q = exact_quantiles(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    lo, hi = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col(value).between(lo, hi)
    return join_lookup(df, q, by).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))


# --- two classes: real against the rest -------------------------------------

def class_moments(long: DataFrame, label: str = "real_or_fake") -> DataFrame:
    """Per feature: count, mean, sample variance and range of both classes; one aggregation."""
    v = F.col("value")
    aggs = []
    for tag, is_class in (("r", F.col(label) == "R"), ("f", F.col(label) != "R")):
        x = F.when(is_class, v)
        aggs += [F.count(x).alias(f"n_{tag}"), F.avg(x).alias(f"mean_{tag}"), F.var_samp(x).alias(f"var_{tag}"),
                 F.min(x).alias(f"min_{tag}"), F.max(x).alias(f"max_{tag}")]
    return long.groupBy("feature").agg(*aggs)


def comparable(moments: DataFrame) -> DataFrame:
    """Without features that are empty or constant in a class."""
    return moments.where((F.col("n_r") > 0) & (F.col("n_f") > 0)
                         & (F.col("min_r") < F.col("max_r")) & (F.col("min_f") < F.col("max_f")))


def _nz(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def welch_columns() -> tuple[Column, Column]:
    a, b = F.col("var_r") / F.col("n_r"), F.col("var_f") / F.col("n_f")
    t = (F.col("mean_r") - F.col("mean_f")) / _nz(F.sqrt(a + b))
    df = (a + b) * (a + b) / _nz(a * a / (F.col("n_r") - 1) + b * b / (F.col("n_f") - 1))
    return t, df


def pooled_columns() -> tuple[Column, Column]:
    df = (F.col("n_r") + F.col("n_f") - 2).cast("double")
    s2 = ((F.col("n_r") - 1) * F.col("var_r") + (F.col("n_f") - 1) * F.col("var_f")) / df
    t = (F.col("mean_r") - F.col("mean_f")) / _nz(F.sqrt(s2 * (1 / F.col("n_r") + 1 / F.col("n_f"))))
    return t, df


def anova_column() -> Column:
    """F of two classes from their moments."""
    n1, n2 = F.col("n_r"), F.col("n_f")
    grand = (n1 * F.col("mean_r") + n2 * F.col("mean_f")) / (n1 + n2)
    between = n1 * F.pow(F.col("mean_r") - grand, F.lit(2)) + n2 * F.pow(F.col("mean_f") - grand, F.lit(2))
    within = (n1 - 1) * F.col("var_r") + (n2 - 1) * F.col("var_f")
    return between / _nz(within / (n1 + n2 - 2))


def effect_column() -> Column:
    return (F.col("mean_r") - F.col("mean_f")) / _nz(F.sqrt((F.col("var_r") + F.col("var_f")) / 2))


def welch_t(long: DataFrame) -> DataFrame:
    t, df = welch_columns()
    out = comparable(class_moments(long)).select("feature", t.alias("t_stat"), df.alias("df"))
    return out.withColumn("t_p_val", t_pvalue("t_stat", "df"))


def effect_size(long: DataFrame) -> DataFrame:
    return comparable(class_moments(long)).select("feature", effect_column().alias("effect_size"))


def anova_f(long: DataFrame) -> DataFrame:
    m = comparable(class_moments(long)).select(
        "feature", anova_column().alias("f_stat"), (F.col("n_r") + F.col("n_f") - 2).cast("double").alias("df2"))
    return m.withColumn("f_p_val", f_pvalue("f_stat", F.lit(1.0), "df2"))


def levene(long: DataFrame, label: str = "real_or_fake") -> DataFrame:
    """Equality of variances about the class medians; exact medians, second pass."""
    side = long.where(F.col("value").isNotNull()).select(
        "feature", F.when(F.col(label) == "R", "R").otherwise("F").alias("side"), "value")
    med = exact_quantiles(side, ["feature", "side"], "value", {"median": 0.5})
    z = join_lookup(side, med, ["feature", "side"]).select(
        "feature", F.col("side").alias("real_or_fake"), F.abs(F.col("value") - F.col("median")).alias("value"))
    out = class_moments(z).select("feature", anova_column().alias("levene_stat"),
                                  (F.col("n_r") + F.col("n_f") - 2).cast("double").alias("df2"))
    return out.withColumn("levene_p_val", f_pvalue("levene_stat", F.lit(1.0), "df2")).drop("df2")


def auto_t(long: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Pooled t when Levene keeps equal variances, Welch otherwise."""
    wt, wdf = welch_columns()
    pt, pdf = pooled_columns()
    m = comparable(class_moments(long)).select(
        "feature", wt.alias("welch_t"), wdf.alias("welch_df"), pt.alias("pooled_t"), pdf.alias("pooled_df"))
    equal = F.coalesce(F.col("levene_p_val") > alpha, F.lit(False))
    j = m.join(levene(long), "feature").select(
        "feature", "levene_stat", "levene_p_val", equal.alias("equal_var"),
        F.when(equal, F.col("pooled_t")).otherwise(F.col("welch_t")).alias("t_stat"),
        F.when(equal, F.col("pooled_df")).otherwise(F.col("welch_df")).alias("df"))
    return j.withColumn("t_p_val", t_pvalue("t_stat", "df"))


def rank_sums(counts: DataFrame, group: list[str], value: str) -> DataFrame:
    """Tie-averaged rank sum of the first class from (group, value, n_first, n) rows."""
    cum = running_sums(counts, group, [value], {"_cum": "n"})
    mid = F.col("_cum") - (F.col("n") - 1) / 2
    n = F.col("n").cast("double")
    keys = group or [F.lit(0).alias("_all")]
    return cum.groupBy(*keys).agg(
        F.sum(F.col("n_first") * mid).alias("rank_sum"), F.sum("n_first").alias("n1"),
        F.sum(F.col("n") - F.col("n_first")).alias("n2"), F.sum(n * n * n - n).alias("ties"))


def mann_whitney_u(long: DataFrame, label: str = "real_or_fake") -> DataFrame:
    """U of the real class with tie-corrected normal p; distinct values are counted before ranking."""
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count_if(F.col(label) == "R").alias("n_first"), F.count(F.lit(1)).alias("n"))
    r = rank_sums(counts, ["feature"], "value").where((F.col("n1") > 0) & (F.col("n2") > 0))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    z = F.greatest(F.abs(u - n1 * n2 / 2) - 0.5, F.lit(0.0)) / _nz(sd)
    return (r.select("feature", u.alias("u_stat"), z.alias("_z"))
            .withColumn("u_p_val", normal_pvalue("_z")).drop("_z"))


def normality(long: DataFrame, label: str = "real_or_fake") -> DataFrame:
    """Jarque-Bera per feature and class side."""
    side = F.when(F.col(label) == "R", "R").otherwise("F")
    v = F.col("value")
    m = long.groupBy("feature", side.alias("side")).agg(
        F.count("value").alias("n"), F.when(F.min(v) < F.max(v), F.skewness(v)).alias("skew"),
        F.when(F.min(v) < F.max(v), F.kurtosis(v)).alias("kurt"))
    jb = F.col("n") / 6 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4)
    return m.select("feature", "side", jb.alias("jb_stat"), F.exp(-jb / 2).alias("jb_p_val"))


def compare_classes(df: DataFrame, columns: list[str], label: str = "real_or_fake") -> DataFrame:
    """Welch t, Mann-Whitney U, effect size and ANOVA F for every feature."""
    long = to_long(df, columns, (label,))
    t, dof = welch_columns()
    m = comparable(class_moments(long, label)).select(
        "feature", t.alias("t_stat"), dof.alias("_df"), effect_column().alias("effect_size"),
        anova_column().alias("f_stat"), (F.col("n_r") + F.col("n_f") - 2).cast("double").alias("_df2"))
    return (m.join(mann_whitney_u(long, label), "feature")
            .withColumn("t_p_val", t_pvalue("t_stat", "_df"))
            .withColumn("f_p_val", f_pvalue("f_stat", F.lit(1.0), "_df2"))
            .select("feature", "t_stat", "t_p_val", "u_stat", "u_p_val", "effect_size", "f_stat", "f_p_val"))


def rank_features(tests: DataFrame, n: int, by: tuple[str, str] = ("t_p_val", "u_p_val")) -> DataFrame:
    """Sum of the ranks under two columns, n smallest. One row per feature, so one task is enough."""
    out = tests
    for k, c in enumerate(by):
        w = W.partitionBy(F.lit(0)).orderBy(F.col(c).asc_nulls_last(), "feature")
        out = out.withColumn(f"rank_{k + 1}", F.row_number().over(w))
    return (out.select("feature", "rank_1", "rank_2", (F.col("rank_1") + F.col("rank_2")).alias("rank_sum"))
            .orderBy("rank_sum", "feature").limit(n))


# --- correlation -----------------------------------------------------------

def correlation_matrix(df: DataFrame, columns: list[str], centre: dict[str, float] | None = None) -> DataFrame:
    """Pearson r of every column pair i < j, over rows where both are present; null for a constant.

    Each task adds up its own cross-product matrices and hands on one packed
    row; these are added in two steps, by about as many tasks as the root of
    their number and then by one, and unpacked once. ``centre`` gives column
    means known from an earlier pass.
    """
    centre = centre or df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    mean = np.array([centre[c] if centre[c] is not None else 0.0 for c in columns])
    k = len(columns)
    iu, ju = np.triu_indices(k, 1)

    def partial(batches):
        acc = np.zeros((6, len(iu)))
        for b in batches:
            x = b.to_numpy(np.float64)
            m = ~np.isnan(x)
            z, m = np.where(m, x - mean, 0.0), m.astype(np.float64)
            n, s, q, p = m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z
            acc += np.stack([n[iu, ju], s[iu, ju], s.T[iu, ju], q[iu, ju], q.T[iu, ju], p[iu, ju]])
        yield pd.DataFrame({"part": [acc.tobytes()]})

    def added(batches):
        """One packed row per task; rows stream through, so their number does not matter."""
        acc = None
        for b in batches:
            for raw in b["part"]:
                own = np.frombuffer(raw, np.float64)
                acc = own.copy() if acc is None else acc + own
        if acc is not None:
            yield pd.DataFrame({"part": [acc.tobytes()]})

    def unpacked(batches):
        for b in added(batches):
            acc = np.frombuffer(b["part"][0], np.float64).reshape(6, len(iu))
            yield pd.DataFrame({"i": iu.astype(np.int32), "j": ju.astype(np.int32), "n": acc[0], "sa": acc[1],
                                "sb": acc[2], "qa": acc[3], "qb": acc[4], "p": acc[5]})

    rows = spread_small(df.select(*[F.col(c).cast("double") for c in columns]))
    parts = rows.mapInPandas(partial, "part binary")
    some = max(1, int(np.sqrt(parts.rdd.getNumPartitions())))
    g = parts.repartition(some).mapInPandas(added, "part binary").repartition(1).mapInPandas(
        unpacked, "i int, j int, n double, sa double, sb double, qa double, qb double, p double")
    n = _nz(F.col("n"))
    cov = F.col("p") - F.col("sa") * F.col("sb") / n
    va, vb = F.col("qa") - F.col("sa") * F.col("sa") / n, F.col("qb") - F.col("sb") * F.col("sb") / n
    # a spread below rounding noise of the sums is a constant column
    r = F.when((va > 1e-12 * F.col("qa")) & (vb > 1e-12 * F.col("qb")), cov / _nz(F.sqrt(va * vb)))
    name = F.array(*[F.lit(c) for c in columns])
    return g.select("i", "j", name[F.col("i")].alias("feature_a"), name[F.col("j")].alias("feature_b"), r.alias("r"))
