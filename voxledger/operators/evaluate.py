"""Metrics of scored tables: y and pred are class numbers, p the probability of class 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .scale import running_sums
from .stats import histogram, rank_sums


def _ratio(a: Column, b: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def binary_metrics(df: DataFrame, by: list[str] | None = None, y: str = "y", pred: str = "pred") -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive (fake) class; one aggregation."""
    hit = (F.col(y) == 1) & (F.col(pred) == 1)
    g = df.groupBy(*(by or [])).agg(
        F.count_if(hit).alias("tp"), F.count_if(F.col(pred) == 1).alias("pp"), F.count_if(F.col(y) == 1).alias("ap"),
        F.count_if(F.col(y) == F.col(pred)).alias("ok"), F.count(F.lit(1)).alias("n"))
    p, rc = _ratio(F.col("tp"), F.col("pp")), _ratio(F.col("tp"), F.col("ap"))
    return g.select(*(by or []), _ratio(F.col("ok"), F.col("n")).alias("accuracy"), p.alias("precision"),
                    rc.alias("recall"), _ratio(2 * p * rc, p + rc).alias("f1"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Counts of every (true, predicted) label pair, empty pairs included."""
    counts = df.groupBy(y, pred).agg(F.count(F.lit(1)).alias("n"))
    # the label set is read off the class-by-class counts, not off the rows
    labels = counts.agg(F.array_union(F.collect_set(y), F.collect_set(pred)).alias("labels"))
    grid = labels.select(F.explode("labels").alias(y), "labels").select(y, F.explode("labels").alias(pred))
    return grid.join(counts, [y, pred], "left").select(y, pred, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def class_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    c = df.groupBy(y, pred).agg(F.count(F.lit(1)).alias("n"))
    sides = c.select(F.explode(F.array(
        F.struct(F.col(y).alias("label"), F.when(F.col(y) == F.col(pred), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col(pred).alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")))).alias("s")).select("s.*")
    g = sides.groupBy("label").agg(*[F.sum(x).alias(x) for x in ("tp", "support", "predicted")])
    p, rc = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    return g.select("label", p.alias("precision"), rc.alias("recall"), _ratio(2 * p * rc, p + rc).alias("f1"), "support")


def averaged_metrics(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Macro and support-weighted precision, recall and F1, with accuracy."""
    g = class_report(df, y, pred)
    names = ("precision", "recall", "f1")
    one = g.agg(*[F.avg(m).alias(f"macro_{m}") for m in names],
                *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in names],
                (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"))
    return one


def _score_counts(df: DataFrame, group: list[str], p: str, positive: Column) -> DataFrame:
    return df.where(F.col(p).isNotNull()).groupBy(*group, p).agg(
        F.count_if(positive).alias("n_first"), F.count(F.lit(1)).alias("n"))


def roc_auc(df: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """Rank form of the area, ties count one half; exact at any size."""
    by = by or []
    r = rank_sums(_score_counts(df, by, p, F.col(y) == 1), by, p)
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    auc = (F.col("rank_sum") - n1 * (n1 + 1) / 2) / F.nullif(n1 * n2, F.lit(0.0))
    return r.select(*by, auc.alias("roc_auc"))


def roc_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score from high to low, after (0, 0, inf)."""
    c = _score_counts(df, [], p, F.col(y) == 1).withColumn("n_second", F.col("n") - F.col("n_first"))
    c = c.withColumn("_down", -F.col(p))
    cum = running_sums(c, [], ["_down"], {"tp": "n_first", "fp": "n_second"}, {"ap": "n_first", "an": "n_second"})
    points = cum.select((F.col("fp") / F.nullif("an", F.lit(0))).alias("fpr"),
                        (F.col("tp") / F.nullif("ap", F.lit(0))).alias("tpr"), F.col(p).alias("threshold"))
    start = df.sparkSession.range(1).select(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                                            F.lit(float("inf")).alias("threshold"))
    return start.union(points)


def one_vs_rest_auc(df: DataFrame, classes: list[int], y: str = "y", prefix: str = "p") -> DataFrame:
    """AUC per class plus macro and support-weighted rows."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(str(k)).alias("label"), (F.col(y) == k).cast("int").alias("y"), F.col(f"{prefix}{k}").alias("p"))
        for k in classes])).alias("s")).select("s.*")
    r = rank_sums(_score_counts(long, ["label"], "p", F.col("y") == 1), ["label"], "p")
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    # one row per class, read twice below
    per = checkpointed(r.select("label", ((F.col("rank_sum") - n1 * (n1 + 1) / 2) / F.nullif(n1 * n2, F.lit(0.0))).alias("roc_auc"), "n1"))
    total = per.agg(F.avg("roc_auc").alias("macro"),
                     (F.sum(F.col("roc_auc") * F.col("n1")) / F.sum("n1")).alias("weighted"))
    return per.select("label", "roc_auc").union(
        total.unpivot([], ["macro", "weighted"], "label", "roc_auc"))


def calibration_curve(df: DataFrame, bins: int = 9, y: str = "y", p: str = "p") -> DataFrame:
    """Share of positives in equal bins (lo, hi] between the least and the largest score.

    Rows at the minimum fall in no bin; an empty bin has a null share.
    """
    e = df.agg(F.min(p).alias("lo"), F.max(p).alias("hi")).first()  # one row
    lo, hi = e["lo"], e["hi"]
    edges = [lo + (hi - lo) / bins * k for k in range(bins)] + [hi]
    b = F.lit(None).cast("int")
    for k in range(bins):
        b = F.when((F.col(p) > edges[k]) & (F.col(p) <= edges[k + 1]), k).otherwise(b)
    got = df.select(b.alias("bin"), y).where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.avg(F.col(y).cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.createDataFrame(
        [(k, (edges[k] + edges[k + 1]) / 2) for k in range(bins)], "bin int, midpoint double")
    return grid.join(got, "bin", "left").select("bin", "midpoint", "share", F.coalesce("n", F.lit(0)).alias("n"))


def probability_histograms(df: DataFrame, bins: int = 20, threshold: float = 0.5, y: str = "y", p: str = "p") -> DataFrame:
    """Density histograms of the scores of right and of wrong rows."""
    right = (F.col(p) >= threshold).cast("int") == F.col(y)
    return histogram(df.select(F.when(right, "right").otherwise("wrong").alias("outcome"), p), p, bins, "outcome")


def linear_shap(df: DataFrame, weights: dict[str, float], keep: tuple[str, ...] = ("audio_id",)) -> DataFrame:
    """phi_j = w_j (x_j - mean_j) per row, wide; the means are one row."""
    m = df.agg(*[F.avg(c).alias(c) for c in weights]).first()
    return df.select(*keep, *[(F.lit(float(w)) * (F.col(c) - m[c])).alias(c) for c, w in weights.items()])


def shap_ranking(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Mean |phi| per feature, in one aggregation."""
    phi = linear_shap(df, weights, ())
    one = phi.agg(*[F.avg(F.abs(c)).alias(c) for c in weights])
    return one.unpivot([], list(weights), "feature", "mean_abs_shap")


def confidence_band(df: DataFrame, p: str = "p") -> DataFrame:
    """p > 0.5 -> Real; confidence max(p, 1 - p): High above 0.8, Low below 0.3, else Moderate."""
    c = F.greatest(F.col(p), 1 - F.col(p))
    return df.select("*", F.when(F.col(p) > 0.5, "Real").otherwise("Fake").alias("result"), c.alias("confidence_value"),
                     F.when(c > 0.8, "High").when(c < 0.3, "Low").otherwise("Moderate").alias("confidence"))
