"""Two-sample drift between the training table and a new batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.special import ks_pvalue
from ..session import checkpointed
from ..sources import store
from ..sources.recordings import scan_ids
from .scale import running_sums
from .stats import to_long


def ks_from_counts(counts: DataFrame, p_limit: float = 0.03) -> DataFrame:
    """KS from (feature, value, n_train, n_new) rows."""
    cum = running_sums(counts, ["feature"], ["value"], {"c_train": "n_train", "c_new": "n_new"},
                       {"t_train": "n_train", "t_new": "n_new"}).where((F.col("t_train") > 0) & (F.col("t_new") > 0))
    gap = F.abs(F.col("c_train") / F.col("t_train") - F.col("c_new") / F.col("t_new"))
    d = cum.groupBy("feature", "t_train", "t_new").agg(F.max(gap).alias("ks_statistic"))
    p = ks_pvalue(F.col("ks_statistic"), F.col("t_train"), F.col("t_new"))
    return d.select("feature", "ks_statistic", p.alias("p_value")).withColumn("drifted", F.col("p_value") < p_limit)


def side_counts(long: DataFrame) -> DataFrame:
    """(side, feature, value) -> counts per distinct value; combined on the map side."""
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(
        F.count_if(F.col("side") == "train").alias("n_train"), F.count_if(F.col("side") == "new").alias("n_new"))


def ks_drift_long(long: DataFrame, p_limit: float = 0.03) -> DataFrame:
    return ks_from_counts(side_counts(long), p_limit)


def ks_drift(train: DataFrame, new: DataFrame, columns: list[str] | None = None, p_limit: float = 0.03,
             name_rule: Callable[[str], bool] = lambda c: "mean" in c) -> DataFrame:
    """Per feature: largest gap of the two distribution functions, asymptotic p, and a drift flag.

    Both tables must have gone through the same fitted preparation.
    """
    cols = columns or [c for c in train.columns if name_rule(c) and c in new.columns]
    both = (train.select(F.lit("train").alias("side"), *cols)
            .unionByName(new.select(F.lit("new").alias("side"), *cols)))
    return ks_drift_long(to_long(both, cols, ("side",)), p_limit)


# --- against a training profile that is written once

#: Distinct training values of one block, unless there are so many that the index would pass ``INDEX_ROWS``.
BLOCK_VALUES = 4096
#: Blocks of all features together; their first values are held by the driver and every task.
INDEX_ROWS = 200_000


BLOCKS = "block string, feature string, `values` array<double>, upto array<bigint>, before bigint, t_train bigint"


@dataclass(frozen=True)
class Profile:
    """Cumulative counts of the training values in blocks of neighbouring values.

    ``blocks`` has a row per block: ``block``, ``values`` in order, ``upto`` (training
    rows up to each value), ``before`` (those below the first one) and ``t_train``. ``index`` has by feature the first
    value and the name of each block, in order.
    """

    blocks: DataFrame
    index: dict[str, tuple[np.ndarray, list[str]]]


def save_profile(train_long: DataFrame, path: str, buckets: int = 64, block_values: int = BLOCK_VALUES) -> None:
    """Count (feature, value) rows once and store the running counts by blocks; null and NaN count as missing."""
    counts = (train_long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("n"), F.lit(1).cast("long").alias("one")))
    cum = checkpointed(running_sums(counts, ["feature"], ["value"], {"upto": "n", "pos": "one"}, {"t_train": "n"}))
    size = max(block_values, -(-cum.count() // INDEX_ROWS) * 2)
    block = F.concat_ws("|", F.floor((F.col("pos") - 1) / size).cast("string"), F.col("feature"))
    rows = cum.groupBy("feature", block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("value", "upto"))).alias("v"), F.min(F.col("upto") - F.col("n")).alias("before"),
        F.max("t_train").alias("t_train"))
    blocks = rows.select("block", "feature", F.col("v.value").cast("array<double>").alias("values"), F.col("v.upto").alias("upto"), "before", "t_train")
    written = store.write_store(blocks, f"{path}/blocks", buckets, "block")
    written.select("feature", "block", F.get("values", F.lit(0)).alias("first")).write.mode("overwrite").parquet(f"{path}/index")


def open_profile(spark: SparkSession, path: str, buckets: int = 64) -> Profile:
    index: dict[str, tuple[np.ndarray, list[str]]] = {}
    rows = spark.read.schema("feature string, block string, first double").parquet(f"{path}/index").limit(2 * INDEX_ROWS).toPandas()
    for feature, part in rows.groupby("feature"):
        part = part.sort_values("first")
        index[feature] = part["first"].to_numpy(np.float64), part["block"].tolist()
    return Profile(store.open_store(spark, f"{path}/blocks", buckets, "block", BLOCKS), index)


def ks_against_profile(new_long: DataFrame, profile: Profile, p_limit: float = 0.03) -> DataFrame:
    """The report of ``ks_drift_long`` for new (feature, value) rows; features without training values have none.

    The distribution function of the new rows jumps at their own values only, so
    the largest gap lies at one of these or just before it. Each distinct new
    value therefore reads its own block: what is shuffled follows the new rows,
    and only the blocks that they touch are read while these are few.
    """
    index = profile.index

    @F.pandas_udf("string")
    def block_of(feature: pd.Series, value: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(feature), index=feature.index, dtype=object)
        for f, at in feature.groupby(feature).groups.items():
            if f in index:
                first, names = index[f]
                place = np.maximum(np.searchsorted(first, value.loc[at].to_numpy(), "right") - 1, 0)
                out.loc[at] = [names[k] for k in place]
        return out

    @F.pandas_udf("double")
    def gap(values: pd.Series, upto: pd.Series, t_train: pd.Series, new: pd.Series, c_new: pd.Series, n_new: pd.Series, t_new: pd.Series,
            before: pd.Series) -> pd.Series:
        out = []
        for v, u, t, x, c, n, m, b in zip(values, upto, t_train, new, c_new, n_new, t_new, before):
            counts = np.concatenate([[b], u])
            here, below = counts[np.searchsorted(v, x, "right")], counts[np.searchsorted(v, x, "left")]
            c, n = np.asarray(c), np.asarray(n)
            out.append(max(np.abs(here / t - c / m).max(), np.abs(below / t - (c - n) / m).max()))
        return pd.Series(out, dtype=float)

    new = (new_long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", F.col("value").cast("double").alias("value"))
           .agg(F.count(F.lit(1)).alias("n_new"), F.lit(1).cast("long").alias("one")))
    cum = running_sums(new, ["feature"], ["value"], {"c_new": "n_new", "pos": "one"}, {"t_new": "n_new"})
    placed = cum.withColumn("block", block_of("feature", "value")).where(F.col("block").isNotNull())
    # at most BLOCK_VALUES values in a row, however many fall into one block
    groups = checkpointed(placed.groupBy("feature", "block", "t_new", F.floor((F.col("pos") - 1) / BLOCK_VALUES).alias("_part")).agg(
        F.array_sort(F.collect_list(F.struct("value", "c_new", "n_new"))).alias("x")))
    blocks = scan_ids(profile.blocks, groups.select("block"), "block").drop("feature")
    both = groups.join(blocks, "block")
    gaps = both.withColumn("_gap", gap("values", "upto", "t_train", "x.value", "x.c_new", "x.n_new", "t_new", "before"))
    d = gaps.groupBy("feature", "t_train", "t_new").agg(F.max("_gap").alias("ks_statistic"))
    p = ks_pvalue(F.col("ks_statistic"), F.col("t_train"), F.col("t_new"))
    return d.select("feature", "ks_statistic", p.alias("p_value")).withColumn("drifted", F.col("p_value") < p_limit)


def drift_summary(report: DataFrame, batch: int | None = None) -> DataFrame:
    """Drifted features of a batch, or one row saying there are none."""
    report = checkpointed(report)  # one row per feature, read twice below
    n = F.lit(batch).cast("bigint").alias("batch")
    rows = report.where("drifted").select(n, F.lit("drift").alias("status"), "feature", "ks_statistic", "p_value")
    none = (report.agg(F.count_if("drifted").alias("k")).where("k = 0")
            .select(n, F.lit("no drift").alias("status"), F.lit(None).cast("string").alias("feature"),
                    F.lit(None).cast("double").alias("ks_statistic"), F.lit(None).cast("double").alias("p_value")))
    return rows.union(none)
