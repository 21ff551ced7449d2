"""Append-only run table, promotion rules and report tables."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .evaluate import binary_metrics, roc_auc


def current_runs(log: DataFrame) -> DataFrame:
    """Newest row of every run name."""
    cols = [c for c in log.columns if c != "run_name"]
    newest = log.groupBy("run_name").agg(F.max_by(F.struct(*cols), F.struct("ts", "run_id")).alias("r"))
    return newest.select("run_name", "r.*")


def upsert_run(log: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows to append: an entry of a known run name resumes its run, any other starts one.

    ``entries`` has run_name, ts and whatever metric, parameter and tag columns
    the log has; the log itself is never rewritten.
    """
    known = current_runs(log).select("run_name", F.col("run_id").alias("_id"))
    first = entries.groupBy("run_name").agg(F.min("ts").alias("_t0"))
    fresh = F.substring(F.md5(F.concat_ws("|", "run_name", F.date_format("_t0", "yyyy-MM-dd HH:mm:ss"))), 1, 12)
    return (entries.join(first, "run_name").join(known, "run_name", "left")
            .select(*entries.columns, F.coalesce("_id", fresh).alias("run_id"), F.col("_id").isNotNull().alias("resumed")))


def has_staged(versions: DataFrame, models: list[str]) -> DataFrame:
    """One row: is any version of the given models staged?"""
    hit = F.col("model").isin(models) & (F.col("stage") == "Staging")
    return versions.agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias("has_staged"))


def promote_to_staging(versions: DataFrame, metric: str = "auc") -> DataFrame:
    """The newest version of a model moves to Staging when it is at least as good as all
    others, or when no version of the model has left stage None yet."""
    scored = versions.where(F.col(metric).isNotNull())
    newest = scored.groupBy("model").agg(
        F.max("version").alias("_newest"), F.max_by(metric, "version").alias("_metric"),
        F.bool_or(F.col("stage") != "None").alias("_staged_once"))
    others = (scored.join(newest.select("model", "_newest"), "model").where(F.col("version") != F.col("_newest"))
              .groupBy("model").agg(F.max(metric).alias("_best")))
    rule = newest.join(others, "model", "left").select(
        "model", "_newest", (~F.col("_staged_once") | F.coalesce(F.col("_metric") >= F.col("_best"), F.lit(True))).alias("_go"))
    stage = F.when(F.col("_go") & (F.col("version") == F.col("_newest")), "Staging").otherwise(F.col("stage"))
    return versions.join(rule, "model", "left").select(*[stage.alias("stage") if c == "stage" else c for c in versions.columns])


def promote_to_production(versions: DataFrame, models: list[str] | None = None, metric: str = "auc") -> DataFrame:
    """The best of each model's newest staged version moves to Production."""
    staged = versions.where((F.col("stage") == "Staging") & F.col(metric).isNotNull())
    if models is not None:
        staged = staged.where(F.col("model").isin(models))
    newest = staged.groupBy("model").agg(F.max("version").alias("version"), F.max_by(metric, "version").alias("_m"))
    best = newest.orderBy(F.col("_m").desc(), "model").limit(1).select("model", "version", F.lit(True).alias("_win"))
    stage = F.when(F.col("_win"), "Production").otherwise(F.col("stage"))
    return versions.join(best, ["model", "version"], "left").select(
        *[stage.alias("stage") if c == "stage" else c for c in versions.columns])


def compare_runs(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(metric, value) of two runs side by side; a missing side stays null."""
    c, p = current.withColumnRenamed("value", "current"), previous.withColumnRenamed("value", "previous")
    return c.join(p, "metric", "full_outer").select(
        "metric", "current", "previous", (F.col("current") - F.col("previous")).alias("change"))


def evaluate_staged(rows: DataFrame) -> DataFrame:
    """previous_version_* metrics of every staged model from rows of (model, y, p, pred)."""
    rows = checkpointed(rows)  # scored once, counted twice
    m = binary_metrics(rows, ["model"]).join(roc_auc(rows, ["model"]), "model")
    names = {"accuracy": "accuracy", "precision": "precision", "recall": "recall", "f1": "f1_score", "roc_auc": "roc_auc_score"}
    return m.select("model", *[F.col(a).alias(f"previous_version_{b}") for a, b in names.items()])


def latest_run(log: DataFrame, run_name: str) -> DataFrame:
    """Newest row of one run name."""
    return log.where(F.col("run_name") == run_name).orderBy(F.col("ts").desc(), F.col("version").desc()).limit(1)


def run_date() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")
