"""Projections, filters, joins, order and splits over recordings and feature tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .scale import join_lookup, position_in_group, running_sums
from ..sources.recordings import base_name

# Expected sampling rate by speaker family and version.
RATE_MAP = {
    "p": {"R": 48000, "F01": 16000, "F02": 16000, "F03": 16000, "F04": 24000, "F05": 48000, "F06": 16000},
    "SSB": {"R": 44100, "F01": 16000, "F02": 16000, "F03": 16000, "F04": 24000, "F05": 48000, "F06": 24000},
}


def binary_target(df: DataFrame, label: str = "real_or_fake") -> DataFrame:
    return df.withColumn("target", F.when(F.col(label) == "R", 0).otherwise(1))


def class_index(df: DataFrame, label: str = "real_or_fake", real_first: bool = True) -> DataFrame:
    """Label -> 0..k in sorted order, R first unless ``real_first`` is off.

    The distinct labels are few; a one-partition window over them is enough.
    """
    order = [F.col(label) != "R", F.col(label)] if real_first else [F.col(label)]
    w = W.partitionBy(F.lit(0)).orderBy(*order)
    index = df.select(label).distinct().select(label, (F.row_number().over(w) - 1).alias("class_index"))
    return join_lookup(df, index, label)


def collapse_labels(df: DataFrame, mode: str = "prefix", label: str = "real_or_fake") -> DataFrame:
    """``prefix``: F.. -> F, other labels stay; ``non_real``: everything but R -> F."""
    if mode == "prefix":
        new = F.when(F.col(label).startswith("F"), "F").otherwise(F.col(label))
    elif mode == "non_real":
        new = F.when(F.col(label) == "R", "R").otherwise("F")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn(label, new)


def real_vs(df: DataFrame, version: str, label: str = "real_or_fake") -> DataFrame:
    return df.where(F.col(label).isin("R", version))


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = ("audio_id", "real_or_fake", "target")) -> list[str]:
    """Names of the numeric columns that are not id or label."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, T.NumericType)]


def drop_missing_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls per column, and in total; a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    return counts.select("*", total.alias("total"))


def complete_columns(df: DataFrame) -> list[str]:
    row = null_counts(df).first()
    return [c for c in df.columns if row[c] == 0]


def drop_missing_columns(df: DataFrame) -> DataFrame:
    return df.select(*complete_columns(df))


def filter_rows(df: DataFrame, *, not_prefix: str | None = None, nonzero: str | None = None,
                contains: tuple[str, str] | None = None, id_col: str = "audio_id") -> DataFrame:
    """Any of: id without a prefix, value other than zero, case-blind substring."""
    if not_prefix is not None:
        df = df.where(~F.col(id_col).startswith(not_prefix))
    if nonzero is not None:
        df = df.where(F.col(nonzero) != 0)
    if contains is not None:
        df = df.where(F.lower(contains[0]).contains(contains[1].lower()))
    return df


def _real_path(path: Column) -> Column:
    name = base_name(path)
    return F.when(name.startswith("F0"), F.concat(F.lit("train/"), F.substr(name, F.lit(5))))


def pair_real_fake(paths: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(fake file, its real file) pairs, and fakes whose real file is absent."""
    fakes = paths.select(F.col(path).alias("fake_path"), _real_path(F.col(path)).alias("real_path")).where(
        F.col("real_path").isNotNull())
    reals = paths.select(F.col(path).alias("real_path")).where(_real_path(F.col("real_path")).isNull())
    return (fakes.join(reals.distinct(), "real_path"),
            fakes.join(reals, "real_path", "left_anti").select("fake_path"))


def pair_duration_diff(signals: DataFrame) -> DataFrame:
    """|duration(real) - duration(fake)| for every fake with a real recording of its id."""
    d = signals.select("audio_id", "real_or_fake",
                       (F.size("samples") / F.col("sampling_rate")).alias("duration"))
    real = d.where(F.col("real_or_fake") == "R").groupBy("audio_id").agg(F.first("duration").alias("real_duration"))
    fake = d.where(F.col("real_or_fake") != "R")
    return fake.join(real, "audio_id").select(
        "audio_id", "real_or_fake", F.abs(F.col("real_duration") - F.col("duration")).alias("duration_diff"))


def pair_completeness(df: DataFrame, fakes: int = 6, rows: int | None = None) -> DataFrame:
    """Ids with a real recording whose fake count is off, or (rows=) whose row count is off."""
    g = df.groupBy("audio_id").agg(
        F.count_if(F.col("real_or_fake") != "R").alias("n_fake"), F.count(F.lit(1)).alias("n_rows"),
        F.max(F.col("real_or_fake") == "R").alias("has_real"))
    bad = (F.col("n_rows") != rows) if rows is not None else (F.col("has_real") & (F.col("n_fake") != fakes))
    return g.where(bad).select("audio_id", "n_fake", "n_rows")


def sampling_rate_conformity(files: DataFrame, expected: dict[str, dict[str, int]] | None = None,
                             path: str = "path", rate: str = "rate") -> DataFrame:
    """Files whose rate differs from the one expected for speaker family and version."""
    spec = expected or RATE_MAP
    name = base_name(F.col(path))
    fake = name.startswith("F0")
    version = F.when(fake, F.substring(name, 1, 3)).otherwise("R")
    speaker = F.when(fake, F.substr(name, F.lit(5))).otherwise(name)
    family = F.lit(None).cast("string")
    for f in spec:
        family = F.when(speaker.startswith(f), f).otherwise(family)
    lookup = F.create_map(*[x for f, m in spec.items() for v, r in m.items()
                            for x in (F.lit(f"{f}|{v}"), F.lit(r))])
    return (files.select(path, rate, F.try_element_at(lookup, F.concat(family, F.lit("|"), version)).alias("expected"))
            .where(F.col("expected").isNotNull() & (F.col(rate) != F.col("expected"))))


def sort_real_first(df: DataFrame, *then: str, label: str = "real_or_fake") -> DataFrame:
    return df.orderBy(F.col(label) != "R", label, *then)


def sort_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Real p files, real SSB files, then fakes; by name inside each."""
    name = base_name(F.col(path))
    rank = F.when(name.startswith("p"), 0).when(name.startswith("SSB"), 1).when(name.startswith("F0"), 2)
    return files.withColumn("family", rank).where(F.col("family").isNotNull()).orderBy("family", path)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(by).desc(), tie).limit(k)


def sample_per_shard(df: DataFrame, n: int, by: str = "partition_id", id_col: str = "audio_id",
                     seed: int = 0) -> DataFrame:
    """n rows of each shard by hash order.

    The rank filter is applied inside each map task first, so a hot shard
    sends at most n rows per task over the network.
    """
    key = F.md5(F.concat(F.col(id_col), F.lit(f"|{seed}")))
    w = W.partitionBy(by).orderBy("_key", id_col)
    return (df.withColumn("_key", key).withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") <= n).drop("_key", "_rank"))


def _unit_hash(key: Column, seed: int) -> Column:
    """Uniform in [0, 1) from the first 8 hex digits of md5."""
    h = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def hash_split(df: DataFrame, frac: float = 0.2, seed: int = 42, group_col: str = "audio_id") -> DataFrame:
    """Add ``is_test``; all rows of one group value fall on the same side. No shuffle."""
    return df.withColumn("is_test", _unit_hash(F.col(group_col), seed) < frac)


def stratified_split(df: DataFrame, frac: float = 0.2, seed: int = 42, label: str = "real_or_fake",
                     id_col: str = "audio_id") -> DataFrame:
    """Add ``is_test``: exactly round(frac * n) rows of every class, by hash order.

    A class may hold most rows, so rows are ranked inside (class, hash prefix).
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))
    keyed = df.withColumn("_h", h).withColumn("_prefix", F.substring("_h", 1, 4))
    ranked = position_in_group(keyed, [label], "_prefix", ["_h", id_col], "_pos")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return (join_lookup(ranked, sizes, label)
            .withColumn("is_test", F.col("_pos") < F.round(F.col("_n") * frac))
            .select(*df.columns, "is_test"))


def grouped_stratified_split(df: DataFrame, group_col: str, frac: float = 0.2, seed: int = 42,
                             label: str = "real_or_fake") -> DataFrame:
    """Add ``is_test``: whole groups, and per stratum ``frac`` of the rows but for half a group.

    A group belongs to the stratum of its commonest class (of equal ones the
    smallest). The groups of a stratum follow each other in hash order, and a
    group is test when the middle of its rows lies below the wanted share. Where
    a group holds one class, strata are classes. Rows without group are one group.

    Rows are counted per group and class first; only groups are ordered.
    """
    marked = df.withColumn("_h", F.coalesce(F.md5(F.concat(F.col(group_col).cast("string"), F.lit(f"|{seed}"))), F.lit("")))
    per_class = marked.groupBy("_h", label).agg(F.count(F.lit(1)).alias("_c"))
    groups = per_class.groupBy("_h").agg(
        F.sum("_c").alias("_n"), F.min(F.struct(-F.col("_c"), F.col(label).alias("stratum")))["stratum"].alias("_stratum"))
    placed = running_sums(groups, ["_stratum"], ["_h"], {"_cum": "_n"}, {"_total": "_n"})
    side = placed.select("_h", (2 * F.col("_cum") - F.col("_n") < F.lit(2 * frac) * F.col("_total")).alias("is_test"))
    return join_lookup(marked, side, "_h").select(*df.columns, "is_test")


def align_columns(df: DataFrame, selected: list[str], keep: tuple[str, ...] = ("audio_id", "real_or_fake")) -> DataFrame:
    absent = [c for c in selected if c not in df.columns]
    if absent:
        raise ValueError(f"missing feature columns: {', '.join(absent)}")
    return df.select(*[c for c in keep if c in df.columns], *selected)


def extract_urls(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per href="..." value."""
    return df.select(*keep, F.explode(F.regexp_extract_all(html, F.lit('href="([^"]+)"'), 1)).alias("url"))


def one_hot(df: DataFrame, classes: list[str], label: str = "real_or_fake") -> DataFrame:
    return df.select("*", *[F.when(F.col(label) == c, 1).otherwise(0).alias(f"is_{c}") for c in classes])


def distinct_labels(df: DataFrame, label: str = "real_or_fake") -> list[str]:
    """The label list; a few values by definition of a class column."""
    return sorted(r[0] for r in df.select(label).distinct().collect())


def join_feature_groups(first: DataFrame, *others: DataFrame, on: tuple[str, ...] = ("audio_id",)) -> DataFrame:
    """Feature groups of the same recordings side by side; repeated names get _2, _3, ..."""
    out = first
    for k, other in enumerate(others, start=2):
        taken = set(out.columns)
        renamed = other.select(*[
            F.col(c) if c in on or c not in taken else F.col(c).alias(f"{c}_{k}") for c in other.columns])
        out = out.join(renamed, list(on))
    return out


def select_versions(df: DataFrame, audio_id: str, indices: list[int]) -> DataFrame:
    wanted = ["R"] + [f"F{i:02d}" for i in indices]
    return df.where((F.col("audio_id") == audio_id) & F.col("real_or_fake").isin(wanted))
