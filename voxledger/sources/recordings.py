"""Manifests, scans and sinks for recordings and their shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.scale import global_position, join_lookup

# Directory of the second corpus -> label.
WAVE_DIR_LABELS = {
    "ljspeech_melgan": "WF1",
    "ljspeech_full_band_melgan": "WF2",
    "ljspeech_hifiGAN": "WF3",
    "ljspeech_melgan_large": "WF4",
    "ljspeech_multi_band_melgan": "WF5",
    "ljspeech_parallel_wavegan": "WF6",
    "ljspeech_waveglow": "WF7",
    "LJSpeech-1.1/wavs": "R",
}


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def manifest_by_prefix(paths: DataFrame, path: str = "path") -> DataFrame:
    """path -> audio_id (parent directory) and label (first 3 characters of an F0 file)."""
    parts = F.split(F.col(path), "/")
    name, parent = F.element_at(parts, -1), F.element_at(parts, -2)
    label = F.when(name.startswith("F0"), F.substring(name, 1, 3)).otherwise("R")
    return (paths.select(F.col(path), parent.alias("audio_id"), label.alias("real_or_fake"))
            .where(~F.col("audio_id").startswith("SSB")))


def manifest_by_dir(paths: DataFrame, mapping: dict[str, str] | None = None,
                    path: str = "path") -> DataFrame:
    """Label from the directory below ``generated_audio`` or the real ``wavs`` folder."""
    labels = mapping or WAVE_DIR_LABELS
    lookup = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    folder = F.regexp_extract(F.col(path), r"(LJSpeech-1\.1/wavs|[^/]+)/[^/]+$", 1)
    audio_id = base_name(F.col(path))
    for cut in ("_generated", "_gen", ".wav"):
        audio_id = F.replace(audio_id, F.lit(cut), F.lit(""))
    return (paths.select(F.col(path), audio_id.alias("audio_id"),
                         F.try_element_at(lookup, folder).alias("real_or_fake"))
            .where(F.col("real_or_fake").isNotNull()))


def scan_partition(df: DataFrame, partition_id: int) -> DataFrame:
    """One shard; prunes files when the table is stored partitioned by partition_id."""
    return df.where(F.col("partition_id") == partition_id)


#: Ids up to which an id table becomes a filter, which files and buckets are selected by.
FILTER_IDS = 1_000


def scan_ids(df: DataFrame, ids: str | list[str] | DataFrame, id_col: str = "audio_id") -> DataFrame:
    """Rows of one id, of a list of ids, or of the first column of an id table; null ids match nothing.

    On a table of ``store`` a filter selects buckets and row groups. A small id
    table is turned into such a filter, a larger one is a semi-join, for which
    the bucketed side is not shuffled.
    """
    if isinstance(ids, DataFrame):
        table = ids.select(F.col(ids.columns[0]).alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
        few = table.limit(FILTER_IDS + 1).collect()
        if len(few) > FILTER_IDS:
            return join_lookup(df, table, id_col, "left_semi")
        ids = [r[0] for r in few]
    return df.where(F.col(id_col).isin([ids] if isinstance(ids, str) else ids))


def scan_dataset(df: DataFrame, name: str, known: tuple[str, ...]) -> DataFrame:
    if name not in known:
        raise ValueError(f"unknown corpus {name!r}; known: {', '.join(known)}")
    return df.where(F.col("corpus") == name)


def list_ids(df: DataFrame, *, ids: list[str] | None = None, indices: list[int] | None = None,
             first_n: int | None = None, last_n: int | None = None, random_n: int | None = None,
             seed: int = 0, id_col: str = "audio_id") -> DataFrame:
    """Distinct ids in id order: all, by position, from either end or a seeded pick."""
    distinct = df.select(id_col).distinct()
    if ids is not None:
        return distinct.where(F.col(id_col).isin(ids))
    if indices is not None:
        return global_position(distinct, [id_col]).where(F.col("pos").isin(indices)).select(id_col)
    if first_n is not None:
        return distinct.orderBy(id_col).limit(first_n)
    if last_n is not None:
        return distinct.orderBy(F.col(id_col).desc()).limit(last_n)
    if random_n is not None:
        key = F.md5(F.concat(F.col(id_col), F.lit(f"|{seed}")))
        return distinct.orderBy(key, id_col).limit(random_n)
    return distinct


def even_shard_size(n_ids: Column, low: int, high: int) -> Column:
    """The largest shard size in the range that cuts ``n_ids`` evenly, null if none does."""
    fits = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda size: F.pmod(n_ids, size) == 0)
    return F.array_max(fits)


def assign_shards(df: DataFrame, low: int = 90, high: int = 110, id_col: str = "audio_id") -> DataFrame:
    """Add partition_id: ids in id order, cut into equal shards; an id stays whole."""
    ids = df.select(id_col).distinct()
    n, size = ids.agg(F.count(F.lit(1)).alias("n")).select("n", even_shard_size(F.col("n"), low, high)).first()
    if size is None:
        raise ValueError(f"{n} ids cannot be cut into even shards of {low} to {high}")
    shard = (global_position(ids, [id_col])
             .select(id_col, F.floor(F.col("pos") / size).alias("partition_id")))
    return df.join(shard, id_col)


def write_shards(df: DataFrame, path: str, pieces: int = 16) -> None:
    """One folder per shard, so scan_partition reads only its own files.

    Rows of a shard go to up to ``pieces`` tasks by a hash of the row, so a
    shard or an id with most of the rows is not written by one task.
    """
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
    (df.repartition("partition_id", piece).write.mode("overwrite")
     .partitionBy("partition_id").option("maxRecordsPerFile", 100_000).parquet(path))


def parse_label_file(lines: DataFrame, col: str = "value") -> DataFrame:
    """'name real|fake type' -> columns; real_file drops the Fxx_ part of a typed fake."""
    p = F.split(F.trim(F.col(col)), r"\s+")
    name, label, kind = F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(2))
    real = F.when(label == "real", name).when((label == "fake") & (kind != "0"), F.substr(name, F.lit(5)))
    return lines.where(F.trim(F.col(col)) != "").select(
        name.alias("file"), label.alias("label"), kind.alias("kind"), real.alias("real_file"))


def verify_checksums(files: DataFrame, expected: DataFrame, content: str = "content",
                     key: str = "path") -> DataFrame:
    """ok / mismatch / missing for every expected file."""
    have = files.select(key, F.md5(F.col(content)).alias("md5"))
    status = (F.when(F.col("md5").isNull(), "missing")
              .when(F.col("md5") == F.col("expected_md5"), "ok").otherwise("mismatch"))
    return expected.join(have, key, "left").select(key, status.alias("status"))


def flatten_examples(df: DataFrame) -> DataFrame:
    """Nested example -> signal table."""
    return df.select("audio_id", F.col("audio.array").alias("samples"),
                     F.col("audio.sampling_rate").alias("sampling_rate"), "real_or_fake")


def resume_shards(source: DataFrame, done: DataFrame, by: str = "partition_id") -> DataFrame:
    """Input rows of the shards whose output row count differs from the input's."""
    a = source.groupBy(by).agg(F.count(F.lit(1)).alias("n_in"))
    b = done.groupBy(by).agg(F.count(F.lit(1)).alias("n_out"))
    todo = (a.join(b, by, "full_outer")
            .where(~F.col("n_in").eqNullSafe(F.col("n_out"))).select(by))
    return join_lookup(source, todo, by, "left_semi")


def batch_number(path: Column) -> Column:
    """.../x_iteration_N.csv -> N - 1, null for other names."""
    n = F.regexp_extract(path, r"iteration_(?:.*_)?(\d+)\.[^_/]*$", 1)
    return F.nullif(n, F.lit("")).cast("bigint") - 1


def training_iteration(names: DataFrame, base: str, col: str = "name", ext: str = "csv") -> DataFrame:
    """Number of numbered backups of base.csv; the live file itself does not count."""
    backup = F.col(col).rlike(rf"^{base}_*\d+\.{ext}$")
    return names.agg(F.count_if(backup).alias("training_iteration"))


def id_file_map(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON {id: {train: url}} -> (audio_id, url)."""
    parsed = F.from_json(F.col(col), "map<string,struct<train:string>>")
    return lines.select(F.explode(parsed).alias("audio_id", "v")).select("audio_id", F.col("v.train").alias("url"))


def read_recordings(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path))
