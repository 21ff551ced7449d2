"""Feature tables: read, write, union; predictions; fitted state."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

ID_COLUMNS = ("audio_id", "real_or_fake", "target")


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN -> null in double columns; drops the stray index column."""
    return df.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields if f.name != "Unnamed: 0"])


def read_features(spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None,
                  fmt: str = "csv") -> DataFrame:
    """Feature table from CSV (schema given, or taken from the header as doubles) or Parquet.

    CSV columns bind by position, so the declared schema must follow the file.
    """
    if fmt != "csv":
        return missing_to_null(spark.read.format(fmt).load(path))
    reader = spark.read.option("header", "true").option("nanValue", "NaN")
    if schema is None:
        names = reader.csv(path).columns
        schema = T.StructType([T.StructField(
            n, T.StringType() if n in ("audio_id", "real_or_fake") else T.DoubleType()) for n in names])
    return missing_to_null(reader.schema(schema).csv(path))


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    w.option("header", "true").csv(path) if fmt == "csv" else w.format(fmt).save(path)


def union_features(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def union_feature_files(spark: SparkSession, dirs: list[str], fmt: str = "parquet") -> DataFrame:
    return union_features([read_features(spark, d, fmt=fmt) for d in dirs])


def predictions(scored: DataFrame) -> DataFrame:
    return scored.select("audio_id", "real_or_fake",
                         F.col("pred").cast("bigint").alias("predicted"), F.col("p").alias("probability"))


def write_predictions(scored: DataFrame, path: str) -> None:
    predictions(scored).write.mode("overwrite").parquet(path)


def save_pipeline(model: PipelineModel, selected: list[str], path: str, spark: SparkSession) -> None:
    """Fitted stages plus the ordered list of kept columns."""
    model.write().overwrite().save(f"{path}/stages")
    (spark.createDataFrame(list(enumerate(selected)), "pos int, feature string")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/selected_features"))


def load_pipeline(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    rows = spark.read.parquet(f"{path}/selected_features").orderBy("pos").collect()
    return PipelineModel.load(f"{path}/stages"), [r.feature for r in rows]
