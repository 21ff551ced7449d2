"""A stored signal table from which single recordings are read without a scan of the rest.

Rows are bucketed and sorted by id. A filter on the id selects its buckets
before any file is opened, and inside a bucket the Parquet statistics skip row
groups. The bucket spec lives in the catalog, so ``open_store`` registers the
folder again in a session that does not know it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BUCKETS = 256
ROW_GROUP = 16 << 20


def write_store(df: DataFrame, path: str, buckets: int = BUCKETS, id_col: str = "audio_id", pieces: int = 8) -> DataFrame:
    """Store recordings by id under ``path`` and open them.

    The rows of a bucket go to up to ``pieces`` tasks by a hash of the row, so
    an id that holds most rows is not written by one task; a bucket then has as
    many files at most. Null ids are kept, in a bucket of their own kind.
    """
    bucket = F.pmod(F.hash(id_col), F.lit(buckets))
    dealt = df.repartition(bucket, F.pmod(F.xxhash64(*df.columns), F.lit(pieces)))
    name = _name()
    (dealt.write.mode("overwrite").bucketBy(buckets, id_col).sortBy(id_col).option("path", path)
     .option("parquet.block.size", ROW_GROUP).saveAsTable(name))
    return df.sparkSession.table(name)


def open_store(spark: SparkSession, path: str, buckets: int = BUCKETS, id_col: str = "audio_id", schema: str | None = None) -> DataFrame:
    """The stored table of another session; ``buckets`` and ``id_col`` as it was written with, ``schema`` if it may be empty."""
    reader = spark.read.schema(schema) if schema else spark.read
    name, schema = _name(), reader.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{id_col}`) SORTED BY (`{id_col}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _name() -> str:
    return f"recordings_{uuid.uuid4().hex}"
