"""What the operators of this folder share: columns, tables, checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.registry import Query
from ..session import checkpointed

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

__all__ = ["ORACLE", "QUERIES", "checkpointed", "free_name", "of_ids", "query", "shared_folder", "stored", "table", "text_of", "without_space"]


def query(name: str, sql: str | None = None):
    """Register a query of this folder, with its DuckDB text if there is one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(name: str) -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: The six white space characters of ``[\x20\x09-\x0D]``.
SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def without_space(text: Column) -> Column:
    """The text without white space; plain byte searches, no regular expression."""
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor reaches: under ``spark.checkpoint.dir``."""
    import tempfile

    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="voxledger-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage, with compressed columns."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Ids that are sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def of_ids(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is in the distinct ``ids``: at the scan if these are few, by a shuffle beyond."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")
