"""Named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent text over ``views``."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(views, sql) if views else sql
        return fn

    return add


# Added before rounding on both sides: a value that lies exactly between two
# rounded neighbours would otherwise fall either way with the order of a sum.
NUDGE = 1e-9


def rounded(df: DataFrame, digits: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column and widen integers to bigint for comparison."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind in ("double", "float") and f.name not in keep:
            c = c.cast("double")
            c = F.round(c + NUDGE if digits <= 7 else c, digits)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
