"""Ordered work inside groups that may hold most of the rows.

A window over one group runs in one task. The helpers here split a group first
and then add per-piece offsets, so the result is exact and no task sees more
than one piece.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import checkpointed


def position_in_group(df: DataFrame, group: list[str], coarse: str,
                      order: list[str], name: str = "pos") -> DataFrame:
    """0-based row position inside ``group``.

    ``coarse`` must be a function of the row that never decreases along
    ``order`` (a minute of the timestamp, a hash prefix); it cuts a hot group
    into pieces that are numbered apart and then shifted.
    """
    piece = [*group, coarse]
    local = df.withColumn(
        "_local", F.row_number().over(W.partitionBy(*piece).orderBy(*order)))
    before = W.partitionBy(*group).orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)
    if not group:
        before = W.partitionBy(F.lit(0)).orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)
    offsets = (df.groupBy(*piece).agg(F.count(F.lit(1)).alias("_rows"))
               .select(*piece, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")))
    return (local.join(offsets, piece)
            .withColumn(name, F.col("_local") - 1 + F.col("_shift"))
            .drop("_local", "_shift"))


#: Rows of a table of classes, features or shards up to which it is sent to all tasks.
LOOKUP_ROWS = 100_000


def join_lookup(df: DataFrame, per_key: DataFrame, keys: list[str] | str, how: str = "inner") -> DataFrame:
    """Join one row per class, feature or shard without moving ``df``.

    The keys are few and each may hold most of the rows, so a shuffle on them
    would end in a few tasks. ``per_key`` is fixed first, so its count is exact
    and it is not worked out twice; beyond ``LOOKUP_ROWS`` rows it is an
    ordinary join.
    """
    fixed = checkpointed(per_key)
    few = fixed.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    return df.join(F.broadcast(fixed) if few else fixed, keys, how)


def estimated_bytes(df: DataFrame) -> int:
    """Size estimate of the optimizer; for filters and aggregates it errs on the high side."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def running_sums(df: DataFrame, group: list[str], order: list[str | Column], sums: dict[str, str],
                 totals: dict[str, str] | None = None) -> DataFrame:
    """Inclusive running sum of each ``sums`` input along ``order``, and group ``totals``.

    Both map output name to input column. Rows that compare equal on group and
    order must have been merged before. Rows are range-partitioned on group and
    order, so one large group spreads over many partitions, and each partition
    adds the totals of those before it to its own sums.
    """
    totals = totals or {}
    keys = group or [F.lit(0)]
    fixed = checkpointed(df.orderBy(*group, *order)).withColumn("_part", F.spark_partition_id())
    local = W.partitionBy("_part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    within = fixed.select("*", *[F.sum(c).over(local).alias(f"_in_{o}") for o, c in sums.items()])
    # one row per partition and group from here on
    pieces = fixed.groupBy("_part", *group).agg(
        *[F.sum(c).alias(f"_tot_{o}") for o, c in sums.items()], *[F.sum(c).alias(f"_all_{o}") for o, c in totals.items()])
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select(
        "_part", *group, *[F.coalesce(F.sum(f"_tot_{o}").over(before), F.lit(0)).alias(f"_off_{o}") for o in sums],
        *[F.sum(f"_all_{o}").over(W.partitionBy(*keys)).alias(o) for o in totals])
    joined = within.join(offsets, ["_part", *group])
    return joined.select(*df.columns, *[(F.col(f"_in_{o}") + F.col(f"_off_{o}")).alias(o) for o in sums], *totals)


def global_position(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """0-based position of every row in the total order."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    out = running_sums(one, [], order, {"_pos": "_one"})
    return out.select(*df.columns, (F.col("_pos") - 1).alias(name))


def value_counts(df: DataFrame, group: list[str], value: str,
                 weight: Column | None = None) -> DataFrame:
    """Rows per distinct non-null value; the map side combines before the shuffle."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(n.alias("n"))


def exact_quantiles(df: DataFrame, group: list[str], value: str,
                    probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles per group, one column per name in ``probs``.

    ``percentile`` holds every distinct value of a group in one task. Here the
    distinct values are counted first and ranked by running sums; only the rows
    at the wanted ranks meet in the last aggregation.
    """
    counted = value_counts(df.select(*group, value), group, value)
    joined = running_sums(counted, group, [value], {"_cum": "n"}, {"_total": "n"})
    if not group:
        joined = joined.withColumn("_all", F.lit(0))
    keys = group or ["_all"]
    at = lambda r: (F.col("_cum") > r) & (F.col("_cum") - F.col("n") <= r)
    wanted, aggs = [], []
    for name, q in probs.items():
        h = (F.col("_total") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        wanted += [at(lo), at(hi)]
        # all rows of a group agree on h, so max() only carries it through
        aggs += [F.max(F.when(at(lo), F.col(value))).alias(f"_lo_{name}"),
                 F.max(F.when(at(hi), F.col(value))).alias(f"_hi_{name}"),
                 F.max(h - lo).alias(f"_w_{name}")]
    keep = reduce(lambda a, b: a | b, wanted)
    picked = joined.where(keep).groupBy(*keys).agg(*aggs)
    return picked.select(*group, *[
        (F.col(f"_lo_{n}") + F.col(f"_w_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
        for n in probs])


SMALL_BYTES_PER_CORE = 16 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """Give a small input to all cores before costly per-row work.

    A small file is one partition, so one task would do all of it. The shuffle
    is only taken when the optimizer's size estimate is below a bound; large
    inputs already have enough partitions and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * SMALL_BYTES_PER_CORE else df
