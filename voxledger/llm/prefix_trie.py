"""The trie of conversations by their turns, from hashes of blocks of turns.

Conversations are grouped by blocks of four turns first: a block's key is the
digest of everything before it and the digest of its own turns. Only where
several different blocks follow the same prefix is the place inside the block
at which they part looked for, turn by turn, with one row per distinct block;
a block without siblings is a chain whose nodes have the same members.

A prefix is named by the exclusive or of a digest of every turn with its
place, two times 64 bits, so prefixes along a conversation need no recursion
and a long conversation is cut into pieces. Sums over subtrees need none
either: the nodes that a conversation is the smallest member of lie at the
end of its path, so each conversation hands the sum of its own nodes to the
nodes above them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..operators.scale import running_sums
from .common import query, stored, table, text_of

BLOCK = 4  # turns
PIECE = 1024  # rows of one group that a task orders at once
HEAD = 9  # a conversation takes fewer turns than this from the first of its five
JOINED = 1 << 16  # bytes of ids in one row
NODE = ["depth", "nx", "ny"]


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEAD


def running(rows: DataFrame, group: str, index: str, xors: tuple[str, ...] = (), sums: tuple[str, ...] = ()) -> DataFrame:
    """Replace each column by its running value along ``index``, whole numbers from 0, inside ``group``.

    A long group is cut into pieces of ``PIECE`` numbers that start from the value of those before.
    """
    cut = rows.withColumn("_piece", F.floor(F.col(index) / PIECE))
    local = W.partitionBy(group, "_piece").orderBy(index).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(group).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    how = {c: F.bit_xor for c in xors} | {c: F.sum for c in sums}
    pieces = cut.groupBy(group, "_piece").agg(*[f(c).alias(f"_all_{c}") for c, f in how.items()])
    offsets = pieces.select(group, "_piece", *[f(f"_all_{c}").over(before).alias(f"_off_{c}") for c, f in how.items()]).where("_piece > 0")
    out = cut.withColumns({c: f(c).over(local) for c, f in how.items()}).join(offsets, [group, "_piece"], "left")
    shift = {c: F.coalesce(F.col(f"_off_{c}"), F.lit(0)) for c in how}
    out = out.withColumns({c: F.col(c).bitwiseXOR(shift[c]) if c in xors else F.col(c) + shift[c] for c in how})
    return out.select(rows.columns)


def turn_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, a, b, bytes) of every turn: its place from 0 and two digests of role and text."""
    role, text = text_of(role_col), text_of(text_col)
    short = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"), F.octet_length(text).cast("long").alias("bytes"))
    # equal turns of one conversation are one row with a count, so that places do not depend on their order
    merged = short.groupBy("conv", "turn", "a", "b").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    placed = running_sums(merged, ["conv"], ["turn", "a", "b"], {"upto": "n"})
    return placed.select("conv", F.explode(F.sequence(F.col("upto") - F.col("n"), F.col("upto") - 1)).alias("pos"), "a", "b", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, total) of every conversation and (conv, total, pos, a, b, bytes) of its turns after the rebuild.

    The first turns come from the first conversation of its five, its own ones follow behind as many.
    """
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    first = own.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    plan = own.select("*", (F.col("conv") - F.col("conv") % 5).alias("base"), head_length(F.col("conv")).alias("head"))
    plan = plan.join(first, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_size", F.lit(0))))
    plan = plan.withColumn("total", F.col("taken") + F.greatest(F.col("size") - F.col("head"), F.lit(0)))
    plan = stored(plan.select("conv", "base", "head", "taken", "total"), "trie-plan")
    tail = turns.join(plan, "conv").where("pos >= head").withColumn("pos", F.expr("pos - head + taken"))
    lead = turns.where(F.col("pos") < HEAD - 1).withColumnRenamed("conv", "base").join(plan, "base").where("pos < taken")
    columns = ["conv", "total", "pos", "a", "b", "bytes"]
    return plan.select("conv", "total"), tail.select(columns).union(lead.select(columns))


def blocks_of(turns: DataFrame) -> DataFrame:
    """A row per block: conv, total, k, size, digests before it (px, py) and of its first 1, 2.. turns (x0, y0, ..), bytes (b0, ..)."""
    spot = turns.select(
        "conv", "total", F.expr(f"pos div {BLOCK}").alias("k"), (F.col("pos") % BLOCK).alias("slot"), "bytes",
        F.xxhash64(F.lit(3), "pos", "a", "b").alias("x"), F.xxhash64(F.lit(4), "pos", "b", "a").alias("y"))
    at = lambda c, i: F.max(F.when(F.col("slot") == i, F.col(c)))
    wide = spot.groupBy("conv", "k").agg(
        F.max("total").alias("total"), F.count(F.lit(1)).alias("size"), F.bit_xor("x").alias("px"), F.bit_xor("y").alias("py"),
        *[at(c, i).alias(f"{n}{i}") for n, c in (("x", "x"), ("y", "y"), ("b", "bytes")) for i in range(BLOCK)])
    for c in "xy":
        upto = list(accumulate((F.coalesce(F.col(f"{c}{i}"), F.lit(0)) for i in range(BLOCK)), Column.bitwiseXOR))
        wide = wide.withColumns({f"{c}{i}": u for i, u in enumerate(upto)})
    whole = running(wide, "conv", "k", xors=("px", "py"))
    return whole.withColumns({f"p{c}": F.col(f"p{c}").bitwiseXOR(F.col(f"{c}{BLOCK - 1}")) for c in "xy"})


def nodes_in(blocks: DataFrame, *carry: str) -> DataFrame:
    """A row per turn of each block: its node, the node above (ux, uy) and the bytes of its text."""
    spots = []
    for i in range(BLOCK):
        here = {c: F.col(f"p{c}").bitwiseXOR(F.col(f"{c}{i}")) for c in "xy"}
        up = {c: F.col(f"p{c}").bitwiseXOR(F.col(f"{c}{i - 1}")) if i else F.col(f"p{c}") for c in "xy"}
        spots.append(F.struct((F.col("k") * BLOCK + i + 1).alias("depth"), here["x"].alias("nx"), here["y"].alias("ny"),
                              up["x"].alias("ux"), up["y"].alias("uy"), F.col(f"b{i}").alias("bytes")))
    each = blocks.select(*carry, F.explode(F.slice(F.array(*spots), 1, F.col("size").cast("int"))).alias("_node"))
    return each.select(*carry, "_node.*")


def nodes_of(blocks: DataFrame) -> DataFrame:
    """(depth, nx, ny, ux, uy, bytes, n, conv): the nodes below the root, their members and the smallest one."""
    own = [f"{c}{i}" for c in "xyb" for i in range(BLOCK)]
    prefix = ["k", "px", "py"]
    edges = blocks.groupBy(*prefix, "size", f"x{BLOCK - 1}", f"y{BLOCK - 1}").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), *[F.max(c).alias(c) for c in own if c not in (f"x{BLOCK - 1}", f"y{BLOCK - 1}")])
    edges = stored(edges, "trie-blocks")
    alone = edges.groupBy(*prefix).agg(F.count(F.lit(1)).alias("siblings"), *[F.max(c).alias(c) for c in ("size", "n", "conv", *own)])
    chains = nodes_in(alone.where("siblings = 1"), "n", "conv")
    # blocks that follow the same prefix: their turns are compared
    parting = edges.join(alone.where("siblings > 1").select(prefix), prefix, "left_semi")
    refined = nodes_in(parting, "n", "conv").groupBy(*NODE).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.max(c).alias(c) for c in ("ux", "uy", "bytes")])
    columns = [*NODE, "ux", "uy", "bytes", "n", "conv"]
    return chains.select(columns).union(refined.select(columns))


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, nx, ny, ends_sha256) from (depth, nx, ny, conv): the ids of each node in order, joined by commas.

    Range partitions join the sorted ids of a node to long strings; these meet in one task,
    as SHA-256 reads its input in order, and are streamed through it.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size, out = None, [], 0, []
        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv"))):
                if ids and (key != node or size > JOINED):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                node = key
                ids.append(conv)
                size += 20
                if len(out) == 1000:
                    yield rows(out)
                    out = []
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
        yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int64()] * 4 + [pa.string()])],
                                          [*NODE, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield finished(done)
        yield finished([(*node, state.hexdigest())] if node else [])

    def finished(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string()])],
                                          [*NODE, "ends_sha256"])

    key = "depth long, nx long, ny long"
    joined = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(join, f"{key}, first long, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, f"{key}, ends_sha256 string")


def subtree_sums(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved_tokens`` of their subtrees.

    ``conv`` is a node's smallest member, and owns it. What it owns is the end
    of its path, so the sum from a node down its owner's path covers the
    owner's share, and every conversation adds the sum of all it owns to each
    node above its own ones.
    """
    weighed = nodes.withColumn("saved", (F.col("n") - 1) * F.col("bytes"))
    owners = weighed.groupBy("conv").agg(
        F.sum("saved").alias("all"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"), F.min("depth").alias("top"))
    owners = stored(owners, "trie-owners")
    upto = running(weighed.withColumn("upto", F.col("saved")), "conv", "depth", sums=("upto",))
    own = upto.join(owners.select("conv", "all", "leaf"), "conv").withColumn("rest", F.expr("all - upto + saved"))
    giving = owners.where("top > 0 AND (all > 0 OR leaf > 0)")
    passed = blocks.join(giving, "conv").where(F.col("k") * BLOCK + 1 < F.col("top"))
    above = nodes_in(passed, "all", "leaf", "top").where("depth < top").select(*NODE, "all", "leaf")
    root = giving.select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("nx"), F.lit(0).cast("long").alias("ny"), "all", "leaf")
    others = above.union(root).groupBy(*NODE).agg(F.sum("all").alias("others"), F.sum("leaf").alias("leaves"))
    return own.join(others, NODE, "left").withColumns({
        "n_leaves": F.col("leaf") + F.coalesce("leaves", F.lit(0)), "saved_tokens": F.col("rest") + F.coalesce("others", F.lit(0))})


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per node of the trie of rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    Turns are ordered by ``turn``, null first, ties by digests of role and
    text; null role or text is empty; repeated rows are repeated turns. Rows
    without conversation id belong to none and are left out. An empty table has
    no node, not even a root. Other columns are not read.
    """
    turns = stored(turn_rows(rows, conv_col, turn_col, role_col, text_col), "trie-turns")
    convs, built = rebuilt(turns)
    blocks = stored(blocks_of(built), "trie-paths")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n > 0").select(
        *[zero.alias(c) for c in (*NODE, "ux", "uy", "bytes")], "n", "conv")
    found = stored(nodes_of(blocks).union(root), "trie-nodes")
    children = found.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("ux").alias("nx"), F.col("uy").alias("ny")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    last = blocks.where(F.col("k") * BLOCK + F.col("size") == F.col("total")).select(
        F.col("total").alias("depth"), *[F.col(f"p{c}").bitwiseXOR(F.col(f"{c}{BLOCK - 1}")).alias(f"n{c}") for c in "xy"], "conv")
    ends = end_digests(last.union(convs.where("total = 0").select(*[zero.alias(c) for c in NODE], "conv")))
    # a node whose owner owns the node above, too, has it as parent; the others look theirs up
    summed = subtree_sums(nodes, blocks).join(ends, NODE, "left")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("nx").alias("ux"), F.col("ny").alias("uy"), F.col("conv").alias("parent_conv_id"))
    return summed.join(up, ["depth", "ux", "uy"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


SQL = """
WITH tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), orig AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM orig), tab
), built AS (
  SELECT v.c, 0 AS part, o.p, o.role, o.text FROM convs v JOIN orig o ON o.c = v.base AND o.p < v.h
  UNION ALL
  SELECT v.c, 1, o.p, o.role, o.text FROM convs v JOIN orig o ON o.c = v.c AND o.p >= v.h
), paths AS (
  SELECT v.c, coalesce(list({'r': b.role, 't': b.text} ORDER BY b.part, b.p) FILTER (b.c IS NOT NULL), []) AS path
  FROM convs v LEFT JOIN built b USING (c) GROUP BY v.c
), spots AS (
  SELECT c, d, path[1:d] AS key, strlen(path[d].t) AS bytes, len(path) = d AS ends FROM paths, unnest(range(len(path) + 1)) u(d)
), nodes AS (
  SELECT key, d, min(c) AS conv, count(*) AS n, coalesce(any_value(bytes), 0) AS bytes,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends
  FROM spots GROUP BY key, d
), kids AS (
  SELECT key[1:d - 1] AS key, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), below AS (
  SELECT n.key[1:u.d] AS key, u.d AS d, sum((n.n - 1) * n.bytes) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN kids k ON k.key = n.key AND k.d = n.d, unnest(range(n.d + 1)) u(d) GROUP BY ALL
)
SELECT n.conv AS conv_id, n.d AS depth, p.conv AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN below b ON b.key = n.key AND b.d = n.d
LEFT JOIN kids k ON k.key = n.key AND k.d = n.d
LEFT JOIN nodes p ON p.key = n.key[1:n.d - 1] AND p.d = n.d - 1
"""


@query("op13_prefix_trie", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
