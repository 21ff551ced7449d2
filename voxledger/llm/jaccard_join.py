"""Jaccard self-join on word shingles: size-aware heavy-light join.

Small sets enumerate fixed-size subsets: two sets of sizes a <= b link exactly
when they share a subset of the least overlap that a and b need, so equal
subset keys are links without any further check. Large sets scan inverted
lists of their first shingles in a global order. The boundary between the two
is the size with the least summed cost over the table's own sizes.

The global order is by hash with the most frequent shingles last, by counts
over all texts. Any order gives the same links; this one keeps lists short. A
list is never turned into all its pairs: sets that agree are one class from the
start, lists of two are grouped to distinct pairs, and in longer lists pairs are
pruned by size, position and a parity sketch in blocks of bounded size. Only a
spanning forest of the likely pairs leaves a block and is checked against the
whole sets. Where a pair of the forest failed, a second pass carries the whole
sets into the blocks, compares what is not joined yet and gives a spanning
forest of true links. So each block gives fewer pairs than it has sets, and no
link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import BROADCAST_IDS, checkpointed, free_name, of_ids, query, stored, table
from .components import components
from .shingles import mix, pieces, shingle_sets

LIGHT_MOST = 16  # largest size for which subsets are considered
LATE = 20_000  # most frequent shingles that come last; bounds what is sent to the tasks
LATE_COUNT = 32
BLOCK = 2048  # sets of one list that a task compares at once
EXACT_BLOCK = 256  # the same where the whole sets are there
SKETCH_BITS = 512  # least length of a sketch; larger sets have longer ones


def need(a: int, b: int) -> int:
    """Least overlap of sets of sizes a and b with a Jaccard similarity of at least 0.8."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """First shingles of which a link partner of any size shares one."""
    return n // 5 + 1


def subset_plan(n: int) -> list[tuple[int, int, int]]:
    """(a, b, overlap) for every pair of sizes in which a set of n elements can link."""
    pairs = {(min(n, m), max(n, m)) for m in range(1, n // 4 * 5 + 5) if 5 * min(n, m) >= 4 * max(n, m)}
    return sorted((a, b, need(a, b)) for a, b in pairs)


def light_cost(n: int) -> float:
    return float(sum(math.comb(n, o) for _, _, o in subset_plan(n)))


def heavy_cost(n: int) -> float:
    """Entries in inverted lists, each with a share of the comparisons that it causes."""
    return (n // 5 + 1) * 4.0


def choose_boundary(sizes: dict[int, int]) -> int:
    """Largest size that enumerates subsets, at least cost for the given counts of sizes."""

    def cost(x: int) -> float:
        # sets a little below the boundary may link with sets above and do both
        return sum(c * ((light_cost(n) if n <= x else 0) + (heavy_cost(n) if 5 * n > 4 * x else 0)) for n, c in sizes.items())

    return min(range(0, LIGHT_MOST + 1), key=lambda x: (cost(x), x))


def _list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _ordinal(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def leading(docs: DataFrame) -> DataFrame:
    """(sig) for the first shingles of every text, in the order of hashes, that a larger partner looks up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch.column("_text").to_pylist()):
                h, at = shingle_sets(texts)
                n = np.bincount(at, minlength=len(texts))
                keep = _ordinal(n) < np.repeat(n // 9 + 1, n)
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64))], ["sig"])

    return docs.select("_text").mapInArrow(run, "sig long")


def sketch_words(n: np.ndarray) -> np.ndarray:
    """Words of a set's sketch: half a bit or more for each element, a power of two, so that it folds to any shorter one."""
    return np.maximum(SKETCH_BITS, 2 ** np.ceil(np.log2(np.maximum(n, 2) / 2)).astype(np.int64)) // 64


def features(docs: DataFrame, late: np.ndarray) -> DataFrame:
    """Per row: size and key of the set, its parity sketch, and its first shingles (all of a small set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.uint64(1)
        for batch in batches:
            ids = batch.column("_id")
            for first, texts in pieces(batch.column("_text").to_pylist()):
                h, at = shingle_sets(texts, late)
                n = np.bincount(at, minlength=len(texts))
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                keys = np.zeros((2, len(texts)), np.uint64)
                sketch = [b""] * len(texts)
                if len(full):
                    for k in (0, 1):
                        keys[k, full] = np.add.reduceat(mix(h, 11 + k), starts)
                    spot, words = mix(h, 5), sketch_words(n)
                    for w in np.unique(words[full]).tolist():
                        some = np.flatnonzero((words == w) & (n > 0))
                        mine = np.isin(at, some)
                        bit = spot[mine] & np.uint64(64 * w - 1)
                        grid = np.zeros((len(some), w), np.uint64)
                        np.bitwise_xor.at(grid, (np.searchsorted(some, at[mine]), (bit >> np.uint64(6)).astype(np.int64)), one << (bit & np.uint64(63)))
                        for i, row in zip(some.tolist(), grid):
                            sketch[i] = row.tobytes()
                most = np.where(n <= LIGHT_MOST, n, prefix_length(n))
                kept = np.minimum(most, n)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array(n.astype(np.int32)), pa.array(keys[0].view(np.int64)),
                     pa.array(keys[1].view(np.int64)), pa.array(sketch, pa.binary()),
                     _list_array(h[_ordinal(n) < np.repeat(kept, n)], kept)],
                    ["_id", "n", "k1", "k2", "sketch", "lead"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.select("_id", "_text").mapInArrow(run, f"_id {kind}, n int, k1 long, k2 long, sketch binary, lead array<long>")


def whole_sets(docs: DataFrame) -> DataFrame:
    """(_id, s): all shingles of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id")
            for first, texts in pieces(batch.column("_text").to_pylist()):
                h, at = shingle_sets(texts)
                n = np.bincount(at, minlength=len(texts))
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)), _list_array(h, n)], ["_id", "s"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.select("_id", "_text").mapInArrow(run, f"_id {kind}, s array<long>")


def subset_links(light: DataFrame) -> DataFrame:
    """(a, b) links among small sets: equal subset keys are links, each to the first of the smaller size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, small = [], [], []
            for i, lead in zip(batch.column("id").to_pylist(), batch.column("lead").to_pylist()):
                h = mix(np.array(lead, np.int64).view(np.uint64), 17)
                n, total = len(h), int(h.sum(dtype=np.uint64))
                for a, b, o in subset_plan(n):
                    tag = (a * 64 + b) * 0x9E3779B97F4A7C15
                    for left_out in combinations(range(n), n - o):
                        keys.append((total - sum(int(h[k]) for k in left_out) + tag) % 2**64)
                        ids.append(i)
                        small.append(n == a)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(ids, batch.column("id").type),
                                              pa.array(small, pa.bool_())], ["key", "id", "small"])

    kind = light.schema["id"].dataType.simpleString()
    rows = light.select("id", "lead").mapInArrow(run, f"key long, id {kind}, small boolean")
    # the pivot is pre-aggregated before the shuffle, so a hot key is one row a task
    pivots = rows.where("small").groupBy("key").agg(F.min("id").alias("a"))
    return rows.join(pivots, "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()


def _forest(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Indices of a spanning forest of the pairs, nearest first."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = both[:len(a)].tolist(), both[len(a):].tolist()
    parent, kept = list(range(len(nodes))), []
    for k in np.lexsort((b, a, distance)).tolist():
        x, y = left[k], right[k]
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(kept, np.int64)


class Sketches:
    """Parity sketches of different lengths; two are compared at the length of the shorter one."""

    def __init__(self, rows: list[bytes]) -> None:
        self.rows, self.words = rows, np.array([len(r) // 8 for r in rows], np.int64)
        self.folded: dict[int, np.ndarray] = {}

    def at(self, w: int) -> np.ndarray:
        """All sketches of ``w`` words or more, folded to ``w``; zeros for shorter ones."""
        if w not in self.folded:
            out = np.zeros((len(self.rows), w), np.uint64)
            for own in np.unique(self.words[self.words >= w]).tolist():
                at = np.flatnonzero(self.words == own)
                grid = np.frombuffer(b"".join(self.rows[i] for i in at.tolist()), np.uint64).reshape(len(at), own // w, w)
                out[at] = np.bitwise_xor.reduce(grid, axis=1)
            self.folded[w] = out
        return self.folded[w]

    def distance(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bits in which the sketches differ: at most the elements that only one set has."""
        out = np.zeros(len(i), np.int64)
        least = np.minimum(self.words[i], self.words[j])
        for w in np.unique(least).tolist():
            some, grid = least == w, self.at(w)
            out[some] = np.bitwise_count(grid[i[some]] ^ grid[j[some]]).sum(1, dtype=np.int64)
        return out


def _possible(n1, p1, n2, p2) -> np.ndarray:
    """Whether sets of these sizes that share elements at these positions may link."""
    low, high = np.minimum(n1, n2), np.maximum(n1, n2)
    ok = (5 * low >= 4 * high) & (np.minimum(n1 - p1, n2 - p2) >= -(-4 * (n1 + n2) // 9))
    return ok & (np.where(n1 <= n2, p1, p2) <= low // 9)  # the smaller set needs fewer first shingles


def _near_enough(n1, n2, distance) -> np.ndarray:
    return distance <= n1 + n2 - 2 * -(-4 * (n1 + n2) // 9)


def _true_forest(i, j, distance, comp, sets) -> np.ndarray:
    """Indices of a spanning forest of the pairs that link, nearest first; sets of one component are joined from the start."""
    parent = {c: c for c in np.unique(comp).tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    kept = []
    for k in np.argsort(distance, kind="stable").tolist():
        x, y = root(comp[i[k]]), root(comp[j[k]])
        if x != y:
            a, b = sets[i[k]], sets[j[k]]
            o = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * o >= 80 * (len(a) + len(b) - o):
                parent[max(x, y)] = min(x, y)
                kept.append(k)
    return np.array(kept, np.int64)


def block_pairs(members: DataFrame, exact: bool) -> DataFrame:
    """(a, b) pairs of ``members(sig, size, id, n, pos, sketch, comp)`` that share a list and differ in ``comp``.

    A list of more than ``BLOCK`` sets is cut into blocks, and each pair of
    blocks is compared in a task of its own, which gives a spanning forest:
    of the pairs that may link, or, if ``exact`` and the members have their
    whole sets ``s``, of those that do.
    """
    size = EXACT_BLOCK if exact else BLOCK
    blocks = F.ceil(F.col("size") / size).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    spread = members.withColumn("_own", own).select("*", F.explode(F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(k, F.col("_own")).alias("x"), F.greatest(k, F.col("_own")).alias("y")))).alias("_b"))
    spread = spread.select("sig", F.col("_b.x").alias("x"), F.col("_b.y").alias("y"), "_own", "id", "n", "pos", "sketch", "comp", *["s"] * exact)
    dealt = spread.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            """Whole runs of one (sig, x, y) as tables of complete groups."""
            rest = None
            for batch in batches:
                t = pa.Table.from_batches([batch])
                t = pa.concat_tables([rest, t]) if rest is not None else t
                if not t.num_rows:
                    continue
                cols = [t.column(c).to_numpy() for c in ("sig", "x", "y")]
                last = np.ones(t.num_rows, bool)
                for c in cols:
                    last &= c == c[-1]
                cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
                if cut:
                    yield t.slice(0, cut)
                rest = t.slice(cut)
            if rest is not None and rest.num_rows:
                yield rest

        for t in groups():
            cols = {c: t.column(c).to_numpy() for c in ("sig", "x", "y", "_own", "n", "pos", "comp")}
            ids = t.column("id").to_numpy()
            sketches = Sketches(t.column("sketch").to_pylist())
            new = np.ones(len(ids), bool)
            new[1:] = np.any([cols[c][1:] != cols[c][:-1] for c in ("sig", "x", "y")], axis=0)
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(ids)))
            n, pos, comp, block = (cols[c].astype(np.int64) for c in ("n", "pos", "comp", "_own"))
            left, right, near = [], [], []

            def take(i, j):
                # two lists whose open members agree stand for each other, so places tell nothing then
                ok = (_possible(n[i], 0 if exact else pos[i], n[j], 0 if exact else pos[j])) & (comp[i] != comp[j]) & (ids[i] != ids[j])
                i, j = i[ok], j[ok]
                d = sketches.distance(i, j)
                ok = _near_enough(n[i], n[j], d)
                left.append(i[ok]), right.append(j[ok]), near.append(d[ok])

            for size in np.unique(sizes):
                at = starts[sizes == size]
                if size <= 12:  # all lists of one length at once
                    for i, j in combinations(range(int(size)), 2):
                        take(at + i, at + j)
                    continue
                for s in at:
                    rows = np.arange(s, s + size)
                    x, y = cols["x"][s], cols["y"][s]
                    one, two = (rows, rows) if x == y else (rows[block[rows] == x], rows[block[rows] == y])
                    for k in range(0, len(one), 64):
                        i, j = np.broadcast_arrays(one[k:k + 64][:, None], two[None, :])
                        pick = i < j if x == y else np.ones(i.shape, bool)
                        take(i[pick], j[pick])
            if not left:
                continue
            i, j, d = np.concatenate(left), np.concatenate(right), np.concatenate(near)
            if exact:
                whole = t.column("s")
                sets = {k: whole[k].values.to_numpy() for k in np.unique(np.concatenate([i, j])).tolist()}
                kept = _true_forest(i, j, d, comp, sets)
            else:
                order = np.lexsort((np.maximum(ids[i], ids[j]), np.minimum(ids[i], ids[j])))
                i, j, d = i[order], j[order], d[order]
                kept = _forest(np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), d) if len(i) else np.zeros(0, np.int64)
            i, j = i[kept], j[kept]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def fewer_rows(rest: DataFrame) -> DataFrame:
    """Open members by list, or by their near component as one list where that carries their sets fewer times."""
    per = rest.groupBy("near").agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("id").alias("_m"))
    whole = checkpointed(per.where(F.col("_m") * F.ceil(F.col("_m") / EXACT_BLOCK) <= F.col("entries")).select("near", "_m"))
    once = rest.join(whole, "near").dropDuplicates(["near", "id"]).withColumn("sig", F.xxhash64("near")).withColumn("size", F.col("_m"))
    return once.select(*rest.columns).union(rest.join(whole, "near", "left_anti").select(*rest.columns)).drop("near")


def pairs_of_two(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The (a, b) pairs that may link by the sketches of both."""
    own = reps.select("id", "n", "sketch")
    both = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m:
                sketches = Sketches(batch.column("sa").to_pylist() + batch.column("sb").to_pylist())
                na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
                ok = _near_enough(na, nb, sketches.distance(np.arange(m), np.arange(m, 2 * m)))
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole sets have a Jaccard similarity of at least 0.8."""
    wanted = pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id"))).distinct()
    sets = whole_sets(of_ids(docs, wanted, "_id"))
    left = pairs.join(sets.select(F.col("_id").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("_id").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    linked = both.select("a", "b", shared.alias("o"), (F.size("sa") + F.size("sb")).alias("t"))
    return linked.where(100 * F.col("o") >= 80 * (F.col("t") - F.col("o"))).select("a", "b").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_shingles`` and ``component_id``.

    A document is the set of its distinct 5-word shingles (A-Z lower-cased);
    with fewer words the whole sequence is one shingle. Two documents link at
    a Jaccard similarity of 0.8 or more; ``component_id`` is the smallest id
    that links reach. Texts without words, empty and null texts have size 0
    and are groups of their own. Ids are integers; rows that repeat an id are
    one document for links. A null id has a null component unless an equal set
    has an id. An empty table gives an empty result; other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    counts = leading(docs).groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= LATE_COUNT)
    top = counts.orderBy(F.desc("c"), "sig").limit(LATE).select("sig").toPandas()["sig"]
    late = np.sort(top.to_numpy(np.int64).view(np.uint64))
    rows = stored(features(docs, late), "sets")
    # sets that agree are one class, named by its smallest id
    groups = checkpointed(rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("_id").alias("id")).where("id is not null"))
    reps = of_ids(rows.withColumnRenamed("_id", "id"), groups.select("id").distinct(), "id").where("n > 0")

    sizes = {r.n: r.c for r in reps.where(F.col("n") <= LIGHT_MOST * 5 // 4 + 1).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    boundary = choose_boundary(sizes)
    links = subset_links(reps.where(F.col("n") <= boundary))

    lists = reps.where(5 * F.col("n") > 4 * boundary).select("id", "n", F.posexplode(F.slice(
        "lead", F.lit(1), F.floor(F.col("n") / 5).cast("int") + 1)).alias("pos", "sig"))
    shape = lists.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.col("pos") - F.floor(F.col("n") / 9)).alias("role"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.min("id").alias("a"), F.max("id").alias("b"))
    # a list needs a set that is looked up in it, and a list of two needs sizes that can link
    shape = stored(shape.where("size > 1 and role <= 0 and (size > 2 or 5 * least >= 4 * most)"), "shared")
    twos = pairs_of_two(shape.where("size = 2 and a <> b").select("a", "b").distinct(), reps)
    long = shape.where("size > 2").select("sig", "size")
    few = long.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    members = stored(lists.join(F.broadcast(long) if few else long, "sig").join(reps.select("id", "n", "sketch"), ["id", "n"]), "lists")
    first = checkpointed(block_pairs(members.withColumn("comp", F.monotonically_increasing_id()), exact=False))
    checked = checkpointed(first.union(twos).distinct())
    links = checkpointed(links.union(verified(checked, docs)))
    label = components(links)

    # where a pair of a forest failed, its lists may still hold links between components: whole sets are compared
    near = components(first).withColumnRenamed("component", "near")
    named = near.join(label, "node", "left").select(F.col("node").alias("id"), "near", F.coalesce("component", "node").alias("comp"))
    named = checkpointed(named)
    split = named.groupBy("near").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("near")
    open_ids = checkpointed(named.join(split, "near", "left_semi"))
    rest = stored(of_ids(members, open_ids.select("id").distinct(), "id").join(open_ids, "id"), "open")
    # of lists with the same open members of one near component, one is enough; a list of two whose pair was checked is none
    same = rest.groupBy("sig", "near").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("id", "n")).alias("who"), F.min("comp").alias("lo"),
                                           F.max("comp").alias("hi"), F.min("id").alias("a"), F.max("id").alias("b")).where("lo < hi")
    same = same.groupBy("near", "size", "who", "a", "b").agg(F.min("sig").alias("sig"))
    same = same.join(checked.withColumn("size", F.lit(2).cast("long")), ["size", "a", "b"], "left_anti").drop("a", "b")
    rest = rest.drop("size").join(same.drop("who"), ["sig", "near"]).withColumn("sig", F.xxhash64("sig", "near")).drop("n")
    rest = fewer_rows(stored(rest, "open-lists"))
    sets = whole_sets(of_ids(docs, rest.select(F.col("id").alias("_id")).distinct(), "_id")).where(F.size("s") > 0)
    rest = rest.join(sets.select(F.col("_id").alias("id"), F.size("s").alias("n"), "s"), "id")
    second = checkpointed(block_pairs(rest, exact=True))
    label = components(links.union(second)) if second.limit(1).count() else label

    classes = groups.join(label.withColumnRenamed("node", "id"), "id", "left").select(
        "k1", "k2", "n", F.coalesce("component", "id").alias("_c"))
    out = rows.select("_id", "n", "k1", "k2").join(classes, ["k1", "k2", "n"], "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("_c")).otherwise(F.col("_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their group, one of each; ids are integers.

    Rows that repeat such an id are kept once, the one with the longest text;
    rows without id stay, as links do not name them. While the ids that stay
    are few enough to be sent to all tasks, no text is shuffled.
    """
    ids = checkpointed(near_groups(docs, id_col, text_col).where(F.col(id_col) == F.col("component_id")).groupBy(
        F.col(id_col).alias("_kid")).agg(F.count(F.lit(1)).alias("_rows")))
    own, rank = free_name(docs, "_kid"), free_name(docs, "_rank")
    named = docs.where(F.col(id_col).isNotNull()).withColumn(own, F.col(id_col).cast("long"))

    def of(rows: str) -> DataFrame:
        return of_ids(named, ids.where(rows).select(F.col("_kid").alias(own)), own)

    one = W.partitionBy(own).orderBy(F.char_length(text_col).desc_nulls_last(), F.col(text_col))
    repeated = of("_rows > 1").withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    return of("_rows = 1").select(*docs.columns).union(repeated.select(*docs.columns)).union(docs.where(F.col(id_col).isNull()))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS s 
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT doc_id, md5(array_to_string(s, ' ') || ' ' || len(s)) AS h FROM s),
c AS (SELECT doc_id, n, md5(string_agg(h, '' ORDER BY h)) AS k FROM h JOIN n USING (doc_id) GROUP BY doc_id, n),
r AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n FROM c GROUP BY k),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM (SELECT h.* FROM h JOIN r ON rep = doc_id) a JOIN (SELECT h.* FROM h JOIN r ON rep = doc_id) b
        ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN r x ON x.rep = a JOIN r y ON y.rep = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
g(x, y) AS (SELECT rep, rep FROM r UNION SELECT g.x, e.b FROM g JOIN e ON e.a = g.y),
m AS (SELECT x, min(y) AS component FROM g GROUP BY x)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN r USING (k) LEFT JOIN m ON m.x = r.rep"""


@query("op10_jaccard_join", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
