"""Removal of repeated byte strings by a distributed sparse suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
in the corpus (smaller id, or earlier in the same text). Sorting every suffix
would shuffle each byte many times over. Instead each window of ``length``
bytes is led by one suffix that its content alone picks (the gram of least
hash inside it), so equal windows are led by equal suffixes, and only the
leading suffixes are sorted, about one in 35.

Suffixes are dealt to buckets by their leading bytes, with splitters from a
sample of the texts; a bucket sorts its suffixes by gram, surroundings and
place, and compares neighbours across the borders of its batches. Suffixes
with the same surroundings lead the same windows, so all but the first are
settled by that. For the others the bytes around them are fetched, and a
second sort compares window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import query, stored, table
from .shingles import mix

LENGTH = 100
GRAM = 32
CHUNK = 1 << 19  # bytes of text that a task treats at once
LEAD = 16
BUCKET_BYTES = 64 << 20  # text whose suffixes make one bucket
HOT_ROWS = 4096  # undecided suffixes of one gram beyond which each window is a key of its own
SAMPLE_TEXTS = 2_000  # texts that the splitters are drawn from
LOWEST = -(2**63)  # stands for a null id

_RNG = np.random.default_rng(77003)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
_POWER = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWER[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _POWER[k] = np.multiply.accumulate(out)
    return _POWER[0][:n], _POWER[1][:n]


class Grams:
    """Hashes of any substring of some bytes, by sums over prefixes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:len(data)], out=self.sums[1:])

    def hashes(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo])

    def fixed(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def leaders(data: np.ndarray, owner_end: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(p, lo, hi, gram, around) of the suffixes that lead windows of the texts in ``data``.

    Texts lie behind one another and end at ``owner_end``. The suffix at ``p``
    leads the windows that start from ``lo`` to ``hi``; ``around`` is a hash of
    all bytes of these windows and of the place of p in them.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams = Grams(data)
    gram = grams.fixed(GRAM)
    width = length - GRAM + 1  # grams in a window
    order = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    pad = -len(order) % width
    blocks = np.concatenate([order, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
    leader = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    whole = np.ones(n, bool)  # windows that lie in one text
    for end in owner_end[:-1].tolist():
        whole[max(0, end - length + 1):end] = False
    edge = np.ones(n, bool)
    edge[1:] = (leader[1:] != leader[:-1]) | ~whole[:-1]
    lo = np.flatnonzero(edge & whole)
    ending = np.ones(n, bool)
    ending[:-1] = edge[1:] | ~whole[1:]
    hi = np.flatnonzero(ending & whole)
    p = leader[lo]
    around = grams.hashes(lo, hi + length) + mix((p - lo).astype(np.uint64) * np.uint64(1000) + (hi - lo).astype(np.uint64), 3)
    return p, lo, hi, gram[p], around


def joined(ids: np.ndarray, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bytes behind one another, ends) in runs of about ``CHUNK`` bytes."""
    run, first, size = [], 0, 0
    for i, t in enumerate(texts):
        run.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(run[-1])
        if size >= CHUNK or i == len(texts) - 1:
            yield ids[first:i + 1], np.frombuffer(b"".join(run), np.uint8), np.cumsum([len(r) for r in run])
            run, first, size = [], i + 1, 0


def lead_bytes(data: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data[p[:, None] + np.arange(LEAD)]).view(f"S{LEAD}").ravel()


def merged(lo: np.ndarray, hi: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges, for ranges sorted by owner and start."""
    if not len(lo):
        return lo, hi, owner
    reach = np.maximum.accumulate(hi + owner * (1 << 40)) - owner * (1 << 40)
    new = np.ones(len(lo), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (lo[1:] > reach[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(lo)) - 1
    return lo[at], reach[last], owner[at]


def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("doc"), F.col(text_col).alias("text"))


def splitters(docs: DataFrame, buckets: int, rows: int, length: int) -> np.ndarray:
    """Leading bytes that cut the suffixes of a sample of the texts into even buckets."""
    share = min(1.0, 1.2 * SAMPLE_TEXTS / max(rows, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, ends in joined(np.zeros(batch.num_rows, np.int64), batch.column("text").to_pylist()):
                p = leaders(data, ends, length)[0][::8]
                yield pa.RecordBatch.from_arrays([pa.array(data[p[:, None] + np.arange(LEAD)].view(f"S{LEAD}").ravel().tolist()
                                                           if len(p) else [], pa.binary())], ["lead"])

    leads = docs.sample(share, 7).select("text").mapInArrow(run, "lead binary").toPandas()["lead"]
    some = np.sort(np.array([bytes(x) for x in leads], f"S{LEAD}"))
    return some[np.linspace(0, len(some), buckets, endpoint=False).astype(int)[1:]] if len(some) else some


def suffix_rows(docs: DataFrame, cuts: np.ndarray, length: int) -> DataFrame:
    """Leading suffixes (bucket, gram, around, doc, place), and ranges settled within a batch (gram null).

    ``place`` packs p, p - lo and hi - lo. Of suffixes of one batch with equal
    surroundings only the first is passed on; the others' windows repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for ids, data, ends in joined(batch.column("doc").to_numpy(), batch.column("text").to_pylist()):
                p, lo, hi, gram, around = leaders(data, ends, length)
                if not len(p):
                    continue
                own = np.searchsorted(ends, p, side="right")
                start = np.concatenate([[0], ends[:-1]])[own]
                bucket = np.searchsorted(cuts, lead_bytes(data, p), side="right")
                place = ((p - start) << 16) | ((p - lo) << 8) | (hi - lo)
                parts.append((bucket, gram.view(np.int64), around.view(np.int64), ids[own], place))
            if not parts:
                continue
            bucket, gram, around, doc, place = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((place, doc, around, gram))
            repeated = np.zeros(len(order), bool)
            repeated[1:] = (gram[order][1:] == gram[order][:-1]) & (around[order][1:] == around[order][:-1])
            first = order[~repeated]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[first]) for x in (bucket.astype(np.int32), gram, around, doc, place)], NAMES)
            place_twice = np.zeros(len(order), bool)  # a repeated row: the same place, no earlier one
            place_twice[1:] = (doc[order][1:] == doc[order][:-1]) & (place[order][1:] == place[order][:-1])
            again = order[repeated & ~place_twice]
            again = again[np.lexsort((place[again], doc[again]))]
            p, doc = place[again] >> 16, doc[again]
            lo = p - (place[again] >> 8 & 255)
            _, code = np.unique(doc, return_inverse=True)
            lo, hi, code = merged(lo, lo + (place[again] & 255) + length, code)
            if len(lo):
                docs_of = np.unique(doc)[code]
                spread = (mix(docs_of.view(np.uint64)) % np.uint64(len(cuts) + 1)).astype(np.int32)
                nothing = pa.nulls(len(lo), pa.int64())
                # a settled range: gram and around are null, the place holds both ends
                yield pa.RecordBatch.from_arrays([pa.array(spread), nothing, nothing, pa.array(docs_of), pa.array((lo << 32) | hi)], NAMES)

    return docs.mapInArrow(run, "bucket int, gram long, around long, doc long, place long")


NAMES = ["bucket", "gram", "around", "doc", "place"]


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by ``keys``: a group that meets a border is carried over."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if not t.num_rows:
            continue
        same = np.ones(t.num_rows, bool)
        for k in keys:
            c = t.column(k).to_numpy()
            same &= c == c[-1]
        other = np.flatnonzero(~same)
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield t.slice(0, cut).combine_chunks()
        rest = t.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def settled(rows: DataFrame, buckets: int, length: int) -> DataFrame:
    """(doc, lo, hi, gram, place): ranges that repeat (gram null) and suffixes still to be compared."""
    dealt = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("gram", "around", "doc", "place")
    schema = "doc long, lo long, hi long, gram long, place long"

    def batch_of(doc, lo, hi, gram=None, place=None):
        nothing = pa.nulls(len(doc), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(hi), nothing if gram is None else pa.array(gram),
                                           nothing if place is None else pa.array(place)], ["doc", "lo", "hi", "gram", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row stays for the comparison across the border of two batches; a group is never held whole
        last, waiting = None, None  # waiting: the first suffix of an open group that has one kind of surroundings so far
        for batch in batches:
            done = batch.filter(batch.column("gram").is_null())
            if done.num_rows:
                place = done.column("place").to_numpy()
                yield batch_of(done.column("doc").to_numpy(), place >> 32, place & 0xFFFFFFFF)
            batch = batch.filter(batch.column("gram").is_valid())
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy() for c in ("gram", "around", "doc", "place")])
            start = 0
            if last is not None:
                rows, start = np.concatenate([last, rows], 1), 1
            gram, around, doc, place = rows
            new = np.ones(len(gram), bool)
            new[1:] = gram[1:] != gram[:-1]
            lead = new.copy()  # first suffix with its surroundings
            lead[1:] |= around[1:] != around[:-1]
            same = np.zeros(len(gram), bool)  # a repeated row: the same place, no earlier one
            same[1:] = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
            if start:
                new[0] = lead[0] = False
            at = np.flatnonzero(~lead & ~same)
            at = at[at >= start]
            order = at[np.lexsort((place[at], doc[at]))]
            p, lo = place[order] >> 16, (place[order] >> 16) - (place[order] >> 8 & 255)
            ids, code = np.unique(doc[order], return_inverse=True)
            lo, hi, code = merged(lo, lo + (place[order] & 255) + length, code)
            if len(lo):
                yield batch_of(ids[code], lo, hi)
            leads = np.flatnonzero(lead)
            group = np.cumsum(new)  # 0: the group that was open
            kinds = np.bincount(group[leads], minlength=int(group[-1]) + 1)
            chosen = leads[(kinds[group[leads]] > 1) | (group[leads] == 0)]
            out = rows[:, chosen]
            if kinds[0] and waiting is not None:
                out, waiting = np.concatenate([waiting, out], 1), None
            if group[-1] > 0:  # the open group is another one now
                tail = leads[group[leads] == group[-1]]
                waiting = rows[:, tail] if len(tail) == 1 else None
            if out.shape[1]:
                zero = np.zeros(out.shape[1], np.int64)
                yield batch_of(out[2], zero, zero, out[0], out[3])
            last = rows[:, -1:]

    return dealt.mapInArrow(run, schema)


def surroundings(docs: DataFrame, undecided: DataFrame, length: int) -> DataFrame:
    """(gram, doc, place, bytes) with the bytes of all windows that each undecided suffix leads.

    Suffixes of a gram that is hot come as one row for each window instead:
    ``gram`` is then a hash of the window, which is a key of its own, ``place``
    its start, and ``bytes`` null. So the group is dealt over many tasks.
    """
    hot = undecided.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > HOT_ROWS).select("gram", F.lit(True).alias("hot"))
    wanted = undecided.join(hot, "gram", "left").groupBy("doc").agg(
        F.collect_list(F.struct("gram", "place", F.col("hot").isNotNull().alias("hot"))).alias("w"))
    found = docs.join(wanted, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text").to_pylist(), batch.column("w")
            flat = lists.flatten()
            gram, place = (flat.field(k).to_numpy() for k in (0, 1))
            hot = flat.field(2).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy())
            first = 0
            cold, windows = [[], [], [], []], [[], [], []]
            for i, doc in enumerate(batch.column("doc").to_pylist()):
                raw = (texts[i] or "").encode("utf-8", "surrogatepass")
                own = np.arange(first, int(ends[i]))
                first = int(ends[i])
                p, back, count = place[own] >> 16, place[own] >> 8 & 255, place[own] & 255
                lo = p - back
                some = ~hot[own]
                cold[3] += [raw[x:y] for x, y in zip(lo[some].tolist(), (lo + count + length)[some].tolist())]
                cold[0].append(gram[own[some]])
                cold[1].append(np.full(int(some.sum()), doc, np.int64))
                cold[2].append(place[own[some]])
                if not some.all():
                    grams = Grams(np.frombuffer(raw, np.uint8))
                    each = count[~some] + 1
                    start = np.repeat(lo[~some], each) + np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
                    windows[0].append(grams.hashes(start, start + length).view(np.int64))
                    windows[1].append(np.full(len(start), doc, np.int64))
                    windows[2].append(start)
            names = ["gram", "doc", "place", "bytes"]
            if cold[3]:
                yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in cold[:3]), pa.array(cold[3], pa.binary())], names)
            if windows[0]:
                arrays = [pa.array(np.concatenate(x)) for x in windows]
                yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(arrays[0]), pa.binary())], names)

    return found.select("doc", "text", "w").mapInArrow(run, "gram long, doc long, place long, bytes binary")


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several key columns: each column sorts only what the ones before left equal."""
    order = np.argsort(columns[0], kind="stable")
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for k, column in enumerate(columns):
        if k:
            rows = order[tied]
            resort = np.lexsort((column[rows], group[tied]))
            order[tied] = rows[resort]
        new = np.ones(len(order), bool)
        new[1:] = (column[order[1:]] != column[order[:-1]]) | (group[1:] != group[:-1])
        group = np.cumsum(new) - 1
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
    return order


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """(doc, lo, hi) unions of the windows that an earlier suffix of the same gram leads as well."""
    dealt = rows.repartition("gram").sortWithinPartitions("gram", "doc", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, ["gram"]):
            gram, doc, place = (t.column(c).to_numpy() for c in ("gram", "doc", "place"))
            once = np.ones(len(gram), bool)  # a repeated row has the same place, which is no earlier one
            once[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
            gram, doc, place = gram[once], doc[once], place[once]
            raw = t.column("bytes").filter(pa.array(once)).to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            at = 0
            while at < len(starts):  # whole groups, about 4,000 suffixes at once
                end = max(at + 1, int(np.searchsorted(starts, starts[at] + 4_000)))
                a, b = int(starts[at]), int(starts[end]) if end < len(starts) else len(gram)
                at = end
                length_of = np.array([len(x) for x in raw[a:b]])
                grams = Grams(np.frombuffer(b"".join(raw[a:b]), np.uint8))
                base = np.cumsum(length_of) - length_of
                windows = length_of - length + 1
                row = np.repeat(np.arange(b - a), windows)
                shift = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                start = base[row] + shift
                window = grams.hashes(start, start + length)
                # rows are in order of place: the first of equal windows is the earliest
                order = multikey_order([window, gram[a:b][row]])
                again = np.zeros(len(order), bool)
                x, y = order[1:], order[:-1]
                again[1:] = (window[x] == window[y]) & (gram[a:b][row[x]] == gram[a:b][row[y]])
                mark = np.zeros(len(row), bool)
                mark[order[again]] = True
                w = place[a:b][row]
                lo = (w >> 16) - (w >> 8 & 255) + shift
                key = doc[a:b][row]
                lo, key = lo[mark], key[mark]
                by = np.lexsort((lo, key))
                ids, code = np.unique(key[by], return_inverse=True)
                lo, hi, code = merged(lo[by], lo[by] + length, code)
                if len(lo):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[code]), pa.array(lo), pa.array(hi)], ["doc", "lo", "hi"])

    return dealt.mapInArrow(run, "doc long, lo long, hi long")


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, lo, hi) byte ranges of ``docs(doc, text)`` that repeat earlier ones; they may overlap."""
    spark = docs.sparkSession
    total = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total[1]) // BUCKET_BYTES))
    cuts = splitters(docs, buckets, total[0], length)
    first = stored(settled(suffix_rows(docs, cuts, length), buckets, length), "suffixes")
    undecided = first.where("gram is not null").select("doc", "gram", "place").distinct()
    around = stored(surroundings(docs, undecided, length), "surroundings")
    second = repeated_windows(around.where("bytes is not null"), length)
    # windows of hot grams: the first of equal ones is pre-aggregated, the others repeat it
    hot = around.where("bytes is null").select("gram", F.struct("doc", "place").alias("at"))
    once = hot.groupBy("gram").agg(F.min("at").alias("first"))
    third = hot.join(once, "gram").where("at <> first").select("at.doc", F.col("at.place").alias("lo"), (F.col("at.place") + length).alias("hi"))
    return first.where("gram is null").select("doc", "lo", "hi").union(second).union(third)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``spans`` (start, end of maximal removed runs) and ``kept`` (remaining bytes).

    Texts are UTF-8 bytes; null is empty. Matches never cross texts. Texts of
    less than ``length`` bytes lose nothing. Ids are integers; a null id comes
    before all others. Rows that repeat an id are one text for the order: the
    same place is not earlier than itself. An empty table gives an empty
    result; other columns are not read.
    """
    texts = _ids(docs, id_col, text_col)
    ranges = stored(repeated_ranges(texts, length), "ranges")
    spans = ranges.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, spans_out, kept = [], [], [], []
            for doc, text, r in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("r").to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                out, rest, at = [], [], 0
                for lo, hi in sorted((x["lo"], x["hi"]) for x in r or ()):
                    hi = min(hi, len(raw))
                    if out and lo <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], hi)
                    elif lo < hi:
                        out.append({"start": lo, "end": hi})
                for s in out:
                    rest.append(raw[at:s["start"]])
                    at = s["end"]
                rest.append(raw[at:])
                ids.append(None if doc == LOWEST else doc)
                sizes.append(len(raw))
                spans_out.append(out)
                kept.append(b"".join(rest))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans_out, span),
                                              pa.array(kept, pa.binary())], ["doc", "n_bytes", "spans", "kept"])

    done = texts.join(spans, "doc", "left").select("doc", "text", "r").mapInArrow(
        run, "doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return done.withColumnRenamed("doc", id_col)


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, n, p, substr(x, 2 * p + 1, 2) AS byte, CASE WHEN p + 100 <= n THEN md5_number(substr(x, 2 * p + 1, 200)) END AS win
      FROM (SELECT *, unnest(range(0, n)) AS p FROM d)),
f AS (SELECT win, min((doc_id, p)) AS first FROM b WHERE win IS NOT NULL GROUP BY win),
m AS (SELECT b.*, coalesce((doc_id, p) <> first, false)::INT AS again FROM b LEFT JOIN f USING (win)),
g AS (SELECT *, max(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM m),
k AS (SELECT *, gone = 1 AND lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) = 0 AS starts FROM g),
o AS (SELECT doc_id, sum(gone) AS gone, count(*) FILTER (WHERE starts) AS spans, string_agg(byte, '' ORDER BY p) FILTER (WHERE gone = 0) AS rest FROM k GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)"""


@query("op6_suffix_dedup", SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))
