"""The conversation trie beside a plain Python version."""

import hashlib
import random
import zlib

import pytest

from voxledger.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv string, n string, pos string"


def brute(rows):
    """(smallest member, depth) -> the other columns, for rows whose ties in turn are equal rows."""
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [r[2:] for r in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(turns.get(c - int(c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:])
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    out = {}
    below = {}
    for key in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[key]) - 1) * (len(key[-1][1].encode()) if key else 0)
        some = [below[k] for k in kids.get(key, [])]
        below[key] = (sum(s[0] for s in some) or 1, own + sum(s[1] for s in some))
        ends = ",".join(str(c) for c in sorted(nodes[key]) if len(paths[c]) == len(key))
        out[min(nodes[key]), len(key)] = (min(nodes[key[:-1]]) if key else None, len(nodes[key]), len(kids.get(key, [])), *below[key],
                                          hashlib.sha256(ends.encode()).hexdigest())
    return out


def got(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)
    found = pt.prefix_trie(df).collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in found}
    assert len(out) == len(found)
    return out


def random_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), convs):
        for t in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 13, 17])):
            rows.append((c, t, "user" if t % 2 else "assistant", rng.choice(["yes", "no"]) if rng.random() < 0.2 else "same"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_brute_force(spark, seed):
    rows = random_rows(seed)
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, 1, "user", None), (3, 2, None, ""), (7, 5, "user", "x" * 100_000), (7, 6, "user", "é"),
            (10, 1, "a", "q"), (10, 1, "a", "q"), (10, 1, "a", "q"), (12, 4, "a", "q"), (-3, 1, "neg", "n"), (-5, 1, "neg", "n"), (2**40, 1, "ab", "c"),
            (2**40 + 1, 1, "a", "bc")]
    assert got(spark, rows) == brute(rows)


def test_ties_in_turn_have_one_order(spark):
    rows = [(10, 1, "a", f"t{k}") for k in range(6)] + [(11, 1, "a", "x")]
    first = got(spark, rows, 1)
    random.Random(2).shuffle(rows)
    assert got(spark, rows, 5) == first and max(d for _, d in first) >= 6


def test_empty(spark):
    assert got(spark, []) == {} and got(spark, [(None, 1, "a", "b")]) == {}


def test_long_conversation_and_copies(spark, monkeypatch):
    """A path over many pieces, and a group of equal conversations whose ids fill several rows."""
    monkeypatch.setattr(pt, "PIECE", 8)
    monkeypatch.setattr(pt, "JOINED", 200)
    rows = [(5, t, "user", f"turn {t}") for t in range(150)]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(12)]
    rows += [(6, t, "user", f"turn {t}") for t in range(90)]
    assert got(spark, rows) == brute(rows)


def test_only_parting_blocks_are_refined(spark):
    """Without siblings a block's nodes have the block's members; a block that ends early is a sibling."""
    rows = [(c, t, "user", f"t{t}") for c in (10, 15) for t in range(8)] + [(20, t, "user", f"t{t}") for t in range(6)]
    out = got(spark, rows)
    assert out == brute(rows)
    assert [out[10, d][1] for d in range(9)] == [3, 3, 3, 3, 3, 3, 3, 2, 2]


def test_running_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 4)
    rows = spark.range(40).selectExpr("id % 2 AS g", "id div 2 AS k", "id * 7919 % 101 AS x", "id AS s")
    plain = {(r.g, r.k): r for r in rows.collect()}
    for r in pt.running(rows, "g", "k", xors=("x",), sums=("s",)).collect():
        x = s = 0
        for k in range(r.k + 1):
            x, s = x ^ plain[r.g, k].x, s + plain[r.g, k].s
        assert (r.x, r.s) == (x, s)
