"""Operators with exact results beside plain Python versions."""

import hashlib
import re

import numpy as np
import pytest

from voxledger.llm import bpe, exact_dedup, jaccard_join, lexicon, shingles, suffix_dedup

SPACE = r"[\x20\x09-\x0D]"


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


# --- exact copies

def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(SPACE, "", t), []).append((-len(t), i))
    return {i: (min(g)[1], len(g), min(g)[1] == i, hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}


def test_exact_groups(unique):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(unique).collect()}
    assert got == brute_exact(texts(unique).items())


def test_exact_hot_group_is_cut_into_pieces(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('own ', id), if(id % 2 = 0, 'hot text', 'hot  text')) AS text")
    rows = exact_dedup.exact_groups(docs).where("group_size > 1").collect()
    assert len(rows) == 2000 and {r.group_size for r in rows} == {2000}
    assert {r.keep_id for r in rows} == {1} and sum(r.kept for r in rows) == 1


def test_exact_odd_rows(odd, empty):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == odd.count()
    assert sum(r.kept for r in rows if r.doc_id == 9) == 1  # repeated row: one stays
    blank = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert len(blank) == 4 and [r.doc_id for r in blank if r.kept] == [6]
    assert exact_dedup.exact_groups(empty).count() == 0
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.text_sha256 for r in rows})
    assert exact_dedup.drop_copies(empty).columns == odd.columns


# --- near copies

def word_sets(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in rows:
        w = [x for x in re.split(SPACE + "+", t.translate(lower)) if x]
        out[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute_components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(df).collect()}


def test_near_groups(unique):
    sets = word_sets(texts(unique).items())
    comp = brute_components(sets)
    assert near(unique) == {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_groups_small_and_hot(spark):
    """Sizes around the boundary of subsets, and a hot group in which many pairs do not link."""
    rng = np.random.default_rng(1)
    base = [f"v{k}" for k in range(60)]
    rows = [(k, " ".join(f"a{(j if rng.random() > 0.03 else rng.integers(99))}" for j in range(4 + k % 26))) for k in range(300)]
    for k in range(300, 500):
        w = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 3)):
            w[j] = f"e{rng.integers(5)}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sets = word_sets(rows)
    comp = brute_components(sets)
    assert near(docs) == {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_groups_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "EXACT_BLOCK", 8)
    rows = [(k, " ".join(f"w{j}" if j != k % 40 else f"x{k}" for j in range(90))) for k in range(70)]
    sets = word_sets(rows)
    comp = brute_components(sets)
    assert near(spark.createDataFrame(rows, "doc_id long, text string")) == {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_hot_group_with_failing_pairs(spark, monkeypatch):
    """3,000 near sets in 20 clusters that nearly link: each block gives fewer pairs than it has sets."""
    seen, plain = [], jaccard_join.block_pairs

    def counted(members, exact):
        out = plain(members, exact).cache()
        seen.append((exact, members.count(), out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "block_pairs", counted)
    monkeypatch.setattr(jaccard_join, "EXACT_BLOCK", 512)
    rows = []
    for k in range(3000):
        w = [f"w{j}" for j in range(110)]
        w[5 * (1 + k % 20)], w[-2] = f"c{k % 20}", f"l{k}"
        rows.append((k, " ".join(w)))
    got = near(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    sets = word_sets(rows[:40])
    assert {len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]) for a in range(20) for b in range(a)} == {False}
    assert got == {k: (106, k % 20) for k in range(3000)}
    assert [e for e, *_ in seen] == [False, True] and all(pairs < members for _, members, pairs in seen)


def test_near_large_sets_have_longer_sketches(spark):
    """Long texts that share passages, and near copies of them."""
    rng = np.random.default_rng(6)
    shared = [" ".join(f"p{i}x{j}" for j in range(60)) for i in range(5)]
    rows = []
    for k in range(24):
        own = [f"d{k % 12}y{j}" for j in range(3000)]
        for j in rng.integers(0, 3000, 20 if k >= 12 else 0):
            own[j] = f"z{k}"
        rows.append((k, " ".join(own) + " " + shared[k % 5] + " " + shared[(k + 1) % 5]))
    sets = word_sets(rows)
    comp = brute_components(sets)
    assert near(spark.createDataFrame(rows, "doc_id long, text string")) == {i: (len(sets[i]), comp[i]) for i in sets}
    assert len(set(comp.values())) < 24


def test_sketches_fold():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, int(n), dtype=np.uint64) for n in (10, 900, 1100, 1300, 5000)]
    words = jaccard_join.sketch_words(np.array([len(s) for s in sets])).tolist()
    assert words == [8, 8, 16, 16, 64]

    def sketch(x, w):
        bit = shingles.mix(x, 5) & np.uint64(64 * w - 1)
        out = np.zeros(w, np.uint64)
        np.bitwise_xor.at(out, (bit >> np.uint64(6)).astype(int), np.uint64(1) << (bit & np.uint64(63)))
        return out

    s = jaccard_join.Sketches([sketch(x, w).tobytes() for x, w in zip(sets, words)])
    for i in range(5):
        for j in range(5):
            w = min(words[i], words[j])
            want = int(np.bitwise_count(sketch(sets[i], w) ^ sketch(sets[j], w)).sum())
            assert s.distance(np.array([i]), np.array([j])).tolist() == [want]


def test_near_odd_rows(odd, empty):
    rows = jaccard_join.near_groups(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert jaccard_join.near_groups(empty).count() == 0
    kept = jaccard_join.drop_near_copies(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) == len({r.component_id for r in rows if r.doc_id is not None})


def test_boundary_follows_cost():
    assert jaccard_join.choose_boundary({}) == 0
    assert jaccard_join.choose_boundary({n: 100 for n in range(1, 9)}) >= 4
    assert jaccard_join.choose_boundary({16: 1000}) < 16


def test_shingle_chunks_agree(monkeypatch):
    rows = ["a b c d e f", "", "x", "a b c d e", "A  B\tc d e f g"]
    once = [shingles.shingle_sets([t.encode()])[0].tolist() for t in rows]
    h, at = shingles.shingle_sets([t.encode() for t in rows])
    assert [h[at == k].tolist() for k in range(5)] == once


# --- repeated strings

def brute_removed(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = t.encode()
        mark = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                mark[s:s + length] = b"\1" * length
            seen.add(w)
        out[i] = ([m.span() for m in re.finditer(b"\1+", bytes(mark))], bytes(b for b, m in zip(raw, mark) if not m))
    return out


def removed(df):
    return {r.doc_id: ([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.without_repeats(df).collect()}


def test_suffix_dedup(unique):
    assert removed(unique) == brute_removed(texts(unique).items())


def test_suffix_dedup_random(spark):
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("ab c"), 400)) for _ in range(20)]
    rows = []
    for i in range(90):
        parts = []
        for _ in range(rng.integers(0, 4)):
            b, k = base[rng.integers(20)], int(rng.integers(0, 300))
            parts.append(b[k:k + int(rng.integers(0, 300))] + "é" * int(rng.integers(0, 2)) * 120)
        rows.append((i, "".join(parts)))
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute_removed(rows)


def test_suffix_dedup_hot_gram(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 20)
    line = "The same line of text stands in very many of the texts, whatever comes before it. "
    rows = [(k, f"{k % 9} {k % 7} before " + line + line[: k % 80] + f"after {k % 5}") for k in range(150)]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute_removed(rows)


def test_suffix_dedup_odd_rows(odd, empty):
    rows = suffix_dedup.without_repeats(odd).collect()
    assert len(rows) == odd.count()
    assert all(not r.spans for r in rows if r.doc_id in (1, 9))  # a repeated row is no earlier place
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(0)
    cols = [rng.integers(0, 4, 500) for _ in range(3)]
    assert suffix_dedup.multikey_order(cols).tolist() == np.lexsort(cols[::-1]).tolist()


# --- tokens

@pytest.fixture(scope="module")
def vocab():
    from public_tokenizers import path

    return path("byte_bpe_50k.json")


def library(vocab, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocab)
    t.no_truncation()
    t.no_padding()
    ids = t.encode(text, add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_tokens_match_the_library(unique, vocab):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, t in texts(unique).items():
        ids, back = library(vocab, t)
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(back))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.token_digests(unique, vocab).collect()}
    assert got == want


def test_tokens_of_odd_strings(vocab):
    from tokenizers import Tokenizer

    t, v = Tokenizer.from_file(vocab), bpe.load_vocabulary(vocab)
    e = bpe.Encoder(v, lexicon.Lexicon(lexicon.build({w: bpe.merge(w, v) for w in (b" foo", b"foo", b"fo")})))
    rng = np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "'ll", "<|endoftext|>", "a", "Zé", "12", "½", "²", "٣", "中文", "😀", "\x1c", "\x85", "\xa0",
             "-", "...", "foo", " foo", ".", "\x00", "\ufffd", "supercalifragilistic" * 5]
    rows = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)]
    for x, ids in zip(rows, e.encode(rows)):
        assert ids.tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)
        assert bpe.to_bytes(ids.tolist(), v).decode("utf-8", "replace") == t.decode(ids.tolist(), skip_special_tokens=False)


def test_tokens_columns(spark, odd, empty, vocab):
    from pyspark.sql import functions as F

    assert bpe.token_digests(odd, vocab).count() == odd.count() and bpe.token_digests(empty, vocab).count() == 0
    name = bpe.ship_lexicon(odd, vocab)
    ids = bpe.encode(F.col("text"), vocab, name)
    rows = odd.select("text", ids.alias("ids")).withColumn("back", bpe.decode(F.col("ids"), vocab)).collect()
    assert all(r.back == (r.text or "") for r in rows)


def test_lexicon_shares_suffixes():
    words = {w.encode(): [k] for k, w in enumerate("walking talking talked walked walks talks a".split())}
    lex = lexicon.Lexicon(lexicon.build(words))
    rests = {frozenset(w[len(p):] for w in words if w.startswith(p)) for q in words for p in (q[:k] for k in range(len(q) + 1))}
    assert len(lex.finals) == len(rests)  # a state for each set of endings: walk and talk lead to the same
    ranks = lex.ranks([*words, b"walk", b"", b"zz", b"walkings", b"x" * 100])
    assert (ranks[-5:] == -1).all()
    assert [np.frombuffer(lex.output(r), np.int32).tolist() for r in ranks[:-5].tolist()] == list(words.values())
    assert lexicon.Lexicon(lexicon.build({})).ranks([b"a"]).tolist() == [-1]
