"""Byte-level BPE encoding and decoding with a shared lexicon of frequent words.

One pass counts the words of the whole corpus; the most frequent ones are
merged once and compiled into the transducer of ``lexicon``, whose file goes to
every executor and is memory-mapped there. Encoding looks words up in it and
merges only words it does not hold, exactly, by the ranks of the vocabulary.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import query, shared_folder, stored, table, text_of
from .lexicon import Lexicon, build

LEXICON_WORDS = 1 << 16
CACHE = 300_000  # word forms that a worker remembers; it starts anew beyond
SLICE = 500  # texts whose pieces are held at once
COUNTER = 500_000  # distinct words that a task counts before it hands them on

#: The pattern of byte-level pre-tokenisation.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                     r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pieces of plain prose that split alike alone and in their text.
PLAIN = re.compile(r" ?[^\W\d_]+|[.,;:!?](?=[ \n]|\Z)|\n(?=\S)| ?\S+")


@dataclass
class Vocabulary:
    byte_id: list[int]  # by byte
    merges: dict[tuple[int, int], tuple[int, int]]  # pair -> rank, id
    raw: list[bytes]  # by id: the bytes
    decimal: list[bytes]
    added: dict[str, int]
    split_added: re.Pattern | None


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(other)}


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    chars, ids = byte_chars(), spec["model"]["vocab"]
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    raw = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for token, i in ids.items():
        raw[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
    for token, i in added.items():
        raw[i] = token.encode()
    merges = {}
    for rank, m in enumerate(spec["model"]["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
    own = {b: ids[c] for c, b in chars.items()}
    pattern = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
    return Vocabulary([own[b] for b in range(256)], merges, raw, [b"%d" % i for i in range(len(raw))], added, pattern)


def merge(word: bytes, v: Vocabulary) -> list[int]:
    """Ids of one word: the pair of lowest rank is joined, leftmost first, until none is left."""
    ids = [v.byte_id[b] for b in word]
    get = v.merges.get
    while len(ids) > 1:
        best = min((m for m in map(get, zip(ids, ids[1:])) if m), default=None)
        if best is None:
            break
        rank, k, out = best[0], 0, []
        while k < len(ids):
            m = get((ids[k], ids[k + 1])) if k + 1 < len(ids) else None
            if m and m[0] == rank:
                out.append(m[1])
                k += 2
            else:
                out.append(ids[k])
                k += 1
        ids = out
    return ids


def packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Merger:
    """Merges many words at once: every step joins the best pair of each word, leftmost first."""

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.base = v, len(v.raw)
        pairs = np.array([a * self.base + b for a, b in v.merges], np.int64)
        order = np.argsort(pairs)
        ranks = np.array([[r, i] for r, i in v.merges.values()], np.int64).reshape(-1, 2)
        self.pairs, self.rank = pairs[order], ranks[order, 0]
        self.joined = np.zeros(int(ranks[:, 0].max(initial=0)) + 1, np.int64)
        self.joined[ranks[:, 0]] = ranks[:, 1]
        self.none = len(self.joined)  # above every rank
        self.byte_id = np.array(v.byte_id, np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; a negative id has none."""
        code = a * self.base + b
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return np.where((self.pairs[at] == code) & (a >= 0) & (b >= 0), self.rank[at], self.none)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word as the bytes of int32 numbers."""
        out = [b""] * len(words)
        length = np.array([len(w) for w in words], np.int64)
        if not len(self.pairs):
            return [packed(merge(w, self.v)) for w in words]
        low = 0
        for high in (4, 8, 12, 16, 24, 40, 64):
            some = np.flatnonzero((length > low) & (length <= high))
            low = high
            for at in range(0, len(some), 20_000):
                self._block(some[at:at + 20_000], words, high, out)
        for i in np.flatnonzero(length > low):
            out[i] = packed(merge(words[i], self.v))
        return out

    def _block(self, chosen: np.ndarray, words: list[bytes], width: int, out: list) -> None:
        grid = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in chosen), np.uint8).reshape(len(chosen), width)
        size = np.array([len(words[i]) for i in chosen])
        ids = np.full((len(chosen), width + 1), -1, np.int64)  # a last column of no token
        ids[:, :width] = np.where(np.arange(width) < size[:, None], self.byte_id[grid], -1)
        rank = np.full((len(chosen), width + 1), self.none, np.int64)  # of the pair that begins there
        rank[:, :width] = self.ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width + 1)
        while len(chosen):
            j = rank.argmin(1)
            rows = np.arange(len(chosen))
            best = rank[rows, j]
            live = best < self.none
            if not live.all():
                done = ids[~live].astype(np.int32)
                raw, wide = done.tobytes(), 4 * (width + 1)
                for k, (i, n) in enumerate(zip(chosen[~live].tolist(), (done >= 0).sum(1).tolist())):
                    out[i] = raw[k * wide:k * wide + 4 * n]
                chosen, ids, rank, j, best = chosen[live], ids[live], rank[live], j[live], best[live]
                rows = rows[:len(chosen)]
                if not len(chosen):
                    break
            source = np.minimum(columns + (columns > j[:, None]), width)
            ids[rows, j] = self.joined[best]
            ids = np.take_along_axis(ids, source, 1)
            rank = np.take_along_axis(rank, source, 1)
            rank[rows, j] = self.ranks(ids[rows, j], ids[rows, np.minimum(j + 1, width)])
            before = np.maximum(j - 1, 0)
            rank[rows, before] = np.where(j > 0, self.ranks(ids[rows, before], ids[rows, j]), rank[rows, before])


def words_of(piece: str) -> list[str]:
    """The words of one piece; letters alone need no regular expression."""
    return [piece] if piece.isalpha() or piece[0] == " " and piece[1:].isalpha() else WORD.findall(piece)


def plain_pieces(text: str) -> list[str]:
    """Pieces whose words are the text's words: words with their space in plain prose, else every word."""
    pieces = PLAIN.findall(text)
    return pieces if sum(map(len, pieces)) == len(text) else WORD.findall(text)


_LOADED: dict[str, object] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = load_vocabulary(path)
    return _LOADED[path]


class Encoder:
    """Encodes texts in one worker; remembers the ids (as bytes) of the pieces it has met."""

    def __init__(self, v: Vocabulary, lexicon: Lexicon) -> None:
        self.v, self.lexicon, self.known, self.merger = v, lexicon, {}, Merger(v)

    def learn(self, pieces: set[str]) -> None:
        words = {p: [w.encode("utf-8", "surrogatepass") for w in words_of(p)] for p in pieces}
        distinct = list(set(chain.from_iterable(words.values())))
        ids, unseen = {}, []
        for w, rank in zip(distinct, self.lexicon.ranks(distinct).tolist()):
            if rank >= 0:
                ids[w] = self.lexicon.output(rank)
            else:
                unseen.append(w)
        ids.update(zip(unseen, self.merger.merge_all(unseen)))
        for p, ws in words.items():
            self.known[p] = ids[ws[0]] if len(ws) == 1 else b"".join(map(ids.__getitem__, ws))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; the pieces of at most ``SLICE`` texts are held at once."""
        split, added = self.v.split_added, self.v.added
        fixed = {s: packed([i]) for s, i in added.items()}
        self.known.update(fixed)
        out = []
        for at in range(0, len(texts), SLICE):
            parts = [[s for s in split.split(t) if s] if split and any(a in t for a in added) else [t] for t in texts[at:at + SLICE]]
            pieces = [[x for s in ss for x in ([s] if s in added else plain_pieces(s))] for ss in parts]
            seen = set(chain.from_iterable(pieces))
            if len(self.known) + len(seen) > CACHE:
                self.known = dict(fixed)
            self.learn(seen.difference(self.known))
            get = self.known.__getitem__
            out += [np.frombuffer(b"".join(map(get, ps)), np.int32) for ps in pieces]
        return out


def encoder(vocab_path: str, lexicon_file: str) -> Encoder:
    key = f"{vocab_path}|{lexicon_file}"
    if key not in _LOADED:
        for old in [k for k in _LOADED if "|" in k]:  # a worker may outlive its query: one cache at a time
            del _LOADED[old]
        _LOADED[key] = Encoder(vocabulary(vocab_path), Lexicon(np.load(SparkFiles.get(lexicon_file), mmap_mode="r")))
    return _LOADED[key]


def word_counts(docs: DataFrame, vocab_path: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; each task counts its own words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, seen = vocabulary(vocab_path), Counter()

        def flush():
            words: Counter = Counter()
            for p, n in seen.items():
                for w in words_of(p):
                    words[w] += n
            seen.clear()
            return pa.RecordBatch.from_pydict({"word": [w.encode() for w in words], "n": list(words.values())})

        for batch in batches:
            for t in batch.column(0).to_pylist():
                for s in v.split_added.split(t) if v.split_added and any(a in t for a in v.added) else [t]:
                    if s not in v.added:
                        seen.update(plain_pieces(s))
                if len(seen) > COUNTER:
                    yield flush()
        if seen:
            yield flush()

    counted = docs.select(text_of(text_col).alias("t")).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def ship_lexicon(docs: DataFrame, vocab_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the ``words`` most frequent words and send the file to all executors; its name.

    Counts cover all texts; words that occur once are left to the merges. The
    number of words, not the corpus, bounds what the driver holds.
    """
    spark = docs.sparkSession
    v = load_vocabulary(vocab_path)
    counts = stored(word_counts(docs, vocab_path, text_col).where("n > 1"), "words")
    # how many words are how frequent, in a bounded number of steps: where to cut
    step = F.floor(F.log2("n") * 16)
    sizes = sorted(((r.k, r.c) for r in counts.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True)
    room, least = words, None
    for k, c in sizes:
        if c > room:
            break
        room, least = room - c, k
    top = counts.where(step >= least).select("word").collect() if least is not None else []
    frequent = [bytes(r.word) for r in top if len(r.word) <= 64]
    data = build({w: np.frombuffer(i, np.int32).tolist() for w, i in zip(frequent, Merger(v).merge_all(frequent))})
    buffer = pa.BufferOutputStream()
    np.save(buffer, data)
    # the file is written to the shared folder by Spark's own file system layer
    path = shared_folder(spark, "lexicon") + ".npy"
    jvm, sc = spark._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    raw = buffer.getvalue().to_pybytes()
    for at in range(0, len(raw), 1 << 20):
        out.write(bytearray(raw[at:at + (1 << 20)]))
    out.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


def encode(text: Column, vocab_path: str, lexicon_file: str) -> Column:
    """array<int> of token ids, null text as empty; no special tokens are added."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(vocab_path, lexicon_file)
        for texts in batches:
            yield pd.Series([*e.encode(texts.fillna("").tolist()), None], dtype=object)[:-1]

    return ids(text)


def decode(ids: Column, vocab_path: str) -> Column:
    """The text of token ids; bytes that are no UTF-8 become replacement characters. Null gives null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(vocab_path)
        for rows in batches:
            yield rows.map(lambda r: None if r is None else to_bytes(r, v).decode("utf-8", "replace"))

    return texts(ids)


def to_bytes(ids, v: Vocabulary) -> bytes:
    return b"".join(map(v.raw.__getitem__, ids))


def digests(ids: Column, vocab_path: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of token ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def summary(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = vocabulary(vocab_path)
        for rows in batches:
            yield pd.DataFrame([(
                len(r), hashlib.sha256(b",".join(map(v.decimal.__getitem__, r))).hexdigest(),
                hashlib.sha256(to_bytes(r, v).decode("utf-8", "replace").encode()).hexdigest())
                for r in map(np.ndarray.tolist, rows)],
                columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return summary(ids)


def token_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Null and empty texts have no tokens. Rows repeat as they are; an empty
    table gives an empty result; other columns are not read.
    """
    name = ship_lexicon(docs, vocab_path, text_col)
    d = digests(encode(text_of(text_col), vocab_path, name), vocab_path)
    # the ids stay in the Python worker: the two functions run as one
    return docs.select(F.col(id_col), d.alias("_d")).select(id_col, "_d.*")


@query("op3_bpe_encode_decode")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_digests(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))
