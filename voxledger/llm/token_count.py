"""Token counts by compiled finite-state transducers, without building token ids.

Two deterministic transducers are run one behind the other. The first reads
code point classes and says where words begin. The second reads bytes; its
states are what byte-pair merges still depend on: the longest suffix that can
go on to a token, and for each start of a token inside it the last token and
the count before it. A transition carries the change of the token count, so
the sum along a text is its number of tokens.

Texts of a batch lie behind one another and are cut into many chunks that are
run at once. A chunk is a map from its entering state to its leaving state; a
parallel prefix scan composes the maps and gives every chunk its true entry.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from .bpe import Vocabulary, load_vocabulary, merge
from .common import query, table

WIDTH = 256  # symbols of a chunk
SLICE = 1 << 20  # characters that a task runs at once
STATES = 400_000  # states beyond which a worker goes back to the compiled ones
SPREAD = 0x9E3779B97F4A7C15  # multiplier of the hash table
WARM = 64  # bytes before a chunk inside a long word, from which its entry is guessed

# classes of code points; the letters of contractions have their own
OTHER, NUMBER, LETTER, STMD, RV, E, L, APOSTROPHE, SPACE, WHITE, END = range(11)
LETTERS = (LETTER, STMD, RV, E, L)
# states: what was read last; an open apostrophe or contraction, and one that has just ended
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHER, AT_SPACE, AT_WHITE, OPEN, OPEN_RV, OPEN_L, ENDED = range(10)
HERE, BEFORE = 1, 2  # a word begins at this code point; at the one before


def split_step(state: int, c: int) -> tuple[int, int]:
    """(next state, word marks) of the word splitter."""
    run = {OTHER: IN_OTHER, NUMBER: IN_NUMBERS, APOSTROPHE: IN_OTHER} | dict.fromkeys(LETTERS, IN_LETTERS)
    white = state in (AT_SPACE, AT_WHITE)
    if state == OPEN and c == STMD or state == OPEN_RV and c == E or state == OPEN_L and c == L:
        return ENDED, 0
    if state == OPEN and c in (RV, L):
        return (OPEN_RV if c == RV else OPEN_L), 0
    mark = 0
    if state in (OPEN_RV, OPEN_L):  # no contraction: the letter began a word
        state, mark = IN_LETTERS, BEFORE
    if c == END:
        return BEGIN, mark
    if c in (SPACE, WHITE):
        return (AT_SPACE if c == SPACE else AT_WHITE), mark | (0 if white else HERE)
    if white:  # the last white character leaves its run: a space goes to the word, any other stands alone
        mark |= BEFORE
    if state == AT_SPACE or run[c] == state or state == OPEN and run[c] == IN_OTHER:
        return run[c], mark
    return (OPEN if c == APOSTROPHE else run[c]), mark | HERE


SPLIT = np.array([[split_step(s, c) for c in range(11)] for s in range(10)], np.uint8)
SPLIT_NEXT, SPLIT_MARK = SPLIT[:, :, 0].ravel(), SPLIT[:, :, 1].ravel()

def code_point_kinds(vocab_path: str) -> np.ndarray:
    """The class of every code point, as the library splits words.

    Tables of different Unicode versions disagree on newer code points only;
    there the library itself is asked, with the code point between a letter
    and a digit.
    """
    every = "".join(chr(k) if not 0xD800 <= k < 0xE000 else "\0" for k in range(0x110000))
    out = np.full(len(every), OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    own = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER) for c in every], np.uint8)
    doubtful = np.flatnonzero((out != own) & (out != WHITE)).tolist()
    splitter = Tokenizer.from_file(vocab_path).pre_tokenizer
    begins = {lo for _, (lo, _) in splitter.pre_tokenize_str("".join(f"a{every[k]}1\n" for k in doubtful))}
    for i, k in enumerate(doubtful):
        out[k] = LETTER if 4 * i + 1 not in begins else NUMBER if 4 * i + 2 not in begins else OTHER
    for chars, kind in (("stmd", STMD), ("rv", RV), ("e", E), ("l", L), ("'", APOSTROPHE), (" ", SPACE)):
        out[[ord(c) for c in chars]] = kind
    return out


def composed(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of state maps (chunk, state): row k leads through the chunks 0 to k."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), 1)
        step *= 2
    return maps


def word_marks(classes: np.ndarray) -> np.ndarray:
    """Whether a word begins at each symbol; the stream begins and ends at a text's border."""
    n = len(classes)
    chunks = -(-n // WIDTH)
    grid = np.full(chunks * WIDTH, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(chunks, WIDTH).T)
    # the map of every chunk: all states at once until they have met, then one
    state = np.repeat(np.arange(10, dtype=np.uint8)[:, None], chunks, 1)
    for k in range(WIDTH):
        state = SPLIT_NEXT.take(state * np.uint8(11) + grid[k])
        if len(state) > 1 and (state == state[0]).all():
            state = state[:1]
    maps = np.ascontiguousarray(np.broadcast_to(state, (10, chunks)).T)
    entry = np.zeros(chunks, np.uint8)
    entry[1:] = composed(maps)[:-1, BEGIN]
    marks = np.empty((WIDTH, chunks), np.uint8)
    for k in range(WIDTH):
        at = entry * np.uint8(11) + grid[k]
        marks[k] = SPLIT_MARK.take(at)
        entry = SPLIT_NEXT.take(at)
    marks = marks.T.ravel()[:n]
    out = (marks & HERE).astype(bool)
    out[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return out


class Machine:
    """The merge transducer; transitions are worked out when first needed and kept in a hash table.

    A state is a node of the trie of tokens (the longest suffix of the word
    that a token may begin with) and, for each shorter suffix of that kind, the
    last token before it and the tokens counted up to there, seen from here.
    The next token must fit behind that last token, and exactly one does.
    """

    def __init__(self, v: Vocabulary, kinds: np.ndarray) -> None:
        self.v, self.kinds = v, kinds
        self.halves = {out: (rank, *pair) for pair, (rank, out) in v.merges.items()}
        rank_of = {out: rank for out, (rank, _, _) in self.halves.items()}
        #: Every token comes of one merge, later than those of its halves: merges go strictly by rank.
        self.ranked = len(self.halves) == len(v.merges) and all(
            rank > max(rank_of.get(a, -1), rank_of.get(b, -1)) for rank, a, b in self.halves.values())
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.children: dict[int, int] = {}  # node * 256 + byte -> node
        self.depth, self.fail, self.token, parent = [0], [0], [-1], [0]
        added = set(v.added.values())
        for i, raw in enumerate(v.raw):
            if raw and i not in added:
                node = 0
                for b in raw:
                    key = node << 8 | b
                    if key not in self.children:
                        self.children[key] = len(self.depth)
                        self.depth.append(self.depth[node] + 1)
                        parent.append(key)
                        self.fail.append(0)
                        self.token.append(-1)
                    node = self.children[key]
                self.token[node] = i
        for x in sorted(range(1, len(self.depth)), key=self.depth.__getitem__):
            if self.depth[x] > 1:
                self.fail[x] = self.follow(self.fail[parent[x] >> 8], parent[x] & 255)
        self.fits: dict[tuple[int, int], bool] = {}
        self.restart([np.array([0, -1, 0], np.int32).tobytes()], np.zeros((2, 0), np.int64))

    def restart(self, states: list[bytes], transitions: np.ndarray) -> None:
        """Hold these states and (symbol, value) transitions only."""
        self.states, self.fits = list(states), {}
        self.number = {s: k for k, s in enumerate(self.states)}
        self.filled, self.bits = 0, 17
        self._table(transitions)

    def compiled(self) -> tuple[list[bytes], np.ndarray]:
        held = np.flatnonzero(self.key >= 0)
        return self.states, np.stack([self.key[held], self.value[held]])

    def _table(self, transitions: np.ndarray) -> None:
        """A table of 2 ** bits places, at most half full."""
        while transitions.shape[1] * 2 > 1 << self.bits:
            self.bits += 1
        self.key = np.full(1 << self.bits, -1, np.int64)  # state * 256 + byte
        self.value = np.zeros(1 << self.bits, np.int64)  # next state * 256 + 128 + change of the count
        self.filled = 0
        for key, value in transitions.T.tolist():
            self._put(key, value)

    def _put(self, key: int, value: int) -> None:
        at, last = (key * SPREAD & 2**64 - 1) >> 64 - self.bits, len(self.key) - 1
        while self.key[at] >= 0:
            at = at + 1 & last
        self.key[at], self.value[at] = key, value
        self.filled += 1

    def follow(self, node: int, b: int) -> int:
        get = self.children.get
        to = get(node << 8 | b)
        while to is None and node:
            node = self.fail[node]
            to = get(node << 8 | b)
        return to or 0

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at the left (1) or right (2) edge of a token while it grows, with the rank that ends each."""
        out = self.edges.get((token, side))
        if out is None:
            out, x, end = [], token, float("inf")
            while True:
                out.append((x, end))
                if x not in self.halves:
                    break
                end, x = self.halves[x][0], self.halves[x][side]
            out = self.edges[token, side] = out[::-1]
        return out

    def fit(self, last: int, t: int) -> bool:
        """Whether merges leave ``t`` whole behind the token ``last`` (-1: at the begin of a word)."""
        out = self.fits.get((last, t))
        if out is None:
            raw = self.v.raw
            if not self.ranked:
                out = merge(raw[t], self.v) == [t] if last < 0 else merge(raw[last] + raw[t], self.v) == [last, t]
            elif last >= 0:
                out = self.fit(-1, last) and self.fit(-1, t) and self.crossing(last, t) < 0
            else:
                _, a, b = self.halves.get(t, (0, -1, -1))
                out = a < 0 or self.fit(-1, a) and self.fit(-1, b) and self.crossing(a, b) == t
            self.fits[last, t] = out
        return out

    def crossing(self, a: int, b: int) -> int:
        """The first token to join the edges of two tokens while both grow, or -1; of equal ranks the left merge goes first."""
        left, right, merges = self.edge(a, 2), self.edge(b, 1), self.v.merges
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            over = merges.get((x, y))
            if over and over[0] < x_ends and over[0] <= y_ends:
                return over[1]
            if x_ends <= y_ends:
                if i + 1 == len(left):
                    return -1
                i += 1
            else:
                j += 1

    def learn(self, state: int, b: int) -> int:
        """Work out one transition; its value."""
        node, *before = np.frombuffer(self.states[state], np.int32).tolist()
        at, x = {}, node  # by length of the suffix: the last token before it and the count up to there
        for k in range(0, len(before), 2):
            at[self.depth[x]] = before[k], before[k + 1]
            x = self.fail[x]
        x = to = self.follow(node, b)
        suffixes = []
        while x:
            suffixes.append((self.depth[x] - 1, self.token[x]))
            x = self.fail[x]
        t, gain = next((t, at[d][1] + 1) for d, t in suffixes if t >= 0 and self.fit(at[d][0], t))
        key = np.array([to, *(n for d, _ in suffixes for n in (at[d][0], at[d][1] - gain)), t, 0], np.int32).tobytes()
        number = self.number.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        return number << 8 | gain + 128

    def look_up(self, symbol: np.ndarray) -> np.ndarray:
        """Values of the transitions, which are learnt where missing."""
        at = (symbol.astype(np.uint64) * np.uint64(SPREAD)) >> np.uint64(64 - self.bits)
        at = at.view(np.int64)
        found, out = self.key.take(at), self.value.take(at)
        other = np.flatnonzero(found != symbol)
        while len(other):
            none = found[other] < 0
            if none.any():
                keys, back = np.unique(symbol[other[none]], return_inverse=True)
                values = [self.learn(k >> 8, k & 255) for k in keys.tolist()]
                for key, value in zip(keys.tolist(), values):
                    self._put(key, value)
                out[other[none]] = np.array(values)[back]
                other = other[~none]
            at[other] = at[other] + 1 & len(self.key) - 1
            found[other], out[other] = self.key.take(at[other]), self.value.take(at[other])
            other = other[found[other] != symbol[other]]
        if self.filled * 2 > len(self.key):
            self._table(self.compiled()[1])
        return out

    def run(self, data: np.ndarray, begins: np.ndarray, lo: np.ndarray, hi: np.ndarray, entry: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Run the chunks from ``lo`` to ``hi`` at once; fills ``gains`` by byte and returns the leaving states."""
        order = np.argsort(lo - hi, kind="stable")  # longest first: those still running are a prefix
        lo, size = lo[order], (hi - lo)[order]
        state = entry[order]
        live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
        for k, m in enumerate(live.tolist()):
            place = lo[:m] + k
            symbol = state[:m] << 8
            symbol[begins.take(place)] = 0
            symbol |= data.take(place)
            value = self.look_up(symbol)
            state[:m] = value >> 8
            gains[place] = (value & 255) - 128
        out = np.empty_like(state)
        out[order] = state
        return out

    def count(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Change of the token count at each byte; words begin at ``begins``, the first byte among them."""
        gains = np.zeros(len(data), np.int8)
        words = np.flatnonzero(begins)
        cuts = np.arange(0, len(data), WIDTH)
        word = words[np.searchsorted(words, cuts, "right") - 1]
        cuts = np.unique(np.where(cuts - word <= WIDTH, word, cuts))  # inside a longer word the cut stays
        ends = np.append(cuts[1:], len(data))
        fixed = begins[cuts]  # the map of such a chunk is constant
        entry = np.zeros(len(cuts), np.int64)
        inside = np.flatnonzero(~fixed)
        if len(inside):
            entry[inside] = self.run(data, begins, cuts[inside] - WARM, cuts[inside], np.zeros(len(inside), np.int64), gains)
        leave = self.run(data, begins, cuts, ends, entry, gains)
        while len(inside):  # a chunk enters as the one before leaves; its map is worked out at the states that occur
            inside = np.flatnonzero(~fixed & (entry != np.concatenate([[0], leave[:-1]])))
            entry[inside] = leave[inside - 1]
            leave[inside] = self.run(data, begins, cuts[inside], ends[inside], entry[inside], gains)
        return gains


@dataclass
class Compiled:
    """What the driver compiles from the vocabulary file; its size follows the vocabulary alone."""

    kinds: np.ndarray
    states: list[bytes]
    transitions: np.ndarray


def compile_machine(vocab_path: str) -> Compiled:
    """Code point classes, and the states and transitions that the tokens themselves take, each read as a word."""
    m = Machine(load_vocabulary(vocab_path), code_point_kinds(vocab_path))
    words = [w for i, w in enumerate(m.v.raw) if w and i not in set(m.v.added.values())]
    size = np.array([len(w) for w in words])
    begins = np.zeros(size.sum(), bool)
    begins[np.cumsum(size) - size] = True
    m.count(np.frombuffer(b"".join(words), np.uint8), begins)
    return Compiled(m.kinds, *m.compiled())


_MACHINES: dict[str, Machine] = {}


def machine(vocab_path: str, compiled: Compiled) -> Machine:
    """The worker's machine; beyond ``STATES`` states it starts anew from the compiled ones."""
    m = _MACHINES.get(vocab_path)
    if m is None:
        _MACHINES.clear()
        m = _MACHINES[vocab_path] = Machine(load_vocabulary(vocab_path), compiled.kinds)
    if len(m.states) == 1 or len(m.states) > STATES:
        m.restart(compiled.states, compiled.transitions)
    return m


def parts(text: str, kind: np.ndarray) -> Iterator[str]:
    """A long text in parts of about ``SLICE`` characters, cut before a space that follows a word."""
    lo = 0
    white = (SPACE, WHITE)
    while len(text) - lo > SLICE:
        p = text.rfind(" ", lo + 1, lo + SLICE)
        while p > lo and kind[ord(text[p - 1])] in white:
            p = text.rfind(" ", lo + 1, p)
        if p <= lo:
            p = text.find(" ", lo + SLICE)
            while p > 0 and kind[ord(text[p - 1])] in white:
                p = text.find(" ", p + 1)
        if p <= lo:
            break
        yield text[lo:p]
        lo = p
    yield text[lo:]


def count_parts(m: Machine, segments: list[str]) -> np.ndarray:
    """Tokens of each segment of plain text."""
    text = "\n".join(segments) + "\n"
    data = np.frombuffer(text.encode(), np.uint8)
    border = np.cumsum([len(s) + 1 for s in segments]) - 1
    classes = m.kinds.take(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    classes[border] = END
    marks = word_marks(classes)
    marks[border] = True  # the line feed between two segments is a word of one token
    if len(marks) == len(data):
        begins = marks
    else:
        leading = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.zeros(len(data), bool)
        begins[leading[marks]] = True
        border = leading[border]
    first = np.concatenate([[0], border[:-1] + 1])
    return np.add.reduceat(m.count(data, begins), first, dtype=np.int64) - 1


def count_texts(m: Machine, texts: list[str]) -> np.ndarray:
    """Tokens of each text; special strings are one token each."""
    v, out = m.v, np.zeros(len(texts), np.int64)
    run, owner, size = [], [], 0
    for i, t in enumerate(texts):
        for s in v.split_added.split(t) if v.split_added and any(a in t for a in v.added) else [t]:
            if s in v.added:
                out[i] += 1
                continue
            for part in parts(s, m.kinds) if len(s) > SLICE else [s]:
                run.append(part)
                owner.append(i)
                size += len(part)
                if size >= SLICE:
                    np.add.at(out, owner, count_parts(m, run))
                    run, owner, size = [], [], 0
    if run:
        np.add.at(out, owner, count_parts(m, run))
    return out


def token_counts(docs: DataFrame, vocab_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` of the text in UTF-8, ``n_tokens`` and ``over_limit``.

    Null and empty texts have no bytes and no tokens. Rows repeat as they are,
    with any id or none; an empty table gives an empty result; other columns
    are not read. A very long text is worked on in parts of a bounded size
    where it has spaces. Nothing is shuffled; the compiled machine is sent to
    all tasks, and the vocabulary alone sets its size.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(compile_machine(vocab_path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = machine(vocab_path, shipped.value)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = count_texts(m, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_counts(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))
