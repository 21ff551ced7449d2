"""A minimal acyclic transducer from words to lists of ids, in flat arrays.

The automaton shares prefixes and suffixes (incremental construction over
sorted words). Each transition carries the number of words on the smaller
branches of its state, so the sum along a path is the word's rank, and the rank
points to its output ids. The arrays are one file that workers memory-map.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def build(words: dict[bytes, Sequence[int]]) -> np.ndarray:
    """The automaton of non-empty ``words`` and their output ids as one int64 array."""
    order = sorted(w for w in words if w)
    register: dict[tuple, int] = {}
    sealed: list[tuple] = []  # by state: (is_final, ((byte, child), ...)) with children sealed

    def seal(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        state = register.get(key)
        if state is None:
            state = register[key] = len(sealed)
            sealed.append(key)
        return state

    # open states along the last word: [is_final, sealed edges, byte that leads here]
    path: list[list] = [[False, [], -1]]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges, byte = path.pop()
            path[-1][1].append((byte, seal(final, edges)))

    last = b""
    for w in order:
        common = 0
        top = min(len(w), len(last))
        while common < top and w[common] == last[common]:
            common += 1
        close(common)
        for b in w[common:]:
            path.append([False, [], b])
        path[-1][0] = True
        last = w
    close(0)
    root = seal(path[0][0], path[0][1])

    below = [0] * len(sealed)  # words accepted from a state; children come first
    keys, targets, before = [], [], []
    for state, (final, edges) in enumerate(sealed):
        n = int(final)
        for byte, child in edges:
            keys.append(state * 256 + byte)
            targets.append(child)
            before.append(n)
            n += below[child]
        below[state] = n
    ids = [i for w in order for i in words[w]]
    starts = np.zeros(len(order) + 1, np.int64)
    np.cumsum([len(words[w]) for w in order], out=starts[1:])
    finals = [int(s[0]) for s in sealed]
    head = [root, len(keys), len(finals), len(order), len(ids)]
    return np.concatenate([np.asarray(x, np.int64) for x in (head, keys, targets, before, finals, starts, ids)])


class Lexicon:
    """Look-ups in a built automaton; ``data`` may be memory-mapped."""

    def __init__(self, data: np.ndarray) -> None:
        self.root, edges, states, words, ids = (int(x) for x in data[:5])
        at = 5
        parts = []
        for n in (edges, edges, edges, states, words + 1, ids):
            parts.append(data[at:at + n])
            at += n
        self.keys, self.targets, self.before, self.finals, self.starts = parts[:5]
        self.ids = parts[5].astype(np.int32).tobytes()
        self.at = self.starts.tolist()

    def ranks(self, words: Sequence[bytes]) -> np.ndarray:
        """Rank of every word, -1 where the automaton has none; all words step at once."""
        out = np.full(len(words), -1, np.int64)
        if not len(words) or not len(self.keys):
            return out
        length = np.array([len(w) for w in words])
        longest = 64  # longer words are rare: they are looked up apart, by their own length
        for chosen in (np.flatnonzero((length > 0) & (length <= longest)), *np.flatnonzero(length > longest)[:, None]):
            if not len(chosen):
                continue
            width = int(length[chosen].max())
            grid = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in chosen), np.uint8).reshape(len(chosen), width)
            state = np.full(len(chosen), self.root, np.int64)
            rank = np.zeros(len(chosen), np.int64)
            live = np.arange(len(chosen))
            for k in range(width):
                live = live[length[chosen[live]] > k]
                if not len(live):
                    break
                key = state[live] * 256 + grid[live, k]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = self.keys[at] == key
                state[live[~found]] = -1
                live, at = live[found], at[found]
                rank[live] += self.before[at]
                state[live] = self.targets[at]
            ok = state >= 0
            ok[ok] = self.finals[state[ok]] == 1
            out[chosen[ok]] = rank[ok]
        return out

    def output(self, rank: int) -> bytes:
        """The ids of the word of this rank, as the bytes of int32 numbers."""
        return self.ids[4 * self.at[rank]:4 * self.at[rank + 1]]
