"""Word shingles of whole texts as 64-bit hashes, by numpy over a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACE = _RNG.integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _RNG.integers(1, 2**63, WIDTH, dtype=np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 1 << 20


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h + np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(256)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its text) of every word, in order; A-Z counts as a-z."""
    buffer = b"\n".join(texts).lower()
    data = np.frombuffer(buffer, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_IS_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.flatnonzero(edge == -1)
    if len(ends) < len(starts):
        ends = np.append(ends, len(data))
    length = ends - starts
    at = np.cumsum(length) - length  # where each word begins among the bytes inside words
    longest = int(length.max())
    power = _POWERS if longest <= len(_POWERS) else _powers(longest)
    place = np.arange(int(length.sum())) - np.repeat(at, length)
    hashes = mix(np.add.reduceat(_BYTE[data[inside]] * power[place], at) + length.astype(np.uint64))
    sizes = np.array([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(np.cumsum(sizes), starts, side="right")


def shingle_sets(texts: list[bytes], late: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its text) of every distinct shingle, by text and then in the global order.

    The order is that of the hashes, but the hashes in ``late`` (sorted) come
    after all others. A text of fewer words than a shingle is one shingle.
    """
    words, owner = word_hashes(texts)
    n = len(words)
    count = np.bincount(owner, minlength=len(texts))
    full = np.zeros(0, np.uint64)
    at = np.zeros(0, np.int64)
    if n >= WIDTH:
        total = np.zeros(n - WIDTH + 1, np.uint64)
        for k in range(WIDTH):
            total += words[k:n - WIDTH + 1 + k] * _PLACE[k]
        same = owner[:n - WIDTH + 1] == owner[WIDTH - 1:]
        full, at = mix(total[same]), owner[:n - WIDTH + 1][same]
    few = np.flatnonzero((count > 0) & (count < WIDTH))
    if len(few):
        first = np.cumsum(count) - count
        short = np.array([(int(np.sum(words[first[i]:first[i] + count[i]] * _PLACE[:count[i]], dtype=np.uint64))
                           + int(_SHORT[count[i]])) % 2**64 for i in few], np.uint64)
        full, at = np.concatenate([full, mix(short)]), np.concatenate([at, few])
    if late is not None and len(late):
        pos = np.minimum(np.searchsorted(late, full), len(late) - 1)
        order = np.lexsort((full, late[pos] == full, at))
    else:
        order = np.lexsort((full, at))
    full, at = full[order], at[order]
    new = np.ones(len(full), bool)
    new[1:] = (full[1:] != full[:-1]) | (at[1:] != at[:-1])
    return full[new], at[new]


def pieces(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, texts as UTF-8) in runs of about ``CHUNK`` bytes; null is empty."""
    run: list[bytes] = []
    first = size = 0
    for i, t in enumerate(texts):
        run.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(run[-1])
        if size >= CHUNK:
            yield first, run
            run, first, size = [], i + 1, 0
    if run:
        yield first, run
