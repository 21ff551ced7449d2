"""URL filters by a bit-parallel wildcard automaton.

Every rule becomes one or two glob patterns over the canonical URL (host
followed by path). All patterns lie side by side in one multiword bit vector;
one step per byte of the URL is a shift, an and with the mask of that byte, and
an or with the states that wait in a wildcard. The simulation of all patterns
runs for a whole Arrow batch of URLs at once, one numpy step per byte position.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import free_name, query, table

#: The rules of the contract, (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ANY, LABEL = "**", "*"  # any bytes; any bytes but a slash


@dataclass(frozen=True)
class Automaton:
    """Bit masks of all patterns: ``step[byte]``, ``stay[byte]``, and start and end states."""

    step: np.ndarray
    stay: np.ndarray
    start: np.ndarray
    ends: tuple[tuple[int, int, int], ...]  # (rule, word, bit)


def tokens(glob: str) -> list[str | int]:
    """Bytes and the two wildcards of a glob; a backslash takes the next character literally."""
    out: list[str | int] = []
    i = 0
    while i < len(glob):
        if glob.startswith(ANY, i):
            out.append(ANY)
            i += 2
        elif glob[i] == LABEL:
            out.append(LABEL)
            i += 1
        else:
            i += glob[i] == "\\" and i + 1 < len(glob)
            out.extend(glob[i].encode())
            i += 1
    return out


def compile_globs(globs: Sequence[tuple[int, str]]) -> Automaton:
    """Pack (rule, glob) pairs into one automaton.

    State k of a pattern means that its first k bytes were read; a wildcard
    between two bytes lets the state before it wait. Patterns take
    (bytes + 1) bits each and never share a state, as a shifted bit that
    enters the next pattern's first state is masked away.
    """
    parsed = [(rule, tokens(g)) for rule, g in globs]
    size = sum(1 + sum(isinstance(t, int) for t in p) for _, p in parsed)
    words = max(1, -(-size // 64))
    step, stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    start, ends, at = np.zeros(words, np.uint64), [], 0
    one = np.uint64(1)
    for rule, pattern in parsed:
        start[at // 64] |= one << np.uint64(at % 64)
        for t in pattern:
            bit = one << np.uint64(at % 64)
            if isinstance(t, int):
                at += 1
                step[t, at // 64] |= one << np.uint64(at % 64)
            elif t == ANY:
                stay[:, at // 64] |= bit
            else:
                stay[np.arange(256) != ord("/"), at // 64] |= bit
        ends.append((rule, at // 64, at % 64))
        at += 1
    return Automaton(step, stay, start, tuple(ends))


def simulate(auto: Automaton, urls: Sequence[bytes], rules: int, chunk: int = 1 << 22) -> np.ndarray:
    """Boolean matrix (url, rule): does one of the rule's globs match the whole URL?

    URLs are taken in order of length and in chunks of at most ``chunk`` bytes
    of padding, so one very long URL costs its own length only.
    """
    out = np.zeros((len(urls), rules), bool)
    order = sorted(range(len(urls)), key=lambda i: len(urls[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(urls[order[end]]) <= chunk:
            end += 1
        picked = order[at:end]
        at = end
        lengths = np.array([len(urls[i]) for i in picked])
        width = int(lengths[-1])
        grid = np.frombuffer(b"".join(urls[i].ljust(width, b"\0") for i in picked), np.uint8).reshape(len(picked), width)
        state = np.repeat(auto.start[None, :], len(picked), 0)
        for k in range(width):
            live = int(np.searchsorted(lengths, k, side="right"))  # URLs longer than k
            now = state[live:]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            byte = grid[live:, k]
            state[live:] = (moved & auto.step[byte]) | (now & auto.stay[byte])
        for rule, word, bit in auto.ends:
            out[picked, rule] |= (state[:, word] >> np.uint64(bit) & np.uint64(1)).astype(bool)
    return out


def quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("*", "\\*")


def rule_globs(rules: Sequence[tuple[str, str]]) -> list[tuple[int, str]]:
    """A rule ``host/path`` fits its host and all subdomains, and every path that begins with its own."""
    out = []
    for k, (_, rule) in enumerate(rules):
        out += [(k, quoted(rule) + ANY), (k, LABEL + "." + quoted(rule) + ANY)]
    return out


def canonical(url: str) -> tuple[F.Column, F.Column]:
    """Host and path columns: host after the first ``://`` up to ``/``, ``?``, ``#`` with A-Z lower-cased."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    empty = F.lit("")
    return F.coalesce(F.translate(host, upper, lower), empty), F.coalesce(path, empty)


def filter_urls(rows: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
                default: str = "allow") -> DataFrame:
    """Every row with ``host``, ``path``, the ``rule`` that fits, and its ``verdict``.

    Of the fitting rules the longest wins, then the first; without one ``rule``
    is null and the verdict is ``default``. A null URL, or one without ``://``,
    has an empty host and path and fits no rule. Columns of ``rows`` that have
    one of the four names are replaced. Rows repeat as they are; an empty table
    gives an empty result. A bare host does not fit ``host/``: its path is empty.
    """
    if not rules:
        raise ValueError("no rules")
    names = [r for _, r in rules]
    auto = compile_globs(rule_globs(rules))
    rank = np.array([-len(n.encode()) for n in names])
    order = np.argsort(rank, kind="stable")  # longest first

    @F.pandas_udf("int")
    def fitting(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for urls in batches:
            hit = simulate(auto, [u.encode("utf-8", "surrogatepass") for u in urls], len(names))[:, order]
            yield pd.Series(np.where(hit.any(1), order[hit.argmax(1)], -1).astype("int32"))

    host, path = canonical(url)
    kept = [c for c in rows.columns if c not in ("host", "path", "rule", "verdict")]
    parts = rows.select(*kept, host.alias("host"), path.alias("path"))
    own = free_name(parts, "_rule")
    k = F.col(own) + 1
    return parts.withColumn(own, fitting(F.concat("host", "path"))).select(
        *kept, "host", "path",
        F.element_at(F.array(F.lit(None).cast("string"), *map(F.lit, names)), k + 1).alias("rule"),
        F.element_at(F.array(F.lit(default), *[F.lit(v) for v, _ in rules]), k + 1).alias("verdict"))


SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rh, rp, v))
SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, coalesce(arg_max(v, length(rh || rp)), 'allow') AS verdict
FROM h LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
GROUP BY page_id, host, path"""


@query("op9_url_filter", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")
