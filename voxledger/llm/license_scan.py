"""License scan by conditional compression.

Around every cue, each template is laid over the words where it fits best, up
to listed differences. The wording found is compressed alone and with the
template as a raw Zstandard dictionary; a template that the wording repeats
saves most. The largest saving is confirmed and cut out, and the rest is tried
again until nothing fits.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import query, table, text_of

# Usual license notices, (license, wording).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                         "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
)
CUES = ("licens", "licenc", "copyright", "rights reserved", "permission", "redistribution", "public domain", "free software", "source code form", "cc0")
LEAST_SAVING = 0.25  # share of the wording's compressed size
ALLOWED = 0.2  # share of the template's words that may differ
REACH = 1200  # characters around a cue in a long line

WORD = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


GAP = 300  # characters between lines of one notice that have a cue


def blocks(text: str) -> list[tuple[int, int]]:
    """Candidate blocks: runs of lines with cues that lie close together; long lines are cut around their cues."""
    low = text.lower()
    if len(low) != len(text):  # a character that changes length: compare letter by letter
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    spots = sorted({m for cue in CUES for m in _spots(low, cue)})
    runs: list[tuple[int, int]] = []
    for at in spots:
        start = max(text.rfind("\n", 0, at) + 1, at - REACH)
        end = text.find("\n", at)
        end = min(len(text) if end < 0 else end, at + REACH)
        if runs and start - runs[-1][1] <= GAP:
            runs[-1] = runs[-1][0], max(runs[-1][1], end)
        else:
            runs.append((start, end))
    return runs


def regions(text: str, runs: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
    """The candidate blocks with at least ``reach`` words and ``REACH`` characters before and behind, as spans that do not meet.

    A notice may begin or end in lines without a cue, and wherever in a line.
    """
    out: list[tuple[int, int]] = []
    for start, end in runs:
        start, end = _before(text, start, reach), _behind(text, end, reach)
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _before(text: str, at: int, reach: int) -> int:
    size = REACH
    while True:
        start = max(0, at - size)
        while start and not text[start - 1].isspace() and at - start < 2 * size:  # no word is cut
            start -= 1
        if not start or sum(1 for _ in WORD.finditer(text, start, at)) >= reach:
            return start
        size *= 2


def _behind(text: str, at: int, reach: int) -> int:
    size = REACH
    while True:
        end = min(len(text), at + size)
        while end < len(text) and not text[end].isspace() and end - at < 2 * size:
            end += 1
        if end == len(text) or sum(1 for _ in WORD.finditer(text, at, end)) >= reach:
            return end
        size *= 2


def _spots(low: str, cue: str) -> Iterator[int]:
    if " " in cue:  # its words may stand on two lines
        yield from (m.start() for m in re.finditer(r"[\W_]+".join(map(re.escape, cue.split())), low))
        return
    at = low.find(cue)
    while at >= 0:
        yield at
        at = low.find(cue, at + len(cue))


class Templates:
    """Templates ready for compression and comparison."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, level: int = 6) -> None:
        self.names = [n for n, _ in templates]
        self.words = [words_of(t) for _, t in templates]
        self.alone = zstandard.ZstdCompressor(level=level)
        self.given = [zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(
            t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, t in templates]
        # words that tell a license from the others: a difference in one of them is another license
        other = lambda k: {w for j, ws in enumerate(self.words) if self.names[j] != self.names[k] for w in ws}
        self.telling = [{w for w in ws if w not in other(k) or any(c.isdigit() for c in w) or "-" in w} for k, ws in enumerate(self.words)]

    def saved(self, wording: str, k: int) -> tuple[int, float]:
        """Bytes that template ``k`` saves in the compressed wording, and their share."""
        raw = wording.encode("utf-8", "surrogatepass")
        plain = len(self.alone.compress(raw))
        less = plain - len(self.given[k].compress(raw))
        return less, less / plain

    def fitting(self, words: list[str], k: int) -> tuple[int, int, list[str]] | None:
        """(first word, behind the last word, differences) of the wording closest to template ``k``; null if too much differs."""
        mine = self.words[k]
        here = set(words)
        if sum(w in here for w in mine) < len(mine) - ALLOWED * len(mine):
            return None
        for gone, new in ((1, 1), (2, 1), (len(mine), 1), (1, 2)):  # few differences, else few of one kind
            match = aligned(mine, words, gone, new)
            if not match or len(mine) - len(match) > ALLOWED * len(mine) or not self.telling[k] <= {mine[a] for a, _ in match}:
                continue
            out, a, b = [], 0, match[0][1]
            for i, j in match + [(len(mine), match[-1][1] + 1)]:
                if i > a or j > b:
                    out.append((mine[a:i], words[b:j]))
                a, b = i + 1, j + 1
            if sum(len(x) for _, x in out) <= _most_new(mine):
                return match[0][1], match[-1][1] + 1, [f"-{' '.join(x)} +{' '.join(y)}" for x, y in out]
        return None

    def scan(self, text: str) -> tuple[int, list[dict]]:
        """(number of candidate blocks, confirmed findings) of one whole text."""
        runs, found = blocks(text), []
        for start, end in regions(text, runs, max((len(w) + _most_new(w) for w in self.words), default=0)):
            found += self._confirmed(text, start, end)
        return len(runs), found

    def _confirmed(self, text: str, start: int, end: int) -> list[dict]:
        """All notices between two places, none over another, in order."""
        spans = [m.span() for m in WORD.finditer(text, start, end)]
        words = [text[a:b].lower() for a, b in spans]
        places: dict[str, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            places[w].append(p)
        heap: list[tuple] = []

        def offer(k: int, q: int, p: int, low: int, high: int) -> None:
            """Template ``k`` with its word ``q`` near place ``p``, between two places."""
            more = _most_new(self.words[k])
            first = max(low, p - q - more)
            fit = self.fitting(words[first:min(high, p + len(self.words[k]) - q + more)], k)
            if fit is None:
                return
            a, b = first + fit[0], first + fit[1]
            less, share = self.saved(text[spans[a][0]:spans[b - 1][1]], k)
            if share >= LEAST_SAVING:
                heapq.heappush(heap, (-less, -len(self.words[k]), k, a, b, q, p, share, fit[2]))

        for k, mine in enumerate(self.words):
            must = self.telling[k] or set(mine)
            if self.telling[k] and not all(w in places for w in must):
                continue
            rare = [min(must, key=lambda w: (len(places.get(w, ())) * mine.count(w), w))] if self.telling[k] else sorted(must)
            for w in rare:
                for q in (q for q, x in enumerate(mine) if x == w):
                    for p in places.get(w, ()):
                        offer(k, q, p, 0, len(words))
        firsts, taken = [], {}  # words of confirmed notices: first places, and for each (behind the last, finding)
        while heap:
            _, _, k, a, b, q, p, share, differences = heapq.heappop(heap)
            at = bisect_right(firsts, p)
            low = taken[firsts[at - 1]][0] if at else 0
            high = firsts[at] if at < len(firsts) else len(words)
            if p < low:  # cut out already
                continue
            if a < low or b > high:
                offer(k, q, p, low, high)
                continue
            firsts.insert(at, a)
            taken[a] = b, {"license": self.names[k], "start": spans[a][0], "end": spans[b - 1][1], "saving": round(share, 4), "differences": differences}
        return [taken[a][1] for a in firsts]


def _most_new(mine: list[str]) -> int:
    """Words that may stand between those of a template."""
    return int(max(2, ALLOWED * len(mine)))


def aligned(mine: list[str], words: list[str], gone: int, new: int) -> list[tuple[int, int]]:
    """Pairs of equal words in order, with the least cost of words that are gone from ``mine`` or new between its first and last."""
    rows = [[0] * (len(words) + 1)]
    for a in mine:
        above, row = rows[-1], [rows[-1][0] + gone]
        for j, b in enumerate(words):
            row.append(min(above[j + 1] + gone, row[j] + new, above[j] if a == b else above[j + 1] + gone))
        rows.append(row)
    i, j = len(mine), min(range(len(words) + 1), key=rows[-1].__getitem__)
    out = []
    while i and j:
        if mine[i - 1] == words[j - 1] and rows[i][j] == rows[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i][j] == rows[i - 1][j] + gone:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row: the id, ``n_blocks`` (candidates) and ``findings`` (license, start, end in code points, saving, differences).

    Whole texts are read; null counts as empty and has no findings. Rows
    repeat as they are; an empty table gives an empty result; other columns
    are not read. Findings are in order of their place in the text.
    """
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saving", pa.float64()),
                               ("differences", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Templates(templates)
        for batch in batches:
            out = [ready.scan(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array([n for n, _ in out], pa.int64()), pa.array([f for _, f in out], kind)],
                                             ["_id", "n_blocks", "findings"])

    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    schema = (f"_id {rows.schema['_id'].dataType.simpleString()}, n_blocks long, "
              "findings array<struct<license:string,start:long,end:long,saving:double,differences:array<string>>>")
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_blocks", F.size("findings").cast("long").alias("n_findings"),
                        F.array_join(F.array_sort(F.array_distinct(F.col("findings.license"))), ",").alias("licenses"),
                        F.exists("findings", lambda f: F.size(f["differences"]) > 0).alias("differs"))
