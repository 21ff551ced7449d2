"""Pauses on a stream of samples by the rule of the batch operators.

The level that separates silence from sound hangs on the loudest frame of the
recording, so it can only rise while samples arrive. The state of a recording
is an automaton that keeps the running maximum: frames once silent stay silent
and are held as the length of their run, frames still sounding keep their
level, as a later maximum may silence them. A recording ends when the
watermark has left its last sample behind by ``gap``; then short runs are
absorbed and its pauses come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.runs import absorbed

POWER_FLOOR = 1e-10
SILENT = -np.inf  # level of a run that is silent for good
FRAMES = 4096  # frames whose samples are laid out at once
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class PauseRule:
    """``floor_db`` below the loudest frame is silent (the floor itself too, if ``inclusive``); all spans in seconds.

    T10 is the default; T09 is ``PauseRule(..., -top_db, 0, 0, inclusive=True)``.
    """

    rate: int
    window: int
    step: int
    floor_db: float = -25.0
    min_silent: float = 0.1
    min_sounding: float = 0.1
    inclusive: bool = False


class Track:
    """The automaton of one recording; ``state`` are plain lists and numbers."""

    def __init__(self, rule: PauseRule, n: int = 0, tail=(), lengths=(), levels=()) -> None:
        self.rule, self.n = rule, n
        self.tail = np.array(tail, float)  # samples from the begin of the next frame
        self.lengths, self.levels = np.array(lengths, np.int64), np.array(levels, float)

    def state(self) -> tuple:
        return self.n, self.tail.tolist(), self.lengths.tolist(), self.levels.tolist()

    def add(self, x: np.ndarray) -> None:
        """Take the next samples."""
        r = self.rule
        self.n += len(x)
        self.tail = np.concatenate([self.tail, x])
        while len(self.tail) >= r.window:
            cut = np.lib.stride_tricks.sliding_window_view(self.tail, r.window)[::r.step][:FRAMES]
            power = np.cumsum(cut * cut, axis=1)[:, -1] / r.window  # summed in order, as the batch operator does
            self.levels = np.concatenate([self.levels, 10 * np.log10(np.maximum(power, POWER_FLOOR))])
            self.lengths = np.concatenate([self.lengths, np.ones(len(cut), np.int64)])
            self.tail = self.tail[len(cut) * r.step:]
            quiet = self.quiet()
            first = np.flatnonzero(np.concatenate([[True], ~(quiet[1:] & quiet[:-1])]))
            self.lengths = np.add.reduceat(self.lengths, first)
            self.levels = np.where(quiet, SILENT, self.levels)[first]

    def quiet(self) -> np.ndarray:
        limit = self.levels.max() + self.rule.floor_db
        return self.levels <= limit if self.rule.inclusive else self.levels < limit

    def pauses(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) in seconds, if the recording ends here."""
        if not len(self.levels):
            return np.empty(0), np.empty(0)
        r = self.rule
        edge = np.concatenate([[0], np.cumsum(self.lengths)]) * r.step / r.rate
        edge[-1] = self.n / r.rate
        flag, start, end = absorbed(self.quiet(), edge[:-1], edge[1:], r.min_silent, r.min_sounding)
        return start[flag], end[flag]


STATE = ("first bigint, seen bigint, last bigint, n bigint, tail binary, lengths binary, levels binary, "
         "ts binary, pos binary, x binary")


class _Recording:
    """Samples wait until the watermark has passed them, so each recording is read in order of time."""

    def __init__(self, rule: PauseRule, gap_ms: int, kept: tuple | None) -> None:
        """``kept``: microseconds of the first and the latest sample that was read, milliseconds of the latest that came, arrays as bytes."""
        self.rule, self.gap, self.found = rule, gap_ms, []
        self.first = self.seen = self.last = None
        self.track, self.waiting = Track(rule), _rows([], [], [])
        if kept:
            self.first, self.seen, self.last, n, tail, lengths, levels, ts, pos, x = kept
            self.track = Track(rule, n, np.frombuffer(tail, float), np.frombuffer(lengths, np.int64), np.frombuffer(levels, float))
            self.waiting = _rows(np.frombuffer(ts, np.int64), np.frombuffer(pos, np.int64), np.frombuffer(x, float))

    def kept(self) -> tuple:
        t, w = self.track, self.waiting
        return (None if self.first is None else int(self.first), self.seen, self.last, t.n, t.tail.tobytes(), t.lengths.tobytes(),
                t.levels.tobytes(), w["ts"].tobytes(), w["pos"].tobytes(), w["x"].tobytes())

    def take(self, part: pd.DataFrame) -> None:
        us = part["ts"].astype("datetime64[us]").astype("int64").to_numpy()
        self.waiting = np.concatenate([self.waiting, _rows(us, part["n"].to_numpy(), part["x"].to_numpy())])
        latest = int(us.max()) // 1000
        self.last = latest if self.last is None else max(self.last, latest)

    def read(self, upto_us: int) -> None:
        """Read the samples up to a time; where more than the gap lies between two, a recording ends."""
        rows = self.waiting[np.lexsort((self.waiting["pos"], self.waiting["ts"]))]
        due = rows["ts"] <= upto_us
        self.waiting, rows = rows[~due], rows[due]
        before = np.concatenate([[rows["ts"][0] if self.seen is None else self.seen], rows["ts"][:-1]]) if len(rows) else rows["ts"]
        for part in np.split(rows, np.flatnonzero(rows["ts"] - before > self.gap * 1000)):
            if len(part):
                if self.seen is not None and part["ts"][0] - self.seen > self.gap * 1000:
                    self.end()
                self.first, self.seen = part["ts"][0] if self.first is None else self.first, int(part["ts"][-1])
                self.track.add(part["x"])

    def end(self) -> None:
        start, end = self.track.pauses()
        self.found.append((self.first, start, end))
        self.first, self.seen, self.track = None, None, Track(self.rule)

    def output(self, key: tuple) -> Iterator[pd.DataFrame]:
        for first, start, end in self.found:
            if len(start):
                out = {f"k{i}": pd.Series([k] * len(start), dtype=object) for i, k in enumerate(key)}
                yield pd.DataFrame(out | {"recording_start": pd.to_datetime(np.full(len(start), first, np.int64), unit="us"),
                                          "start": start, "end": end, "duration": end - start})


def _step(rule: PauseRule, gap_ms: int):
    """One call per recording and micro-batch; its state comes and goes with the rows, not by calls of its own."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        recording = _Recording(rule, gap_ms, state.getOption)
        if state.hasTimedOut:
            recording.read(2**62)
            recording.end()
            state.remove()
        else:
            for part in frames:
                if len(part):
                    recording.take(part)
            passed = state.getCurrentWatermarkMs()
            recording.read(passed * 1000)
            state.update(recording.kept())
            state.setTimeoutTimestamp(max(recording.last + gap_ms, passed + 1))
        yield from recording.output(key)

    return run


def _rows(ts, pos, x) -> np.ndarray:
    out = np.empty(len(ts), [("ts", np.int64), ("pos", np.int64), ("x", float)])
    out["ts"], out["pos"], out["x"] = ts, pos, x
    return out


def use_state_store(spark: SparkSession) -> None:
    """The state store on disk, as open recordings may pass the memory; set before the stream is started."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def pause_stream(samples: DataFrame, rule: PauseRule, gap_seconds: float, late: str = "10 minutes",
                 keys: tuple[str, ...] = ("audio_id", "real_or_fake")) -> DataFrame:
    """(keys, ts, n, x) samples -> (keys, recording_start, start, end, duration), seconds from the recording's first sample.

    Samples count in order of ``ts`` and ``n``; one that is later than ``late``
    is dropped as if it had never been recorded. A recording without a frame
    has no pause. Samples of the same keys after a silence of ``gap_seconds``
    in event time begin another recording.
    """
    typed = samples.select(*keys, "ts", samples["n"].cast("bigint").alias("n"), samples["x"].cast("double").alias("x"))
    schema = ", ".join(f"k{i} {typed.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    out = typed.withWatermark("ts", late).groupBy(*keys).applyInPandasWithState(
        _step(rule, int(gap_seconds * 1000)), f"{schema}, recording_start timestamp, start double, end double, duration double",
        STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
