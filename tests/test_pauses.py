"""The pause automaton: any cut of the samples gives the pauses of the batch operators."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from voxledger.operators import frames as fr
from voxledger.streaming import pauses as xp, streams as xs

SCHEMA = "audio_id string, real_or_fake string, ts timestamp, n long, x double"


def signal(seed, n=400):
    rng = np.random.default_rng(seed)
    return np.repeat(rng.choice([0.0, 0.01, 0.2, 1.0], n // 20), 20) * (1 + 0.3 * rng.standard_normal(n))


def flat(pairs):
    return pytest.approx([v for p in pairs for v in p])


def batch(spark, x, rate=10, window=8, step=4, floor=-14.0, silent=0.6, sounding=0.9):
    df = spark.createDataFrame([("a", "R", [float(v) for v in x], rate)], "audio_id string, real_or_fake string, samples array<double>, sampling_rate int")
    rows = fr.intensity_pauses(df, floor, silent, sounding, window / rate, step / rate).collect()
    return sorted((r["start"], r["end"]) for r in rows)


RULE = xp.PauseRule(10, 8, 4, -14.0, 0.6, 0.9)


@pytest.mark.parametrize("seed", range(4))
def test_track_equals_batch_for_any_cut(spark, seed):
    x, rng = signal(seed), np.random.default_rng(seed)
    want = batch(spark, x)
    for cuts in ([], [1], [7, 8, 9], sorted(rng.integers(0, 400, 30).tolist()), list(range(0, 400, 3))):
        state = ()
        for part in np.split(x, cuts):
            track = xp.Track(RULE, *state)
            track.add(part)
            state = track.state()
        start, end = xp.Track(RULE, *state).pauses()
        assert [v for p in zip(start, end) for v in p] == flat(want)
        assert len(want) and len(state[2]) < 100 and sum(state[2]) == 99  # silent runs are held as one


def test_track_equals_silences(spark):
    x = signal(9)
    df = spark.createDataFrame([("a", "R", [float(v) for v in x], 10)], "audio_id string, real_or_fake string, samples array<double>, sampling_rate int")
    want = sorted((r["start"], r["end"]) for r in fr.silences(df, 14.0, 8, 4).collect())
    track = xp.Track(xp.PauseRule(10, 8, 4, -14.0, 0.0, 0.0, inclusive=True))
    track.add(x)
    assert [v for p in zip(*track.pauses()) for v in p] == flat(want)


def test_a_later_maximum_silences_what_sounded():
    track = xp.Track(xp.PauseRule(1, 1, 1, -20.0, 0.0, 0.0))
    track.add(np.array([0.1, 0.1, 0.05]))
    assert not len(track.pauses()[0])
    track.add(np.array([10.0]))
    assert [v.tolist() for v in track.pauses()] == [[0.0], [3.0]] and track.state()[2] == [3, 1]


def test_short_and_empty_recordings():
    for x in ([], [1.0], [0.0] * 7):
        track = xp.Track(RULE)
        track.add(np.array(x))
        assert not len(track.pauses()[0])


def test_stream_with_late_rows_and_two_recordings(spark, tmp_path):
    """Rows out of order within the watermark count, later ones do not; a long silence begins another recording."""
    base = str(tmp_path)
    x, y = signal(1), signal(2, 200)
    t0 = datetime(2024, 1, 1)
    rows = [("a", "R", t0 + timedelta(seconds=k), k, float(v)) for k, v in enumerate(x)]
    second = [("a", "R", t0 + timedelta(hours=5, seconds=k), k, float(v)) for k, v in enumerate(y)]
    mixed = rows[100:250] + [rows[40]]  # 40 comes in the second file, well within ten minutes
    lost = ("a", "R", t0 - timedelta(hours=1), -1, 99.0)  # an hour before the watermark
    files = [rows[:40] + rows[41:100], mixed[::-1], rows[250:], second, [lost], [("z", "R", t0 + timedelta(days=30), 0, 1.0)]]
    xp.use_state_store(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for k, part in enumerate(files):
            spark.createDataFrame(part, SCHEMA).write.parquet(f"{base}/in/{k}")
            stream = xp.pause_stream(xs.file_stream(spark, f"{base}/in", SCHEMA), RULE, 3600.0)
            xs.to_files(stream, f"{base}/out", f"{base}/state").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = spark.read.parquet(f"{base}/out").collect()
    assert {r["recording_start"] for r in got} == {t0, t0 + timedelta(hours=5)}
    first = sorted((r["start"], r["end"]) for r in got if r["recording_start"] == t0)
    later = sorted((r["start"], r["end"]) for r in got if r["recording_start"] != t0)
    assert [v for p in first for v in p] == flat(batch(spark, x)) and [v for p in later for v in p] == flat(batch(spark, y))
    assert all(r["duration"] == r["end"] - r["start"] for r in got)


@pytest.mark.parametrize("seed", range(2))
def test_kept_state_goes_on_where_it_stopped(seed, spark):
    """The state is one row of bytes that comes with the recording's samples; any cut gives the pauses of the whole."""
    x, kept = signal(seed), None
    us = np.arange(len(x)) * 100_000
    for at, cut in ((0, 90), (90, 95), (95, 400)):
        recording = xp._Recording(RULE, 3_600_000, kept)
        recording.take(pd.DataFrame({"ts": us[at:cut].astype("datetime64[us]"), "n": np.arange(at, cut), "x": x[at:cut]}).sample(frac=1, random_state=seed))
        recording.read(int(us[at]))
        kept = recording.kept()
        assert all(isinstance(v, bytes) for v in kept[4:])
    recording = xp._Recording(RULE, 3_600_000, kept)
    recording.read(2**62)
    recording.end()
    (_, start, end), = recording.found
    assert [v for p in zip(start, end) for v in p] == flat(batch(spark, x))
