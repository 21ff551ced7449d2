"""Signals with known answers."""

import io
import math
import wave

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxledger.functions import describe, runs, dsp, special, voice
from voxledger.operators import feature_row as row, frames as fr, quality as qa, spectral as sp, voice as vo
from voxledger.sources.wav import decode_pcm_wav

SR = 16000


def recordings(spark, signals, sr=SR):
    data = [(str(i), "R", [float(v) for v in x], sr) for i, x in enumerate(signals)]
    return spark.createDataFrame(data, "audio_id string, real_or_fake string, samples array<double>, sampling_rate int")


def sine(hz, seconds=0.5, amp=0.5, sr=SR):
    return amp * np.sin(2 * np.pi * hz * np.arange(int(seconds * sr)) / sr)


def voiced(hz=120.0, formants=((700, 80), (1200, 90), (2500, 120)), seconds=0.6, sr=SR):
    """Pulse train through two-pole resonators."""
    x = np.zeros(int(seconds * sr))
    x[::int(round(sr / hz))] = 1.0
    for f, bw in formants:
        r = math.exp(-math.pi * bw / sr)
        a1, a2 = 2 * r * math.cos(2 * math.pi * f / sr), -r * r
        y = np.zeros_like(x)
        for n in range(len(x)):
            y[n] = x[n] + a1 * (y[n - 1] if n > 0 else 0) + a2 * (y[n - 2] if n > 1 else 0)
        x = y
    return 0.5 * x / np.abs(x).max()


def test_sine_energy_crossings_and_centroid(spark):
    df = recordings(spark, [sine(440.0)])
    assert fr.rms_energy(df).first()["rms"] == pytest.approx(0.5 / math.sqrt(2), rel=1e-2)
    assert fr.zero_crossing_rate(df).first()["zcr"] == pytest.approx(880 / SR, rel=0.05)
    assert sp.spectral_centroid(df).first()["value"] == pytest.approx(440, rel=0.02)
    assert qa.dominant_frequency(df).first()["dominant_hz"] == pytest.approx(440, abs=2)
    f0 = [r["f0"] for r in vo.f0_track(df).collect()]
    assert np.median(f0) == pytest.approx(440, rel=0.01)


def test_constant_and_noise(spark):
    noise = np.random.default_rng(1).normal(size=SR // 2)
    df = recordings(spark, [np.full(4096, 0.3), noise])
    assert fr.zero_crossings(df.where("audio_id = '0'")).first()["zero_crossings"] == 0
    flat = [r["value"] for r in sp.spectral_flatness(df.where("audio_id = '1'")).collect()]
    assert 0.4 < np.mean(flat) < 0.7  # e^-gamma for exponential powers
    assert max(r["f0"] for r in vo.f0_track(df.where("audio_id = '0'")).collect()) == 0


def test_resample_keeps_a_sine(spark):
    df = recordings(spark, [sine(440.0, 0.5, sr=48000)], 48000)
    out = fr.resample(df, SR).first()
    got, want = np.array(out["samples"]), sine(440.0)
    assert out["sampling_rate"] == SR and len(got) == len(want)
    assert np.abs(got - want)[200:-200].max() < 1e-3
    assert fr.resample(recordings(spark, [[0.1, 0.2]]), SR).first()["samples"] == [0.1, 0.2]


def test_formants_of_a_known_filter(spark):
    f = vo.formants(recordings(spark, [voiced()]), count=4).first()
    assert f["F1_mean"] == pytest.approx(700, rel=0.1)
    assert f["F2_mean"] == pytest.approx(1200, rel=0.1)
    assert f["F3_mean"] == pytest.approx(2500, rel=0.1)


def test_pulses_of_a_steady_voice_have_no_jitter(spark):
    df = recordings(spark, [voiced()])
    p = vo.pulses(df)
    period = [r["period"] for r in p.collect() if r["period"] is not None]
    assert np.median(period) == pytest.approx(round(SR / 120) / SR, rel=0.01)
    both = vo.perturbation(p).first()
    assert both["jitter_local"] < 0.01 and both["shimmer_local"] < 0.05
    assert vo.hnr_db(df).first()["hnr"] > 10


def test_jitter_of_alternating_periods(spark):
    rows = [("a", i, 0.010 + (0.0002 if i % 2 else 0.0), 1.0 + (0.1 if i % 2 else 0.0)) for i in range(40)]
    p = spark.createDataFrame(rows, "audio_id string, i int, period double, amp double")
    j = vo.jitter(p, keys=("audio_id",)).first()
    s = vo.shimmer(p, keys=("audio_id",)).first()
    assert j["jitter_local"] == pytest.approx(0.0002 / 0.0101)
    assert j["jitter_ddp"] == pytest.approx(3 * j["jitter_rap"])
    assert s["shimmer_local"] == pytest.approx(0.1 / 1.05)
    assert s["shimmer_dda"] == pytest.approx(3 * s["shimmer_apq3"])


def test_silences_and_pauses(spark):
    x = np.concatenate((sine(300, 0.5), np.zeros(SR // 2), sine(300, 0.5), np.zeros(SR // 4)))
    df = recordings(spark, [x])
    got = sorted((r["start"], r["end"]) for r in fr.silences(df, window=512, step=256).collect())
    assert len(got) == 2 and got[0][0] == pytest.approx(0.5, abs=0.05) and got[1][1] == pytest.approx(1.75)
    long = qa.long_silence(df, window=512, step=256).first()
    assert long["has_long_silence"] is False or long["longest"] >= 0.5
    assert fr.intensity_pauses(df, window=512 / SR, step=256 / SR).count() == 2


def test_wav_round_trip(spark):
    def wav(width, channels=1):
        buf = io.BytesIO()
        with wave.open(buf, "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(8000)
            full = 1 << (8 * width - 1)
            v = np.repeat((sine(100, 0.05, sr=8000) * (full - 1)).astype(np.int64), channels)
            if width == 1:
                w.writeframes((v + 128).astype(np.uint8).tobytes())
            else:
                w.writeframes(b"".join(int(a).to_bytes(width, "little", signed=True) for a in v))
        return bytearray(buf.getvalue())

    cases = [("8", wav(1)), ("16", wav(2)), ("24", wav(3)), ("32", wav(4)), ("stereo", wav(2, 2))]
    out = decode_pcm_wav(spark.createDataFrame(cases, "path string, content binary")).collect()
    want = sine(100, 0.05, sr=8000)
    for r in out:
        assert r["sampling_rate"] == 8000
        assert np.abs(np.array(r["samples"]) - want).max() < (0.02 if r["path"] == "8" else 1e-3), r["path"]


def test_mfcc_chroma_tonnetz_shapes(spark):
    df = recordings(spark, [sine(440.0)])
    c = sp.chroma(df).where("frame_idx = 0").orderBy("coef").collect()
    assert len(c) == 12 and max(c, key=lambda r: r["value"])["coef"] == 10  # pitch class A
    assert sp.mfcc(df).where("frame_idx = 0").count() == 13
    assert sp.tonnetz(df).where("frame_idx = 0").count() == 6
    assert sp.mel_spectrogram_db(df, 40).agg({"db": "max"}).first()[0] == pytest.approx(0.0)


def test_full_feature_row_has_407_columns(spark):
    out = row.feature_row(recordings(spark, [voiced(), sine(200.0)]))
    assert len(out.columns) == 2 + 407
    r = out.where("audio_id = '0'").first().asDict()
    assert r["f0_max"] > 100 and r["F1_mean"] > 500 and r["mfcc_13_mean"] is not None and r["hnr"] > 5
    assert len(row.feature_row(recordings(spark, [sine(200.0)]), ["hnr", "energy"]).columns) == 2 + 12
    with pytest.raises(ValueError):
        row.feature_row(recordings(spark, [sine(200.0)]), ["loudness"])


def test_feature_row_is_one_scan_without_join(spark):
    df = recordings(spark, [voiced(), sine(200.0)])
    text = row.feature_row(df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1 and "Join" not in text and "Exchange" not in text and "Window" not in text
    assert text.count("ArrowEvalPython") == 3  # tracks; runs and pulses; summaries


def test_runs_on_arrays_equal_windows(spark):
    """Random levels: the interval kernel gives what windows over rows give."""
    rng = np.random.default_rng(11)
    found = 0
    for blocks in (0, 1, 5, 20, 40, 41):
        n = blocks * 1100
        x = np.repeat(rng.choice([0.0, 0.001, 0.5, 1.0], blocks), 1100) * rng.standard_normal(n)
        df = recordings(spark, [x])
        want = sorted((r["start"], r["end"]) for r in fr.intensity_pauses(df).collect())
        db = np.array(df.select(vo.level_array(fr.LEVEL_WINDOW, fr.LEVEL_STEP, 1.0).alias("l")).first()["l"])
        top = db.max() - 25.0 if len(db) else None
        flag, start, end = runs.intervals(db, top, round(fr.LEVEL_STEP * SR), n, SR, 0.1, 0.1)
        assert [v for p in zip(start[flag], end[flag]) for v in p] == pytest.approx([v for p in want for v in p])
        found += len(want)
    assert found > 8
    assert [len(v) for v in runs.intervals(np.empty(0), None, 1, 0, SR, 0.1, 0.1)] == [0, 0, 0]


def test_perturbation_on_arrays_equals_windows(spark):
    rng = np.random.default_rng(12)
    for n in (0, 1, 2, 4, 5, 12, 60):
        t = np.cumsum(rng.choice([0.004, 0.0045, 0.005, 0.03, 0.00005], n))
        amp = rng.choice([1.0, 1.1, 0.9, 3.0, -0.5], n)
        got = runs.perturbation(t, amp, 0.0001, 0.02, 1.3, 1.6)
        if not n:
            assert np.isnan(got).all()
            continue
        rows = [("a", i, float(t[i] - t[i - 1]) if i else None, float(amp[i])) for i in range(n)]
        p = spark.createDataFrame(rows, "audio_id string, i int, period double, amp double")
        want = vo.perturbation(p, keys=("audio_id",)).first().asDict()
        for name, v in zip(runs.PERTURBATION, got):
            assert (want[name] is None) == np.isnan(v) and (want[name] is None or v == pytest.approx(want[name])), (n, name)


def test_summaries_of_edge_arrays(spark):
    df = recordings(spark, [[], [2.0], [1.0, 1.0], [1.0, 2.0, 4.0]])
    out = {r["audio_id"]: r for r in df.select("audio_id", describe.summary_of("samples").alias("s")).select("audio_id", "s.*").collect()}
    assert out["0"]["mean"] is None and out["1"]["mean"] == 2.0 and out["1"]["skew"] is None
    assert out["2"]["kurtosis"] is None and out["3"]["skew"] == pytest.approx(0.3818017741606)
    only = df.select(describe.summary_of("samples", ["max"]).alias("s")).select("s.*")
    assert only.columns == ["max"]


def test_peaks_take_plateau_midpoints():
    assert describe.peak_positions(np.array([0, 1, 1, 1, 0, 2, 0.0])).tolist() == [2, 5]
    assert describe.peak_positions(np.array([3, 1, 2.0])).tolist() == []


def test_tail_probabilities():
    assert special.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert special.t_two_sided(1.959963985, 1e7) == pytest.approx(0.05, abs=1e-6)
    assert special.f_upper(4.964602744, 1, 10) == pytest.approx(0.05, abs=1e-8)
    assert special.f_upper(3.325834530, 5, 10) == pytest.approx(0.05, abs=1e-7)
    assert special.normal_two_sided(1.959963985) == pytest.approx(0.05, abs=1e-9)
    assert special.beta_inc(2, 3, 0.5) == pytest.approx(0.6875)


def test_ks_tail(spark):
    from pyspark.sql import functions as F

    # Kolmogorov's distribution: P(K > 1.3581) = 0.05
    n = 2 * 1.3581015 ** 2 / 0.01
    d = spark.range(1).select(special.ks_pvalue(F.lit(0.1), F.lit(n), F.lit(n)).alias("p")).first()["p"]
    assert d == pytest.approx(0.05, abs=1e-4)


def test_pitch_needs_enough_samples():
    assert len(voice.pitch_track(np.zeros(5), SR, 75, 500, 0.01, 0.45)[0]) == 0
    assert dsp.stft_magnitude(np.zeros(3), 16, 8).shape == (0, 9)


def test_voiced_runs_of_two_samples_have_no_pulses():
    """Runs shorter than three samples used to end the job."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        t, amp = voice.find_pulses(rng.normal(size=64), 64.0, 4.0, 25.0, 0.01)
        assert len(t) == len(amp)


def test_rates_do_not_follow_the_sampling_rate(spark):
    """The same bursts at 16 and 48 kHz have the same rates, and pauses within a frame."""
    def bursts(sr):
        return np.concatenate([p for k in range(4) for p in (sine(300, 0.2, 0.5 + 0.1 * (k % 2), sr), np.zeros(int(0.4 * sr)))])

    df = recordings(spark, [bursts(16000)]).union(recordings(spark, [bursts(48000)], 48000).selectExpr("'hi' audio_id", "real_or_fake", "samples", "sampling_rate"))
    rate = [r["speaking_rate"] for r in vo.speaking_rate(df).collect()]
    assert rate[0] == pytest.approx(rate[1], rel=0.02)
    speech = [r for r in vo.speech_rate(df, voicing=False).collect()]
    assert speech[0]["npause"] == speech[1]["npause"] == 3 and speech[0]["voicedcount"] == speech[1]["voicedcount"]
    pauses = {}
    for r in fr.intensity_pauses(df).orderBy("start").collect():
        pauses.setdefault(r["audio_id"], []).append((r["start"], r["end"]))
    assert np.allclose(pauses["0"], pauses["hi"], atol=0.016) and len(pauses["0"]) == 4


def test_batches_are_python_objects_by_slices_only(spark):
    """However many rows an Arrow batch has, the function sees a slice; nulls, structs and nested arrays come through."""
    rows = spark.range(1000, numPartitions=1).selectExpr("id", "if(id = 3, null, array(cast(id as double), 1.0D)) as x", "cast(id as int) as k")
    seen = describe.in_slices(lambda s: pd.Series([len(s)] * len(s)), "bigint")
    assert 0 < rows.select(seen("k").alias("n")).agg(F.max("n")).first()[0] <= describe.SLICE
    got = rows.withColumn("s", dsp.per_recording("n bigint, m array<array<double>>", lambda x, k: (len(x) + k, [x, x + 1]), "x", "k"))
    for r in got.collect():
        want = (None, None) if r["id"] == 3 else (2 + r["id"], [[r["id"], 1.0], [r["id"] + 1, 2.0]])
        assert (r["s"]["n"], r["s"]["m"]) == want
    assert got.where("false").count() == 0
