"""T and Q: time-domain operators and quality checks. Test frames: 16 samples, hop 8."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frames as fr, quality as qa, stats as st
from . import fixtures as fx
from .q_stats import KEYS, peaks_ctes, r
from .registry import query, rounded

W_, H_ = 16, 8


def frame_rows(src: str, keys: str = KEYS, w: int = W_, h: int = H_, ragged: bool = False) -> str:
    """fr: one row per (frame, sample)."""
    lim = f"WHERE c >= {w}" if not ragged else ""
    last = f"(c - {w}) // {h} + 1" if not ragged else f"(c - 1) // {h} + 1"
    return f"""ln AS (SELECT {keys}, count(*) AS c FROM {src} GROUP BY {keys}),
    st AS (SELECT *, unnest(range(0, {last})) AS frame_idx FROM ln {lim}),
    fr AS (SELECT st.*, u.n, u.x FROM st JOIN {src} u USING ({keys}) WHERE u.n >= frame_idx * {h} AND u.n < frame_idx * {h} + {w})"""


def _user(spark, sf):
    return fx.sig_user(spark, sf)


@query("t01_resample", "samp_emb", f"""
    d AS (SELECT {KEYS}, j AS n, x, s.n - j * 64 / 48 AS d FROM samp_emb s, range(48) t(j)),
    k AS (SELECT {KEYS}, n, x * 0.75 * CASE WHEN abs(d) < 1e-12 THEN 1 ELSE sin(pi() * 0.75 * d) / (pi() * 0.75 * d) END
        * (0.5 + 0.5 * cos(pi() * d / 43)) AS v FROM d WHERE abs(d) < 43)
    SELECT {KEYS}, 48::BIGINT AS sampling_rate, n::BIGINT AS n, {r('sum(v)', 'x', 6)} FROM k GROUP BY {KEYS}, n""")
def t01(spark, sf):
    out = fr.resample(fx.sig_emb(spark, sf), 48)
    return rounded(out.select("audio_id", "real_or_fake", "sampling_rate", F.posexplode("samples").alias("n", "x")), 6)


@query("t02_frames", "samp_user", f"""{frame_rows('samp_user')}
    SELECT {KEYS}, frame_idx::BIGINT AS frame_idx, string_agg(round(x * 1e9)::BIGINT::VARCHAR, ',' ORDER BY n) AS frame FROM fr GROUP BY {KEYS}, frame_idx""")
def t02(spark, sf):
    f = fr.frames(_user(spark, sf), W_, H_)
    text = F.array_join(F.transform("frame", lambda x: F.round(x * 1e9).cast("bigint").cast("string")), ",")
    return rounded(f.select("audio_id", "real_or_fake", "frame_idx", text.alias("frame")))


G = f"GROUP BY {KEYS}, frame_idx"
FI = f"{KEYS}, frame_idx::BIGINT AS frame_idx"


@query("t03_rms_energy", "samp_user", f"{frame_rows('samp_user')} SELECT {FI}, {r('sqrt(avg(x * x))', 'rms')} FROM fr {G}")
def t03(spark, sf):
    return rounded(fr.rms_energy(_user(spark, sf), W_, H_))


@query("t04_zero_crossing_rate", "samp_user", f"""{frame_rows('samp_user')},
    z AS (SELECT *, (x < 0) <> lag(x < 0) OVER (PARTITION BY {KEYS}, frame_idx ORDER BY n) AS s FROM fr)
    SELECT {FI}, {r('coalesce(sum(s::INT), 0) / 16', 'zcr')} FROM z {G}""")
def t04(spark, sf):
    return rounded(fr.zero_crossing_rate(_user(spark, sf), W_, H_))


@query("t05_zero_crossings", "samp_user", f"""
    z AS (SELECT *, (x < 0) <> lag(x < 0) OVER (PARTITION BY {KEYS} ORDER BY n) AS s FROM samp_user)
    SELECT {KEYS}, coalesce(sum(s::INT), 0)::BIGINT AS zero_crossings FROM z GROUP BY {KEYS}""")
def t05(spark, sf):
    return rounded(fr.zero_crossings(_user(spark, sf)))


@query("t06_crest_factor", "samp_user", f"{frame_rows('samp_user')} SELECT {FI}, {r('max(x) / sqrt(avg(x * x))', 'crest')} FROM fr {G}")
def t06(spark, sf):
    return rounded(fr.crest_factor(_user(spark, sf), W_, H_))


@query("t07_crest_factor_abs", "samp_user", f"""{frame_rows('samp_user', ragged=True)}
    SELECT {FI}, {r('max(abs(x)) / sqrt(avg(x * x))', 'crest')} FROM fr {G}""")
def t07(spark, sf):
    return rounded(fr.crest_factor_abs(_user(spark, sf), W_, H_))


def peaks_sql(where: str = "") -> str:
    return f"""{peaks_ctes('samp_user', KEYS)}, a AS (SELECT DISTINCT {KEYS} FROM samp_user),
    p AS (SELECT {KEYS}, count(*) AS k, avg(h) AS m FROM peaks {where} GROUP BY {KEYS})
    SELECT {KEYS}, coalesce(k, 0)::BIGINT AS n_peaks, {r('coalesce(m, 0)', 'mean_height')} FROM a LEFT JOIN p USING ({KEYS})"""


@query("t08_peaks", "samp_user", peaks_sql("WHERE h >= 5"))
def t08(spark, sf):
    return rounded(fr.peaks(_user(spark, sf), 5.0))


def level_sql(src: str = "samp_user", sr: int = 16, ref: str = "1") -> str:
    """lv: one row per frame with start, end and db, and lm with the run structure helpers."""
    return f"""{frame_rows(src)},
    lv AS (SELECT {KEYS}, frame_idx, frame_idx * {H_} / {sr} AS s,
        CASE WHEN frame_idx = (any_value(c) - {W_}) // {H_} THEN any_value(c) ELSE (frame_idx + 1) * {H_} END / {sr} AS e,
        any_value(c) / {sr} AS dur, 10 * log10(greatest(avg(x * x), 1e-10) / {ref}) AS db FROM fr {G})"""


def islands(src: str, out: str, order: str, carry: str = "") -> str:
    extra = "".join(f", any_value({c}) AS {c}" for c in carry.split())
    return f"""{out}_a AS (SELECT *, CASE WHEN q = lag(q) OVER (PARTITION BY {KEYS} ORDER BY {order}) THEN 0 ELSE 1 END AS nw FROM {src}),
    {out}_b AS (SELECT *, sum(nw) OVER (PARTITION BY {KEYS} ORDER BY {order}) AS run FROM {out}_a),
    {out} AS (SELECT {KEYS}, bool_or(q) AS q, min(s) AS s, max(e) AS e{extra} FROM {out}_b GROUP BY {KEYS}, run)"""


def silence_sql(top: float) -> str:
    return f"""{level_sql()}, ql AS (SELECT *, db <= max(db) OVER (PARTITION BY {KEYS}) - {top} AS q FROM lv), {islands('ql', 'iv', 'frame_idx')}"""


@query("t09_silences", "samp_user", f"""{silence_sql(3)}
    SELECT {KEYS}, {r('s', 'start')}, {r('e', 'end')}, {r('e - s', 'duration')} FROM iv WHERE q""")
def t09(spark, sf):
    return rounded(fr.silences(_user(spark, sf), 3.0, W_, H_))


def interval_sql(threshold: str, silent: float, sounding: float, carry: str = "") -> str:
    extra = "".join(f", {c}" for c in carry.split())
    return f"""ql AS (SELECT *, db < {threshold} AS q FROM lv), {islands('ql', 'i1', 'frame_idx', carry)},
    q2 AS (SELECT {KEYS}, s, e, q AND round(e - s, 9) >= {silent} AS q{extra} FROM i1), {islands('q2', 'i2', 's', carry)},
    q3 AS (SELECT {KEYS}, s, e, q OR NOT round(e - s, 9) >= {sounding} AS q{extra} FROM i2), {islands('q3', 'i3', 's', carry)}"""


@query("t10_intensity_pauses", "samp_user", f"""{level_sql()}, {interval_sql(f'max(db) OVER (PARTITION BY {KEYS}) - 2.5', 0.6, 0.6)}
    SELECT {KEYS}, {r('s', 'start')}, {r('e', 'end')}, {r('e - s', 'duration')} FROM i3 WHERE q""")
def t10(spark, sf):
    return rounded(fr.intensity_pauses(_user(spark, sf), -2.5, 0.6, 0.6, W_ / 16, H_ / 16))


@query("t11_rolling", "samp_user", f"""
    w AS (SELECT {KEYS}, avg(x) OVER w AS m, stddev_samp(x) OVER w AS s, count(*) OVER w AS c FROM samp_user
        WINDOW w AS (PARTITION BY {KEYS} ORDER BY n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
    SELECT {KEYS}, {r('avg(m) FILTER (WHERE c = 3)', 'rolling_mean')}, {r('avg(s) FILTER (WHERE c = 3)', 'rolling_std')} FROM w GROUP BY {KEYS}""")
def t11(spark, sf):
    return rounded(fr.rolling(_user(spark, sf)))


@query("t12_autocorr", "samp_user", f"""
    l AS (SELECT {KEYS}, x, lag(x) OVER (PARTITION BY {KEYS} ORDER BY n) AS y FROM samp_user)
    SELECT {KEYS}, {r('corr(x, y)', 'autocorr')} FROM l WHERE y IS NOT NULL GROUP BY {KEYS} HAVING count(*) >= 2""")
def t12(spark, sf):
    return rounded(fr.autocorr(_user(spark, sf)))


@query("t13_value_entropy", "samp_user", f"""
    v AS (SELECT {KEYS}, x, count(*) AS c FROM samp_user GROUP BY {KEYS}, x),
    t AS (SELECT *, sum(c) OVER (PARTITION BY {KEYS}) AS t FROM v)
    SELECT {KEYS}, {r('-sum(c / t * ln(c / t))', 'entropy')} FROM t GROUP BY {KEYS}""")
def t13(spark, sf):
    return rounded(fr.value_entropy(_user(spark, sf)))


@query("t14_peak_normalize", "samp_emb", f"""
    SELECT {KEYS}, n::BIGINT AS n, {r('x / max(abs(x)) OVER (PARTITION BY audio_id)', 'x')} FROM samp_emb""")
def t14(spark, sf):
    out = fr.peak_normalize(fx.sig_emb(spark, sf))
    return rounded(out.select("audio_id", "real_or_fake", F.posexplode("samples").alias("n", "x")))


@query("t15_time_axis", "samp_emb", f"SELECT {KEYS}, {r('n / 64', 't', 9)}, {r('x', 'x', 9)} FROM samp_emb")
def t15(spark, sf):
    return rounded(fr.time_axis(fx.sig_emb(spark, sf)), 9)


DFT = """b AS (SELECT audio_id, k, sum(x * cos(2 * pi() * ((k * n) % 64) / 64)) AS re, -sum(x * sin(2 * pi() * ((k * n) % 64) / 64)) AS im
    FROM samp_emb, range(33) t(k) GROUP BY 1, 2), m AS (SELECT *, sqrt(re * re + im * im) AS a FROM b)"""


@query("q01_dominant_frequency", "samp_emb", f"""{DFT},
    d AS (SELECT audio_id, arg_max(k, a)::DOUBLE AS f FROM m GROUP BY 1)
    SELECT DISTINCT {KEYS}, {r('f', 'dominant_hz')}, 64 >= 4 * f AS compliant FROM d JOIN sig_emb USING (audio_id)""")
def q01(spark, sf):
    return rounded(qa.dominant_frequency(fx.sig_emb(spark, sf), 4.0))


@query("q02_clipping", "sig_emb", f"SELECT {KEYS}, list_max(list_transform(samples, lambda x: abs(x))) >= 0.3 AS clipped FROM sig_emb")
def q02(spark, sf):
    return qa.clipping(fx.sig_emb(spark, sf), 0.3)


@query("q03_long_silence", "samp_user", f"""{silence_sql(3)}, g AS (SELECT {KEYS}, max(e - s) AS m FROM iv WHERE q GROUP BY {KEYS}),
    a AS (SELECT DISTINCT {KEYS} FROM samp_user)
    SELECT {KEYS}, {r('coalesce(m, 0)', 'longest')}, coalesce(m, 0) >= 0.75 AS has_long_silence FROM a LEFT JOIN g USING ({KEYS})""")
def q03(spark, sf):
    return rounded(qa.long_silence(_user(spark, sf), 3.0, 0.75, W_, H_))


def stft_sql(src: str = "samp_emb", n_fft: int = 16, hop: int = 8) -> str:
    """sp: magnitude a per (recording, frame, bin k), Hann window."""
    return f"""{frame_rows(src, KEYS, n_fft, hop)},
    hw AS (SELECT {KEYS}, frame_idx, n - frame_idx * {hop} AS j, x * (0.5 - 0.5 * cos(2 * pi() * (n - frame_idx * {hop}) / {n_fft})) AS v FROM fr),
    sp AS (SELECT {KEYS}, frame_idx, k, sqrt(pow(sum(v * cos(2 * pi() * ((k * j) % {n_fft}) / {n_fft})), 2)
        + pow(sum(v * sin(2 * pi() * ((k * j) % {n_fft}) / {n_fft})), 2)) AS a FROM hw, range({n_fft // 2 + 1}) t(k) GROUP BY {KEYS}, frame_idx, k)"""


@query("q04_snr_db", "samp_emb", f"{stft_sql()} SELECT {KEYS}, {r('10 * log10(avg(a * a) / var_pop(a))', 'snr_db')} FROM sp GROUP BY {KEYS}")
def q04(spark, sf):
    return rounded(qa.snr_db(fx.sig_emb(spark, sf), 16, 8))


@query("q05_artifact_counts", "samp_emb", f"""
    nm AS (SELECT {KEYS}, n, x / max(abs(x)) OVER (PARTITION BY audio_id) AS x FROM samp_emb),
    {level_sql('nm', 64)}, ql AS (SELECT *, db <= max(db) OVER (PARTITION BY {KEYS}) - 3 AS q FROM lv), {islands('ql', 'iv', 'frame_idx')},
    {peaks_ctes('nm', KEYS)}, p AS (SELECT {KEYS}, count(*) AS k FROM peaks WHERE h >= 0.6 GROUP BY {KEYS}),
    c AS (SELECT {KEYS}, count(*) FILTER (WHERE abs(x) > 0.9) AS c FROM nm GROUP BY {KEYS}),
    v AS (SELECT {KEYS}, count(*) FILTER (WHERE NOT q) AS v FROM iv GROUP BY {KEYS})
    SELECT {KEYS}, c AS clipping, v AS reverberation, coalesce(k, 0)::BIGINT AS compression FROM c LEFT JOIN v USING ({KEYS}) LEFT JOIN p USING ({KEYS})""")
def q05(spark, sf):
    return rounded(qa.artifact_counts(fr.peak_normalize(fx.sig_emb(spark, sf)), 0.9, 3.0, 0.6, W_, H_))


@query("q06_audio_properties", "sig_ev", f"SELECT {KEYS}, 16::BIGINT AS sampling_rate, {r('len(samples) / 16', 'duration')} FROM sig_ev")
def q06(spark, sf):
    return rounded(qa.audio_properties(fx.sig_ev(spark, sf)))


@query("q07_property_summary", "sig_ev", f"""
    p AS (SELECT len(samples) / 16 AS duration, 16.0::DOUBLE AS sampling_rate FROM sig_ev)
    SELECT 'duration' AS feature, {r('avg(duration)', 'mean')}, {r('stddev_pop(duration)', 'std_dev')}, {r('quantile_cont(duration, 0.5)', 'median')} FROM p
    UNION ALL SELECT 'sampling_rate', avg(sampling_rate), stddev_pop(sampling_rate), quantile_cont(sampling_rate, 0.5) FROM p""")
def q07(spark, sf):
    p = qa.audio_properties(fx.sig_ev(spark, sf)).withColumn("sampling_rate", F.col("sampling_rate").cast("double"))
    return rounded(st.property_summary(p, ["duration", "sampling_rate"]))
