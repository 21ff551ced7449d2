"""V: voice operators, and the full feature row H06."""

from __future__ import annotations

from ..operators import feature_row as row, voice as vo
from ..operators.scale import spread_small
from . import fixtures as fx
from .q_frames import G, H_, W_, interval_sql, level_sql, stft_sql
from .q_stats import KEYS, deviations, peaks_ctes, r, summary_select
from .registry import query, rounded

PITCH = dict(fmin=4.0, fmax=24.0, step=0.125)  # for signals at 64 samples a second


def _emb(spark, sf):
    return spread_small(fx.sig_emb(spark, sf))


@query("v01_f0_track")
def v01(spark, sf):
    return vo.f0_track(_emb(spark, sf), **PITCH)


@query("v02_speaking_rate", "samp_user", f"""{level_sql('samp_user', 16, '4e-10')},
    m AS (SELECT *, max(db) OVER (PARTITION BY {KEYS}) AS mx FROM lv),
    l AS (SELECT {KEYS}, count(*) AS c FROM samp_user GROUP BY {KEYS}),
    k AS (SELECT {KEYS}, count(*) FILTER (WHERE db > 0.9 * mx) AS k FROM m GROUP BY {KEYS})
    SELECT {KEYS}, {r('coalesce(k, 0) / (l.c / 16)', 'speaking_rate')} FROM l LEFT JOIN k USING ({KEYS})""")
def v02(spark, sf):
    return rounded(vo.speaking_rate(fx.sig_user(spark, sf), W_ / 16, H_ / 16, 0.9))


@query("v03_formants")
def v03(spark, sf):
    return vo.formants(_emb(spark, sf), step=0.125, count=2, ceiling=32.0, window=0.125, emphasis=1.0)


@query("v04_pulses")
def v04(spark, sf):
    return vo.pulses(_emb(spark, sf), **PITCH)


def perturb_sql(col: str, points: int, link: str, out: str) -> str:
    h = points // 2
    return f"""CASE WHEN count({col}) OVER (PARTITION BY audio_id ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) = {points}
    AND sum({link}::INT) OVER (PARTITION BY audio_id ORDER BY i ROWS BETWEEN {h - 1} PRECEDING AND {h} FOLLOWING) = {points - 1}
    THEN abs({col} - avg({col}) OVER (PARTITION BY audio_id ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)) END AS {out}"""


JIT = f"""a AS (SELECT *, coalesce(period BETWEEN 0 AND 1e6, false) AS ok FROM pulses),
    b AS (SELECT *, lag(period) OVER w AS prev, lag(ok) OVER w AS prev_ok FROM a WINDOW w AS (PARTITION BY audio_id ORDER BY i)),
    c AS (SELECT *, coalesce(ok AND prev_ok AND greatest(period, prev) / nullif(least(period, prev), 0) <= 1e3, false) AS link FROM b),
    d AS (SELECT *, CASE WHEN link THEN abs(period - prev) END AS d1, {perturb_sql('period', 3, 'link', 'd3')}, {perturb_sql('period', 5, 'link', 'd5')} FROM c),
    j AS (SELECT audio_id, avg(CASE WHEN ok THEN period END) AS t, avg(d1) AS d1, avg(d3) AS d3, avg(d5) AS d5 FROM d GROUP BY 1)"""
SHIM = f"""a AS (SELECT *, lag(amp) OVER (PARTITION BY audio_id ORDER BY i) AS prev FROM pulses),
    c AS (SELECT *, coalesce(period BETWEEN 0 AND 1e6 AND amp > 0 AND prev > 0 AND greatest(amp, prev) / nullif(least(amp, prev), 0) <= 20, false) AS link FROM a),
    d AS (SELECT *, CASE WHEN link THEN abs(amp - prev) END AS d1, CASE WHEN link THEN abs(20 * log10(amp / prev)) END AS db,
    {perturb_sql('amp', 3, 'link', 'd3')}, {perturb_sql('amp', 5, 'link', 'd5')}, {perturb_sql('amp', 11, 'link', 'd11')} FROM c),
    s AS (SELECT audio_id, avg(amp) AS m, avg(d1) AS d1, avg(db) AS db, avg(d3) AS d3, avg(d5) AS d5, avg(d11) AS d11 FROM d GROUP BY 1)"""


def _jitter(spark, sf):
    return vo.jitter(fx.pulses(spark, sf), 0.0, 1e6, 1e3, ("audio_id",))


def _shimmer(spark, sf):
    return vo.shimmer(fx.pulses(spark, sf), 0.0, 1e6, 20.0, ("audio_id",))


@query("v05_jitter", "pulses", f"{JIT} SELECT audio_id, {r('d1 / t', 'jitter_local')}, {r('d3 / t', 'jitter_rap')}, {r('d5 / t', 'jitter_ppq5')} FROM j")
def v05(spark, sf):
    return rounded(_jitter(spark, sf).select("audio_id", "jitter_local", "jitter_rap", "jitter_ppq5"))


@query("v06_shimmer", "pulses", f"{SHIM} SELECT audio_id, {r('d1 / m', 'shimmer_local')}, {r('d3 / m', 'shimmer_apq3')}, {r('d5 / m', 'shimmer_apq5')}, {r('3 * d3 / m', 'shimmer_dda')} FROM s")
def v06(spark, sf):
    return rounded(_shimmer(spark, sf).select("audio_id", "shimmer_local", "shimmer_apq3", "shimmer_apq5", "shimmer_dda"))


@query("v07_perturbation", "pulses", f"""{JIT}, {SHIM.replace('a AS', 'a2 AS', 1).replace('FROM a)', 'FROM a2)').replace('c AS', 'c2 AS', 1).replace('FROM c)', 'FROM c2)').replace('d AS', 'd2 AS', 1).replace('FROM d GROUP', 'FROM d2 GROUP')}
    SELECT audio_id, {r('j.d1', 'jitter_absolute')}, {r('3 * j.d3 / t', 'jitter_ddp')}, {r('db', 'shimmer_db')}, {r('d11 / m', 'shimmer_apq11')} FROM j JOIN s USING (audio_id)""")
def v07(spark, sf):
    p = vo.perturbation(fx.pulses(spark, sf), 0.0, 1e6, 1e3, 20.0, ("audio_id",))
    return rounded(p.select("audio_id", "jitter_absolute", "jitter_ddp", "shimmer_db", "shimmer_apq11"))


@query("v08_hnr_db")
def v08(spark, sf):
    return vo.hnr_db(_emb(spark, sf), **PITCH)


@query("v09_speech_rate", "samp_user", f"""{level_sql('samp_user', 16, '4e-10')},
    q AS (SELECT {KEYS}, quantile_cont(db, 0.99) - 4 AS cut, greatest(quantile_cont(db, 0.99) - 4, min(db)) AS thr, any_value(dur) AS dur, count(*) AS nf FROM lv GROUP BY {KEYS}),
    fx AS (SELECT {KEYS}, frame_idx AS n, db AS x FROM lv), {peaks_ctes('fx', KEYS)},
    pk AS (SELECT *, lead(n) OVER (PARTITION BY {KEYS} ORDER BY n) AS nxt FROM peaks JOIN q USING ({KEYS}) WHERE h > thr),
    dp AS (SELECT pk.{KEYS.replace(', ', ', pk.')}, pk.n, any_value(pk.h) - min(fx.x) AS dip FROM pk JOIN fx ON pk.audio_id = fx.audio_id AND pk.real_or_fake = fx.real_or_fake
        AND fx.n BETWEEN pk.n AND pk.nxt GROUP BY 1, 2, 3),
    lv2 AS (SELECT lv.*, cut FROM lv JOIN q USING ({KEYS})),
    {interval_sql('cut', 0.75, 0.75).replace('FROM lv)', 'FROM lv2)')},
    snd AS (SELECT * FROM i3 WHERE NOT q),
    vc AS (SELECT dp.audio_id, dp.real_or_fake, count(*) AS v FROM dp JOIN snd ON dp.audio_id = snd.audio_id AND dp.real_or_fake = snd.real_or_fake
        AND dp.n * 8 / 16 >= s AND dp.n * 8 / 16 < e WHERE dip > 1 GROUP BY 1, 2),
    sp AS (SELECT {KEYS}, count(*) AS np, sum(e - s) AS speak FROM snd GROUP BY {KEYS}),
    z AS (SELECT {KEYS}, coalesce(v, 0)::DOUBLE AS v, coalesce(np, 0) - 1 AS np, dur, nf * 8 / 16 AS idur, coalesce(speak, 0) AS speak
        FROM q LEFT JOIN vc USING ({KEYS}) LEFT JOIN sp USING ({KEYS}))
    SELECT {KEYS}, v AS voicedcount, np::DOUBLE AS npause, {r('dur', 'originaldur')}, {r('idur', 'intensity_duration')}, {r('v / dur', 'speakingrate')},
    {r('v / nullif(speak, 0)', 'articulationrate')}, {r('speak / nullif(v, 0)', 'asd')}, {r('dur - speak', 'totalpauseduration')} FROM z""")
def v09(spark, sf):
    return rounded(vo.speech_rate(fx.sig_user(spark, sf), W_ / 16, H_ / 16, silence_db=-4.0, min_dip=1.0, min_pause=0.75,
                                  min_sounding=0.75, voicing=False))


@query("v10_pitch_and_formants")
def v10(spark, sf):
    e = _emb(spark, sf)
    p = vo.pitch_summary(e, **PITCH)
    return p.join(vo.formants_at_pulses(e, 4.0, 24.0, 0.125, 32.0), ["audio_id", "real_or_fake"])


ZCR_RMS = f"""zf AS (SELECT *, (x < 0) <> lag(x < 0) OVER (PARTITION BY {KEYS}, frame_idx ORDER BY n) AS sg FROM fr),
    tk AS (SELECT {KEYS}, frame_idx, coalesce(sum(sg::INT), 0) / 16 AS z, sqrt(avg(x * x)) AS en FROM zf {G})"""


def prefixed(alias: str, name: str) -> str:
    return ", ".join(f'{alias}."{m}" AS "{name}_{m}"' for m in row.MEASURES)


@query("h06_feature_row", "samp_user", f"""{level_sql('samp_user', 16, '1')}, {ZCR_RMS},
    {deviations('tk', KEYS, 'z').replace('dev AS', 'dz AS')}, hz AS (SELECT {KEYS}, {summary_select('z', 7)} FROM dz GROUP BY {KEYS}),
    {deviations('tk', KEYS, 'en').replace('dev AS', 'de AS')}, he AS (SELECT {KEYS}, {summary_select('en', 7)} FROM de GROUP BY {KEYS}),
    {interval_sql(f'max(db) OVER (PARTITION BY {KEYS}) - 2.5', 0.6, 0.6)}, pz AS (SELECT {KEYS}, e - s AS x FROM i3 WHERE q),
    {deviations('pz', KEYS)}, hp AS (SELECT {KEYS}, {summary_select('x', 7)} FROM dev GROUP BY {KEYS}),
    l AS (SELECT {KEYS}, count(*) AS c FROM samp_user GROUP BY {KEYS}),
    mx AS (SELECT *, max(db + 10 * log10(1 / 4e-10)) OVER (PARTITION BY {KEYS}) AS mx FROM lv),
    sr AS (SELECT {KEYS}, count(*) FILTER (WHERE db + 10 * log10(1 / 4e-10) > 0.3 * mx) AS k FROM mx GROUP BY {KEYS})
    SELECT {KEYS}, {prefixed('hz', 'zero_crossing_rate')}, {prefixed('he', 'energy')}, {r('coalesce(k, 0) / (c / 16)', 'speaking_rate', 7)}, {prefixed('hp', 'pause')}
    FROM l LEFT JOIN hz USING ({KEYS}) LEFT JOIN he USING ({KEYS}) LEFT JOIN hp USING ({KEYS}) LEFT JOIN sr USING ({KEYS})""")
def h06(spark, sf):
    opts = row.Options(n_fft=W_, hop=H_, target_sr=None, level_window=W_ / 16, level_step=H_ / 16, rate_window=W_ / 16, rate_step=H_ / 16, pause_db=-2.5, min_silent=0.6, min_sounding=0.6)
    return rounded(row.feature_row(fx.sig_user(spark, sf), ["zero_crossing_rate", "energy", "speaking_rate", "pauses"], opts), 7)


HZ = "k * 4.0"  # bin k of a 16-point frame at rate 64
LEVEL = "10 * log10(greatest({}, 1e-10))"
SPECTRAL = {
    "spectral_centroid": f"SELECT {KEYS}, sum({HZ} * a) / sum(a) AS x FROM mid GROUP BY {KEYS}, frame_idx",
    "spectral_bandwidth": f"SELECT {KEYS}, sqrt(sum(a * pow({HZ} - hz, 2)) / sum(a)) AS x FROM mid GROUP BY {KEYS}, frame_idx",
    "spectral_contrast": f"SELECT {KEYS}, {LEVEL.format('max(a)')} - {LEVEL.format('min(a)')} AS x FROM mid, (VALUES (0, 0, 1), (1, 1, 2), (2, 2, 8)) v(bd, lo, hi) "
                         f"WHERE k BETWEEN lo AND hi GROUP BY {KEYS}, frame_idx, bd",
    "spectral_flatness": f"SELECT {KEYS}, exp(avg(ln(greatest(a * a, 1e-10)))) / avg(greatest(a * a, 1e-10)) AS x FROM mid GROUP BY {KEYS}, frame_idx",
    "spectral_rolloff": f"SELECT {KEYS}, (min({HZ}) FILTER (WHERE upto >= 0.85 * tot))::DOUBLE AS x FROM mid GROUP BY {KEYS}, frame_idx",
    "spectral_flux": f"SELECT {KEYS}, sqrt(sum(pow(a - prev, 2))) AS x FROM mid WHERE frame_idx > 0 GROUP BY {KEYS}, frame_idx",
}


@query("h06_feature_row_spectral", "samp_emb", f"""{stft_sql()},
    mid AS (SELECT *, sum({HZ} * a) OVER w / sum(a) OVER w AS hz, sum(a) OVER w AS tot, sum(a) OVER (PARTITION BY {KEYS}, frame_idx ORDER BY k) AS upto,
        lag(a) OVER (PARTITION BY {KEYS}, k ORDER BY frame_idx) AS prev FROM sp WINDOW w AS (PARTITION BY {KEYS}, frame_idx)),
    tracks AS ({' UNION ALL '.join(f"SELECT *, '{n}' AS f FROM ({q})" for n, q in SPECTRAL.items())}),
    {deviations('tracks', KEYS + ', f')}, h AS (SELECT {KEYS}, f, {summary_select()} FROM dev GROUP BY {KEYS}, f)
    SELECT {KEYS}, {', '.join(prefixed(f's{k}', n) for k, n in enumerate(SPECTRAL))} FROM (SELECT * FROM h WHERE f = 'spectral_centroid') s0 """
       + " ".join(f"JOIN (SELECT * FROM h WHERE f = '{n}') s{k} USING ({KEYS})" for k, n in enumerate(SPECTRAL) if k))
def h06_spectral(spark, sf):
    opts = row.Options(n_fft=W_, hop=H_, target_sr=None, contrast_fmin=4.0, contrast_bands=2)
    return rounded(row.feature_row(fx.sig_emb(spark, sf), list(SPECTRAL), opts))


@query("h06_feature_row_all")
def h06_all(spark, sf):
    opts = row.Options(n_fft=W_, hop=H_, target_sr=None, level_window=W_ / 64, level_step=H_ / 64, rate_window=W_ / 64, rate_step=H_ / 64, n_mels=16, contrast_fmin=4.0, contrast_bands=2, f0_low=4.0, f0_high=24.0,
                       pitch_low=4.0, pitch_high=24.0, pitch_step=0.125, formant_ceiling=32.0, formant_count=2, formant_window=0.125,
                       formant_step=0.125)
    return row.feature_row(fx.sig_emb(spark, sf), None, opts)
