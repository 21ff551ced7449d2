"""F: spectral operators, against a relational Fourier sum. Test spectra: n_fft 16, hop 8."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.describe import DESCRIPTIVE, MEASURES
from ..operators import spectral as sp, stats as st
from . import fixtures as fx
from .q_frames import stft_sql
from .q_stats import KEYS, descriptive_ctes, deviations, r, summary_select
from .registry import query, rounded

P = dict(n_fft=16, hop=8)
FI = f"{KEYS}, frame_idx::BIGINT AS frame_idx"
G = f"GROUP BY {KEYS}, frame_idx"
HZ = "k * 4.0"  # bin k of a 16-point frame at rate 64


def emb(spark, sf):
    return fx.sig_emb(spark, sf)


def whole_dft(src: str, sr: int) -> str:
    """am: amplitude per (recording, bin) of the first n / 2 bins."""
    return f"""nn AS (SELECT {KEYS}, count(*) AS c FROM {src} GROUP BY {KEYS}),
    kk AS (SELECT *, unnest(range(0, c // 2)) AS k FROM nn WHERE c >= 2),
    am AS (SELECT {KEYS}, k AS bin, c, k * ({sr} / 2) / greatest(c // 2 - 1, 1) AS hz, 2.0 * sqrt(pow(sum(x * cos(2 * pi() * ((k * n) % c) / c)), 2)
        + pow(sum(x * sin(2 * pi() * ((k * n) % c) / c)), 2)) / c AS ampl FROM kk JOIN {src} USING ({KEYS}) GROUP BY {KEYS}, k, c)"""


AM = whole_dft("samp_emb", 64)


@query("f01_amplitude_spectrum", "samp_emb", f"{AM} SELECT {KEYS}, bin, {r('hz', 'hz')}, {r('ampl', 'ampl', 6)} FROM am")
def f01(spark, sf):
    a = sp.amplitude_spectrum(emb(spark, sf)).select("audio_id", "real_or_fake", sp._positions(F.col("spectrum"), "array<struct<hz:double,ampl:double>>").alias("bin", "s"))
    return rounded(a.select("audio_id", "real_or_fake", "bin", F.round("s.hz", 4).alias("hz"), "s.ampl"), 6)


@query("f02_spectrum", "samp_emb", f"""{AM} SELECT {KEYS}, bin, 'decibel' AS kind, {r('20 * log10(ampl)', 'value', 6)} FROM am
    UNION ALL SELECT {KEYS}, bin, 'energy', {r('ampl * ampl', 'value', 6)} FROM am UNION ALL SELECT {KEYS}, bin, 'power', {r('ampl * ampl / c', 'value', 6)} FROM am""")
def f02(spark, sf):
    parts = [sp.spectrum(emb(spark, sf), k).select("audio_id", "real_or_fake", "bin", F.lit(k).alias("kind"), "value")
             for k in ("decibel", "energy", "power")]
    return rounded(parts[0].union(parts[1]).union(parts[2]), 6)


@query("f03_spectrogram_db", "samp_emb", f"""{stft_sql()}
    SELECT {FI}, k AS bin, {r("greatest(20 * log10(greatest(a, 1e-5) / greatest(max(a) OVER (PARTITION BY audio_id), 1e-5)), -80)", 'db')} FROM sp""")
def f03(spark, sf):
    return rounded(sp.spectrogram_db(emb(spark, sf), **P))


@query("f04_mel_spectrogram_db")
def f04(spark, sf):
    return sp.mel_spectrogram_db(emb(spark, sf), n_mels=6, **P)


@query("f05_spectral_centroid", "samp_emb", f"""{stft_sql()},
    c AS (SELECT {KEYS}, frame_idx, sum({HZ} * a) / sum(a) AS hz, sum(k * a) / sum(a) AS b FROM sp {G})
    SELECT {FI}, {r('hz', 'centroid_hz')}, {r('b * (32.0 / 9)', 'bin_hz')} FROM c""")
def f05(spark, sf):
    e = emb(spark, sf)
    both = sp.tracks(e, ["spectral_centroid", "centroid_bin"], **P)
    z = both.select("audio_id", "real_or_fake", F.posexplode(F.arrays_zip("spectral_centroid", "centroid_bin")).alias("frame_idx", "z"))
    return rounded(z.select("audio_id", "real_or_fake", "frame_idx", F.col("z.spectral_centroid").alias("centroid_hz"),
                            sp.bin_to_freq(F.col("z.centroid_bin"), 9, F.lit(64)).alias("bin_hz")))


@query("f06_spectral_bandwidth", "samp_emb", f"""{stft_sql()},
    c AS (SELECT *, sum({HZ} * a) OVER w / sum(a) OVER w AS hz FROM sp WINDOW w AS (PARTITION BY {KEYS}, frame_idx))
    SELECT {FI}, {r(f'sqrt(sum(a * pow({HZ} - hz, 2)) / sum(a))', 'value')} FROM c {G}""")
def f06(spark, sf):
    return rounded(sp.spectral_bandwidth(emb(spark, sf), **P))


DB = "10 * log10(greatest({}, 1e-10))"


@query("f07_spectral_contrast", "samp_emb", f"""{stft_sql()},
    b AS (SELECT *, bd FROM sp, (VALUES (0, 0, 1), (1, 1, 2), (2, 2, 8)) v(bd, lo, hi) WHERE k BETWEEN lo AND hi)
    SELECT {KEYS}, (bd * 7 + frame_idx)::BIGINT AS frame_idx, {r(f"{DB.format('max(a)')} - {DB.format('min(a)')}", 'value')} FROM b GROUP BY {KEYS}, frame_idx, bd""")
def f07(spark, sf):
    return rounded(sp.spectral_contrast(emb(spark, sf), fmin=4.0, bands=2, **P))


@query("f08_spectral_flatness", "samp_emb", f"""{stft_sql()}
    SELECT {FI}, {r('exp(avg(ln(greatest(a * a, 1e-10)))) / avg(greatest(a * a, 1e-10))', 'value')} FROM sp {G}""")
def f08(spark, sf):
    return rounded(sp.spectral_flatness(emb(spark, sf), **P))


@query("f09_spectral_rolloff", "samp_emb", f"""{stft_sql()},
    c AS (SELECT *, sum(a) OVER (PARTITION BY {KEYS}, frame_idx ORDER BY k) AS s, sum(a) OVER (PARTITION BY {KEYS}, frame_idx) AS t FROM sp)
    SELECT {FI}, {r(f'(min({HZ}) FILTER (WHERE s >= 0.85 * t))::DOUBLE', 'value')} FROM c {G}""")
def f09(spark, sf):
    return rounded(sp.spectral_rolloff(emb(spark, sf), **P))


@query("f10_spectral_flux", "samp_emb", f"""{stft_sql()},
    d AS (SELECT *, a - lag(a) OVER (PARTITION BY {KEYS}, k ORDER BY frame_idx) AS d FROM sp)
    SELECT {KEYS}, frame_idx::BIGINT - 1 AS frame_idx, {r('sqrt(sum(d * d))', 'value')} FROM d WHERE frame_idx > 0 {G}""")
def f10(spark, sf):
    return rounded(sp.spectral_flux(emb(spark, sf), **P))


@query("f11_mfcc")
def f11(spark, sf):
    return sp.mfcc(emb(spark, sf), n=5, n_mels=6, **P)


# only bins 7 and 8 (28 and 32 Hz) lie above 27.5 Hz; they are the pitch classes A and C
CHROMA = f"""{stft_sql()}, ac AS (SELECT {KEYS}, frame_idx, max(CASE WHEN k = 7 THEN a * a END) AS pa, max(CASE WHEN k = 8 THEN a * a END) AS pc FROM sp {G})"""


@query("f12_chroma", "samp_emb", f"""{CHROMA}
    SELECT {FI}, c AS coef, {r('CASE c WHEN 1 THEN pc WHEN 10 THEN pa ELSE 0 END / greatest(pa, pc)', 'value')} FROM ac, range(1, 13) t(c)""")
def f12(spark, sf):
    return rounded(sp.chroma(emb(spark, sf), **P))


@query("f13_tonnetz", "samp_emb", f"""{CHROMA},
    w AS (SELECT * FROM (VALUES (1, 7 / 6, 1.0), (3, 3 / 2, 1.0), (5, 2 / 3, 0.5)) v(c0, turn, rad)),
    s AS (SELECT *, pc / (pa + pc) AS sc, pa / (pa + pc) AS sa FROM ac)
    SELECT {FI}, c0 AS coef, {r('rad * sa * sin(9 * pi() * turn)', 'value')} FROM s, w
    UNION ALL SELECT {FI}, c0 + 1, {r('rad * (sc + sa * cos(9 * pi() * turn))', 'value')} FROM s, w""".replace("c0 AS coef", "c0::BIGINT AS coef").replace("c0 + 1,", "c0::BIGINT + 1,"))
def f13(spark, sf):
    return rounded(sp.tonnetz(emb(spark, sf), **P))


@query("f14_band_energy_ratio", "samp_emb", f"""{stft_sql()}
    SELECT {FI}, {r('sum(a * a) FILTER (WHERE k < 3) / sum(a * a) FILTER (WHERE k >= 3)', 'value')} FROM sp {G}""")
def f14(spark, sf):
    return rounded(sp.band_energy_ratio(emb(spark, sf), 12.0, **P))


@query("f15_welch_psd", "samp_emb", f"""
    seg AS (SELECT {KEYS}, f, n - f * 8 AS j, x - avg(x) OVER (PARTITION BY {KEYS}, f) AS x FROM samp_emb, range(7) t(f) WHERE n >= f * 8 AND n < f * 8 + 16),
    w AS (SELECT *, x * (0.5 - 0.5 * cos(2 * pi() * j / 16)) AS v FROM seg),
    p AS (SELECT {KEYS}, f, k, (pow(sum(v * cos(2 * pi() * ((k * j) % 16) / 16)), 2) + pow(sum(v * sin(2 * pi() * ((k * j) % 16) / 16)), 2))
        / (64 * (SELECT sum(pow(0.5 - 0.5 * cos(2 * pi() * i / 16), 2)) FROM range(16) u(i))) * CASE WHEN k IN (0, 8) THEN 1 ELSE 2 END AS p
        FROM w, range(9) t(k) GROUP BY {KEYS}, f, k)
    SELECT {KEYS}, k AS bin, {r('(k * 4.0)::DOUBLE', 'hz', 8)}, {r('avg(p)', 'psd', 8)} FROM p GROUP BY {KEYS}, k""")
def f15(spark, sf):
    return rounded(sp.welch_psd(emb(spark, sf), 16), 8)


@query("f16_band_stats", "samp_emb", f"""{AM}, bd AS (SELECT {KEYS}, bin AS n, ampl AS x FROM am WHERE bin BETWEEN 5 AND 25),
    {descriptive_ctes('bd', KEYS)} SELECT {KEYS}, {', '.join(r(f'"{m}"', f'{m}_5_25Hz') for m in DESCRIPTIVE)} FROM desc_t""")
def f16(spark, sf):
    return rounded(sp.band_stats(emb(spark, sf), 5, 25))


@query("f17_fft_mean", "sig_emb", f"SELECT {KEYS}, {r('samples[1]', 'fft_real_mean', 6)}, 0.0::DOUBLE AS fft_imag_mean FROM sig_emb")
def f17(spark, sf):
    return rounded(sp.fft_mean(emb(spark, sf)), 6)


@query("f18_spectrum_overlay", "samp_ev", f"""{whole_dft('samp_ev', 16)}
    SELECT f.audio_id, f.real_or_fake, f.bin, {r('f.hz', 'hz', 7)}, {r('f.ampl', 'ampl', 7)}, {r('g.ampl', 'real_ampl', 7)}
    FROM am f LEFT JOIN am g ON f.audio_id = g.audio_id AND f.bin = g.bin AND g.real_or_fake = 'R' WHERE f.real_or_fake <> 'R'""")
def f18(spark, sf):
    return rounded(sp.spectrum_overlay(fx.sig_ev(spark, sf)), 7)


@query("h05_coefficient_stats", "samp_emb", f"""{stft_sql()},
    {deviations('sp', 'audio_id, k', 'a')}, s AS (SELECT audio_id, k, {summary_select('a')} FROM dev GROUP BY audio_id, k)
    SELECT audio_id, """ + ", ".join(f'max(CASE WHEN k = {c - 1} THEN "{m}" END) AS "bin_{c}_{m}"' for c in range(1, 10) for m in MEASURES)
       + " FROM s GROUP BY audio_id")
def h05(spark, sf):
    from ..functions import dsp

    rows = sp._matrix_rows(emb(spark, sf), dsp.magnitudes_of("samples", 16, 8), "_c", "value")
    return rounded(st.coefficient_stats(rows.select("audio_id", (F.col("_c") + 1).alias("coef"), "value"), "bin", n_coefs=9))
