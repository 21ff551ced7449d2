"""H: statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.describe import DESCRIPTIVE
from ..operators import stats as st
from . import fixtures as fx
from .registry import NUDGE, query, rounded


def r(x: str, name: str, digits: int = 4) -> str:
    x = f"({x}) + {NUDGE}::DOUBLE" if digits <= 7 else x
    return f'round({x}, {digits}) + 0.0 AS "{name}"'


SKEW = "CASE WHEN min({x}) < max({x}) THEN sqrt(count(*)) * sum(d*d*d) / pow(sum(d*d), 1.5) END"
KURT = "CASE WHEN min({x}) < max({x}) THEN count(*) * sum(d*d*d*d) / pow(sum(d*d), 2) - 3 END"


def deviations(src: str, keys: str, x: str = "x") -> str:
    return f"dev AS (SELECT *, {x} - avg({x}) OVER (PARTITION BY {keys}) AS d FROM {src})"


def summary_select(x: str = "x", digits: int = 4) -> str:
    parts = {"mean": f"avg({x})", "std": f"stddev_pop({x})", "var": f"var_pop({x})", "min": f"min({x})", "max": f"max({x})",
             "range": f"max({x}) - min({x})", "25th_percentile": f"quantile_cont({x}, 0.25)",
             "50th_percentile": f"quantile_cont({x}, 0.5)", "75th_percentile": f"quantile_cont({x}, 0.75)",
             "skew": SKEW.format(x=x), "kurtosis": KURT.format(x=x)}
    return ", ".join(r(e, m, digits) for m, e in parts.items())


def peaks_ctes(src: str, keys: str) -> str:
    """Runs of equal neighbours, then runs above both neighbours."""
    return f"""pk_b AS (SELECT *, CASE WHEN x = lag(x) OVER (PARTITION BY {keys} ORDER BY n) THEN 0 ELSE 1 END AS s FROM {src}),
    pk_r AS (SELECT *, sum(s) OVER (PARTITION BY {keys} ORDER BY n) AS run FROM pk_b),
    pk_g AS (SELECT {keys}, run, any_value(x) AS h, min(n) AS lo, max(n) AS hi FROM pk_r GROUP BY {keys}, run),
    pk_l AS (SELECT *, lag(h) OVER (PARTITION BY {keys} ORDER BY run) AS p, lead(h) OVER (PARTITION BY {keys} ORDER BY run) AS q FROM pk_g),
    peaks AS (SELECT {keys}, (lo + hi) // 2 AS n, h FROM pk_l WHERE h > p AND h > q)"""


def descriptive_ctes(src: str, keys: str) -> str:
    """desc_t: the ten descriptive measures per key, unrounded."""
    return f"""{peaks_ctes(src, keys)}, {deviations(src, keys)},
    pk_m AS (SELECT {keys}, avg(h) AS ph FROM peaks GROUP BY {keys}),
    desc_t AS (SELECT {keys}, avg(x) AS mean, var_pop(x) AS variance, {SKEW.format(x='x')} AS skewness,
    {KURT.format(x='x')} AS kurtosis, quantile_cont(x, 0.1) AS "10th_percentile", quantile_cont(x, 0.25) AS "25th_percentile",
    quantile_cont(x, 0.5) AS "50th_percentile", quantile_cont(x, 0.75) AS "75th_percentile",
    quantile_cont(x, 0.9) AS "90th_percentile", coalesce(max(ph), 0) AS mean_peak_height
    FROM dev LEFT JOIN pk_m USING ({keys}) GROUP BY {keys})"""


KEYS = "audio_id, real_or_fake"


@query("h01_summary_stats", "samp_user", f"""{deviations('samp_user', KEYS)}
    SELECT {KEYS}, {summary_select()} FROM dev GROUP BY {KEYS}""")
def h01(spark, sf):
    return rounded(st.summary_stats(fx.sig_user(spark, sf), "samples"))


@query("h02_extended_stats", "samp_user", f"""{descriptive_ctes('samp_user', KEYS)},
    roll AS (SELECT {KEYS}, avg(m) AS rm, avg(s) AS rs FROM (SELECT {KEYS}, avg(x) OVER w AS m, stddev_samp(x) OVER w AS s, count(*) OVER w AS c
        FROM samp_user WINDOW w AS (PARTITION BY {KEYS} ORDER BY n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) WHERE c = 3 GROUP BY {KEYS}),
    ent AS (SELECT {KEYS}, -sum(c / t * ln(c / t)) AS e FROM (SELECT *, sum(c) OVER (PARTITION BY {KEYS}) AS t FROM
        (SELECT {KEYS}, x, count(*) AS c FROM samp_user GROUP BY {KEYS}, x)) GROUP BY {KEYS}),
    lagged AS (SELECT {KEYS}, x, lag(x) OVER (PARTITION BY {KEYS} ORDER BY n) AS y FROM samp_user),
    ac AS (SELECT {KEYS}, corr(x, y) AS a FROM lagged WHERE y IS NOT NULL GROUP BY {KEYS}),
    np AS (SELECT {KEYS}, count(*) AS k FROM peaks GROUP BY {KEYS}),
    base AS (SELECT {KEYS}, stddev_pop(x) AS sd, min(x) AS mn, max(x) AS mx, max(CASE WHEN n = 0 THEN x END) AS x0 FROM samp_user GROUP BY {KEYS})
    SELECT {KEYS}, {r('mean', 'mean')}, {r('sd', 'std_dev')}, {r('variance', 'variance')}, {r('mn', 'min')}, {r('mx', 'max')},
    {r('"50th_percentile"', 'median')}, {r('mx - mn', 'range')}, {r('skewness', 'skewness')}, {r('kurtosis', 'kurtosis')},
    {r('"10th_percentile"', 'quantile_10')}, {r('"25th_percentile"', 'quantile_25')}, {r('"50th_percentile"', 'quantile_50')},
    {r('"75th_percentile"', 'quantile_75')}, {r('"90th_percentile"', 'quantile_90')}, {r('rm', 'rolling_mean_3')}, {r('rs', 'rolling_std_3')},
    coalesce(k, 0)::DOUBLE AS num_peaks, {r('mean_peak_height', 'peak_heights')}, {r('e', 'entropy')}, {r('a', 'autocorrelation_lag1')},
    {r('x0', 'fft_real_mean')}, 0.0::DOUBLE AS fft_imag_mean
    FROM desc_t JOIN base USING ({KEYS}) LEFT JOIN roll USING ({KEYS}) LEFT JOIN ent USING ({KEYS}) LEFT JOIN ac USING ({KEYS}) LEFT JOIN np USING ({KEYS})""")
def h02(spark, sf):
    return rounded(st.extended_stats(fx.sig_user(spark, sf)))


@query("h03_descriptive_stats", "samp_user", f"""{descriptive_ctes('samp_user', KEYS)}
    SELECT {KEYS}, {', '.join(r(f'"{m}"', m) for m in DESCRIPTIVE)} FROM desc_t""")
def h03(spark, sf):
    return rounded(st.descriptive_stats(fx.sig_user(spark, sf)))


@query("h04_windowed_stats", "samp_user", f"""
    len AS (SELECT {KEYS}, count(*) // 10 AS w, greatest(count(*) // 10 // 2, 1) AS s, count(*) AS c FROM samp_user GROUP BY {KEYS}),
    starts AS (SELECT *, unnest(range(0, (c - w) // s + 1)) AS k FROM len WHERE w > 0),
    win AS (SELECT u.audio_id, u.real_or_fake, k, u.n, x FROM samp_user u JOIN starts USING ({KEYS}) WHERE u.n >= k * s AND u.n < k * s + w),
    {descriptive_ctes('win', KEYS + ', k')}
    SELECT {KEYS}, {', '.join(r(f'avg("{m}")', f'windowed_{m}_mean') for m in DESCRIPTIVE)} FROM desc_t GROUP BY {KEYS}""")
def h04(spark, sf):
    return rounded(st.windowed_stats(fx.sig_user(spark, sf)))


@query("h07_histogram", "score", f"""
    e AS (SELECT min(p) AS lo, max(p) AS hi, count(*) AS n FROM score),
    b AS (SELECT least(floor((p - lo) / ((hi - lo) / 20)), 19)::BIGINT AS bin, count(*) AS c FROM score, e GROUP BY 1)
    SELECT i::BIGINT AS bin, {r('lo + (hi - lo) / 20 * i', 'lo')}, {r('lo + (hi - lo) / 20 * (i + 1)', 'hi')},
    coalesce(c, 0)::BIGINT AS n, {r('coalesce(c, 0) / (n * (hi - lo) / 20)', 'density')}
    FROM e, range(20) g(i) LEFT JOIN b ON b.bin = g.i""")
def h07(spark, sf):
    return rounded(st.histogram(fx.score(spark, sf), "p", 20))


@query("h08_box_stats", "feat_line", f"""
    q AS (SELECT real_or_fake, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM feat_line GROUP BY 1)
    SELECT real_or_fake, {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')},
    {r('min(CASE WHEN price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN price END)', 'whisker_low')},
    {r('max(CASE WHEN price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN price END)', 'whisker_high')},
    count(*) FILTER (WHERE price NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
    FROM feat_line JOIN q USING (real_or_fake) GROUP BY real_or_fake, q1, median, q3""")
def h08(spark, sf):
    return rounded(st.box_stats(fx.feat_line(spark, sf), "price", "real_or_fake"))


COMPARED = ["qty", "price", "disc", "tax", "const", "quasi", "miss"]
LONG = f"feat_long AS (SELECT * FROM (UNPIVOT feat_line ON {', '.join(COMPARED)} INTO NAME feature VALUE value)), "
MOMENTS = LONG + """m0 AS (SELECT feature,
    count(*) FILTER (WHERE real_or_fake = 'R') AS n1, count(*) FILTER (WHERE real_or_fake <> 'R') AS n2,
    avg(value) FILTER (WHERE real_or_fake = 'R') AS m1, avg(value) FILTER (WHERE real_or_fake <> 'R') AS m2,
    var_samp(value) FILTER (WHERE real_or_fake = 'R') AS v1, var_samp(value) FILTER (WHERE real_or_fake <> 'R') AS v2,
    min(value) FILTER (WHERE real_or_fake = 'R') < max(value) FILTER (WHERE real_or_fake = 'R')
    AND min(value) FILTER (WHERE real_or_fake <> 'R') < max(value) FILTER (WHERE real_or_fake <> 'R') AS varied
    FROM feat_long GROUP BY 1), m AS (SELECT * FROM m0 WHERE varied AND n1 > 0 AND n2 > 0)"""
WELCH = "(m1 - m2) / sqrt(v1 / n1 + v2 / n2)"
WELCH_DF = "pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1))"
EFFECT = "(m1 - m2) / sqrt((v1 + v2) / 2)"
ANOVA = ("n1 * n2 * pow(m1 - m2, 2) / (n1 + n2) / (((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))")
RANKS = """rk AS (SELECT feature, real_or_fake, value, rank() OVER (PARTITION BY feature ORDER BY value)
    + (count(*) OVER (PARTITION BY feature, value) - 1) / 2 AS rk FROM feat_long),
    u AS (SELECT feature, sum(rk) FILTER (WHERE real_or_fake = 'R') - count(*) FILTER (WHERE real_or_fake = 'R')
    * (count(*) FILTER (WHERE real_or_fake = 'R') + 1) / 2 AS u_stat FROM rk GROUP BY 1)"""


def _long(spark, sf):
    return st.to_long(fx.feat_line(spark, sf), COMPARED)


@query("h09_welch_t", "feat_line", f"{MOMENTS} SELECT feature, {r(WELCH, 't_stat')}, {r(WELCH_DF, 'df')} FROM m")
def h09(spark, sf):
    return rounded(st.welch_t(_long(spark, sf)).drop("t_p_val"))


@query("h10_auto_t", "feat_line", f"""{MOMENTS},
    side AS (SELECT feature, real_or_fake = 'R' AS rr, value FROM feat_long),
    med AS (SELECT feature, rr, quantile_cont(value, 0.5) AS md FROM side GROUP BY 1, 2),
    z AS (SELECT feature, rr, abs(value - md) AS z FROM side JOIN med USING (feature, rr)),
    lm AS (SELECT feature, avg(z) FILTER (WHERE rr) AS z1, avg(z) FILTER (WHERE NOT rr) AS z2,
        var_samp(z) FILTER (WHERE rr) AS y1, var_samp(z) FILTER (WHERE NOT rr) AS y2 FROM z GROUP BY 1),
    j AS (SELECT *, n1 * n2 * pow(z1 - z2, 2) / (n1 + n2) / (((n1 - 1) * y1 + (n2 - 1) * y2) / (n1 + n2 - 2)) AS w FROM m JOIN lm USING (feature))
    SELECT feature, {r('w', 'levene_stat')}, {r('(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2))', 'pooled_t')},
    {r(WELCH, 'welch_t')} FROM j""")
def h10(spark, sf):
    long = _long(spark, sf)
    both = st.comparable(st.class_moments(long)).select(
        "feature", st.pooled_columns()[0].alias("pooled_t"), st.welch_columns()[0].alias("welch_t"))
    return rounded(st.auto_t(long).select("feature", "levene_stat").join(both, "feature"))


@query("h11_mann_whitney_u", "feat_line", f"{LONG} {RANKS} SELECT feature, {r('u_stat', 'u_stat')} FROM u")
def h11(spark, sf):
    return rounded(st.mann_whitney_u(_long(spark, sf)).drop("u_p_val"))


@query("h12_effect_size", "feat_line", f"{MOMENTS} SELECT feature, {r(EFFECT, 'effect_size')} FROM m")
def h12(spark, sf):
    return rounded(st.effect_size(_long(spark, sf)))


@query("h13_anova_f", "feat_line", f"{MOMENTS} SELECT feature, {r(ANOVA, 'f_stat')} FROM m")
def h13(spark, sf):
    return rounded(st.anova_f(_long(spark, sf)).select("feature", "f_stat"))


@query("h14_normality", "feat_line", f"""{LONG}
    s AS (SELECT feature, CASE WHEN real_or_fake = 'R' THEN 'R' ELSE 'F' END AS side, value AS x FROM feat_long),
    {deviations('s', 'feature, side')},
    g AS (SELECT feature, side, count(*) AS n, {SKEW.format(x='x')} AS sk, {KURT.format(x='x')} AS ku FROM dev GROUP BY 1, 2)
    SELECT feature, side, {r('n / 6 * (sk * sk + ku * ku / 4)', 'jb_stat', 3)}, {r('exp(-(n / 6 * (sk * sk + ku * ku / 4)) / 2)', 'jb_p_val')} FROM g""")
def h14(spark, sf):
    return rounded(st.normality(_long(spark, sf)).withColumn("jb_stat", F.round("jb_stat", 3)), keep=("jb_stat",))


@query("h15_rank_features", "feat_line", f"""{MOMENTS}, {RANKS},
    k AS (SELECT feature, -abs({WELCH}) AS a, -abs(u_stat / (n1 * n2) - 0.5) AS b FROM m JOIN u USING (feature)),
    rr AS (SELECT feature, row_number() OVER (ORDER BY a, feature) AS rank_1, row_number() OVER (ORDER BY b, feature) AS rank_2 FROM k)
    SELECT feature, rank_1, rank_2, rank_1 + rank_2 AS rank_sum FROM rr ORDER BY 4, 1 LIMIT 4""")
def h15(spark, sf):
    long = _long(spark, sf)
    m = st.comparable(st.class_moments(long)).select(
        "feature", (F.col("n_r") * F.col("n_f")).alias("nn"), (-F.abs(st.welch_columns()[0])).alias("a"))
    tests = m.join(st.mann_whitney_u(long), "feature").withColumn("b", -F.abs(F.col("u_stat") / F.col("nn") - 0.5))
    return rounded(st.rank_features(tests, 4, ("a", "b")))


CORR = ["qty", "price", "disc", "tax", "quasi", "dup_qty", "corr_price", "miss"]


def corr_sql(cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})', 'r')} FROM feat_line WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for i, a in enumerate(cols) for b in cols[i + 1:])


@query("h16_correlation_matrix", "feat_line", corr_sql(CORR))
def h16(spark, sf):
    return rounded(st.correlation_matrix(fx.feat_line(spark, sf), CORR).select("feature_a", "feature_b", "r"))


@query("h17_compare_classes", "feat_line", f"""{MOMENTS}, {RANKS}
    SELECT feature, {r(WELCH, 't_stat')}, {r('u_stat', 'u_stat')}, {r(EFFECT, 'effect_size')}, {r(ANOVA, 'f_stat')} FROM m JOIN u USING (feature)""")
def h17(spark, sf):
    return rounded(st.compare_classes(fx.feat_line(spark, sf), COMPARED).select(
        "feature", "t_stat", "u_stat", "effect_size", "f_stat"))


@query("h08_box_stats_array", "samp_emb", f"""
    q AS (SELECT real_or_fake, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM samp_emb GROUP BY 1)
    SELECT real_or_fake, {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')},
    {r('min(CASE WHEN x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN x END)', 'whisker_low')},
    {r('max(CASE WHEN x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN x END)', 'whisker_high')},
    count(*) FILTER (WHERE x NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
    FROM samp_emb JOIN q USING (real_or_fake) GROUP BY real_or_fake, q1, median, q3""")
def h08_array(spark, sf):
    return rounded(st.box_stats(fx.sig_emb(spark, sf), "samples", "real_or_fake"))
