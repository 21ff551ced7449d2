"""E: evaluation; M14 and M15 score rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from . import fixtures as fx
from .q_stats import r
from .registry import query, rounded


def div0(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif({b}, 0), 0)"


BIN = """c AS (SELECT count(*) FILTER (WHERE y = 1 AND pred = 1)::DOUBLE AS tp, count(*) FILTER (WHERE pred = 1) AS pp,
    count(*) FILTER (WHERE y = 1) AS ap, count(*) FILTER (WHERE y = pred)::DOUBLE AS ok, count(*) AS n FROM score)"""


@query("e01_binary_metrics", "score", f"""{BIN}, m AS (SELECT *, {div0('tp', 'pp')} AS p, {div0('tp', 'ap')} AS rc FROM c)
    SELECT {r('ok / n', 'accuracy')}, {r('p', 'precision')}, {r('rc', 'recall')}, {r(div0('2 * p * rc', 'p + rc'), 'f1')} FROM m""")
def e01(spark, sf):
    return rounded(ev.binary_metrics(fx.score(spark, sf)))


REPORT = f"""l AS (SELECT DISTINCT y AS label FROM score_k UNION SELECT DISTINCT pred FROM score_k),
    c AS (SELECT label, count(*) FILTER (WHERE y = label AND pred = label)::DOUBLE AS tp, count(*) FILTER (WHERE pred = label) AS pp,
    count(*) FILTER (WHERE y = label) AS support FROM l, score_k GROUP BY 1),
    m AS (SELECT label, {div0('tp', 'pp')} AS p, {div0('tp', 'support')} AS rc, support FROM c),
    rep AS (SELECT *, {div0('2 * p * rc', 'p + rc')} AS f1 FROM m)"""


@query("e02_averaged_metrics", "score_k", f"""{REPORT} SELECT {r('avg(p)', 'macro_precision')}, {r('avg(rc)', 'macro_recall')}, {r('avg(f1)', 'macro_f1')},
    {r('sum(p * support) / sum(support)', 'weighted_precision')}, {r('sum(rc * support) / sum(support)', 'weighted_recall')},
    {r('sum(f1 * support) / sum(support)', 'weighted_f1')}, {r('(SELECT count(*) FILTER (WHERE y = pred) / count(*) FROM score_k)', 'accuracy')} FROM rep""")
def e02(spark, sf):
    return rounded(ev.averaged_metrics(fx.score_k(spark, sf)))


@query("e03_class_report", "score_k", f"""{REPORT} SELECT label::BIGINT AS label, {r('p', 'precision')}, {r('rc', 'recall')}, {r('f1', 'f1')}, support FROM rep""")
def e03(spark, sf):
    return rounded(ev.class_report(fx.score_k(spark, sf)))


@query("e04_confusion_matrix", "score_k", """
    s AS (SELECT y, CASE WHEN pred = 2 THEN 1 ELSE pred END AS pred FROM score_k),
    l AS (SELECT DISTINCT y AS k FROM s UNION SELECT DISTINCT pred FROM s)
    SELECT a.k::BIGINT AS y, b.k::BIGINT AS pred, count(s.y) AS n FROM l a CROSS JOIN l b LEFT JOIN s ON s.y = a.k AND s.pred = b.k GROUP BY 1, 2""")
def e04(spark, sf):
    s = fx.score_k(spark, sf).withColumn("pred", F.when(F.col("pred") == 2, 1).otherwise(F.col("pred")))
    return rounded(ev.confusion_matrix(s))


AUC = """rk AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rk FROM score)"""


@query("e05_roc_auc", "score", f"""{AUC} SELECT {r('''(sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2)
    / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0))''', 'roc_auc')} FROM rk""")
def e05(spark, sf):
    return rounded(ev.roc_auc(fx.score(spark, sf)))


@query("e06_roc_points", "score", f"""
    g AS (SELECT p, count(*) FILTER (WHERE y = 1) AS a, count(*) FILTER (WHERE y = 0) AS b FROM score GROUP BY 1),
    c AS (SELECT p, sum(a) OVER (ORDER BY p DESC) AS tp, sum(b) OVER (ORDER BY p DESC) AS fp, sum(a) OVER () AS ap, sum(b) OVER () AS an FROM g)
    SELECT {r('fp / an', 'fpr')}, {r('tp / ap', 'tpr')}, p AS threshold FROM c UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, 'inf'::DOUBLE""")
def e06(spark, sf):
    return rounded(ev.roc_points(fx.score(spark, sf)), keep=("threshold",))


@query("e07_one_vs_rest_auc", "score_k", f"""
    lg AS (SELECT k::VARCHAR AS label, (y = k)::INT AS y, CASE k WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END AS p FROM score_k, range(4) t(k)),
    rk AS (SELECT label, y, rank() OVER (PARTITION BY label ORDER BY p) + (count(*) OVER (PARTITION BY label, p) - 1) / 2 AS rk FROM lg),
    a AS (SELECT label, sum(y) AS n1, (sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS auc FROM rk GROUP BY 1)
    SELECT label, {r('auc', 'roc_auc')} FROM a UNION ALL SELECT 'macro', {r('avg(auc)', 'roc_auc')} FROM a
    UNION ALL SELECT 'weighted', {r('sum(auc * n1) / sum(n1)', 'roc_auc')} FROM a""")
def e07(spark, sf):
    return rounded(ev.one_vs_rest_auc(fx.score_k(spark, sf), [0, 1, 2, 3]))


@query("e08_calibration_curve", "score", f"""
    e AS (SELECT min(p) AS lo, max(p) AS hi FROM score),
    b AS (SELECT k, lo + (hi - lo) / 9 * k AS a, CASE WHEN k = 8 THEN hi ELSE lo + (hi - lo) / 9 * (k + 1) END AS z FROM e, range(9) t(k))
    SELECT k::BIGINT AS bin, {r('(a + z) / 2', 'midpoint')}, {r('avg(y)', 'share')}, count(y) AS n FROM b LEFT JOIN score ON p > a AND p <= z GROUP BY k, a, z""")
def e08(spark, sf):
    return rounded(ev.calibration_curve(fx.score(spark, sf)))


@query("e09_probability_histograms", "score", f"""
    o AS (SELECT CASE WHEN (p >= 0.5)::INT = y THEN 'right' ELSE 'wrong' END AS outcome, p FROM score),
    e AS (SELECT outcome, min(p) AS lo, max(p) AS hi, count(*) AS n FROM o GROUP BY 1),
    b AS (SELECT outcome, least(floor((p - lo) / ((hi - lo) / 20)), 19)::BIGINT AS bin, count(*) AS c FROM o JOIN e USING (outcome) GROUP BY 1, 2),
    g AS (SELECT *, unnest(range(20)) AS bin FROM e)
    SELECT outcome, bin, {r('lo + (hi - lo) / 20 * bin', 'lo')}, {r('lo + (hi - lo) / 20 * (bin + 1)', 'hi')},
    coalesce(c, 0)::BIGINT AS n, {r('coalesce(c, 0) / (n * (hi - lo) / 20)', 'density')} FROM g LEFT JOIN b USING (outcome, bin)""")
def e09(spark, sf):
    return rounded(ev.probability_histograms(fx.score(spark, sf)))


WEIGHTS = {f"e{i}": round(0.5 - i / 10, 2) for i in range(10)}


@query("e11_linear_shap", "feat_emb", "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in WEIGHTS) + " FROM feat_emb), "
       "s AS (SELECT " + ", ".join(f"avg(abs({w} * ({c} - m_{c}))) AS {c}" for c, w in WEIGHTS.items()) + " FROM feat_emb, m) "
       f"SELECT feature, {r('v', 'mean_abs_shap')} FROM (UNPIVOT s ON {', '.join(WEIGHTS)} INTO NAME feature VALUE v)")
def e11(spark, sf):
    return rounded(ev.shap_ranking(fx.feat_emb(spark, sf), WEIGHTS))


@query("m15_confidence_band", "score", f"""
    SELECT audio_id, p, CASE WHEN p > 0.5 THEN 'Real' ELSE 'Fake' END AS result, {r('greatest(p, 1 - p)', 'confidence_value')},
    CASE WHEN greatest(p, 1 - p) > 0.8 THEN 'High' WHEN greatest(p, 1 - p) < 0.3 THEN 'Low' ELSE 'Moderate' END AS confidence FROM score""")
def m15(spark, sf):
    return rounded(ev.confidence_band(fx.score(spark, sf).select("audio_id", "p")), keep=("p",))
