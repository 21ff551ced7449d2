"""D: drift, run table, promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as dr, runs as rn
from ..sources.recordings import batch_number
from . import fixtures as fx
from .q_evaluate import div0
from .q_stats import r
from .registry import query, rounded

KS = """g AS (SELECT feature, value, count(*) FILTER (WHERE side = 'train') AS a, count(*) FILTER (WHERE side = 'new') AS b FROM drift GROUP BY 1, 2),
    c AS (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS ta, sum(b) OVER (PARTITION BY feature) AS tb
        FROM g WINDOW w AS (PARTITION BY feature ORDER BY value)),
    k AS (SELECT feature, ta, tb, max(abs(ca / ta - cb / tb)) AS d FROM c GROUP BY 1, 2, 3),
    kp AS (SELECT feature, d, CASE WHEN d * d * ta * tb / (ta + tb) < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101),
        lambda i: CASE WHEN i % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * i * i * (d * d * ta * tb / (ta + tb))))))) END::DOUBLE AS p FROM k)"""


@query("d01_ks_drift", "drift", f"{KS} SELECT feature, {r('d', 'ks_statistic')}, {r('p', 'p_value')}, p < 0.03 AS drifted FROM kp")
def d01(spark, sf):
    return rounded(dr.ks_drift_long(fx.drift(spark, sf)))


@query("d02_drift_summary", "drift", f"""{KS}
    SELECT 6::BIGINT AS batch, 'drift' AS status, feature, {r('d', 'ks_statistic')}, {r('p', 'p_value')} FROM kp WHERE p < 0.03
    UNION ALL SELECT 7::BIGINT, 'no drift', NULL, NULL, NULL FROM (SELECT count(*) AS c FROM kp WHERE p < 0.03 AND feature <> 'error_mean') WHERE c = 0""")
def d02(spark, sf):
    report = dr.ks_drift_long(fx.drift(spark, sf))
    n = spark.range(1).select(batch_number(F.lit("new/test_iteration_7.csv"))).first()[0]
    return rounded(dr.drift_summary(report, n).union(dr.drift_summary(report.where("feature <> 'error_mean'"), n + 1)))


@query("d03_upsert_run", "runs", """
    lg AS (SELECT *, md5(run_name)[1:12] AS run_id FROM runs WHERE version <= 4),
    e AS (SELECT run_name, ts, round(auc, 6) AS auc, version FROM runs WHERE version >= 4),
    f AS (SELECT run_name, min(ts) AS t0 FROM e GROUP BY 1)
    SELECT e.run_name, e.ts, e.auc, e.version::BIGINT AS version, coalesce(k.run_id, md5(e.run_name || '|' || strftime(t0, '%Y-%m-%d %H:%M:%S'))[1:12]) AS run_id,
    k.run_id IS NOT NULL AS resumed FROM e JOIN f USING (run_name) LEFT JOIN (SELECT DISTINCT run_name, run_id FROM lg) k USING (run_name)""")
def d03(spark, sf):
    runs = fx.runs(spark, sf)
    log = runs.where("version <= 4").withColumn("run_id", F.substring(F.md5("run_name"), 1, 12))
    entries = runs.where("version >= 4").select("run_name", "ts", "auc", "version")
    return rounded(rn.upsert_run(log, entries), 6)


@query("d04_has_staged", "runs", "SELECT bool_or(model IN ('1-URGENT', '5-LOW') AND stage = 'Staging') AS has_staged FROM runs")
def d04(spark, sf):
    return rn.has_staged(fx.runs(spark, sf), ["1-URGENT", "5-LOW"])


PROMOTE = """n AS (SELECT model, max(version) AS nv, bool_or(stage <> 'None') AS so FROM runs GROUP BY 1),
    j AS (SELECT r.*, nv, so, max(auc) FILTER (WHERE version <> nv) OVER (PARTITION BY model) AS best, max(auc) FILTER (WHERE version = nv) OVER (PARTITION BY model) AS mine
        FROM runs r JOIN n USING (model)),
    st AS (SELECT model, version, auc, CASE WHEN version = nv AND (NOT so OR mine >= best) THEN 'Staging' ELSE stage END AS stage FROM j)"""


@query("d05_promote_to_staging", "runs", f"{PROMOTE} SELECT model, version::BIGINT AS version, round(auc, 6) AS auc, stage FROM st")
def d05(spark, sf):
    return rounded(rn.promote_to_staging(fx.runs(spark, sf)).select("model", "version", "auc", "stage"), 6)


@query("d06_promote_to_production", "runs", f"""{PROMOTE},
    s AS (SELECT model, max(version) AS version, arg_max(auc, version) AS m FROM st WHERE stage = 'Staging' GROUP BY 1),
    w AS (SELECT model, version FROM s ORDER BY m DESC, model LIMIT 1)
    SELECT st.model, st.version::BIGINT AS version, round(auc, 6) AS auc, CASE WHEN w.model IS NOT NULL THEN 'Production' ELSE stage END AS stage
    FROM st LEFT JOIN w ON st.model = w.model AND st.version = w.version""")
def d06(spark, sf):
    staged = rn.promote_to_staging(fx.runs(spark, sf))
    return rounded(rn.promote_to_production(staged).select("model", "version", "auc", "stage"), 6)


@query("d07_compare_runs", "runs", f"""
    c AS (SELECT model AS metric, max(auc) FILTER (WHERE version = 8) AS cur, max(auc) FILTER (WHERE version = 7 AND model <> '5-LOW') AS prev FROM runs WHERE version IN (7, 8) GROUP BY 1)
    SELECT metric, {r('cur', 'current')}, {r('prev', 'previous')}, {r('cur - prev', 'change')} FROM c""")
def d07(spark, sf):
    v = fx.runs(spark, sf)
    cur = v.where("version = 8").select(F.col("model").alias("metric"), F.col("auc").alias("value"))
    prev = v.where("version = 7 AND model <> '5-LOW'").select(F.col("model").alias("metric"), F.col("auc").alias("value"))
    return rounded(rn.compare_runs(cur, prev))


@query("d08_evaluate_staged", "score runs", f"""
    sm AS (SELECT model, row_number() OVER (ORDER BY model) AS k FROM runs WHERE stage = 'Staging'),
    s AS (SELECT model, y, round(pow(p, 1.0 / k), 9) AS p, (round(pow(p, 1.0 / k), 9) > 0.5)::INT AS pred FROM score, sm),
    c AS (SELECT model, count(*) FILTER (WHERE y = 1 AND pred = 1)::DOUBLE AS tp, count(*) FILTER (WHERE pred = 1) AS pp,
        count(*) FILTER (WHERE y = 1) AS ap, count(*) FILTER (WHERE y = pred)::DOUBLE AS ok, count(*) AS n FROM s GROUP BY 1),
    m AS (SELECT *, {div0('tp', 'pp')} AS pr, {div0('tp', 'ap')} AS rc FROM c),
    rk AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY p) + (count(*) OVER (PARTITION BY model, p) - 1) / 2 AS rk FROM s),
    a AS (SELECT model, (sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS auc FROM rk GROUP BY 1)
    SELECT model, {r('ok / n', 'previous_version_accuracy')}, {r('pr', 'previous_version_precision')}, {r('rc', 'previous_version_recall')},
    {r(div0('2 * pr * rc', 'pr + rc'), 'previous_version_f1_score')}, {r('auc', 'previous_version_roc_auc_score')} FROM m JOIN a USING (model)""")
def d08(spark, sf):
    # one row per staged model; all models score the rows in one scan
    staged = fx.runs(spark, sf).where("stage = 'Staging'").agg(F.array_sort(F.collect_set("model"))).first()[0]
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(1.0 / k).alias("power")) for k, m in enumerate(staged, start=1)])
    s = fx.score(spark, sf).select("y", "p", F.explode(models).alias("m"))
    scored = s.select("m.model", "y", F.round(F.pow("p", F.col("m.power")), 9).alias("p")).withColumn("pred", (F.col("p") > 0.5).cast("int"))
    return rounded(rn.evaluate_staged(scored))


@query("d09_latest_run", "runs", """
    SELECT model, version::BIGINT AS version, run_name, round(auc, 6) AS auc, ts FROM runs WHERE run_name = '2-HIGH_training_1' ORDER BY ts DESC, runs.version DESC LIMIT 1""")
def d09(spark, sf):
    return rounded(rn.latest_run(fx.runs(spark, sf), "2-HIGH_training_1").select("model", "version", "run_name", "auc", "ts"), 6)


@query("d10_ks_drift_wide", "feat_line", """drift AS (SELECT side, feature, value FROM (SELECT
    CASE WHEN md5(audio_id)[1:1] < '8' THEN 'train' ELSE 'new' END AS side, qty AS qty_mean, disc AS disc_mean,
    CASE WHEN md5(audio_id)[1:1] < '8' THEN price ELSE price * 1.1 END AS price_mean FROM feat_line)
    UNPIVOT (value FOR feature IN (qty_mean, disc_mean, price_mean))), """ + f"""{KS}
    SELECT feature, {r('d', 'ks_statistic')}, {r('p', 'p_value')}, p < 0.03 AS drifted FROM kp""")
def d10(spark, sf):
    """Both sides go through the preparation fitted on the training side; only columns named mean are compared."""
    from ..operators import prep

    is_train = F.substring(F.md5("audio_id"), 1, 1) < "8"
    f = fx.feat_line(spark, sf).select(
        "audio_id", "real_or_fake", F.col("qty").alias("qty_mean"), F.col("disc").alias("disc_mean"),
        F.when(is_train, F.col("price")).otherwise(F.col("price") * 1.1).alias("price_mean"), F.col("tax").alias("tax_std"))
    cols = ["qty_mean", "disc_mean", "price_mean", "tax_std"]
    train, new = f.where(is_train), f.where(~is_train)
    state = prep.fit_preparation(train, cols)
    return rounded(dr.ks_drift(prep.prepare(train, state, cols), prep.prepare(new, state, cols)))
