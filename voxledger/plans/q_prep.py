"""P: preprocessing and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import prep, relational as rel
from . import fixtures as fx
from .q_stats import r
from .registry import query, rounded

TRAIN = "tr AS (SELECT * FROM feat_line WHERE NOT (('0x' || md5(audio_id || '|42')[1:8])::BIGINT / 4294967296.0 < 0.2))"


def names(spark, cols: list[str], order: list[str]) -> DataFrame:
    """A short list of column names as rows, with their place in the schema."""
    return spark.createDataFrame([(order.index(c), c) for c in cols], "pos bigint, feature string")


def _split(spark, sf):
    f = rel.hash_split(fx.feat_line(spark, sf), 0.2, 42)
    return f.where(~F.col("is_test")).drop("is_test"), f.where("is_test").drop("is_test")


@query("p01_impute_mean", "feat_line", f"""{TRAIN}, m AS (SELECT avg(miss) AS mm FROM tr)
    SELECT audio_id, {r('coalesce(miss, mm)', 'miss')}, qty FROM feat_line, m WHERE audio_id NOT IN (SELECT audio_id FROM tr)""")
def p01(spark, sf):
    train, test = _split(spark, sf)
    (filled,) = prep.impute_mean(train, ["qty", "miss"], test)
    return rounded(filled.select("audio_id", "miss", "qty"))


@query("p02_impute_median", "feat_line", f"""
    m AS (SELECT quantile_cont(tax, 0.5) AS mt FROM feat_line WHERE disc <> 0.03)
    SELECT audio_id, {r('CASE WHEN disc = 0.03 THEN mt ELSE tax END', 'tax')}, {r('qty', 'qty')} FROM feat_line, m""")
def p02(spark, sf):
    f = fx.feat_line(spark, sf).select(
        "audio_id", F.when(F.col("disc") == 0.03, "None").otherwise(F.col("tax").cast("string")).alias("tax"), "qty")
    return rounded(prep.impute_median(f, ["tax", "qty"]))


@query("p03_standardize", "feat_line", f"""
    m AS (SELECT avg(qty) AS a, stddev_pop(qty) AS b, avg(price) AS c, stddev_pop(price) AS e FROM feat_line)
    SELECT audio_id, {r('(qty - a) / b', 'qty')}, {r('(price - c) / e', 'price')}, 0.0::DOUBLE AS const FROM feat_line, m""")
def p03(spark, sf):
    return rounded(prep.standardize(fx.feat_line(spark, sf), ["qty", "price", "const"]).select("audio_id", "qty", "price", "const"))


LONG_ALL = f"lg AS (SELECT * FROM (UNPIVOT feat_line ON {', '.join(fx.FEATURES)} INTO NAME feature VALUE value))"
POS = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(fx.FEATURES)) + " END::BIGINT"


@query("p04_constant_columns", "feat_line", f"""{LONG_ALL}
    SELECT {POS} AS pos, feature FROM lg GROUP BY feature HAVING count(DISTINCT value) = 1""")
def p04(spark, sf):
    return names(spark, prep.constant_columns(fx.feat_line(spark, sf), fx.FEATURES), fx.FEATURES)


QUASI = "qc AS (SELECT feature, max(n) / sum(n) AS share FROM (SELECT feature, value, count(*) AS n FROM lg GROUP BY 1, 2) GROUP BY 1)"


@query("p05_quasi_constant_columns", "feat_line", f"{LONG_ALL}, {QUASI} SELECT {POS} AS pos, feature FROM qc WHERE share > 0.99")
def p05(spark, sf):
    return names(spark, prep.quasi_constant_columns(fx.feat_line(spark, sf), fx.FEATURES), fx.FEATURES)


def same_sql(cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{b}' AS feature FROM feat_line HAVING count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) = 0"
        for i, a in enumerate(cols) for b in cols[i + 1:])


@query("p06_duplicate_columns", "feat_line", f"d AS ({same_sql(fx.FEATURES)}) SELECT DISTINCT {POS} AS pos, feature FROM d")
def p06(spark, sf):
    return names(spark, prep.duplicate_columns(fx.feat_line(spark, sf), fx.FEATURES), fx.FEATURES)


def high_corr_sql(cols: list[str], limit: float = 0.9) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS fa, '{b}' AS feature FROM feat_line WHERE {a} IS NOT NULL AND {b} IS NOT NULL HAVING abs(corr({a}, {b})) > {limit}"
        for i, a in enumerate(cols) for b in cols[i + 1:])


VARIED = [c for c in fx.FEATURES if c != "const"]


@query("p07_correlated_columns", "feat_line", f"c AS ({high_corr_sql(VARIED)}) SELECT DISTINCT {POS} AS pos, feature FROM c")
def p07(spark, sf):
    return names(spark, prep.correlated_columns(fx.feat_line(spark, sf), VARIED), fx.FEATURES)


@query("p08_correlated_greedy", "feat_line", f"""c AS ({high_corr_sql(VARIED, 0.6)}),
    v AS (SELECT unnest({VARIED}) AS feature) SELECT {POS} AS pos, feature FROM v WHERE feature NOT IN (SELECT fa FROM c)""")
def p08(spark, sf):
    return names(spark, prep.correlated_greedy(fx.feat_line(spark, sf), VARIED), fx.FEATURES)


@query("p09_select_features", "feat_line", f"""{LONG_ALL}, {QUASI},
    d AS ({same_sql([c for c in VARIED if c != 'quasi'])}), c AS ({high_corr_sql([c for c in VARIED if c != 'quasi'])}),
    keep1 AS (SELECT feature FROM qc WHERE share <= 0.99 EXCEPT SELECT feature FROM d)
    SELECT {POS} AS pos, feature FROM keep1 WHERE feature NOT IN
    (SELECT feature FROM c WHERE fa IN (SELECT feature FROM keep1) AND feature IN (SELECT feature FROM keep1))""")
def p09(spark, sf):
    return names(spark, prep.select_features(fx.feat_line(spark, sf), fx.FEATURES), fx.FEATURES)


@query("p12_prepare", "feat_line", f"""{TRAIN},
    f AS (SELECT qty, price, coalesce(miss, (SELECT avg(miss) FROM tr)) AS miss FROM tr),
    m AS (SELECT avg(qty) AS a, stddev_pop(qty) AS b, avg(price) AS c, stddev_pop(price) AS e, avg(miss) AS g, stddev_pop(miss) AS h FROM f)
    SELECT audio_id, real_or_fake, {r('(price - c) / e', 'price')}, {r('(coalesce(miss, g) - g) / h', 'miss')}, {r('(qty - a) / b', 'qty')},
    (real_or_fake <> 'R')::BIGINT AS target FROM feat_line, m WHERE audio_id NOT IN (SELECT audio_id FROM tr)""")
def p12(spark, sf):
    train, test = _split(spark, sf)
    state = prep.fit_preparation(train, ["qty", "price", "miss"])
    return rounded(prep.prepare(test, state, ["price", "miss", "qty"]))
