"""R: projections, filters, joins, sort, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as rel
from . import fixtures as fx
from .q_sources import MANIFEST_IDS, stored_signals
from .registry import query, rounded

KEY = ("audio_id", "real_or_fake")
SPLIT_HASH = "('0x' || md5(audio_id || '|42')[1:8])::BIGINT / 4294967296.0"


@query("r01_binary_target", "sig_ev", "SELECT audio_id, real_or_fake, CASE WHEN real_or_fake = 'R' THEN 0 ELSE 1 END::BIGINT AS target FROM sig_ev")
def r01(spark, sf):
    return rounded(rel.binary_target(fx.sig_ev(spark, sf).select(*KEY)))


@query("r02_class_index", "sig_ev", """
    l AS (SELECT DISTINCT real_or_fake FROM sig_ev),
    i AS (SELECT real_or_fake, row_number() OVER (ORDER BY real_or_fake <> 'R', real_or_fake) - 1 AS class_index,
    row_number() OVER (ORDER BY real_or_fake) - 1 AS alphabetical FROM l)
    SELECT audio_id, real_or_fake, class_index, alphabetical FROM sig_ev JOIN i USING (real_or_fake)""")
def r02(spark, sf):
    s = fx.sig_ev(spark, sf).select(*KEY)
    a = rel.class_index(s).withColumnRenamed("class_index", "c")
    b = rel.class_index(a, real_first=False).withColumnRenamed("class_index", "alphabetical")
    return rounded(b.withColumnRenamed("c", "class_index"))


@query("r03_collapse_labels", "sig_ev", """
    SELECT audio_id, CASE WHEN real_or_fake LIKE 'F%' THEN 'F' ELSE real_or_fake END AS real_or_fake FROM sig_ev""")
def r03(spark, sf):
    return rel.collapse_labels(fx.sig_ev(spark, sf).select(*KEY))


@query("r04_real_vs", "sig_ev", "SELECT audio_id, real_or_fake FROM sig_ev WHERE real_or_fake IN ('R', 'F02')")
def r04q(spark, sf):
    return rel.real_vs(fx.sig_ev(spark, sf).select(*KEY), "F02")


@query("r05_feature_columns", "feat_line", "SELECT qty, price, disc, tax, const, quasi, dup_qty, corr_price, miss FROM feat_line")
def r05(spark, sf):
    f = fx.feat_line(spark, sf)
    return f.select(*rel.feature_columns(f))


@query("r06_drop_missing", "feat_line", """
    SELECT 'rows' AS axis, count(*) AS n, sum(qty) AS total FROM feat_line WHERE miss IS NOT NULL
    UNION ALL SELECT 'columns', count(*), sum(qty) FROM feat_line""")
def r06(spark, sf):
    f = fx.feat_line(spark, sf)
    rows, cols = rel.drop_missing_rows(f), rel.drop_missing_columns(f)
    assert "miss" not in cols.columns
    return (rows.agg(F.lit("rows").alias("axis"), F.count(F.lit(1)).alias("n"), F.sum("qty").alias("total"))
            .union(cols.agg(F.lit("columns"), F.count(F.lit(1)), F.sum("qty"))))


@query("r07_filter_rows", "feat_line", """
    SELECT audio_id, qty, disc FROM feat_line WHERE audio_id NOT LIKE '1%' AND disc <> 0 AND lower(real_or_fake) LIKE '%f0%'""")
def r07(spark, sf):
    return rel.filter_rows(fx.feat_line(spark, sf), not_prefix="1", nonzero="disc",
                           contains=("real_or_fake", "F0")).select("audio_id", "qty", "disc")


@query("r08_pair_real_fake", "manifest", MANIFEST_IDS + """,
    f AS (SELECT path AS fake_path, 'train/' || own AS real_path FROM ids WHERE name LIKE 'F0%'),
    r AS (SELECT path FROM manifest WHERE path NOT LIKE 'train/F0%' AND doc_id % 21 <> 0)
    SELECT fake_path, CASE WHEN real_path IN (SELECT path FROM r) THEN real_path END AS real_path FROM f""")
def r08(spark, sf):
    m = fx.manifest(spark, sf)
    fake = F.col("path").startswith("train/F0")
    pairs, orphans = rel.pair_real_fake(m.where(fake | (F.pmod("doc_id", F.lit(21)) != 0)))
    return pairs.select("fake_path", "real_path").unionByName(orphans, allowMissingColumns=True)


@query("r09_pair_duration_diff", "sig_ev", """
    d AS (SELECT audio_id, real_or_fake, len(samples) / sampling_rate AS d FROM sig_ev)
    SELECT f.audio_id, f.real_or_fake, abs(r.d - f.d) AS duration_diff FROM d f JOIN d r ON f.audio_id = r.audio_id
    WHERE r.real_or_fake = 'R' AND f.real_or_fake <> 'R'""")
def r09(spark, sf):
    return rounded(rel.pair_duration_diff(fx.sig_ev(spark, sf)))


@query("r10_pair_completeness", "sig_ev manifest", MANIFEST_IDS + """,
    m AS (SELECT own AS audio_id, CASE WHEN name LIKE 'F0%' THEN 'F' ELSE 'R' END AS real_or_fake FROM ids)
    SELECT audio_id, count(*) FILTER (WHERE real_or_fake <> 'R') AS n_fake, count(*) AS n_rows FROM m GROUP BY 1
    HAVING bool_or(real_or_fake = 'R') AND count(*) FILTER (WHERE real_or_fake <> 'R') <> 6""")
def r10(spark, sf):
    from ..sources.recordings import base_name

    name = base_name(F.col("path"))
    fake = name.startswith("F0")
    m = fx.manifest(spark, sf).select(
        F.when(fake, F.substr(name, F.lit(5))).otherwise(name).alias("audio_id"),
        F.when(fake, "F").otherwise("R").alias("real_or_fake"))
    return rel.pair_completeness(m, fakes=6)


@query("r11_sampling_rate_conformity", "manifest", MANIFEST_IDS + """,
    e AS (SELECT path, rate, CASE WHEN name LIKE 'F0%' THEN name[1:3] ELSE 'R' END AS v,
        CASE WHEN own LIKE 'SSB%' THEN 'SSB' ELSE 'p' END AS fam FROM ids),
    x AS (SELECT path, rate, CASE v WHEN 'R' THEN (CASE fam WHEN 'p' THEN 48000 ELSE 44100 END) WHEN 'F04' THEN 24000
        WHEN 'F05' THEN 48000 WHEN 'F06' THEN (CASE fam WHEN 'p' THEN 16000 ELSE 24000 END) ELSE 16000 END AS expected FROM e)
    SELECT path, rate::BIGINT AS rate, expected::BIGINT AS expected FROM x WHERE rate <> expected""")
def r11(spark, sf):
    return rounded(rel.sampling_rate_conformity(fx.manifest(spark, sf)))


@query("r12_sort_real_first", "sig_ev", """
    SELECT audio_id, real_or_fake FROM sig_ev ORDER BY real_or_fake <> 'R', real_or_fake, audio_id""")
def r12(spark, sf):
    return rel.sort_real_first(fx.sig_ev(spark, sf).select(*KEY), "audio_id")


@query("r13_top_k", "feat_emb", """
    SELECT audio_id, round(e0, 4) + 0.0 AS e0 FROM feat_emb ORDER BY feat_emb.e0 DESC, audio_id LIMIT 10""")
def r13(spark, sf):
    return rounded(rel.top_k(fx.feat_emb(spark, sf).select("audio_id", "e0"), "e0", 10, "audio_id"))


@query("r14_null_counts", "feat_line", """
    SELECT count(*) - count(audio_id) AS audio_id, count(*) - count(real_or_fake) AS real_or_fake, """
       + ", ".join(f"count(*) - count({c}) AS {c}" for c in fx.FEATURES) + ", count(*) - count(miss) AS total FROM feat_line")
def r14(spark, sf):
    return rel.null_counts(fx.feat_line(spark, sf))


@query("r15_sample_per_shard", "manifest", """
    s AS (SELECT path, doc_id % 9 AS partition_id FROM manifest)
    SELECT path, partition_id FROM (SELECT *, row_number() OVER (PARTITION BY partition_id ORDER BY md5(path || '|7'), path) AS r FROM s) WHERE r <= 3""")
def r15(spark, sf):
    s = fx.manifest(spark, sf).select("path", F.pmod("doc_id", F.lit(9)).alias("partition_id"))
    return rel.sample_per_shard(s, 3, id_col="path", seed=7)


@query("r16_stratified_split", "feat_line", f"""
    h AS (SELECT audio_id, real_or_fake, md5(audio_id || '|42') AS h FROM feat_line)
    SELECT audio_id, real_or_fake, row_number() OVER (PARTITION BY real_or_fake ORDER BY h, audio_id) <=
    round(count(*) OVER (PARTITION BY real_or_fake) * 0.2) AS is_test, {SPLIT_HASH} < 0.2 AS hash_test FROM h""")
def r16(spark, sf):
    f = fx.feat_line(spark, sf).select(*KEY)
    exact = rel.stratified_split(f, 0.2, 42)
    return rel.hash_split(exact.withColumnRenamed("is_test", "t"), 0.2, 42).select(
        *KEY, F.col("t").alias("is_test"), F.col("is_test").alias("hash_test"))


@query("r16_grouped_stratified_split", "feat_line", """
    h AS (SELECT audio_id, real_or_fake, md5(split_part(audio_id, '-', 4) || '|42') AS h FROM feat_line),
    c AS (SELECT h, real_or_fake, count(*) AS k FROM h GROUP BY h, real_or_fake),
    g AS (SELECT h, sum(k) AS n, first(real_or_fake ORDER BY k DESC, real_or_fake) AS stratum FROM c GROUP BY h),
    s AS (SELECT h, 2 * sum(n) OVER (PARTITION BY stratum ORDER BY h) - n < 0.4::DOUBLE * sum(n) OVER (PARTITION BY stratum) AS is_test FROM g)
    SELECT audio_id, real_or_fake, is_test FROM h JOIN s USING (h)""")
def r16_grouped(spark, sf):
    f = fx.feat_line(spark, sf).select(*KEY, F.split_part("audio_id", F.lit("-"), F.lit(4)).alias("supplier"))
    return rel.grouped_stratified_split(f, "supplier", 0.2, 42).drop("supplier")


@query("r17_align_columns", "feat_line", "SELECT audio_id, real_or_fake, tax, qty, disc FROM feat_line")
def r17(spark, sf):
    return rel.align_columns(fx.feat_line(spark, sf), ["tax", "qty", "disc"])


@query("r18_extract_urls", sql="""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS url FROM pages""")
def r18(spark, sf):
    return rel.extract_urls(fx.table(spark, sf, "pages"))


@query("r19_one_hot", "score_k", "SELECT audio_id, y::BIGINT AS y, " + ", ".join(
    f"(y = {k})::BIGINT AS is_{k}" for k in range(4)) + " FROM score_k")
def r19(spark, sf):
    k = fx.score_k(spark, sf).select("audio_id", F.col("y").cast("string").alias("y"))
    return rounded(rel.one_hot(k, rel.distinct_labels(k, "y"), "y").withColumn("y", F.col("y").cast("bigint")))


@query("r20_join_feature_groups", "feat_line", """
    SELECT audio_id, qty, price, qty * 2 AS qty_2, disc FROM feat_line""")
def r20(spark, sf):
    f = fx.feat_line(spark, sf)
    a = f.select("audio_id", "qty", "price")
    return rel.join_feature_groups(a, f.select("audio_id", (F.col("qty") * 2).alias("qty"), "disc"))


@query("r21_select_versions", "sig_ev", """
    SELECT audio_id, real_or_fake, len(samples)::BIGINT AS n_samples FROM sig_ev
    WHERE audio_id = '7-2024-01' AND real_or_fake IN ('R', 'F01', 'F03', 'F09')""")
def r21(spark, sf):
    return rel.select_versions(stored_signals(spark, sf), "7-2024-01", [1, 3, 9]).select(
        *KEY, F.size("samples").cast("bigint").alias("n_samples"))


@query("r22_sort_files", "manifest", MANIFEST_IDS + """
    SELECT path, CASE WHEN name LIKE 'p%' THEN 0 WHEN name LIKE 'SSB%' THEN 1 ELSE 2 END::BIGINT AS family FROM ids""")
def r22(spark, sf):
    return rounded(rel.sort_files(fx.manifest(spark, sf).select("path")))
