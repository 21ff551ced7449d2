"""S: scans, sources and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, functions as F

from ..sources import features as feat, recordings as rec, store
from . import fixtures as fx
from .registry import NUDGE, query, rounded


def folder(name: str) -> str:
    return tempfile.mkdtemp(prefix=f"voxledger-{name}-")


def shared_folder(spark, name: str) -> str:
    """A fresh folder beside the checkpoints on a cluster, a temporary one in local tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return folder(name)
    return f"{base.rstrip('/')}/voxledger-{name}-{uuid.uuid4().hex}"


def _by_id_layout(m: DataFrame) -> DataFrame:
    """manifest paths in the one-folder-per-id layout."""
    name = rec.base_name(F.col("path"))
    own = F.when(name.startswith("F0"), F.substr(name, F.lit(5))).otherwise(name)
    return m.select(F.concat(F.lit("flac/"), F.replace(own, F.lit(".wav"), F.lit("")), F.lit("/"), name).alias("path"))


MANIFEST_IDS = """ids AS (SELECT *, CASE WHEN path LIKE 'train/F0%' THEN path[11:] ELSE path[7:] END AS own,
    path[7:] AS name FROM manifest)"""


@query("s01_manifest_by_prefix", "manifest", MANIFEST_IDS + """
    SELECT 'flac/' || replace(own, '.wav', '') || '/' || name AS path, replace(own, '.wav', '') AS audio_id,
    CASE WHEN name LIKE 'F0%' THEN name[1:3] ELSE 'R' END AS real_or_fake FROM ids WHERE own NOT LIKE 'SSB%'""")
def s01(spark, sf):
    return rec.manifest_by_prefix(_by_id_layout(fx.manifest(spark, sf)))


DIRS = list(rec.WAVE_DIR_LABELS)


@query("s02_manifest_by_dir", "manifest", """
    d AS (SELECT doc_id % 8 AS m, doc_id // 8 AS g FROM manifest),
    p AS (SELECT CASE m WHEN 7 THEN 'base/' ELSE 'base/generated_audio/' END || CASE m """
       + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DIRS)) + """ END || '/LJ' || g::VARCHAR ||
       CASE WHEN m = 7 THEN '' WHEN m % 2 = 0 THEN '_gen' ELSE '_generated' END || '.wav' AS path, m, g FROM d)
    SELECT path, 'LJ' || g::VARCHAR AS audio_id, CASE WHEN m = 7 THEN 'R' ELSE 'WF' || (m + 1)::VARCHAR END AS real_or_fake FROM p""")
def s02(spark, sf):
    m, g = F.pmod("doc_id", F.lit(8)), F.floor(F.col("doc_id") / 8)
    d = F.element_at(F.array(*[F.lit(x) for x in DIRS]), (m + 1).cast("int"))
    path = F.concat(F.when(m == 7, "base/").otherwise("base/generated_audio/"), d, F.lit("/LJ"), g.cast("string"),
                    F.when(m == 7, "").when(F.pmod(m, F.lit(2)) == 0, "_gen").otherwise("_generated"), F.lit(".wav"))
    return rec.manifest_by_dir(fx.manifest(spark, sf).select(path.alias("path")))


@query("s03_scan_partition", "manifest", """
    SELECT doc_id, path, (doc_id // 7) % 5 AS partition_id FROM manifest WHERE (doc_id // 7) % 5 = 3""")
def s03(spark, sf):
    out = shared_folder(spark, "shards")
    m = fx.manifest(spark, sf).select("doc_id", "path", F.pmod(F.floor(F.col("doc_id") / 7), F.lit(5)).alias("partition_id"))
    m.write.mode("overwrite").partitionBy("partition_id").parquet(out)
    return rec.scan_partition(spark.read.parquet(out), 3).withColumn("partition_id", F.col("partition_id").cast("bigint"))


def sized(df: DataFrame) -> DataFrame:
    return df.select("audio_id", "real_or_fake", F.size("samples").cast("bigint").alias("n_samples"))


def stored_signals(spark, sf):
    return store.write_store(fx.sig_ev(spark, sf), shared_folder(spark, "signals"), 64)


@query("s04_scan_ids", "sig_ev", """
    SELECT audio_id, real_or_fake, len(samples)::BIGINT AS n_samples FROM sig_ev WHERE audio_id IN ('1-2024-01', '7-2024-01', '12-2024-01')""")
def s04(spark, sf):
    return sized(rec.scan_ids(stored_signals(spark, sf), ["1-2024-01", "7-2024-01", "12-2024-01"]))


@query("s20_scan_id_table", "sig_ev", """
    SELECT audio_id, real_or_fake, len(samples)::BIGINT AS n_samples FROM sig_ev
    WHERE audio_id IN (SELECT audio_id FROM sig_ev WHERE real_or_fake = 'F04' AND len(samples) > 10)""")
def s20(spark, sf):
    signals = stored_signals(spark, sf)
    wanted = signals.where((F.col("real_or_fake") == "F04") & (F.size("samples") > 10)).select("audio_id")
    return sized(rec.scan_ids(signals, wanted))


@query("s05_scan_dataset", "manifest", "SELECT doc_id, path, corpus FROM manifest WHERE corpus = 'de'")
def s05(spark, sf):
    return rec.scan_dataset(fx.manifest(spark, sf), "de", ("en", "de", "fr", "es")).select("doc_id", "path", "corpus")


@query("s06_list_ids", "sig_ev", """
    ids AS (SELECT DISTINCT audio_id FROM sig_ev), pos AS (SELECT audio_id, row_number() OVER (ORDER BY audio_id) - 1 AS p,
    row_number() OVER (ORDER BY audio_id DESC) AS q, row_number() OVER (ORDER BY md5(audio_id || '|3'), audio_id) AS r FROM ids)
    SELECT 'first' AS pick, audio_id FROM pos WHERE p < 5 UNION ALL SELECT 'last', audio_id FROM pos WHERE q <= 5
    UNION ALL SELECT 'random', audio_id FROM pos WHERE r <= 5 UNION ALL SELECT 'index', audio_id FROM pos WHERE p IN (0, 2, 9)""")
def s06(spark, sf):
    s = fx.sig_ev(spark, sf).select("audio_id")
    picks = {"first": {"first_n": 5}, "last": {"last_n": 5}, "random": {"random_n": 5, "seed": 3},
             "index": {"indices": [0, 2, 9]}}
    parts = [rec.list_ids(s, **kw).select(F.lit(k).alias("pick"), "audio_id") for k, kw in picks.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("s07_assign_shards", "manifest", MANIFEST_IDS + """,
    n AS (SELECT count(DISTINCT own) AS n FROM ids),
    size AS (SELECT max(s) AS size FROM n, range(5, 31) t(s) WHERE n % s = 0)
    SELECT path, own AS audio_id, (dense_rank() OVER (ORDER BY own) - 1) // size AS partition_id FROM ids, size""")
def s07(spark, sf):
    m = fx.manifest(spark, sf)
    name = rec.base_name(F.col("path"))
    own = F.when(name.startswith("F0"), F.substr(name, F.lit(5))).otherwise(name)
    return rec.assign_shards(m.select("path", own.alias("audio_id")), 5, 30)


@query("s08_read_write_features", "feat_line", "SELECT audio_id, real_or_fake, qty, price, miss FROM feat_line")
def s08(spark, sf):
    out = shared_folder(spark, "features")
    cols = ["audio_id", "real_or_fake", "qty", "price", "miss"]
    raw = fx.feat_line(spark, sf).select(F.lit(0).alias("Unnamed: 0"), *cols)
    # missing values leave as NaN text, as a data-frame library would write them
    feat.write_features(raw.withColumn("miss", F.coalesce("miss", F.lit(float("nan")))), out, "csv")
    return feat.read_features(spark, out)


@query("s09_union_feature_files", "feat_line", """
    SELECT audio_id, real_or_fake, qty, price, NULL::DOUBLE AS tax FROM feat_line WHERE real_or_fake = 'R'
    UNION ALL SELECT audio_id, real_or_fake, qty, NULL::DOUBLE AS price, tax FROM feat_line WHERE real_or_fake <> 'R'""")
def s09(spark, sf):
    a, b = shared_folder(spark, "corpus-a"), shared_folder(spark, "corpus-b")
    f = fx.feat_line(spark, sf)
    feat.write_features(f.where("real_or_fake = 'R'").select("audio_id", "real_or_fake", "qty", "price"), a)
    feat.write_features(f.where("real_or_fake <> 'R'").select("audio_id", "real_or_fake", "qty", "tax"), b)
    return feat.union_feature_files(spark, [a, b])


@query("s10_parse_label_file", "manifest", MANIFEST_IDS + """
    SELECT name AS file, CASE WHEN name LIKE 'F0%' THEN 'fake' ELSE 'real' END AS label,
    CASE WHEN name LIKE 'F0%' THEN name[3:3] ELSE '-' END AS kind, own AS real_file FROM ids""")
def s10(spark, sf):
    name = rec.base_name(F.col("path"))
    fake = name.startswith("F0")
    line = F.concat_ws("  ", name, F.when(fake, "fake").otherwise("real"), F.when(fake, F.substring(name, 3, 1)).otherwise("-"))
    out = shared_folder(spark, "labels")
    fx.manifest(spark, sf).select(line.alias("value")).write.mode("overwrite").text(out)
    return rec.parse_label_file(spark.read.text(out))


@query("s11_verify_checksums", "manifest", """
    SELECT path, CASE WHEN doc_id % 13 = 0 THEN 'missing' WHEN doc_id % 5 = 0 THEN 'mismatch' ELSE 'ok' END AS status
    FROM manifest""")
def s11(spark, sf):
    m = fx.manifest(spark, sf)
    expected = m.select("path", F.when(F.pmod("doc_id", F.lit(5)) == 0, F.md5(F.concat("content", F.lit("x"))))
                        .otherwise(F.md5("content")).alias("expected_md5"))
    return rec.verify_checksums(m.where(F.pmod("doc_id", F.lit(13)) != 0).select("path", "content"), expected)


@query("s12_flatten_examples", "sig_emb", """
    SELECT audio_id, real_or_fake, sampling_rate::BIGINT AS sampling_rate, i - 1 AS n, samples[i] AS x
    FROM (SELECT *, unnest(range(1, len(samples) + 1)) AS i FROM sig_emb)""")
def s12(spark, sf):
    nested = fx.sig_emb(spark, sf).select(
        F.struct(F.col("samples").alias("array"), "sampling_rate").alias("audio"), "audio_id", "real_or_fake")
    return rounded(rec.flatten_examples(nested).select(
        "audio_id", "real_or_fake", "sampling_rate", F.posexplode("samples").alias("n", "x")), keep=("x",))


@query("s13_decode_pcm_wav", "samp_emb", """
    SELECT audio_id AS path, n::BIGINT AS n, round(round(x * 32767) / 32768, 8) + 0.0 AS x, 64::BIGINT AS sampling_rate FROM samp_emb""")
def s13(spark, sf):
    from ..sources.wav import decode_pcm_wav

    s = fx.sig_emb(spark, sf)
    # 16-bit mono WAV bytes put together from the embedding samples by SQL
    le = lambda v, n: F.expr("concat(" + ", ".join(
        f"substring(to_binary(lpad(hex({v}), 16, '0'), 'hex'), {8 - i}, 1)" for i in range(n)) + ")")
    pcm = F.expr("""unhex(array_join(transform(samples, x -> concat(
        substring(lpad(hex(pmod(cast(round(greatest(-1D, least(1D, x)) * 32767) as int), 65536)), 4, '0'), 3, 2),
        substring(lpad(hex(pmod(cast(round(greatest(-1D, least(1D, x)) * 32767) as int), 65536)), 4, '0'), 1, 2))), ''))""")
    b = s.select("audio_id", "sampling_rate", pcm.alias("pcm"), (F.size("samples") * 2).cast("bigint").alias("len"))
    b = b.withColumn("riff", F.col("len") + 36).withColumn("rate", F.col("sampling_rate").cast("bigint"))
    b = b.withColumn("byterate", F.col("rate") * 2)
    text = lambda t: F.encode(F.lit(t), "US-ASCII")
    wav = F.concat(text("RIFF"), le("riff", 4), text("WAVEfmt "), F.unhex(F.lit("10000000" "0100" "0100")),
                   le("rate", 4), le("byterate", 4), F.unhex(F.lit("0200" "1000")), text("data"), le("len", 4), F.col("pcm"))
    out = decode_pcm_wav(b.select(F.col("audio_id").alias("path"), wav.alias("content")))
    return rounded(out.select("path", "sampling_rate", F.posexplode("samples").alias("n", "x")), 8)


@query("s14_resume_shards", "feat_line", """
    f AS (SELECT audio_id, l_suppkey % 10 AS partition_id, l_quantity FROM line_id)
    SELECT audio_id, partition_id FROM f WHERE partition_id IN (SELECT partition_id FROM f GROUP BY 1
    HAVING count(*) <> count(*) FILTER (WHERE partition_id NOT IN (2, 5) AND NOT (partition_id = 7 AND l_quantity < 5)))""")
def s14(spark, sf):
    f = fx.feat_line(spark, sf).select(
        "audio_id", "qty", F.pmod(F.split("audio_id", "-")[3].cast("bigint"), F.lit(10)).alias("partition_id"))
    done = f.where(~F.col("partition_id").isin(2, 5) & ~((F.col("partition_id") == 7) & (F.col("qty") < 5)))
    return rec.resume_shards(f, done).select("audio_id", "partition_id")


@query("s15_batch_number", "manifest", """
    SELECT path, CASE WHEN doc_id % 3 > 0 THEN doc_id % 40 - 1 END AS batch FROM (SELECT doc_id,
    CASE WHEN doc_id % 3 > 0 THEN 'batches/test_iteration_' || (doc_id % 40)::VARCHAR || '.csv' ELSE path END AS path FROM manifest)""")
def s15(spark, sf):
    p = F.when(F.pmod("doc_id", F.lit(3)) > 0, F.concat(
        F.lit("batches/test_iteration_"), F.pmod("doc_id", F.lit(40)).cast("string"), F.lit(".csv"))).otherwise(F.col("path"))
    return fx.manifest(spark, sf).select(p.alias("path")).select("path", rec.batch_number(F.col("path")).alias("batch"))


@query("s16_training_iteration", "manifest", """
    SELECT count(*) FILTER (WHERE doc_id % 9 IN (2, 3)) AS training_iteration FROM manifest""")
def s16(spark, sf):
    k = F.pmod("doc_id", F.lit(9))
    d = F.col("doc_id").cast("string")
    name = (F.when(k == 2, F.concat(F.lit("train_"), d, F.lit(".csv"))).when(k == 3, F.concat(F.lit("train"), d, F.lit(".csv")))
            .when(k == 4, "train.csv").when(k == 5, F.concat(F.lit("train_a"), d, F.lit(".csv"))).otherwise(F.concat(F.lit("test_"), d, F.lit(".csv"))))
    return rec.training_iteration(fx.manifest(spark, sf).select(name.alias("name")), "train")


@query("s17_save_load_state", "feat_emb", "m AS (SELECT " + ", ".join(
    f"avg(e{i}) AS m{i}, stddev_pop(e{i}) AS s{i}" for i in range(64)) + " FROM feat_emb) SELECT audio_id, real_or_fake, " + ", ".join(
    f"round((e{i} - m{i}) / s{i} + {NUDGE}::DOUBLE, 4) + 0.0 AS e{i}" for i in range(64)) + ", (real_or_fake <> 'R')::BIGINT AS target FROM feat_emb, m")
def s17(spark, sf):
    from ..operators import prep

    f = fx.feat_emb(spark, sf)
    model = prep.fit_preparation(f, fx.EMB)
    path = shared_folder(spark, "state")
    feat.save_pipeline(model, fx.EMB, path, spark)
    loaded, selected = feat.load_pipeline(spark, path)
    return rounded(prep.prepare(f, loaded, selected))


@query("s18_write_predictions", "score", """
    SELECT audio_id, real_or_fake, pred::BIGINT AS predicted, p AS probability FROM score""")
def s18(spark, sf):
    out = shared_folder(spark, "predictions")
    feat.write_predictions(fx.score(spark, sf), out)
    return spark.read.parquet(out)


@query("s19_id_file_map", "manifest", "SELECT doc_id::VARCHAR AS audio_id, 'https://files.example/' || path AS url FROM manifest")
def s19(spark, sf):
    url = F.struct(F.concat(F.lit("https://files.example/"), F.col("path")).alias("train"))
    lines = fx.manifest(spark, sf).select(F.to_json(F.create_map(F.col("doc_id").cast("string"), url)).alias("value"))
    return rec.id_file_map(lines)
