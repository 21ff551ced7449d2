"""Views over the test tables, once as DataFrames and once as SQL.

See FIXTURES.md for what each view stands for. A recording made from events is
one user's month, so its length does not follow the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.scale import position_in_group

EVENT_LABEL = {"view": "R", "click": "F01", "error": "F02", "purchase": "F03", "signup": "F04"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _recordings(spark: SparkSession, sf: str, label: F.Column) -> DataFrame:
    """Events of one user and month (and label), in order, as one row with an array."""
    ev = table(spark, sf, "events").select(
        F.concat(F.col("user_id").cast("string"), F.date_format("ts", "'-'yyyy-MM")).alias("audio_id"),
        label.alias("real_or_fake"), F.struct("ts", "event_id", "value").alias("e"))
    return ev.groupBy("audio_id", "real_or_fake").agg(F.array_sort(F.collect_list("e")).alias("s"), F.avg("e.value").alias("m"))


def sig_ev(spark: SparkSession, sf: str) -> DataFrame:
    label = F.lit(None).cast("string")
    for kind, name in EVENT_LABEL.items():
        label = F.when(F.col("event_type") == kind, name).otherwise(label)
    return _recordings(spark, sf, label).select(
        "audio_id", "real_or_fake", F.col("s.value").alias("samples"), F.lit(16).alias("sampling_rate"))


def _user_label() -> F.Column:
    r = F.pmod("user_id", F.lit(4))
    return F.when(r == 0, "R").otherwise(F.concat(F.lit("F0"), r.cast("string")))


def sig_user(spark: SparkSession, sf: str) -> DataFrame:
    return _recordings(spark, sf, _user_label()).select(
        "audio_id", "real_or_fake", F.transform("s", lambda e: e["value"] - F.col("m")).alias("samples"), F.lit(16).alias("sampling_rate"))


def samp_user(spark: SparkSession, sf: str) -> DataFrame:
    return sig_user(spark, sf).select(
        "audio_id", "real_or_fake", F.posexplode("samples").alias("n", "x"))


def timed_user(spark: SparkSession, sf: str) -> DataFrame:
    """``samp_user`` with the time of each sample."""
    rows = _recordings(spark, sf, _user_label()).select("audio_id", "real_or_fake", "m", F.posexplode("s").alias("n", "e"))
    return rows.select("audio_id", "real_or_fake", "n", (F.col("e.value") - F.col("m")).alias("x"), F.col("e.ts").cast("timestamp").alias("ts"))


def sig_emb(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("audio_id"),
        F.when(F.col("label") == 0, "R")
        .otherwise(F.concat(F.lit("F0"), F.col("label").cast("string"))).alias("real_or_fake"),
        F.col("embedding").cast("array<double>").alias("samples"),
        F.lit(64).alias("sampling_rate"))


def pulses(spark: SparkSession, sf: str) -> DataFrame:
    rows = _recordings(spark, sf, _user_label()).select("audio_id", "s", F.posexplode("s").alias("i", "e"))
    us = lambda ts: F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    before = F.when(F.col("i") > 0, F.get("s.ts", F.col("i") - 1))
    return rows.select("audio_id", "i", ((us(F.col("e.ts")) - us(before)) / F.lit(1e6)).alias("period"), F.col("e.value").alias("amp"))


FEATURES = ["qty", "price", "disc", "tax", "const", "quasi", "dup_qty", "corr_price", "miss"]


def feat_line(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.datediff(F.col("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("string")
                    ).alias("audio_id"),
        F.when(F.col("l_returnflag") == "R", "R").when(F.col("l_returnflag") == "A", "F01")
        .otherwise("F02").alias("real_or_fake"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"))
    return li.select(
        "*", F.lit(1.0).alias("const"),
        F.when(F.md5("audio_id").startswith("00"), 0.0).otherwise(1.0).alias("quasi"),
        F.col("qty").alias("dup_qty"), (F.col("price") + F.col("tax")).alias("corr_price"),
        F.when(F.col("disc") != 0.05, F.col("tax")).alias("miss"))


EMB = [f"e{i}" for i in range(64)]


def feat_emb(spark: SparkSession, sf: str) -> DataFrame:
    return sig_emb(spark, sf).select(
        "audio_id", "real_or_fake", *[F.col("samples")[i].alias(f"e{i}") for i in range(64)])


def _total(a: F.Column) -> F.Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def score(spark: SparkSession, sf: str) -> DataFrame:
    p = F.round(1 / (1 + F.exp(-4 * _total(F.col("samples")))), 9)
    return (sig_emb(spark, sf)
            .select("audio_id", "real_or_fake",
                    (F.col("real_or_fake") != "R").cast("int").alias("y"), p.alias("p"))
            .withColumn("pred", (F.col("p") > 0.5).cast("int")))


def score_k(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("audio_id"),
        F.pmod("label", F.lit(4)).alias("y"),
        *[F.exp(_total(F.slice(F.col("embedding").cast("array<double>"), 16 * k + 1, 16))).alias(f"x{k}")
          for k in range(4)])
    z = F.col("x0") + F.col("x1") + F.col("x2") + F.col("x3")
    soft = base.select("audio_id", "y", *[F.round(F.col(f"x{k}") / z, 9).alias(f"p{k}") for k in range(4)])
    best = F.greatest("p0", "p1", "p2", "p3")
    pred = F.when(F.col("p0") == best, 0).when(F.col("p1") == best, 1).when(F.col("p2") == best, 2).otherwise(3)
    return soft.withColumn("pred", pred)


def drift(spark: SparkSession, sf: str) -> DataFrame:
    side = F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "train").otherwise("new")
    return (table(spark, sf, "events").withColumn("side", side)
            .select("side", F.concat("event_type", F.lit("_mean")).alias("feature"),
                    F.when((F.col("side") == "new") & (F.col("event_type") == "error"),
                           F.col("value") * 2).otherwise(F.col("value")).alias("value")))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    # a model has most of the rows: they are numbered by day and shifted
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice")
    o = position_in_group(o, ["o_orderpriority"], "o_orderdate", ["o_orderdate", "o_orderkey"], "_pos")
    o = o.withColumn("version", (F.col("_pos") + 1).cast("int"))
    v = F.col("version")
    return o.select(
        F.col("o_orderpriority").alias("model"), v,
        F.concat_ws("_", "o_orderpriority", F.lit("training"), F.floor((v - 1) / 2).cast("string")).alias("run_name"),
        (0.5 + F.pmod("o_totalprice", F.lit(1000.0)) / 2000).alias("auc"),
        F.when(v == 3, "Staging").when(v == 2, "Production").otherwise("None").alias("stage"),
        F.col("o_orderdate").alias("ts"))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    m, g = F.pmod(d, F.lit(7)), F.floor(d / 7)
    kind = F.when(m == 0, F.lit("")).otherwise(F.concat(F.lit("F0"), m.cast("string"), F.lit("_")))
    family = F.when(F.pmod(g, F.lit(2)) == 0, "p").otherwise("SSB")
    rate = (F.when(F.pmod(d, F.lit(11)) == 0, 8000)
            .when(m == 0, F.when(family == "p", 48000).otherwise(44100))
            .when(m.isin(1, 2, 3), 16000).when(m == 4, 24000).when(m == 5, 48000)
            .otherwise(F.when(family == "p", 16000).otherwise(24000)))
    return table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("train/"), kind, family, g.cast("string"), F.lit(".wav")).alias("path"),
        F.col("text").alias("content"), rate.alias("rate"), F.col("lang").alias("corpus"))


_RECORDING = "user_id::VARCHAR || '-' || strftime(ts, '%Y-%m')"

# name -> (names it reads, body)
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "sig_ev": ((), f"""SELECT {_RECORDING} AS audio_id,
        CASE event_type WHEN 'view' THEN 'R' WHEN 'click' THEN 'F01' WHEN 'error' THEN 'F02'
        WHEN 'purchase' THEN 'F03' WHEN 'signup' THEN 'F04' END AS real_or_fake,
        list(value ORDER BY ts, event_id) AS samples, 16 AS sampling_rate FROM events GROUP BY 1, 2"""),
    "us_n": ((), f"""SELECT audio_id, CASE WHEN user_id % 4 = 0 THEN 'R' ELSE 'F0' || (user_id % 4)::VARCHAR END AS real_or_fake,
        row_number() OVER (PARTITION BY audio_id ORDER BY ts, event_id) - 1 AS n, value, ts
        FROM (SELECT *, {_RECORDING} AS audio_id FROM events)"""),
    "samp_user": (("us_n",), """SELECT audio_id, real_or_fake, n,
        value - avg(value) OVER (PARTITION BY audio_id) AS x FROM us_n"""),
    "sig_emb": ((), """SELECT vec_id::VARCHAR AS audio_id,
        CASE WHEN label = 0 THEN 'R' ELSE 'F0' || label::VARCHAR END AS real_or_fake,
        embedding::DOUBLE[] AS samples, 64 AS sampling_rate FROM embeddings"""),
    "samp_emb": (("sig_emb",), """SELECT audio_id, real_or_fake, i - 1 AS n, samples[i] AS x
        FROM (SELECT *, unnest(range(1, len(samples) + 1)) AS i FROM sig_emb)"""),
    "samp_ev": (("sig_ev",), """SELECT audio_id, real_or_fake, i - 1 AS n, samples[i] AS x
        FROM (SELECT *, unnest(range(1, len(samples) + 1)) AS i FROM sig_ev)"""),
    "pulses": (("us_n",), """SELECT audio_id, n AS i,
        (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY audio_id ORDER BY n)) / 1e6 AS period,
        value AS amp FROM us_n"""),
    "line_id": ((), """SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
        date_diff('day', DATE '1970-01-01', l_shipdate::DATE)) AS audio_id FROM lineitem"""),
    "feat_line": (("line_id",), """SELECT audio_id,
        CASE l_returnflag WHEN 'R' THEN 'R' WHEN 'A' THEN 'F01' ELSE 'F02' END AS real_or_fake,
        l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
        1.0::DOUBLE AS const, CASE WHEN md5(audio_id)[1:2] = '00' THEN 0.0 ELSE 1.0 END::DOUBLE AS quasi,
        l_quantity AS dup_qty, l_extendedprice + l_tax AS corr_price,
        CASE WHEN l_discount <> 0.05 THEN l_tax END AS miss FROM line_id"""),
    "feat_long": (("feat_line",), """SELECT * FROM (UNPIVOT feat_line
        ON qty, price, disc, tax, const, quasi, dup_qty, corr_price, miss INTO NAME feature VALUE value)"""),
    "feat_emb": (("sig_emb",), "SELECT audio_id, real_or_fake, "
                 + ", ".join(f"samples[{i + 1}] AS e{i}" for i in range(64)) + " FROM sig_emb"),
    "score": (("sig_emb",), """SELECT *, (p > 0.5)::INT AS pred FROM (SELECT audio_id, real_or_fake,
        (real_or_fake <> 'R')::INT AS y, round(1 / (1 + exp(-4 * list_sum(samples))), 9) AS p FROM sig_emb)"""),
    "score_k": ((), """SELECT *, CASE WHEN p0 = greatest(p0, p1, p2, p3) THEN 0
        WHEN p1 = greatest(p0, p1, p2, p3) THEN 1 WHEN p2 = greatest(p0, p1, p2, p3) THEN 2 ELSE 3 END AS pred
        FROM (SELECT audio_id, y, round(x0 / (x0+x1+x2+x3), 9) AS p0, round(x1 / (x0+x1+x2+x3), 9) AS p1,
        round(x2 / (x0+x1+x2+x3), 9) AS p2, round(x3 / (x0+x1+x2+x3), 9) AS p3
        FROM (SELECT vec_id::VARCHAR AS audio_id, label % 4 AS y,
        exp(list_sum(embedding[1:16]::DOUBLE[])) AS x0, exp(list_sum(embedding[17:32]::DOUBLE[])) AS x1,
        exp(list_sum(embedding[33:48]::DOUBLE[])) AS x2, exp(list_sum(embedding[49:64]::DOUBLE[])) AS x3
        FROM embeddings))"""),
    "drift": ((), """SELECT side, event_type || '_mean' AS feature,
        CASE WHEN side = 'new' AND event_type = 'error' THEN value * 2 ELSE value END AS value
        FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'train' ELSE 'new' END AS side FROM events)"""),
    "runs": ((), """SELECT o_orderpriority AS model, version,
        o_orderpriority || '_training_' || ((version - 1) // 2)::VARCHAR AS run_name,
        0.5 + (o_totalprice % 1000) / 2000 AS auc,
        CASE version WHEN 3 THEN 'Staging' WHEN 2 THEN 'Production' ELSE 'None' END AS stage, o_orderdate AS ts
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS version
        FROM orders)"""),
    "manifest": ((), """SELECT doc_id, 'train/' || (CASE WHEN m = 0 THEN '' ELSE 'F0' || m::VARCHAR || '_' END)
        || family || g::VARCHAR || '.wav' AS path, text AS content,
        CASE WHEN doc_id % 11 = 0 THEN 8000 WHEN m = 0 THEN (CASE WHEN family = 'p' THEN 48000 ELSE 44100 END)
        WHEN m IN (1, 2, 3) THEN 16000 WHEN m = 4 THEN 24000 WHEN m = 5 THEN 48000
        ELSE (CASE WHEN family = 'p' THEN 16000 ELSE 24000 END) END AS rate, lang AS corpus
        FROM (SELECT *, doc_id % 7 AS m, doc_id // 7 AS g,
        CASE WHEN (doc_id // 7) % 2 = 0 THEN 'p' ELSE 'SSB' END AS family FROM documents)"""),
}


def with_views(names: str, rest: str) -> str:
    """SQL text: the named views and what they read, then ``rest``.

    ``rest`` is a SELECT, or ``name AS (...), ... SELECT`` to add more CTEs.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        for d in SQL[n][0]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names.split():
        visit(n)
    ctes = ", ".join(f"{n} AS ({SQL[n][1]})" for n in order)
    glue = " " if rest.lstrip().upper().startswith("SELECT") else ", "
    return f"WITH {ctes}{glue}{rest}"
