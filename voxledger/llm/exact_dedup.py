"""Exact deduplication by content sort, in DataFrame functions only.

Rows are range-partitioned on the leading characters of the normalised text by
splitters that Spark samples, sorted there externally on the whole text, and
neighbours are compared in full. Rows of one text may be most of the table: a
salt of the id is the last part of the range key, so a hot group is cut into
pieces that lie in many partitions. Each piece names its best row; pieces of
one text then meet by digest and length, one short row each, and rows get their
text's verdict through their piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import checkpointed, free_name, query, table, text_of, without_space

SALTS = 256
LEAD = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with the group of equal texts that it belongs to.

    Texts are equal when identical without white space. The row with most code
    points in its original text stays, then the smallest id. Columns: the id,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null text counts as empty, and empty texts are one group. A null id sorts
    before all others. Of rows that repeat id and text one is kept. An empty
    table gives an empty result; other columns are not read.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.char_length(text).cast("long").alias("_chars"),
                       without_space(text).alias("_norm"))
    keyed = rows.select("*", F.left("_norm", F.lit(LEAD)).alias("_lead"), F.xxhash64("_norm").alias("_fp"),
                        F.pmod(F.hash("_id"), F.lit(SALTS)).alias("_salt"))
    # the range key is a part of the window's key, so the window needs no second shuffle
    dealt = keyed.repartitionByRange("_lead", "_fp", "_salt")
    piece = W.partitionBy("_lead", "_fp", "_salt", "_norm")
    best_first = piece.orderBy(F.col("_chars").desc(), F.col("_id").asc_nulls_first())
    pieces = dealt.select(
        "_id", "_chars", "_salt", F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"),
        F.octet_length("_norm").alias("_bytes"), F.row_number().over(best_first).alias("_rank"),
        F.count(F.lit(1)).over(piece).alias("_piece"))
    pieces = checkpointed(pieces)  # short rows; the texts have been read and shuffled once
    # at most SALTS rows of one text meet here, and its rows are joined piece by piece
    text_of_piece = W.partitionBy("_sha", "_bytes")
    groups = pieces.where("_rank = 1").select(
        "_sha", "_bytes", "_salt", F.sum("_piece").over(text_of_piece).alias("group_size"),
        F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").alias("i"))).over(text_of_piece).alias("_best"))
    joined = pieces.join(groups, ["_sha", "_bytes", "_salt"])
    keep = F.col("_best.i")
    return joined.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"), "group_size",
        (F.col("_id").eqNullSafe(keep) & (F.col("_rank") == 1)).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``exact_groups`` keeps, with all their columns."""
    digest = F.sha2(without_space(text_of(text_col)).cast("binary"), 256)
    kept = exact_groups(docs, id_col, text_col).where("kept").select(
        F.col(id_col).alias("_kid"), F.col("text_sha256").alias("_ksha"))
    sha, rank = free_name(docs, "_sha"), free_name(docs, "_rank")
    tagged = docs.withColumn(sha, digest)
    found = tagged.join(kept, tagged[id_col].eqNullSafe(kept["_kid"]) & (tagged[sha] == kept["_ksha"]), "left_semi")
    # rows that repeat id and text both match; one of them stays
    one = W.partitionBy(id_col, sha).orderBy(F.char_length(text_of(text_col)).desc())
    return found.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*docs.columns)


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) = 1 AS kept, h AS text_sha256
FROM d"""


@query("op8_exact_dedup", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
