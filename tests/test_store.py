"""The stored signal table: what a scan by id reads."""

import re
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voxledger.operators import relational as rel
from voxledger.sources import recordings as rec, store

ROWS = 4000


@pytest.fixture(scope="module")
def signals(spark):
    """4,000 recordings; a third of them share one id, one has none."""
    name = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None).otherwise(F.concat(F.lit("a"), F.col("id").cast("string")))
    return spark.range(ROWS).select(
        name.alias("audio_id"), F.when(F.col("id") % 2 == 0, "R").otherwise("F01").alias("real_or_fake"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.rand(7) + k + F.col("id")).alias("samples")).cache()


@pytest.fixture(scope="module")
def stored(spark, signals, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "signals")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with partitions of a real size
    try:
        return path, store.write_store(signals, path, 32)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def read(df) -> tuple[int, int]:
    """Rows and bytes that the tasks of ``df`` read from files."""
    sc, group = df.sparkSession.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "read")
    df.write.format("noop").mode("overwrite").save()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    stages = [sc._jsc.sc().statusStore().lastStageAttempt(k) for j in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(j).stageIds]
    return sum(x.inputRecords() for x in stages), sum(x.inputBytes() for x in stages)


def folder_bytes(path: str) -> int:
    return sum(f.stat().st_size for f in Path(path).glob("*.parquet"))


def rows(df):
    return sorted((r.audio_id, r.real_or_fake, tuple(r.samples)) for r in df.collect())


def test_ids_select_buckets_and_row_groups(signals, stored):
    path, table = stored
    wanted = ["a100", "a200", "missing"]
    got = rec.scan_ids(table, wanted)
    text = plan(got)
    assert re.search(r"PushedFilters: \[In\(audio_id", text)
    n, size = read(got)
    assert 2 <= n < ROWS / 5 and 0 < size < folder_bytes(path) / 4
    assert read(table)[0] == ROWS
    assert rows(got) == rows(signals.where(F.col("audio_id").isin(wanted)))
    assert rows(rec.scan_ids(table, "a100")) == rows(signals.where("audio_id = 'a100'"))


def test_only_named_columns_are_read(stored):
    assert "ReadSchema: struct<audio_id:string,real_or_fake:string>" in plan(rec.scan_ids(stored[1], "a100").select("audio_id", "real_or_fake"))


def test_small_id_table_becomes_a_filter(spark, signals, stored):
    ids = spark.createDataFrame([("a100",), ("a100",), (None,), ("nope",)], "name string")
    got = rec.scan_ids(stored[1], ids)
    assert "Join" not in plan(got) and read(got)[0] < ROWS / 10
    assert rows(got) == rows(signals.where("audio_id = 'a100'"))
    assert rec.scan_ids(stored[1], ids.limit(0)).count() == 0


def test_large_id_table_does_not_move_the_recordings(spark, signals, stored, monkeypatch):
    monkeypatch.setattr(rec, "FILTER_IDS", 10)
    monkeypatch.setattr("voxledger.operators.scale.LOOKUP_ROWS", 10)
    ids = signals.select("audio_id").where("audio_id = 'hot' OR audio_id LIKE 'a1%'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rec.scan_ids(stored[1], ids)
        text = plan(got)
        assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") <= 1
        want = rows(signals.where("audio_id = 'hot' OR audio_id LIKE 'a1%'"))
        assert rows(got) == want and len(want) > ROWS / 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_id_is_written_by_many_tasks(stored):
    table = stored[1]
    files = table.where("audio_id = 'hot'").select(F.col("_metadata.file_path")).distinct().count()
    assert files > 1
    assert table.count() == ROWS and table.where("audio_id IS NULL").count() == 1


def test_opened_again_it_prunes_as_before(spark, signals, stored):
    path, _ = stored
    again = store.open_store(spark, path, 32)
    got = rec.scan_ids(again, ["a4", "a5"])
    assert read(got)[0] < ROWS / 5
    assert rows(got) == rows(signals.where("audio_id IN ('a4', 'a5')"))
    assert again.schema["samples"].dataType.simpleString() == "array<double>"


def test_versions_of_one_id_read_one_bucket(stored):
    got = rel.select_versions(stored[1], "hot", [1, 3])
    assert re.search(r"PushedFilters: .*EqualTo\(audio_id,hot\)", plan(got))
    hot = stored[1].where("audio_id = 'hot'").count()
    assert got.count() == hot and read(got)[0] < hot + ROWS / 10
