"""Stateful dedup over streams: any order of arrival, late rows, and no row lost."""

import random

import pytest
from pyspark.sql import functions as F

from sievelight.operators import dedup as batch
from sievelight.streaming import dedup


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, dedup.ROCKSDB)
    yield
    spark.conf.set(key, before)


SCHEMA = "id string, ts timestamp, i long, big decimal(30,2), headers map<string,string>, body binary"


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, t double, i long").select(
        "id", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")).alias("ts"), "i", F.lit("12345678901234567890.12").cast("decimal(30,2)").alias("big"),
        F.create_map(F.lit("h"), F.col("id")).alias("headers"), F.lit("x").cast("binary").alias("body"))


def drained(spark, folder, batches, judge):
    """One micro-batch per list of rows, then one that closes all windows."""
    for k, rows in enumerate([*batches, [("", 1e9, -1)]]):
        part = f"{folder}/in-{k:03d}"
        table(spark, rows).coalesce(1).write.parquet(part)
    # Files are read in the order in which they were made.
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in-*")
    q = (judge(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{folder}/out").where("i >= 0").collect()
    assert all(str(r.big) == "12345678901234567890.12" and bytes(r.body) == b"x" for r in got)
    return sorted((r.i, r.outcome) for r in got)


def test_ttl_stream_equals_batch_for_every_order(spark, rocksdb, tmp_path):
    r = random.Random(6)
    rows = [(r.choice("ab"), r.choice([round(r.uniform(1, 900), 3), float(r.randint(1, 30) * 30)]), i) for i in range(90)]
    rows += [("", 5.0, 90), (None, 5.0, 91), ("", 5.0, 92), ("a", 30.0, 93), ("a", 30.0, 94), ("c", 899.9995, 95), ("c", 899.9991, 96)]
    want = {x.i for x in batch.dedup_ttl(table(spark, rows), ["id"], "ts", "i", ttl=100).collect()}
    for turn in range(3):
        # Any order within the delay: rows are shuffled inside windows of 300 s; the delay is 700 s.
        own = sorted(rows, key=lambda x: x[1] + r.uniform(0, 300)) if turn else sorted(rows, key=lambda x: -x[1])
        size = (25, 7, 40)[turn]
        got = drained(spark, str(tmp_path / str(turn)), [own[k:k + size] for k in range(0, len(own), size)],
                      lambda s: dedup.judge_ttl(s, ["id"], "ts", "i", 100, "1000 seconds" if not turn else "700 seconds"))
        assert [i for i, _ in got] == list(range(len(rows)))
        assert {i for i, o in got if o == dedup.ACCEPTED} == want and not any(o == dedup.LATE for _, o in got)


def test_out_of_order_copies_of_two_batches(spark, rocksdb, tmp_path):
    got = drained(spark, str(tmp_path), [[("a", 1000.0, 0)], [("a", 10.0, 1)]], lambda s: dedup.judge_ttl(s, ["id"], "ts", "i", 100, "2000 seconds"))
    assert got == [(0, "accepted"), (1, "accepted")]


def test_late_rows_come_out_as_late(spark, rocksdb, tmp_path):
    batches = [[("a", 1000.0, 0), ("b", 1000.0, 1)], [("a", 5000.0, 2)], [("a", 10.0, 3), ("a", 5000.0, 4), ("b", 4990.0, 5), ("c", 4899.0, 6), ("", 1.0, 7)], [("c", 5001.0, 8)]]
    got = drained(spark, str(tmp_path / "ttl"), batches, lambda s: dedup.judge_ttl(s, ["id"], "ts", "i", 50, "100 seconds"))
    assert got == [(0, "accepted"), (1, "accepted"), (2, "accepted"), (3, "late"), (4, "duplicate"), (5, "accepted"), (6, "late"), (7, "accepted"), (8, "accepted")]
    # Copies within 4500 s of the first one are duplicates; the state of b is kept as long.
    got = drained(spark, str(tmp_path / "replay"), batches, lambda s: dedup.judge_replays(s, ["id"], "ts", "100 seconds", 4500))
    assert got == [(0, "accepted"), (1, "accepted"), (2, "duplicate"), (3, "late"), (4, "duplicate"), (5, "duplicate"), (6, "late"), (7, "accepted"), (8, "accepted")]
