"""Findings of round 3 on growth: F18 all_mods, F26 daily_ttl_dedup."""

from pyspark.sql import functions as F

from sievelight.operators import dedup, history, mods as M, terms as T
from sievelight.plans import common, q_mods


def test_tasks_of_all_mods_have_a_bounded_number_of_rows(spark, tmp_path):
    rows = 2 * spark.sparkContext.defaultParallelism * common.ROWS_PER_TASK
    spark.range(0, rows, 1, 1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value",
        "'{\"k\": 7}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    emitted = q_mods.emissions(spark, str(tmp_path)).select("event_id")
    sizes = [r.n for r in emitted.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == rows and max(sizes) <= 1.1 * common.ROWS_PER_TASK


def test_a_row_that_its_gate_stops_pays_for_no_hits(spark):
    found = F.when(F.col("id") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.raise_error(F.lit("hits were searched")).cast("array<string>"))
    out = M.when_any(found, lambda j: [M.Row(mod="m").advise(M.ANNOTATION, j)], gate=F.col("id") == 1)
    got = spark.range(2).select("id", F.transform(out, lambda o: o["message"]).alias("said")).collect()
    assert {r.id: r.said for r in got} == {0: [], 1: ["a, b"]}


def test_picked_terms_keep_order_and_repeats_and_null_hits_have_none(spark):
    df = spark.createDataFrame([(["b", "a"],), (["c"],), ([],), (None,)], "hits array<string>")
    assert [r.p for r in df.select(T.pick(F.col("hits"), ["a", "b"]).alias("p")).collect()] == [["a", "b"], [], [], []]
    assert [r.p for r in df.select(T.pick(F.col("hits"), ["b", "a", "b"]).alias("p")).collect()] == [["b", "a", "b"], [], [], []]


def deliveries(spark, rows):
    return spark.createDataFrame(rows, "k string, t long, i long").withColumn("ts", F.timestamp_seconds("t"))


def test_ttl_dedup_shuffles_rows_and_instants_once_each(spark):
    df = deliveries(spark, [(f"x{n % 7}", n * 40, n) for n in range(100)])
    plan = dedup.dedup_ttl(df, ["k"], "ts", "i", ttl=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_light_and_heavy_ids_are_settled_side_by_side(spark):
    heavy = [("hot", n % 50 * 10, n) for n in range(400)] + [("span", n, 1000 + n) for n in range(60)] + [("near", 5, 2000 + n) for n in range(30)]
    light = [(f"x{n % 9}", n * 30, 3000 + n) for n in range(90)] + [("", 1, 4000), (None, 1, 4001)]
    keep, last = [], {}
    for k, t, i in sorted(heavy + light, key=lambda r: (r[1], r[2])):
        if not k or k not in last or t - last[k] > 100:
            keep.append(i)
            last[k] = t
    for fold in (10, 20, 55, 1000):  # rounds, both, folds of heavy ids, no heavy id
        got = dedup.dedup_ttl(deliveries(spark, heavy + light), ["k"], "ts", "i", ttl=100, max_fold=fold)
        assert sorted(r.i for r in got.collect()) == sorted(keep)


def test_a_delivery_without_a_tiebreak_is_kept(spark):
    df = deliveries(spark, [("x", 1, None), ("x", 50, 2), ("y", 1, None), ("y", 1, 3)] + [("z", 1, None)] * 9)
    for fold in (1000, 3):
        got = dedup.dedup_ttl(df, ["k"], "ts", "i", ttl=100, max_fold=fold).collect()
        assert sorted((r.k, r.i) for r in got) == [("x", None), ("y", 3), ("z", None)]


def test_buckets_of_a_history_grow_with_its_rows():
    assert [history.buckets_for(n) for n in (0, 100_000, 6_000_000, 36_000_000)] == [8, 8, 12, 72]
