"""Finding of round 4 on growth: F1 phase_traces."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from sievelight.functions.canonical import canonical, json_object
from sievelight.operators import audits as K, normalize as N
from sievelight.schemas import SIGNAL, observation_columns


def test_neighbours_are_found_with_one_shuffle_and_rows_are_made_once(spark, tmp_path):
    spark.range(10).selectExpr("id % 3 AS g", "CAST(id AS INT) AS pos", "id AS v").write.parquet(f"{tmp_path}/t")
    plan = K.previous_row(spark.read.parquet(f"{tmp_path}/t"), ["g"], "pos", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_neighbours_are_those_of_an_equi_join(spark, monkeypatch):
    monkeypatch.setattr(K, "RUN", 4)
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([*range(-6, 14), None]), rng.choice(["x", "y", None]), i) for i in range(120)]
    rows += [("long", i, str(i), 1000 + i) for i in range(50)]
    got = K.previous_row(spark.createDataFrame(rows, "g string, pos int, v string, i int"), ["g"], "pos", ["v"])
    want = []
    for g, p, v, i in rows:
        before = [r for r in rows if None not in (g, p, r[1]) and r[0] == g and r[1] == p - 1]
        want += [(g, p, v, i, r[2], True) for r in before] or [(g, p, v, i, None, False)]
    assert sorted(map(str, (tuple(r) for r in got.select("g", "pos", "v", "i", "prev_v", "has_prev").collect()))) == sorted(map(str, want))


def traced(spark):
    """A plain row, one with signals, one with flags, one with text that JSON escapes."""
    rows = spark.createDataFrame(
        [(0, "plain"), (1, "signals"), (2, "flags"), (3, 'esc "\\\t\x0b\x1f é \U0001f600 [x] {y}')], "trace_id long, text string")
    signal = F.array(F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(
        ("code", "scope", "basis", "confidence", "recommended_effect", "explanation", "schema_version"),
        ("x", None, "b", None, None, None, "1"))]))
    cols = observation_columns(
        "slack", ref=F.lit("R"), kind="message", excerpt=F.col("text"), mode="webhook", title=F.col("text"),
        evidence_metadata={"z": F.col("text"), "a": F.lit(None)}, metadata={"note": F.col("text"), "actor_type": F.lit("bot")},
        advisory_signals=F.when(F.col("trace_id") == 1, signal).cast(f"array<{SIGNAL}>"))
    obs = rows.select("trace_id", *cols).withColumn("metadata", F.when(
        F.col("trace_id") == 2, F.create_map(F.lit("tombstone"), F.lit("true"))).otherwise(F.col("metadata")))
    packed = obs.withColumn("o", F.struct(*[c for c in obs.columns if c != "trace_id"]))
    em = N.with_advisories(N.to_emissions(packed))
    return em.withColumn("provenance", F.when(F.col("trace_id") != 3, F.col("provenance"))).withColumn("e", F.struct(
        "source_id", "title", "body", "evidence", "emission_type", "adapter_version", "advisories", "provenance", "metadata", "advisory_signals"))


def test_phase_documents_are_the_fields_encoded_one_by_one(spark):
    rows = traced(spark).select(
        "trace_id", "o", "e", F.lit("{}").alias("envelope_json"), json_object(
            K.emission_fields("e.") | {"advisories": K._advisory_json(F.col("e.advisories"))}).alias("whole"))
    trace = K.phase_trace(rows, delivery=None).where("phase_id = 'PHASE-07-UNIVERSAL-ADVISORIES'")
    both = trace.join(rows.select("trace_id", "whole", canonical(F.col("whole")).alias("text")), "trace_id").collect()
    assert len(both) == 4 and all(r.output_data == r.whole for r in both)
    assert all(r.output_digest == "sha256:" + hashlib.sha256(r.text.encode()).hexdigest() for r in both)
    assert [json.loads(r.output_data)["provenance"] is None for r in sorted(both, key=lambda r: r.trace_id)] == [False, False, False, True]


def test_each_document_of_a_trace_has_one_digest(spark):
    rows = traced(spark).select("trace_id", "o", "e", F.lit("{}").alias("envelope_json"), F.lit("{}").alias("c"), F.lit('{"status":201}').alias("d"))
    trace = K.phase_trace(rows, capture="c", delivery="d")
    assert trace._jdf.queryExecution().analyzed().toString().count("sha2(") == 8
    links = {(r.trace_id, r.pos): r for r in trace.collect()}
    assert len(links) == 28 and all(links[t, p].input_digest == links[t, p - 1].output_digest for t, p in links if p)
