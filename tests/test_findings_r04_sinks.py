"""Finding of round 4 on growth: F2 sinks."""

from pyspark.sql import functions as F

from sievelight.functions import sensitive as S
from sievelight.operators import exports as X
from sievelight.plans import q_exports


def test_sinks_make_the_emissions_once(spark, tmp_path, monkeypatch):
    spark.range(30).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value",
        "concat('{\"k\": ', id, '}') AS props").write.parquet(f"{tmp_path}/events.parquet")
    plans, write = [], X.write_emissions

    def watched(df, kind, path):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, kind, path)

    monkeypatch.setattr(X, "write_emissions", watched)
    got = {(r.kind, r.system): r.n for r in q_exports.sinks(spark, str(tmp_path)).collect()}
    assert got == {(k, s): 6 for k in ("table", "sdk", "envelope") for s in ("github", "jira", "slack", "linear", "osv")}
    assert len(plans) == 3 and not any("Generate" in p for p in plans)


def test_label_tokens_are_as_before(spark):
    secret = "npm_" + "a" * 36
    given = ["plain_token", " Mixed Case! ", "", None, "_edge_", "a" * 119, "b" * 140, secret, "x_" + "sk_live_" + "c" * 24, "dob: x", "a\n", "é", "a__b", "a"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    got = [r.t for r in df.select("i", X.label_token(F.col("v"), "none").alias("t")).orderBy("i").collect()]
    assert got == ["plain_token", "mixed_case", "none", "none", "edge", "a" * 119, "b" * 120, "redacted_secret", "x_sk_live_" + "c" * 24,
                   "redacted_phi", "a", "none", "a__b", "a"]


def test_a_placeholder_needs_no_rules(spark):
    df = spark.createDataFrame([("[redacted:phone].x",), ("[redacted:phi] dob: y",), ("mrn: 12345",), ("[redacted: dob:z",)], "v string")
    assert [r.g for r in df.select(S.maybe_any(F.col("v")).alias("g")).collect()] == [False, True, True, True]
    assert [r.t for r in df.select(S.redact(F.col("v")).alias("t")).collect()] == [
        "[redacted:phone].x", "[redacted:phi] [redacted:phi]", "[redacted:phi]", "[redacted: [redacted:phi]"]
