"""Findings F13 to F16 and F23 of round 3: what a row of the text rules, or a payload, pays."""

from pyspark.sql import functions as F

from sievelight.functions import sensitive as S, variant as V
from sievelight.functions.text import each_once
from sievelight.operators import observe


def test_placeholders_are_no_health_labels(spark):
    labels = ["mrn: 1", "medical record =", "record number :", "patient_id:", "patient_name:", "Patient_Email =", "date_of_birth:", "DOB:", "ſſn:", "social_security:"]
    texts = [f"pre [redacted:{c}] post" for c in ("secret", "phi", "pan", "email", "phone")]
    rows = spark.createDataFrame([(t,) for t in labels + texts], "t string").select("t", S._maybe_phi(F.col("t")).alias("maybe")).collect()
    assert all(r.maybe == (r.t in labels) for r in rows), rows


def test_equal_leaves_are_redacted_once(spark):
    calls = each_once(F.col("a"), lambda v: F.struct(v.alias("v"), F.uuid().alias("call")))
    (row,) = spark.createDataFrame([(["x", None, "y", "x", "", "y"],)], "a array<string>").select(calls.alias("r")).collect()
    assert [r.v for r in row.r] == ["x", "", "y", "x", "", "y"]
    assert len({(r.v, r.call) for r in row.r}) == 3


def test_counts_of_placeholders_are_counts_of_matches(spark):
    key, pat, mail = "AKIA" + "A" * 16, "ghp_" + "a" * 36, "a@b.co"
    cases = {
        f"{key} {key}": (0, 0, 2), f"{key} {pat} task-x": (0, 0, 2), "task-x " + pat: (0, 0, 1), "task-x glpat-": (0, 0, 0),
        f"[redacted:email] {mail} {mail}": (0, 2, 0), "[redacted:phone] 555-123-4567, 555-123-4568 tel 1-2-3-4-5-6-7": (0, 3, 0),
        f"[redacted:secret] {key} mrn: 12345 dob=x": (0, 2, 1), "1234567x": (0, 0, 0)}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select(
        "t", S.redact_with_findings(F.col("t")).alias("f"), S.redact(F.col("t")).alias("r")).collect()
    for r in rows:
        assert (r.f.credential, r.f.pii, r.f.secret) == cases[r.t] and r.f.text == r.r, r


def test_payloads_are_parsed_once(spark):
    rows = spark.createDataFrame([(1, '{"runs":[{"tool":{"driver":{"name":"t"}},"results":[{"ruleId":"R"},{"ruleId":"S","level":"note"}]}]}'), (2, "[]"), (
        3, '{"runs":[{"results":[{"ruleId":"R"},{"message":"no object"}]}]}')], "id long, payload string")
    out = observe.observe_sarif(rows.withColumn("payload_v", F.try_parse_json("payload")))
    got = out.select("id", "title", F.col("metadata")["tool"].alias("tool"), F.col("metadata")["level"].alias("level")).collect()
    assert sorted(map(tuple, got)) == [(1, "R", "t", ""), (1, "S", "t", "note")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 1


def test_type_tests_do_not_spell_out_the_value(spark):
    docs = ['{"a":{}}', '{"a":{"x":[1]}}', '{"a":[]}', '{"a":[1,{"b":2},{}]}', '{"a":"{}"}', '{"a":1}', '{"a":null}', "{}", "[]", "null", "bad"]
    rows = spark.createDataFrame([(d,) for d in docs], "t string").select("t", F.try_parse_json("t").alias("v"))
    out = rows.select("t", V.is_object(F.col("v"), "$.a").alias("o"), F.size(V.array(F.col("v"), "$.a")).alias("n"), F.size(V.objects(F.col("v"), "$.a")).alias("m"))
    want = {docs[0]: (True, 0, 0), docs[1]: (True, 0, 0), docs[3]: (False, 3, 2)}
    assert all((r.o, r.n, r.m) == want.get(r.t, (False, 0, 0)) for r in out.collect())
    assert "schema_of_variant" not in out._jdf.queryExecution().analyzed().toString().lower()
