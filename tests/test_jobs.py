import hashlib
import hmac
import json

from pyspark.sql import functions as F

from sievelight.operators import exports, mods, normalize as N, redaction as R
from sievelight.schemas import DELIVERIES, observation_columns
from sievelight.sources import landing
from sievelight.streaming.ingest import deliveries_to_emissions

KEY = "unit-test-key"


def deliveries(spark):
    def row(i, body, good=True):
        raw = json.dumps(body).encode()
        mac = hmac.new(KEY.encode(), raw, hashlib.sha256).hexdigest()
        return ({"x-hub-signature-256": "sha256=" + (mac if good else "0" * 64), "X-GitHub-Delivery": f"d{i}"}, bytearray(raw), i)

    pr = {"action": "opened", "number": 4, "pull_request": {"title": "lgtm", "body": "mail a@b.org", "user": {"login": "renovate[bot]"},
                                                            "base": {"repo": {"full_name": "o/r"}}, "html_url": "https://g/4"}}
    rows = [row(1, pr), row(1, pr), row(2, pr, good=False), row(3, {"zen": "ping"}), row(4, [1])]
    df = spark.createDataFrame(rows, "headers map<string,string>, body binary, s long")
    return df.select("headers", "body", F.timestamp_seconds("s").alias("received_at"))


def check(rows):
    (e,) = rows
    assert e.body == "mail [redacted:email]" and e.delivery_id == "d1"
    assert e.provenance.delivery_mode == "poll" and e.provenance.verification == "unsigned"
    assert [a.kind for a in e.advisories] == ["bot_authored", "dependency_automation"]
    assert e.redaction_receipt.findings == []


def test_batch_ingest(spark):
    check(deliveries_to_emissions(deliveries(spark), "github", KEY)[0].collect())


def test_stream_ingest(spark, tmp_path):
    deliveries(spark).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = landing.read_deliveries(spark, str(tmp_path / "in"), streaming=True)
    emissions, _ = deliveries_to_emissions(stream, "github", KEY)
    schema = emissions.schema
    q = (emissions.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    check(spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())
    assert DELIVERIES


def test_null_identity_and_oversized_rows_are_rejected(spark):
    cols = observation_columns("github", ref=F.col("r"), kind="issue", excerpt=F.col("x"), mode="active")
    df = spark.createDataFrame([("a", "t"), (None, "t"), ("b", "y" * 3000)], "r string, x string").select(*cols)
    good, bad = R.sanitize(df, limit=2000)
    assert [r.source_ref.ref for r in good.collect()] == ["a"]
    assert sorted(r.reason for r in bad.collect()) == ["engine_unavailable", "oversized_payload"]


def test_marked_tables_equal_the_two_outputs(spark, tmp_path):
    from sievelight.operators.exports import write_by_outcome

    cols = observation_columns("github", ref=F.col("r"), kind="issue", excerpt=F.col("x"), mode="active", author=F.lit("bob@example.com"),
                               metadata={"note": F.col("x")})
    texts = [("a", "t"), (None, "t"), ("b", "y" * 3000), ("c", "mail x@y.org"), ("d", ""), ("AKIA" + "A" * 16, "t"), ("e", "ok")]
    df = spark.createDataFrame(texts, "r string, x string").select("r", *cols)
    good, bad = R.sanitize(df, "2024", limit=2000)
    write_by_outcome(R.mark_sanitized(df, "2024", limit=2000), str(tmp_path / "marked"))
    kept, rejected = (spark.read.parquet(str(tmp_path / "marked" / f"outcome={o}")) for o in ("kept", "rejected"))
    assert sorted(map(str, kept.drop("reason").collect())) == sorted(map(str, good.select(*kept.drop("reason").columns).collect()))
    assert sorted(map(str, rejected.drop("redaction_receipt").collect())) == sorted(map(str, bad.select(*rejected.drop("redaction_receipt").columns).collect()))
    valid, rejects = N.normalize(df, completed_at="2024")
    marked = N.mark_normalized(df, completed_at="2024")
    fine = marked.where("reason IS NULL")
    assert sorted(map(str, fine.select(*valid.columns).collect())) == sorted(map(str, valid.collect()))
    assert sorted((r.r or "", r.reason) for r in marked.where("reason IS NOT NULL").collect()) == sorted((r.r or "", r.reason) for r in rejects.collect())
    # One scan of the input, and the screen once.
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Union" not in plan


def test_nested_json_keys_and_leaves(spark):
    doc = json.dumps({"a": {"a@b.org": 1}, "l": ["x@y.org", {"z": "ok"}], "n": 1.5, "u": "é"})
    df = spark.createDataFrame([(doc,), ("{}",), ("not json",), (None,)], "d string")
    got = [r.d for r in R.redact_json(df, "d").collect()]
    assert sorted(g for g in got if g) == sorted([
        doc.replace("x@y.org", "[redacted:email]"), "{}", "not json"])
    keyed = df.where("d IS NOT NULL AND d <> 'not json'").select(
        "d", F.create_map().cast("map<string,string>").alias("metadata"), F.create_map().cast("map<string,string>").alias("evidence_metadata"))
    _, bad = R.reject_sensitive_keys(keyed, ("d",))
    assert [r.reason for r in bad.collect()] == ["sensitive_metadata_key:d"]


def test_redacted_json_keeps_every_other_character(spark):
    from sievelight.functions.json_text import _is_json, value_spans

    doc = ' {"n" : [1.00, -0, 1e400,12345678901234567890.123 , %s],\t"v":"mail x@y.org",\r\n"v":"\\u00e9\\/","a@b.org":true, "h":"\\ud800"}\n' % ("7" * 5000)
    deep = "[" * 100_000 + '"x@y.org"' + "]" * 100_000
    got = [r.d for r in R.redact_json(spark.createDataFrame([(doc,), (deep,)], "d string"), "d").collect()]
    assert sorted(got) == sorted(d.replace("x@y.org", "[redacted:email]") for d in (doc, deep))
    for text in ('{"a":}', "[1,]", "[1 2]", "[01]", '{"a" "b"}', '{"a","b"}', '["a":1]', '"\n"', '"\\x"', "", "nul", "[" * 9 + "]" * 8, "NaN", "{}", ' "s" ', "[[],{}]"):
        assert (value_spans(text) is not None) == _is_json(text), text


def test_repeated_keys_keep_the_last_value(spark):
    from sievelight.sources.landing import split_payloads, with_payload

    rows = with_payload(spark.createDataFrame([('{"a":1,"a":{"b":2,"b":3}}',), ("{",)], "payload string"))
    good, bad = split_payloads(rows)
    assert [r.v for r in good.selectExpr("variant_get(payload_v, '$.a.b', 'int') AS v").collect()] == [3]
    assert [r.reason for r in bad.collect()] == ["unparseable"]


def test_unreadable_json_fails_closed(spark):
    deep = "[" * 100_000 + '"bob@example.com"' + "]" * 100_000
    docs = ['{"a":"bob@example.com","a":"x"}', '{"a":"bob@example.com', '{"a":"bob\\u0040example.com', deep, "ok"]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    got = [r.d for r in R.redact_json(df, "d").collect()]
    assert len(got) == 5 and not any("example.com" in g for g in got) and "ok" in got and R.UNREADABLE in got
    keyed = df.select("d", F.create_map().cast("map<string,string>").alias("metadata"), F.create_map().cast("map<string,string>").alias("evidence_metadata"))
    clean, bad = R.reject_sensitive_keys(keyed, ("d",))
    assert clean.count() == 1 and {r.reason for r in bad.collect()} == {"unreadable_json:d"}


def test_long_domains_are_redacted_whole(spark):
    from sievelight.functions import sensitive as S

    for labels in (1, 140, 9000):
        text = "mail bob@" + "ab." * labels + "com now"
        assert spark.createDataFrame([(text,)], "t string").select(S.redact_pii(F.col("t")).alias("r")).first().r == "mail [redacted:email] now"
    hostile = "x@" + "a." * 100_000 + " and c@" + "a." * 50_000 + "1"
    assert spark.createDataFrame([(hostile,)], "t string").select(S.redact_pii(F.col("t")).alias("r")).first().r == hostile


def test_issue_events_and_rejects_of_the_seam(spark):
    from sievelight.streaming.ingest import delivery_rejects

    def row(i, body, event, good=True):
        raw = body if isinstance(body, bytes) else json.dumps(body).encode()
        mac = hmac.new(KEY.encode(), raw, hashlib.sha256).hexdigest()
        return ({"x-hub-signature-256": "sha256=" + (mac if good else "0" * 64), "X-GitHub-Delivery": f"d{i}", "X-GitHub-Event": event}, bytearray(raw), i)

    issue = {"action": "opened", "repository": {"full_name": "o/r", "id": 5, "node_id": "R5"}, "sender": {"login": "ann", "id": 1, "type": "User"},
             "issue": {"id": 9, "node_id": "I9", "number": 4, "title": "It breaks", "body": "steps", "updated_at": "2024-01-01T00:00:00Z",
                       "html_url": "https://github.com/o/r/issues/4", "user": {"login": "ann", "id": 1, "type": "User"}, "state": "open"}}
    rows = [row(1, issue, "issues"), row(2, issue, "issues", good=False), row(3, issue, "push"), row(4, b"{", "issues"), row(5, b"[" + b" " * (1 << 20) + b"]", "issues")]
    df = spark.createDataFrame(rows, "headers map<string,string>, body binary, s long").select("headers", "body", F.timestamp_seconds("s").alias("received_at"))
    emissions, _ = deliveries_to_emissions(df, "github_issues", KEY)
    assert [(e.delivery_id, e.body) for e in emissions.collect()] == [("d1", "steps")]
    got = {r.headers["X-GitHub-Delivery"]: r.reason for r in delivery_rejects(df, "github_issues", KEY).collect()}
    assert got == {"d2": "signature_rejected", "d3": "not_admitted", "d4": "unparseable_body", "d5": "oversized_body"}


def test_failfast_raises(spark):
    import pytest

    cols = observation_columns("github", ref=F.lit("r"), kind="issue", excerpt=F.lit(" "), mode="active")
    em = N.to_emissions(spark.range(1).select(*cols))
    with pytest.raises(Exception, match="evidence_excerpt_blank"):
        N.validate_emissions(em, "failfast").collect()


def test_custom_mod_is_audited(spark):
    cols = observation_columns("github", ref=F.lit("r"), kind="issue", excerpt=F.lit("uses hipaa"), mode="active")
    em = N.to_emissions(spark.range(1).select(*cols))

    def mine(df):
        return df.select("source_id", F.lit("mine").alias("mod_id"), F.lit("routing_hint").alias("output_type"),
                         F.lit("qa").alias("role"), F.lit("4111" + "1" * 12).alias("reason"), F.lit("low").alias("priority"))

    out = mods.run_mods(em, ["compliance-routing"], custom={"mine": mine})
    assert out.groupBy("mod_id").count().orderBy("mod_id").collect()[1]["count"] == 1
    assert [r.reason for r in mods.audit_outputs(out, mods.manifests(spark)).collect()] == ["undeclared_output_type"]
    assert mods.screen_outputs(out).count() == 1


def test_envelope_of_blank_emission(spark):
    cols = observation_columns("slack", ref=F.lit(" "), kind="message", excerpt=F.lit(" "), mode="webhook")
    (e,) = exports.to_envelopes(N.to_emissions(spark.range(1).select(*cols))).collect()
    assert (e.source_uri, e.content, e.candidate_hints[0].title) == ("slack", "slack", "slack")


def test_modules_import_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) > 150 and set(e.oracle_sql()) <= set(e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=str(__import__("pathlib").Path(__file__).parents[1])).returncode == 0


def test_declared_filters_leave_out_rows_by_the_specs_only(spark, tmp_path, monkeypatch):
    from sievelight.plans import q_sources

    rows = [(i, ["Sing", "Rechnung", "token sing", "plain"][i % 4], ["en", "de", "fr"][i % 3], f"src{i % 5}", [100, 200, 8999, 9000][i // 60 % 4])
            for i in range(480)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    apply, seen = q_sources.filters.apply_filters, []

    def counted(df, *args, **names):
        seen.append(df.count())
        return apply(df, *args, **names)

    monkeypatch.setattr(q_sources.filters, "apply_filters", counted)
    got = sorted(r["doc_id"] for r in q_sources.declared_filters(spark, str(tmp_path)).collect())
    assert got == [i for i, text, lang, source, n in rows if text in ("Sing", "Rechnung") and lang != "fr" and source != "src3" and 200 <= n < 9000]
    # The operator gets every row, and src3 reaches the second spec.
    assert seen[0] == len(rows) and seen[1] == len([r for r in rows if r[1] in ("Sing", "Rechnung") and r[2] != "fr" and 200 <= r[4] < 9000])
