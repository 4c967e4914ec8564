"""Queries for envelopes, labels, evidence rows and sinks (operators H1-H6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievelight.operators import exports as X, normalize as N, redaction as R
from sievelight.plans.common import SQL_K, element, k_of, kept, run_folder, sql_element, table
from sievelight.plans.q_normalize import BODIES, MODES, ORACLES as NORMALIZED, SOURCES, observations
from sievelight.plans.q_redaction import TOKENS, tracked

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


_CTE = f"WITH e AS (SELECT event_id, event_type, {SQL_K} AS k, CAST(event_id AS VARCHAR) AS eid FROM events) "


def emissions(spark, sf):
    return N.with_advisories(N.to_emissions(observations(spark, sf)))


@query(_CTE + f"""SELECT event_id, {sql_element(SOURCES, 'k')} AS source_system, CASE WHEN k % 3 = 0 THEN 'https://x/' || eid || '?m=[redacted:email]'
  WHEN k % 3 = 1 THEN {sql_element(SOURCES, 'k')} || ':R-' || eid ELSE {sql_element(SOURCES, 'k')} END AS source_uri,
  CASE WHEN k % 4 = 0 THEN trim({sql_element(BODIES, 'k')}) WHEN k % 4 = 1 THEN 'T ' || event_type ELSE trim({sql_element(BODIES, 'k')}) END AS content,
  CASE WHEN k % 4 = 2 THEN trim({sql_element(BODIES, 'k')}) ELSE 'T ' || event_type END AS title, 1 AS n_evidence FROM e""")
def envelopes(spark, sf):
    """Fallback chains: blank bodies (k%4=1) and blank titles (k%4=2); urls, refs or neither."""
    k, eid = F.col("k"), F.col("event_id").cast("string")
    obs = observations(spark, sf)
    ref = F.struct(
        F.col("source_ref.source_id").alias("source_id"),
        F.when(k % 3 == 2, F.lit(" ")).otherwise(F.concat(F.lit("R-"), eid)).alias("ref"),
        F.when(k % 3 == 0, F.concat(F.lit("https://x/"), eid, F.lit("?m=a@b.org"))).otherwise(F.lit("")).alias("url"),
        F.col("source_ref.kind").alias("kind"))
    em = N.to_emissions(obs.withColumn("source_ref", ref).withColumn(
        "title", F.when(k % 4 == 2, F.lit(" ")).otherwise(F.col("title"))))
    em = em.withColumn("body", F.when(F.col("k") % 4 == 1, F.lit("\n")).otherwise(F.col("body")))
    out = X.to_envelopes(em)
    hint = F.get("candidate_hints", F.lit(0))
    return out.select("event_id", "source_system", "source_uri", "content", hint["title"].alias("title"),
                      F.size("evidence").alias("n_evidence"))


@query("WITH m AS (" + NORMALIZED["merged_advisories"] + "), " + _CTE.removeprefix("WITH ") + f"""
SELECT event_id, 'emission_type:evidence' AS label FROM e
UNION ALL SELECT event_id, 'advisory:' || kind FROM m
UNION ALL SELECT event_id, 'advisory_v1:' || kind || ':' || scope || ':' || confidence || ':' || effect || ':' || basis FROM m
UNION ALL SELECT event_id, 'delivery:' || CASE {sql_element(MODES, 'k')} WHEN 'webhook' THEN 'webhook' WHEN 'passive' THEN 'active-fetch'
  ELSE 'poll' END FROM e
UNION ALL SELECT event_id, 'verification:' || CASE WHEN k % 5 = 0 THEN 'signed' ELSE 'unsigned' END FROM e
UNION ALL SELECT event_id, 'provider_event_id:[redacted:phone].0001-' || eid FROM e
UNION ALL SELECT event_id, 'provider_resource_id:' || CASE WHEN k % 2 = 0 THEN '[redacted:email]' ELSE 'R-' || eid END FROM e""")
def envelope_labels(spark, sf):
    return emissions(spark, sf).select("event_id", F.explode(X.envelope_labels(None)).alias("label"))


@query("""SELECT event_id, 'redaction:v1,redaction_ruleset:fx-sec-001-plus-pii-v1' AS labels FROM events""")
def receipt_labels(spark, sf):
    clean, _ = R.sanitize(tracked(spark, sf))
    labels = X.envelope_labels("redaction_receipt")
    return N.to_emissions(clean).select(
        "event_id", F.array_join(F.filter(labels, lambda x: x.startswith("redaction")), ",").alias("labels"))


@query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id, CASE k % 5 WHEN 1 THEN 'level' WHEN 2 THEN 'content_hash' ELSE 'snapshot_content' END AS owned_field
FROM e WHERE k % 5 IN (1, 2, 4)""")
def owned_fields(spark, sf):
    """Landed envelopes that carry receiver-owned fields, at the top or inside a hint."""
    cases = ['{"content":"a","candidate_hints":[{"title":"t"}]}', '{"level":2,"snapshot_content":"x"}',
             '{"candidate_hints":[{"title":"t"},{"level":1,"content_hash":"h"}]}', '{"metadata":{"level":1}}',
             '{"snapshot_content":null}']
    rows = table(spark, sf, "events").select("event_id", element(cases, k_of()).alias("doc"))
    return X.audit_envelopes(rows, "doc").select("event_id", "owned_field")


@query("SELECT event_id, CAST(NULL AS VARCHAR) AS owned_field FROM events WHERE false")
def envelope_authority(spark, sf):
    """Our own envelopes have none of the owned fields, by schema."""
    return X.audit_envelopes(X.to_envelopes(emissions(spark, sf))).select("event_id", "owned_field")


@query(TOKENS + """SELECT event_id, 'slack:' || event_id AS id, 'slack' AS system, 'R-' || event_id AS resource, 'raw' AS status,
  'sha256:' || sha256(clean) AS source_hash, 'connector' AS actor, '2024-01-01' AS captured_at, 'slack/0.1.0' AS version FROM r""")
def sdk_evidence(spark, sf):
    clean, _ = R.sanitize(tracked(spark, sf))
    good, _ = X.to_sdk_evidence(N.to_emissions(clean), keys=["event_id"])
    return good.select(
        "event_id", "id", F.col("source.system").alias("system"), F.col("source.resourceId").alias("resource"), "status",
        F.col("provenance.sourceHash").alias("source_hash"), F.col("provenance.capturedBy.actorType").alias("actor"),
        F.col("capturedAt").alias("captured_at"), F.col("provenance.pipelineVersion").alias("version"))


@query(TOKENS + """SELECT event_id, CASE WHEN k % 20 < 12 THEN 'secret' WHEN k % 20 < 14 THEN 'phi' ELSE 'pan' END AS cls
FROM r WHERE k % 20 <= 14""")
def sdk_evidence_rejects(spark, sf):
    """Unredacted observations are screened again at the export."""
    _, bad = X.to_sdk_evidence(tracked(spark, sf), keys=["event_id"])
    return bad.select("event_id", F.regexp_extract("reason", r"^sensitive_data:(\w+)", 1).alias("cls"))


@query(_CTE + f"""SELECT 'table' AS kind, {sql_element(SOURCES, 'k')} AS system, count(*) AS n FROM e GROUP BY ALL
UNION ALL SELECT 'sdk', {sql_element(SOURCES, 'k')}, count(*) FROM e GROUP BY ALL
UNION ALL SELECT 'envelope', {sql_element(SOURCES, 'k')}, count(*) FROM e GROUP BY ALL""")
def sinks(spark, sf):
    """Write each sink below the shared folder and count what comes back."""
    folder = run_folder(spark)
    em = kept(emissions(spark, sf), f"{folder}/emissions")
    out = None
    for kind, col in (("table", "source_id"), ("sdk", "system"), ("envelope", "source_system")):
        path = f"{folder}/{kind}"
        X.write_emissions(em, kind, path)
        back = spark.read.json(path) if kind == "envelope" else spark.read.parquet(path)
        rows = back.groupBy(F.col(col).alias("system")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "system", "n")
        out = rows if out is None else out.unionByName(rows)
    return out
