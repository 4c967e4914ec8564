"""Queries for provenance, advisories, contract and screen (operators F1-F13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.operators import normalize as N
from sievelight.plans.common import SQL_K, element, k_of, spread, sql_element, table, with_k
from sievelight.plans.q_redaction import CARDS, TOKENS, secrets, tracked
from sievelight.schemas import SIGNAL, observation_columns

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


MODES = ["webhook", "active", "passive", "discovery", "other"]
AUTHORS = ["alice", "", "renovate[bot]", "Dependabot-x", "bob[BOT]"]
BODIES = ["plain words", " LGTM ", "<!-- note --> x", "uses the Issue Template here", "closed", "long text"]
SOURCES = ["github", "jira", "slack", "linear", "osv"]
# Signals per event: (code, scope, basis, confidence, effect, version); "-" = the signal has no value there.
SIGNALS = [
    ("Custom Code!", "-", "rule one", "-", "-", "1"), ("", "-", "-", "-", "-", "1"),
    ("x", "galaxy", "-", "-", "-", "1"), ("x", "-", "-", "sure", "-", "1"), ("x", "-", "-", "-", "drop", "1"),
    ("x", "universal", "-", "high", "route", "2"), ("status_only", "universal", "-", "low", "annotate", "1"),
]


def _signal(index):
    def field(pos: int):
        value = element([s[pos] for s in SIGNALS], index)
        return F.when(value != "-", value)

    return F.struct(
        field(0).alias("code"), field(1).alias("scope"), field(2).alias("basis"), field(3).alias("confidence"),
        field(4).alias("recommended_effect"), F.lit(None).cast("string").alias("explanation"),
        field(5).alias("schema_version"))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    df = with_k(spread(table(spark, sf, "events")))
    eid = F.col("event_id").cast("string")
    k = F.col("k")
    flag = lambda n, v: F.when(k % n == 0, F.lit(v)).otherwise(F.lit(""))
    signals = F.array(_signal(k), _signal(k + 3))
    cols = observation_columns(
        "github", ref=F.concat(F.lit("R-"), eid), kind="issue", excerpt=element(BODIES, k), mode=element(MODES, k),
        title=F.concat(F.lit("T "), F.col("event_type")), author=element(AUTHORS, F.col("event_id")),
        provider_event_id=F.concat(F.lit("1718033988.0001-"), eid),
        provider_resource_id=F.when(k % 2 == 0, F.concat(F.lit("mail"), eid, F.lit("@example.org"))).otherwise(F.lit("")),
        evidence_id=F.concat(F.lit("e:"), eid),
        metadata={"duplicate_delivery": flag(5, "false"), "stale_source": flag(7, "yes"),
                  "generated_sync_event": flag(11, "1"), "source_trust": flag(3, " LOW "), "actor_type": flag(13, "Bot")},
        advisory_signals=F.when(k % 4 < 2, signals).cast(f"array<{SIGNAL}>"))
    source = F.struct(element(SOURCES, k).alias("source_id"), F.col("source_ref.ref"), F.col("source_ref.url"),
                      F.col("source_ref.kind"))
    return df.select("event_id", "event_type", "k", *cols).withColumn("source_ref", source)


_CTE = f"WITH e AS (SELECT event_id, event_type, {SQL_K} AS k, CAST(event_id AS VARCHAR) AS eid FROM events) "


@query(_CTE + f"""SELECT event_id, CASE {sql_element(MODES, 'k')} WHEN 'webhook' THEN 'webhook' WHEN 'passive' THEN 'active-fetch'
  ELSE 'poll' END AS delivery_mode, CASE WHEN k % 5 = 0 THEN 'signed' ELSE 'unsigned' END AS verification,
  '[redacted:phone].0001-' || eid AS provider_event_id,
  CASE WHEN k % 2 = 0 THEN '[redacted:email]' ELSE 'R-' || eid END AS provider_resource_id FROM e""")
def provenance(spark, sf):
    """Ids pass through redaction, so a ten-digit run inside an event id is scrubbed."""
    return N.with_provenance(observations(spark, sf)).select("event_id", "provenance.*")


@query(_CTE + f"""SELECT {sql_element(SOURCES, 'k')} || '/' || CASE k % 5 WHEN 0 THEN '0.2.0' WHEN 1 THEN '0.1.0' WHEN 2 THEN '0.1.0'
  WHEN 3 THEN '1.4.2' ELSE '0.1.0' END AS adapter_version, count(*) AS n FROM e GROUP BY 1""")
def adapter_versions(spark, sf):
    """A missing row and an empty version both fall back to the baseline."""
    descriptors = table(spark, sf, "nation").where("n_nationkey < 3").select(
        element(["github", "jira", "linear"], F.col("n_nationkey")).alias("source_id"),
        element(["0.2.0", "", "1.4.2"], F.col("n_nationkey")).alias("version"))
    return N.with_version(observations(spark, sf), descriptors).groupBy("adapter_version").agg(F.count("*").alias("n"))


@query(_CTE + f"""SELECT event_id, {sql_element(SOURCES, 'k')} AS source_id, {sql_element(BODIES, 'k')} AS body,
  {sql_element(BODIES, 'k')} AS excerpt, 'evidence' AS emission_type, {sql_element(SOURCES, 'k')} || '/0.1.0' AS adapter_version,
  1 AS n_evidence, 'e:' || eid AS evidence_id FROM e""")
def emissions(spark, sf):
    return N.to_emissions(observations(spark, sf)).select(
        "event_id", "source_id", "body", F.get("evidence", F.lit(0))["excerpt"].alias("excerpt"), "emission_type",
        "adapter_version", F.size("evidence").alias("n_evidence"), F.get("evidence", F.lit(0))["evidence_id"].alias("evidence_id"))


def _flat_advisories(df: DataFrame, col: str = "advisories") -> DataFrame:
    return df.select("event_id", F.posexplode(col).alias("pos", "a")).select(
        "event_id", "pos", "a.kind", F.col("a.metadata")["scope"].alias("scope"),
        F.col("a.metadata")["basis"].alias("basis"), F.col("a.metadata")["confidence"].alias("confidence"),
        F.col("a.metadata")["recommended_effect"].alias("effect"))


def _sql_signal(index: str) -> str:
    """Kind, scope, basis, confidence and effect of a signal, by its place in the list."""
    err = lambda why: ("heuristic_schema_error", "universal", why, "high", "annotate")
    results = [
        ("custom_code", "integration", "rule_one", "medium", "annotate"), err("advisory_code_missing"),
        err("advisory_scope_invalid"), err("advisory_confidence_invalid"), err("advisory_effect_invalid"),
        err("advisory_schema_version_invalid"), ("status_only", "universal", "integration_rule", "low", "annotate"),
    ]
    names = ("kind", "scope", "basis", "confidence", "effect")
    return ", ".join(f"{sql_element([r[i] for r in results], index)} AS {n}" for i, n in enumerate(names))


@query(_CTE + f"""SELECT event_id, 0 AS pos, {_sql_signal('k')} FROM e WHERE k % 4 < 2
UNION ALL SELECT event_id, 1, {_sql_signal('k + 3')} FROM e WHERE k % 4 < 2""")
def integration_advisories(spark, sf):
    em = N.to_emissions(observations(spark, sf)).withColumn("found", N.integration_advisories())
    return _flat_advisories(em, "found")


_UNIVERSAL = _CTE + f""", a AS (SELECT *, lower(trim({sql_element(AUTHORS, 'event_id')})) AS author,
  lower(trim({sql_element(BODIES, 'k')})) AS body FROM e),
u AS (
  SELECT event_id, 0 AS ord, 'bot_authored' AS kind, 'provider_actor_type_or_author_suffix' AS basis, 'high' AS confidence, 'annotate' AS effect
    FROM a WHERE k % 13 = 0 OR author LIKE '%[bot]'
  UNION ALL SELECT event_id, 1, 'dependency_automation', 'known_dependency_automation_identity', 'high', 'rank_lower'
    FROM a WHERE contains(author, 'dependabot') OR contains(author, 'renovate')
  UNION ALL SELECT event_id, 2, 'status_only', 'exact_status_vocabulary', 'high', 'rank_lower' FROM a
    WHERE body IN ('lgtm','approved','done','fixed','closed')
  UNION ALL SELECT event_id, 3, 'template_dominant', 'template_marker', 'medium', 'rank_lower' FROM a
    WHERE body LIKE '<!--%' OR contains(body, 'issue template')
  UNION ALL SELECT event_id, 4, 'duplicate_delivery', 'connector_delivery_identity', 'high', 'annotate' FROM a WHERE k % 5 = 0
  UNION ALL SELECT event_id, 5, 'generated_sync_event', 'connector_sync_marker', 'high', 'rank_lower' FROM a WHERE k % 11 = 0
  UNION ALL SELECT event_id, 6, 'stale_source', 'connector_freshness_marker', 'high', 'route' FROM a WHERE k % 7 = 0
  UNION ALL SELECT event_id, 7, 'low_source_trust', 'connector_source_trust_marker', 'medium', 'route' FROM a WHERE k % 3 = 0)
"""


@query(_UNIVERSAL + """SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY ord) - 1 AS INTEGER) AS pos, kind,
  'universal' AS scope, basis, confidence, effect FROM u""")
def universal_advisories(spark, sf):
    em = N.to_emissions(observations(spark, sf)).withColumn("found", N.universal_advisories())
    return _flat_advisories(em, "found")


@query(_UNIVERSAL + f""", i AS (SELECT event_id, 0 AS ord, {_sql_signal('k')} FROM e WHERE k % 4 < 2
  UNION ALL SELECT event_id, 1 AS ord, {_sql_signal('k + 3')} FROM e WHERE k % 4 < 2),
m AS (SELECT event_id, ord, kind, scope, basis, confidence, effect FROM i UNION ALL
  SELECT event_id, 10 + ord, kind, 'universal', basis, confidence, effect FROM u
  WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.event_id = u.event_id AND i.kind = u.kind)),
d AS (SELECT *, row_number() OVER (PARTITION BY event_id, kind, scope ORDER BY ord) AS rn FROM m)
SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY ord) - 1 AS INTEGER) AS pos, kind, scope, basis,
  confidence, effect FROM d WHERE rn = 1""")
def merged_advisories(spark, sf):
    return _flat_advisories(N.with_advisories(N.to_emissions(observations(spark, sf))))


_DEFECT_IDS = ["github", "bad id!", "x" * 129]


def _defective(spark: SparkSession, sf: str) -> DataFrame:
    """Emissions with one broken rule each, by ``k % 10``; the excerpts hold sensitive values by event."""
    k = F.col("k")
    em = N.to_emissions(tracked(spark, sf).join(
        table(spark, sf, "events").select("event_id", k_of().alias("k")), "event_id"))
    is_ = lambda n: k % 10 == n
    blank = F.lit("​ ﻿\t")
    excerpt = F.when(is_(4), blank).when(is_(9), F.get("evidence", F.lit(0))["excerpt"]).otherwise(F.lit("fine"))
    ev = F.transform("evidence", lambda e: e.withField("excerpt", excerpt).withField("metadata", F.create_map(F.lit("a"), F.lit("b"))))
    conf = F.when(is_(8), F.named_struct(
        F.lit("dimensions"), F.create_map().cast("map<string,string>"), F.lit("rationale"), F.lit("r")))
    return em.withColumns({
        "source_id": F.when(is_(1), F.lit(_DEFECT_IDS[1])).when(is_(2), F.lit(_DEFECT_IDS[2])).otherwise(F.col("source_id")),
        "body": F.lit("fine"), "metadata": F.create_map(F.lit("a"), F.lit("b")),
        "evidence": F.when(is_(3), F.array().cast(em.schema["evidence"].dataType)).otherwise(ev),
        "adapter_version": F.when(is_(5), F.lit(" ")).otherwise(F.col("adapter_version")),
        "emission_type": F.when(is_(6), F.lit("fact")).otherwise(F.col("emission_type")),
        "confidence": conf.cast(em.schema["confidence"].dataType),
    })


_REASONS = ["ok", "source_id_invalid", "source_id_too_long", "evidence_required", "evidence_excerpt_blank",
            "adapter_version_required", "emission_type_invalid", "ok", "confidence_not_dimensional"]
_VERDICT = f"""WITH e AS (SELECT event_id, event_type, {SQL_K} AS k FROM events),
v AS (SELECT *, CASE WHEN k % 10 < 9 THEN ({_REASONS})[1 + k % 10] WHEN k % 20 = 9 THEN 'secret' ELSE 'ok' END AS verdict FROM e)
"""


@query(_VERDICT + "SELECT event_id, verdict FROM v")
def emission_contract(spark, sf):
    """Broken rules by name; a sensitive hit by its class."""
    good, bad = N.validate_emissions(_defective(spark, sf))
    label = F.when(F.col("reason").startswith("sensitive_data:"), F.regexp_extract("reason", r"^sensitive_data:(\w+)", 1)).otherwise(
        F.col("reason"))
    return good.select("event_id", F.lit("ok").alias("verdict")).unionByName(
        bad.select("event_id", label.alias("verdict")))


@query(TOKENS + """SELECT event_id, 'sensitive_data:' || CASE WHEN k % 20 < 12 THEN 'secret' WHEN k % 20 < 14 THEN 'phi' ELSE 'pan' END
  || ' (pattern=' || CASE WHEN k % 20 < 12 THEN k % 20 WHEN k % 20 = 13 THEN 1 ELSE 0 END || ', excerpt='''
  || CASE WHEN k % 20 < 12 THEN left(tok, 4) || repeat('*', CAST(least(length(tok), 64) - 8 AS INTEGER)) || right(left(tok, 64), 4)
     WHEN k % 20 < 14 THEN '[phi:redacted]' ELSE '[pan:redacted]' END || ''', catalog=v1)' AS screen_reason FROM r WHERE k % 20 <= 14""")
def sensitive_screen(spark, sf):
    """Masked reasons of unredacted emissions; clean ones have none."""
    rows = N.screen(N.to_emissions(tracked(spark, sf)))
    return rows.where("screen_reason IS NOT NULL").select("event_id", "screen_reason")


@query(_VERDICT + """, b AS (SELECT *, event_id // 4 AS batch FROM v),
bad AS (SELECT batch FROM b WHERE verdict <> 'ok' GROUP BY 1)
SELECT batch, count(*) AS n FROM b WHERE batch NOT IN (SELECT batch FROM bad) GROUP BY 1""")
def batch_rejection(spark, sf):
    """One broken emission rejects its batch of four."""
    em = _defective(spark, sf).withColumn("batch", F.floor(F.col("event_id") / 4))
    marked = em.withColumn("reason", F.coalesce(N.contract_reason(), N.screen_reason(N.emission_leaves())))
    clean, _ = N.gate_batches(marked.select("event_id", "batch", "reason"), "batch")
    return clean.groupBy("batch").agg(F.count("*").alias("n"))


@query(f"""
WITH e AS (SELECT event_id, user_id, {SQL_K} AS k FROM events)
SELECT event_id, 'order_id: ' AS first, CASE WHEN true THEN 'pan' END AS cls FROM e""")
def split_label_screen(spark, sf):
    """A label that ends the title does not excuse a card number that starts the body."""
    df = secrets(spark, sf)
    cols = observation_columns("github", ref=F.lit("r"), kind="issue", excerpt=element(CARDS, F.col("event_id")),
                               mode="active", title=F.lit("order_id: "))
    em = N.to_emissions(df.select("event_id", *cols))
    return N.screen(em).select(
        "event_id", F.col("title").alias("first"),
        F.regexp_extract("screen_reason", r"^sensitive_data:(\w+)", 1).alias("cls"))


@query(f"""
WITH e AS (SELECT event_id, event_type, {SQL_K} AS k FROM events)
SELECT event_type, count(*) FILTER (k % 10 NOT IN (3, 7) OR (k % 10 = 3 AND k % 20 > 14)) AS emitted,
  count(*) FILTER (k % 10 = 7 OR (k % 10 = 3 AND k % 20 <= 14)) AS rejected FROM e GROUP BY 1""")
def normalized_outcomes(spark, sf):
    """The whole seam over hostile observations."""
    rows = N.mark_normalized(tracked(spark, sf, hostile=True), completed_at="2024-01-01T00:00:00Z")
    return rows.groupBy("event_type").agg(
        F.count_if(F.col("reason").isNull()).alias("emitted"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
