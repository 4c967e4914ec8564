"""Queries for the advisory mods (operators G1-G27): one per mod, over emissions derived from all events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.operators import mods as M
from sievelight.operators import terms as T
from sievelight.plans.common import SQL_K, element, k_of, meta_text, spread, sql_element, sql_list, sql_text, table, with_k
from sievelight.schemas import ADVISORY, EVIDENCE, HINT, PROVENANCE, SIGNAL

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


# Phrases the bodies are made of: vocabulary of every mod next to words that only look like it.
PHRASES = [
    "the author wrote prose", "TODO and fixme", "an untested stub", "double-check this", "force push to main", "sudo rm -rf",
    "signoff needed", "the migration adds ddl", "oauth token", "a Dockerfile", "drop table users", "breaking change ahead",
    "HIPAA and PCI DSS", "soxhlet filter", "iso 27001 audit evidence", "deprecated api", "will be removed", "uses v2",
    "api version bump", "see github.com/x", "asked in slack.com", "jira board", "confidential plan", "Do Not  Share",
    "[redacted:email] wrote", "internal only", "the adr was superseded", "stale decision", "requirements.txt changed",
    "go.mod and Cargo.toml", "@here please", "mass email", "security policy", "readme changelog", "prefix latest contest",
    "waiver granted", "wontfix", "accepted risk", "tls certificate", "credential leak", "fixed a bug", "new endpoint",
    "has a unit test", "pytest coverage", "webhook replay", "svix missing signature", "spoof", "plain words here",
    "auth_token inside", "governance ledger", "nothing to see", "retired service", "hotfix for parser", "exempt from review",
    "the quadratic cadre", "gh-pages", "docs/ update", "nda signed", "page everyone now", "recorded decision revoked",
]
SOURCES = ["github", "slack", "aider", "mcp_registry", "jira", "osv", "bad id!", "cursor", "fathom"]
KINDS = ["pull_request", "message", "commit", "mcp_server", "issue", "vulnerability", "", "merge_request", "meeting"]
AUTHORS = ["alice", "", "  ", "bob"]
TYPES = ["evidence", "evidence", "hint", "evidence", "advisory"]
P = len(PHRASES)


def emissions(spark: SparkSession, sf: str) -> DataFrame:
    df = with_k(spread(table(spark, sf, "events")))
    eid, e = F.col("event_id").cast("string"), F.col("event_id")
    body = F.concat_ws(" and ", element(PHRASES, e), element(PHRASES, e * 7 + F.col("k")))
    ref = F.when(e % 13 == 0, F.lit(" ")).otherwise(F.concat(F.lit("R-"), eid))
    url = F.when(e % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("https://x/"), eid))
    excerpt = F.when(e % 17 == 0, F.lit(" ")).otherwise(F.col("body"))
    evidence = F.when(e % 29 == 0, F.array().cast(f"array<{EVIDENCE}>")).otherwise(F.array(F.struct(
        F.struct(element(SOURCES, e).alias("source_id"), ref.alias("ref"), url.alias("url"), element(KINDS, e).alias("kind"))
        .alias("source_ref"),
        excerpt.alias("excerpt"), element(AUTHORS, e).alias("author"), F.lit("").alias("timestamp"),
        F.concat(F.lit("e"), eid).alias("evidence_id"), F.create_map(F.lit("a"), F.lit("b")).alias("metadata"),
    )).cast(f"array<{EVIDENCE}>"))
    metadata = F.create_map(
        F.lit("packages"), F.when(e % 3 == 0, F.lit("")).otherwise(F.lit("pkg-a,pkg-b")), F.lit("severity"), F.lit("CVSS:9"),
        F.lit("aliases"), F.when(e % 4 == 0, F.lit("X-1, ghsa-2")).otherwise(F.lit("X-1")))
    return df.withColumn("body", body).select(
        "event_id", element(SOURCES, e).alias("source_id"), element(PHRASES, e + 11).alias("title"), "body",
        evidence.alias("evidence"), element(TYPES, e).alias("emission_type"), F.lit("x/0.1.0").alias("adapter_version"),
        F.lit(None).cast("struct<dimensions:map<string,string>,rationale:string>").alias("confidence"),
        F.array().cast(f"array<{HINT}>").alias("routing_hints"), F.array().cast(f"array<{ADVISORY}>").alias("advisories"),
        F.lit(None).cast(PROVENANCE).alias("provenance"), metadata.alias("metadata"),
        F.lit(None).cast(f"array<{SIGNAL}>").alias("advisory_signals"))


_CTE = f"""WITH a AS (SELECT event_id AS e, event_id, {SQL_K} AS k, {sql_element(SOURCES, 'event_id')} AS source_id,
  {sql_element(KINDS, 'event_id')} AS kind0, {sql_element(PHRASES, 'event_id + 11')} AS title,
  {sql_element(PHRASES, 'event_id')} || ' and ' || {sql_element(PHRASES, f'event_id * 7 + {SQL_K}')} AS body FROM events),
b AS (SELECT *, CASE WHEN e % 17 = 0 THEN ' ' ELSE body END AS excerpt, e % 29 <> 0 AS has_ev,
  CASE WHEN source_id = 'bad id!' THEN 'unknown' ELSE source_id END AS src FROM a),
c AS (SELECT *, CASE WHEN has_ev THEN kind0 END AS kind, title || ' ' || body || CASE WHEN has_ev THEN ' ' || excerpt ELSE '' END AS text FROM b),
d AS (SELECT *, lower(text) AS low, regexp_extract_all(lower(text), '[a-z0-9]+') AS toks,
  coalesce(kind IN ('pull_request', 'issue', 'merge_request'), false) AS chg FROM c)
"""


def sql_hits(terms) -> str:
    return (f"list_filter({sql_list(terms)}, lambda t: CASE WHEN regexp_full_match(t, '[a-z0-9]+') THEN list_contains(toks, t) "
            "ELSE contains(low, t) END)")


def sql_any(terms) -> str:
    return f"(len({sql_hits(terms)}) > 0)"


def sql_groups(groups: dict[str, list[str]]) -> str:
    parts = ", ".join(f"CASE WHEN {sql_any(t)} THEN {sql_text(n)} END" for n, t in groups.items())
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


def advise(kind: str, message: str, meta: str = "''", where: str = "true", ids: str = "''") -> str:
    return (f"SELECT event_id, '{kind}' AS output_type, {message} AS message, {meta} AS meta, {ids} AS ids, "
            f"NULL AS role, NULL AS reason, NULL AS priority FROM f WHERE {where}")


def route(role: str, reason: str, priority: str = "'normal'", where: str = "true") -> str:
    return (f"SELECT event_id, 'routing_hint', NULL, '', '', {role}, {reason}, {priority} FROM f WHERE {where}")


def sql_mod(found: str, *outputs: str, where: str = "len(hits) > 0") -> str:
    """``found`` is the hit list; outputs refer to ``j`` (joined hits) and ``src``."""
    return _CTE + f", g AS (SELECT *, {found} AS hits FROM d), f AS (SELECT *, array_to_string(hits, ', ') AS j FROM g WHERE {where})\n" + \
        "\nUNION ALL ".join(outputs)


A, G, Q, L, D = M.ANNOTATION, M.GOVERNANCE, M.QUESTION, M.LENS, M.DEPENDENCY
_ISSUES = """list_filter([CASE WHEN NOT has_ev THEN 'there is no evidence to review' END,
 CASE WHEN has_ev AND e % 13 = 0 AND e % 2 = 0 THEN 'no reference or url leads to the evidence (source ' || src || ')' END,
 CASE WHEN has_ev AND trim(excerpt) = '' THEN 'the excerpt is blank, there is nothing to review' END], lambda x: x IS NOT NULL)"""
_TRUST = """list_filter([CASE WHEN source_id = 'mcp_registry' THEN 'mcp_registry is open to all writers' END,
 CASE WHEN e % 5 IN (2, 4) THEN 'emission_type ''' || CASE WHEN e % 5 = 2 THEN 'hint' ELSE 'advisory' END || ''' only ever advises' END,
 CASE WHEN has_ev AND kind IN ('pull_request','message','commit','issue','merge_request','meeting') AND e % 4 IN (1, 2)
   THEN 'nobody is named as the author of ' || kind || ' evidence' END,
 CASE WHEN has_ev AND kind = '' THEN 'the evidence does not say what it is' END], lambda x: x IS NOT NULL)"""
_MARKS = ("list_sort(list_distinct(list_transform(regexp_extract_all(low, '\\b(confidential|internal\\s+only|internal-only|proprietary|nda|"
          "do\\s+not\\s+share|do\\s+not\\s+distribute|restricted|classified|privileged)\\b'), lambda m: regexp_replace(m, '\\s+', ' ', 'g'))))")
_SEC = "list_sort(list_distinct(regexp_extract_all(low, '\\b(" + "|".join(M.SECURITY_WORDS) + ")\\b')))"
_VULN = "has_ev AND kind = 'vulnerability'"
_REF = "CASE WHEN e % 13 = 0 THEN ' ' ELSE 'R-' || e END"
_PKG = "CASE WHEN e % 3 = 0 THEN 'packages not named' ELSE 'pkg-a,pkg-b' END"
_SYSTEMS = {n: M.SYSTEM_MARKERS[n] for n in sorted(M.SYSTEM_MARKERS)}
_FOREIGN = "list_filter([" + ", ".join(
    f"CASE WHEN src <> '{n}' AND {sql_any(t)} THEN '{n}' END" for n, t in _SYSTEMS.items()) + "], lambda x: x IS NOT NULL)"
_OWN = "(SELECT f.*, unnest(hits) AS dom FROM f)"

MOD_SQL = {
    "adapter-contract": sql_mod(
        _ISSUES, advise(A, "'incomplete evidence on ' || src || ': ' || array_to_string(hits, '; ')"),
        advise(G, "'the evidence lost parts on the way: ' || array_to_string(hits, '; ')",
               "'issues=' || array_to_string(hits, '; ') || ';source=' || src"),
        route("'connectors'", "'no pointer on ' || src || ': check how the connector reads it'",
              where="NOT has_ev OR (e % 13 = 0 AND e % 2 = 0)")),
    "ai-authorship-review": sql_mod(
        f"list_sort({sql_hits(M.UNCERTAINTY)})",
        advise(G, "'text written by a model, from ' || src || ', calls itself unsure or unfinished: ' || j",
               "'markers=' || j || ';source=' || src"),
        route("'qa'", "'a person should read this model text (' || src || '): ' || j"),
        advise(Q, "'Did a person review and test the model change from ' || src || ' (' || j || ') before it was taken?'"),
        where="len(hits) > 0 AND src IN ('aider','claude_code','continue_dev','copilot','cursor','devin')"),
    "authority-boundary": sql_mod(
        sql_hits(M.AUTHORITY), advise(A, "'change on ' || src || ' speaks of an action beyond its authority: ' || j"),
        advise(G, "'authority may be exceeded (' || j || '): have a person and the policy confirm it'", "'source=' || src || ';terms=' || j"),
        route("'governance'", "'authority at risk in ' || src || ': ' || j", "'high'"),
        advise(Q, "'Is the ''' || j || ''' step bound to human approval, a known actor and a record?'"),
        where="len(hits) > 0 AND chg"),
    "code-review-risk": sql_mod(
        sql_groups(M.RISK_AREAS), advise(A, "'change on ' || src || ' reaches into sensitive areas: ' || j"),
        advise(G, "'risky change (' || j || '): weigh its reach before the merge'", "'areas=' || j || ';source=' || src"),
        route("'review'", "'sensitive areas changed in ' || src || ': ' || j", "'high'"),
        advise(Q, "'Does this change to ' || j || ' come with a tried way back and a known reach?'"),
        where="len(hits) > 0 AND chg"),
    "compliance-routing": sql_mod(
        sql_hits(M.COMPLIANCE), advise(G, "'evidence on ' || src || ' is under regulation: ' || j", "'frameworks=' || j || ';source=' || src"),
        route("'compliance'", "'a regulation is named in ' || src || ': ' || j", "'high'"),
        advise(Q, "'Does the ' || j || ' duty have a named owner and a record for this change?'")),
    "connector-freshness": sql_mod(
        sql_hits(M.BREAK_TERMS), advise(A, "'sign of a provider change on ' || src || ': ' || j", where="len(hits) > 0"),
        advise(G, "'a provider change may break the connector (' || j || '): check references and sign-in'",
               "'source=' || src || ';terms=' || j", "len(hits) > 0"),
        route("'connectors'", "'check for provider changes: ' || src || ': ' || j", where="len(hits) > 0"),
        advise(A, "'an api version is named on ' || src || ' (weak sign of a change)'", where="len(hits) = 0"),
        where=f"len(hits) > 0 OR {sql_any(M.VERSION_TERMS)}"),
    "cross-system-reference": sql_mod(
        _FOREIGN, advise(A, "'evidence on ' || src || ' points to other systems: ' || j", "'foreign_systems=' || j"),
        advise(Q, "'Does the reference to ' || j || ' keep up with the ' || src || ' item, or must someone compare them?'",
               "'foreign_systems=' || j"),
        route("'integrations'", "'other systems named in ' || src || ': ' || j")),
    "data-classification": sql_mod(
        f"list_concat({_MARKS}, CASE WHEN regexp_matches(text, '\\[redacted:[a-z]+\\]') THEN ['redacted-pii'] ELSE [] END)",
        advise(A, "'data classification: RESTRICTED (' || j || ')'", "'classification=restricted;signals=' || j",
               ids=f"CASE WHEN has_ev THEN {_REF} ELSE '' END"),
        route("'restricted-review'", "'restricted content (' || j || ')'"),
        advise(G, "'restricted content, for the restricted review (' || j || ')'", "'classification=restricted'")),
    "decision-drift": sql_mod(
        sql_hits(M.CONFLICT_CUES),
        advise(A, f"'a decision may have moved on ' || src || ': ' || array_to_string({sql_hits(M.DECISION_ANCHORS)}, ', ') || ' + ' || j"),
        advise(G, "'this may contradict a recorded decision (' || j || '): read the record again'",
               f"'anchors=' || array_to_string({sql_hits(M.DECISION_ANCHORS)}, ', ') || ';cues=' || j || ';source=' || src"),
        route("'governance'", "'moved decision in ' || src || ': ' || j"),
        advise(Q, "'Must the recorded decision be changed or replaced after this (' || j || ')?'"),
        where=f"len(hits) > 0 AND {sql_any(M.DECISION_ANCHORS)}"),
    "dependency-risk": sql_mod(
        f"list_filter({sql_list(M.MANIFEST_FILES)}, lambda t: contains(lower(title || ' ' || body), t))",
        advise(D, f"'Vulnerable dependency ' || {_REF} || ' affects ' || {_PKG}",
               f"'aliases=' || CASE WHEN e % 4 = 0 THEN 'X-1, ghsa-2' ELSE 'X-1' END || ';packages=' || {_PKG} || ';severity=CVSS:9;vuln=' || {_REF}",
               _VULN, ids=_REF),
        route("'security'", f"'dependency vulnerability ' || {_REF} || ' in ' || {_PKG}", "CASE WHEN e % 4 = 0 THEN 'high' ELSE 'normal' END", _VULN),
        advise(A, f"'this reports a vulnerable dependency (' || {_REF} || ')'", where=_VULN, ids=_REF),
        advise(D, "'a dependency manifest is named (' || j || '): look at the change'", "'manifests=' || j || ';source=' || source_id",
               f"NOT coalesce({_VULN}, false) AND len(hits) > 0"),
        advise(A, "'a dependency manifest is part of this (' || j || ')'", where=f"NOT coalesce({_VULN}, false) AND len(hits) > 0"),
        where="true"),
    "noisy-source-gate": sql_mod(
        "['x']", route("'reviewer'", "'noisy source ''' || source_id || ''': put a person before it until it is trusted more'",
                       "'low'").replace("SELECT event_id, 'routing_hint', NULL, '', '',",
                                        "SELECT event_id, 'routing_hint' AS output_type, NULL AS message, '' AS meta, '' AS ids,", 1)
        .replace("'reviewer',", "'reviewer' AS role,", 1).replace("trusted more', 'low'", "trusted more' AS reason, 'low' AS priority", 1),
        "SELECT event_id, 'advisory_governance_result', 'evidence from noisy source ''' || source_id || '''; a person should pass it until it is trusted more', "
        "'source=' || source_id, '', NULL, NULL, NULL FROM f", where="source_id IN ('slack','granola','fathom')"),
    "notification-scope-risk": sql_mod(
        sql_hits(M.BROADCAST), advise(G, "'evidence on ' || src || ' notifies more people than named: ' || j", "'signals=' || j || ';source=' || src"),
        route("'security'", "'notification to too many in ' || src || ': ' || j"),
        advise(Q, "'Is the ''' || j || ''' notification limited to those who need it, or is it over-broad?'")),
    "ownership-routing": sql_mod(
        sql_groups(M.DOMAINS), advise(A, "'change on ' || src || ' concerns these owners: ' || j"),
        advise(L, "'look at it as ' || dom || ' lens'", "'lens=' || dom || ';source=' || src").replace("FROM f", f"FROM {_OWN}"),
        route("dom", "dom || '-owned change in ' || src").replace("FROM f", f"FROM {_OWN}"), where="len(hits) > 0 AND chg"),
    "policy-exemption-audit": sql_mod(
        sql_hits(M.EXEMPTIONS), advise(G, "'evidence on ' || src || ' claims to be exempt from a policy: ' || j", "'source=' || src || ';terms=' || j"),
        route("'policy'", "'claimed exemption in ' || src || ': ' || j", "'high'"),
        advise(Q, "'Has the ''' || j || ''' exemption been renewed by the owner of the policy, with a record and an end?'")),
    "security-mentions": sql_mod(
        _SEC, advise(G, "'security is mentioned: ' || j", "'keywords=' || j"),
        route("'security'", "'security mentions in evidence (' || j || ')'"), advise(A, "'the text is about security: ' || j")),
    "source-trust-calibration": sql_mod(
        _TRUST, advise(A, "'on the trust in ' || src || ': ' || array_to_string(hits, '; ')"),
        advise(G, "'origin of little weight on ' || src || ', advise only or review by hand: ' || array_to_string(hits, '; ')",
               "'signals=' || array_to_string(hits, '; ') || ';source=' || src"),
        route("'review'", "'set the trust in ' || src || ' (origin of little weight): ' || array_to_string(hits, '; ')")),
    "test-adequacy": sql_mod(
        sql_hits(M.BEHAVIOR), advise(A, "'behavior change on ' || src || ' (' || j || '), and no test is mentioned'"),
        advise(G, "'tests may be missing: new behaviour (' || j || ') without a test or fixture'", "'behavior=' || j || ';source=' || src"),
        route("'review'", "'check the tests of ' || src || ': ' || j"),
        advise(Q, "'Does this ' || j || ' change bring or alter a test of what is new?'"),
        where=f"len(hits) > 0 AND chg AND NOT {sql_any(M.TEST_TERMS)}"),
    "webhook-risk": sql_mod(
        sql_hits(M.WEBHOOK_RISKS), advise(A, "'webhook handling is concerned (' || src || ')'"),
        advise(G, "'a webhook risk is named (' || j || '): check signatures and replays'", "'risks=' || j || ';source=' || src", "len(hits) > 0"),
        route("'security'", "'webhook risk in ' || src || ': ' || j", "'high'", "len(hits) > 0"), where=sql_any(M.WEBHOOK_TERMS)),
}


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "output_type", "message", meta_text().alias("meta"),
                       F.array_join("evidence_ids", ",").alias("ids"), "role", "reason", "priority")


def _register(mod_id: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _flat(M.run_mods(emissions(spark, sf), [mod_id], ["event_id"]))

    query(MOD_SQL[mod_id], "mod_" + mod_id.replace("-", "_"))(run)


for _m in M.MODS:
    _register(_m)


@query("WITH " + ", ".join(f'"{m}" AS (SELECT \'{m}\' AS mod_id, output_type, priority, count(*) AS n FROM ({sql}) GROUP BY ALL)'
                           for m, sql in MOD_SQL.items())
       + " " + " UNION ALL ".join(f'SELECT * FROM "{m}"' for m in MOD_SQL))
def all_mods(spark, sf):
    """All 18 mods in one projection and one explode."""
    return M.run_mods(emissions(spark, sf), keys=["event_id"]).groupBy("mod_id", "output_type", "priority").agg(
        F.count("*").alias("n"))


_SUMMARY_MODS = ["compliance-routing", "policy-exemption-audit", "webhook-risk"]


@query("WITH o AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS mod_id, role, priority FROM ({MOD_SQL[m]})" for m in _SUMMARY_MODS) + """)
SELECT mod_id, role, priority, count(*) AS outputs, CAST(grouping_id(mod_id, role, priority) AS INTEGER) AS grouping FROM o
GROUP BY CUBE (mod_id, role, priority)""")
def advisory_summary(spark, sf):
    return M.advisory_summary(M.run_mods(emissions(spark, sf), _SUMMARY_MODS, ["event_id"]))


@query(_CTE + f"SELECT event_id, array_to_string({sql_hits(M.COMPLIANCE + M.BROADCAST)}, ',') AS terms FROM d")
def term_matches(spark, sf):
    text = F.concat_ws(" ", "title", "body", F.get("evidence", F.lit(0))["excerpt"])
    return emissions(spark, sf).select(
        "event_id", F.array_join(T.matched_terms(text, M.COMPLIANCE + M.BROADCAST), ",").alias("terms"))


@query("""
WITH r AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE p_name END AS term FROM part),
d AS (SELECT c_custkey, lower(c_mktsegment || ' ordered a ' || CASE c_custkey % 4 WHEN 0 THEN 'small ring' WHEN 1 THEN 'Blue Bolt and red widget'
  WHEN 2 THEN 'reddish thing' ELSE 'big gear' END) AS low FROM customer),
t AS (SELECT DISTINCT c_custkey, unnest(regexp_extract_all(low, '[a-z0-9]+')) AS term FROM d),
m AS (SELECT c_custkey, pos FROM t JOIN r USING (term) UNION SELECT c_custkey, pos FROM d JOIN r ON contains(low, r.term) AND contains(r.term, ' '))
SELECT c_custkey, count(*) AS n_rules, CAST(sum(pos) AS BIGINT) AS pos_sum FROM m GROUP BY 1""")
def rule_table_matches(spark, sf):
    """Part names as a rule table over customer notes; phrases go through the anchor join."""
    rules = table(spark, sf, "part").select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_partkey") % 2 == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.col("p_name")).alias("term"))
    note = F.concat(F.col("c_mktsegment"), F.lit(" ordered a "), element(
        ["small ring", "Blue Bolt and red widget", "reddish thing", "big gear"], F.col("c_custkey")))
    texts = table(spark, sf, "customer").select("c_custkey", note.alias("note"))
    distinct = rules.groupBy("term").agg(F.count("*").alias("n"), F.sum("pos").alias("s"), F.min("pos").alias("pos"))
    found = T.match_rules(texts, distinct.select("pos", "term"), "c_custkey", "note")
    hits = found.select("c_custkey", F.explode("terms").alias("term")).join(distinct, "term")
    return hits.groupBy("c_custkey").agg(F.sum("n").alias("n_rules"), F.sum("s").alias("pos_sum"))


_OUTPUT_TYPES = ["advisory_governance_result", "routing_hint", "owner_lens_hint", "suggested_review_question"]


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs as a user-supplied mod might return them, some of them out of contract."""
    df = table(spark, sf, "events").withColumn("k", k_of())
    k = F.col("k")
    kind = element(_OUTPUT_TYPES, k)
    advisory = F.when(k % 4 != 1, F.when(k % 11 == 0, F.lit("other_kind")).otherwise(kind))
    return df.select(
        "event_id", F.lit("compliance-routing").alias("mod_id"), kind.alias("output_type"), advisory.alias("kind"),
        F.when(k % 4 != 1, F.concat(F.lit("note "), F.col("event_type"))).alias("message"),
        F.array(F.col("event_id").cast("string")).alias("evidence_ids"),
        F.create_map(F.lit("n"), F.lit("1")).alias("metadata"),
        F.when((k % 4 == 1) & (k % 13 != 0), F.lit("qa")).alias("role"),
        F.when(k % 4 == 1, F.lit("why")).alias("reason"), F.when(k % 4 == 1, F.lit("normal")).alias("priority"))


@query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id, CASE WHEN k % 4 = 1 AND k % 13 = 0 THEN 'exactly_one_artifact' WHEN k % 4 <> 1 AND k % 11 = 0 THEN 'kind_differs_from_type'
  ELSE 'undeclared_output_type' END AS reason FROM e
WHERE (k % 4 = 1 AND k % 13 = 0) OR (k % 4 <> 1 AND k % 11 = 0) OR k % 4 = 2""")
def output_audit(spark, sf):
    return M.audit_outputs(_outputs(spark, sf), M.manifests(spark)).select("event_id", "reason")


@query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id, CASE k % 6 WHEN 0 THEN 'risk_score' WHEN 3 THEN 'overall' ELSE 'p' END AS score_key FROM e WHERE k % 6 IN (0, 3, 4)""")
def opaque_scores(spark, sf):
    k = F.col("k")
    cases = ['{"risk_score":0.5}', '{"score":true}', '{"confidence":"high"}', '{"scores":{"deep":[],"overall":3}}',
             '{"Likelihoods":[{"p":0.1}]}', '{"size":12,"scoring":null}']
    df = table(spark, sf, "events").withColumn("k", k_of()).select("event_id", element(cases, k).alias("meta_json"))
    return M.audit_scores(df, "meta_json").select("event_id", "score_key")


@query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id, 'pan' AS cls FROM e WHERE k % 4 <> 1 AND k % 5 = 0""")
def output_screen(spark, sf):
    rows = _outputs(spark, sf)
    card = F.when(k_card(), F.concat(F.lit("card "), F.lit("4111" + "1" * 12)))
    marked = rows.join(table(spark, sf, "events").select("event_id", k_of().alias("k")), "event_id").withColumn(
        "message", F.coalesce(card, F.col("message")))
    return M.screen_outputs(marked).select(
        "event_id", F.regexp_extract("screen_reason", r"^sensitive_data:(\w+)", 1).alias("cls"))


def k_card():
    return (F.col("k") % 4 != 1) & (F.col("k") % 5 == 0)


@query("""
WITH p AS (SELECT p_partkey AS k FROM part)
SELECT mod_id, reason, count(*) AS n FROM (
  SELECT CASE WHEN k % 3 = 0 THEN 'made-up-' || k % 7 ELSE 'compliance-routing' END AS mod_id,
    CASE WHEN k % 3 = 0 THEN 'id_mismatch' WHEN k % 5 = 0 THEN 'version_mismatch' WHEN k % 5 = 1 THEN 'outputs_mismatch'
      WHEN k % 5 = 2 THEN 'forbidden_baseline_missing' END AS reason FROM p) WHERE reason IS NOT NULL GROUP BY ALL""")
def manifest_audit(spark, sf):
    """One declared manifest per part, right or wrong by a rule, against the code of one mod."""
    code = M.manifests(spark).where("mod_id = 'compliance-routing'")
    k = F.col("p_partkey")
    own = table(spark, sf, "part").select("p_partkey").join(code.withColumnRenamed("mod_id", "_mod"))
    declared = own.select(
        F.when(k % 3 == 0, F.concat(F.lit("made-up-"), k % 7)).otherwise(F.col("_mod")).alias("mod_id"),
        F.when(k % 5 == 0, F.lit("9.9.9")).otherwise(F.col("version")).alias("version"),
        F.when(k % 5 == 1, F.array(F.lit("routing_hint"))).otherwise(F.col("outputs")).alias("outputs"),
        F.when(k % 5 == 2, F.array(F.lit("other"))).otherwise(F.col("forbidden")).alias("forbidden"))
    return M.audit_manifests(declared, code).groupBy("mod_id", "reason").agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT doc_id, source, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS toks FROM documents)
SELECT source, count(*) FILTER (list_contains(toks, 'token')) AS has_token, count(*) FILTER (list_contains(toks, 'test')) AS has_test
FROM t GROUP BY source""")
def document_terms(spark, sf):
    """Whole-token terms over whole documents."""
    docs = spread(table(spark, sf, "documents")).select("source", T.matched_terms(F.col("text"), ["token", "test"]).alias("t"))
    return docs.groupBy("source").agg(
        F.count_if(F.array_contains("t", "token")).alias("has_token"), F.count_if(F.array_contains("t", "test")).alias("has_test"))
