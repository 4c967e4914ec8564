"""Queries for trace, chain and conformance audits (operators K1-K14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievelight.functions.canonical import json_object, json_string
from sievelight.operators import audits as K, exports as X, normalize as N, redaction as R
from sievelight.plans.common import SQL_K, element, k_of, spread, struct, table
from sievelight.plans.q_redaction import TOKENS, secrets, tracked

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


def _trace_rows(spark, sf):
    """Observation, emission and envelope of each event, packed side by side."""
    obs = tracked(spark, sf, keep=("k",)).drop("event_type")
    clean, _ = R.sanitize(obs)
    packed = clean.withColumn("o", F.struct(*[c for c in obs.columns if c not in ("event_id", "k")]))
    em = N.with_advisories(N.to_emissions(packed))
    fields = ["source_id", "title", "body", "evidence", "emission_type", "adapter_version", "advisories", "provenance", "metadata",
              "advisory_signals"]
    both = em.withColumn("e", F.struct(*fields))
    env = X.to_envelopes(both).withColumn("envelope_json", X.envelope_json())
    return env.select(
        F.col("event_id").alias("trace_id"), "o", "e", "envelope_json",
        F.when(F.col("k") % 2 == 0, F.lit('{"raw":1}')).alias("capture"),
        F.when(F.col("k") % 3 > 0, F.when(F.col("k") % 3 == 1, F.lit('{"status":201}')).otherwise(F.lit('{"status":503}'))).alias("delivery"))


@query(f"""WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id AS trace_id, 5 + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 3 > 0 THEN 1 ELSE 0 END AS n_phases,
  CASE WHEN k % 3 = 2 THEN 'failed' ELSE 'completed' END AS last_status, true AS chained FROM e""")
def phase_traces(spark, sf):
    t = K.phase_trace(_trace_rows(spark, sf), capture="capture", delivery="delivery")
    rows = K.previous_row(t, ["trace_id"], "pos", ["output_digest"])
    ok = ~F.col("has_prev") | (F.col("input_digest") == F.col("prev_output_digest"))
    return rows.groupBy("trace_id").agg(
        F.count("*").cast("int").alias("n_phases"), F.max_by("receipt_status", "pos").alias("last_status"),
        F.bool_and(ok).alias("chained"))


@query(TOKENS + """SELECT event_id AS trace_id, 'sha256:' || sha256('{"author":"alice","evidence_id":"slack:' || event_id || '","evidence_metadata":{},"excerpt":"'
  || clean || '","metadata":{"channel":"C1","note":"' || clean || '"},"mode":"webhook","provider_event_id":"ev-' || event_id || '","provider_resource_id":"","source_ref":{"kind":"message","ref":"R-'
  || event_id || '","source_id":"slack","url":""},"timestamp":"2024-01-01","title":"T ' || event_type || '"}') AS output_digest FROM r""")
def observation_phases(spark, sf):
    """Output digest of the observation phase against the same JSON built in SQL."""
    t = K.phase_trace(_trace_rows(spark, sf).withColumn("trace_id", F.col("trace_id")), capture="capture", delivery="delivery")
    return t.where("phase_id = 'PHASE-04-OBSERVATION'").select("trace_id", "output_digest")


_CHAIN_LI = """
WITH li AS (SELECT l_orderkey AS trace_id, l_linenumber - 1 AS pos, count(*) AS n, min(l_partkey) AS part FROM lineitem GROUP BY ALL),
c AS (SELECT trace_id, CAST(row_number() OVER (PARTITION BY trace_id ORDER BY pos) - 1 AS INTEGER) AS pos, part FROM li)
"""


def _chain(spark, sf):
    """Orders as traces: phases chain on the part numbers; some records are damaged by rule."""
    from pyspark.sql import Window

    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("trace_id"), "l_linenumber").agg(F.min("l_partkey").alias("part"))
    w = Window.partitionBy("trace_id").orderBy("l_linenumber")  # at most seven lines per order
    rows = li.withColumns({"pos": F.row_number().over(w) - 1, "prev": F.lag("part").over(w)})
    out = json_object({"p": F.col("part").cast("string")})
    given = F.when(F.col("prev").isNull(), F.lit("{}")).otherwise(json_object({"p": F.col("prev").cast("string")}))
    tag = lambda c: F.concat(F.lit("sha256:"), F.sha2(c, 256))
    names = [p[0] for p in K.PHASES]
    bad = F.col("part") % 17
    phase = F.when((bad == 1) & (F.col("pos") > 0), F.lit(names[0])).otherwise(element(names, F.col("pos")))
    contract = F.create_map(*[F.lit(x) for kv in K.CONTRACTS.items() for x in kv])
    return rows.select(
        "trace_id", "pos", phase.alias("phase_id"), contract[phase].alias("contract_id"), given.alias("input_data"), out.alias("output_data"),
        F.when(bad == 2, F.lit("sha256:0")).otherwise(tag(given)).alias("input_digest"), tag(out).alias("output_digest"),
        (bad == 3).alias("canonical"))


@query(_CHAIN_LI + """, p AS (SELECT *, part % 17 AS bad, CASE WHEN part % 17 = 1 AND pos > 0 THEN 0 ELSE pos END AS phase FROM c)
SELECT trace_id, pos, 'input_digest_invalid' AS problem FROM p WHERE bad = 2
UNION ALL SELECT trace_id, pos, 'digest_chain_broken' FROM p WHERE bad = 2 AND pos > 0
UNION ALL SELECT trace_id, pos, 'canonical_authority' FROM p WHERE bad = 3
UNION ALL SELECT trace_id, pos, 'duplicate_phase_id' FROM p WHERE bad = 1 AND pos > 0""")
def trace_audit(spark, sf):
    return K.audit_trace(_chain(spark, sf))


@query(f"""
WITH e AS (SELECT event_id, user_id, event_type, {SQL_K} AS k FROM events),
p AS (SELECT user_id, event_type, count(*) AS n FROM e GROUP BY ALL),
bad AS (SELECT user_id AS trace_id, CASE k % 23 WHEN 1 THEN 'phase_' || event_type || '_title_required' WHEN 2 THEN 'phase_' || event_type || '_data_required'
  WHEN 3 THEN 'phase_' || event_type || '_display_required' WHEN 4 THEN 'phase_' || event_type || '_added_items_must_be_nonempty_strings' END AS problem
  FROM e WHERE k % 23 IN (1, 2, 3, 4)),
u AS (SELECT bad.trace_id, bad.problem FROM bad UNION ALL SELECT user_id, 'duplicate_phase_id:' || event_type FROM p WHERE n > 1
  UNION ALL SELECT user_id, 'missing_required_phases:refund' FROM (SELECT DISTINCT user_id FROM e))
SELECT trace_id, problem, count(*) AS n FROM u GROUP BY ALL""")
def phase_completeness(spark, sf):
    k = F.col("k") % 23
    one = F.array(F.lit("x"))
    rows = table(spark, sf, "events").withColumn("k", k_of()).select(
        F.col("user_id").alias("trace_id"), F.col("event_type").alias("phase_id"),
        F.when(k == 1, F.lit(" ")).otherwise(F.lit("T")).alias("title"), F.lit("f").alias("function"),
        F.when(k == 2, F.lit("{}")).otherwise(F.lit('{"a":1}')).alias("data_json"),
        F.when(k == 3, F.array().cast("array<string>")).otherwise(one).alias("display"), one.alias("preserved"),
        F.when(k == 4, F.array(F.lit(""))).otherwise(one).alias("added"), one.alias("removed"), F.lit("g").alias("gate"))
    return K.audit_phases(rows, ["refund"]).groupBy("trace_id", "problem").agg(F.count("*").alias("n"))


@query(TOKENS + """SELECT event_id, CASE WHEN k % 9 = 1 THEN 'emission_missing' WHEN k % 9 = 2 THEN 'content_changed' ELSE 'observation_missing' END AS problem
FROM r WHERE k % 9 IN (1, 2, 3)""")
def content_loss(spark, sf):
    rows = tracked(spark, sf).join(table(spark, sf, "events").select("event_id", k_of().alias("k")), "event_id")
    em = N.to_emissions(rows).where("k % 9 <> 1")
    ev = F.transform("evidence", lambda e: e.withField("excerpt", F.when(F.col("k") % 9 == 2, F.lit("x")).otherwise(e["excerpt"])))
    return K.audit_loss(rows.where("k % 9 <> 3"), em.withColumn("evidence", ev), "event_id")


@query(_CHAIN_LI.replace("trace_id", "connector") + """, s AS (SELECT connector, pos, part, CASE WHEN part % 13 = 0 THEN 'changed' ELSE 'same' END AS st FROM c),
f AS (SELECT connector, min(pos) FILTER (st = 'changed') AS first, count(*) AS stages, count(*) FILTER (st = 'same') AS matching FROM s GROUP BY 1)
SELECT connector, stages, matching AS matching_stages, (['acquisition_verification','parsed_facts','redaction_receipt','integration_advisories',
  'observation','universal_advisories','adapter_emission'])[1 + first] AS failed_stage, first IS NULL AS passed FROM f""")
def golden_comparison(spark, sf):
    rows = _chain(spark, sf).select(
        F.col("trace_id").alias("connector"), F.lit("poll").alias("mode"), element(K.GOLDEN_STAGES, F.col("pos")).alias("stage"),
        F.col("output_data").alias("digest"), F.get_json_object("output_data", "$.p").cast("bigint").alias("part"))
    golden = rows.withColumn("digest", F.when(F.col("part") % 13 == 0, F.lit("old")).otherwise(F.col("digest")))
    return K.golden_diff(rows, golden).select("connector", "stages", "matching_stages", "failed_stage", "passed")


@query(r"""SELECT doc_id, 'sha256:' || sha256('{"text":"' || lang || ' ' || source || ' \u00e9 \ud83d\ude00"}') AS plain FROM documents""")
def escaped_digests(spark, sf):
    """The harness digest escapes non-ASCII characters as UTF-16 units."""
    text = F.concat_ws(" ", "lang", "source", F.lit("é"), F.lit("\U0001f600"))
    return table(spark, sf, "documents").select("doc_id", K.harness_digest(json_object({"text": json_string(text)})).alias("plain"))


_ACQ = ["ok", "receipt_missing", "receipt_incomplete", "not_over_original_bytes", "not_verified", "payload_digest_missing",
        "path_escapes_scan_root", "ok"]


@query(f"""WITH e AS (SELECT event_id, {SQL_K} AS k FROM events), v AS (SELECT event_id, ({_ACQ})[1 + k % 8] AS problem FROM e)
SELECT * FROM v WHERE problem <> 'ok'""")
def acquisition_receipts(spark, sf):
    c = element(_ACQ, F.col("k"))
    receipt = F.to_json(struct(
        original_payload_sha256=F.when(c == "payload_digest_missing", F.lit("md5:1")).otherwise(F.lit("sha256:1")),
        provider_headers=struct(a=F.lit(1)),
        provider_verification=struct(over=F.when(c == "not_over_original_bytes", F.lit("copy")).otherwise(F.lit("original_bytes")),
                                     result=F.when(c == "not_verified", F.lit("skipped")).otherwise(F.lit("verified"))),
        replay_window=struct(result=F.lit("x")), receiver=F.when(c != "receipt_incomplete", struct(identity=F.lit("r"))),
        captured_at=F.lit("t"), source_scope=F.lit("data/in")))
    path = F.when(c == "path_escapes_scan_root", F.lit("data/in/../in-evil/f")).otherwise(F.lit("./data/in/x/../f.txt"))
    rows = table(spark, sf, "events").withColumn("k", k_of()).select(
        "event_id", F.try_parse_json(F.when(c == "receipt_missing", F.lit("[]")).otherwise(receipt)).alias("receipt_v"), path.alias("path"))
    return K.audit_acquisition(rows, path="path", keys=["event_id"])


@query(TOKENS + """SELECT event_id, CASE WHEN k % 9 = 4 THEN 'ref' WHEN k % 9 = 5 THEN 'timestamp,mode' ELSE '' END AS changed, k % 9 NOT IN (4, 5) AS preserved FROM r""")
def structural_proofs(spark, sf):
    raw = tracked(spark, sf)
    k = table(spark, sf, "events").select("event_id", (k_of() % 9).alias("k"))
    clean, _ = R.sanitize(raw)
    bad_ref = F.col("source_ref").withField("ref", F.when(F.col("k") == 4, F.lit("other")).otherwise(F.col("source_ref.ref")))
    changed = clean.join(k, "event_id").withColumns({
        "source_ref": bad_ref, "timestamp": F.when(F.col("k") == 5, F.lit("t")).otherwise(F.col("timestamp")),
        "mode": F.when(F.col("k") == 5, F.lit("active")).otherwise(F.col("mode"))})
    return K.structural_proof(raw, changed, "event_id").select(
        "event_id", F.array_join("changed_fields", ",").alias("changed"), "preserved")


@query(TOKENS + """, d AS (SELECT event_type, CASE WHEN k % 20 < 12 THEN 'secret' WHEN k % 20 < 14 THEN 'phi' WHEN k % 20 = 14 THEN 'pan'
  WHEN k % 20 > 15 THEN 'pii' END AS category FROM r)
SELECT event_type, category, count(*) AS added FROM d WHERE category IS NOT NULL GROUP BY ALL""")
def placeholder_deltas(spark, sf):
    from sievelight.functions.sensitive import redact

    rows = secrets(spark, sf).withColumn("clean", redact(F.col("text")))
    return K.redaction_delta(rows, "text", "clean", "event_type")


def _ledger(spark, sf):
    """Orders as ledgers of up to seven entries, as Markdown text; the hashes of some are wrong."""
    from pyspark.sql import Window

    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("ledger"), "l_linenumber").agg(F.min("l_partkey").alias("part"))
    w = Window.partitionBy("ledger").orderBy("l_linenumber")
    content = F.sha2(F.concat(F.lit("c"), F.col("part").cast("string")), 256)
    rows = li.withColumns({"pos": F.row_number().over(w) - 1, "content": content})
    # A ledger's chain value depends on all earlier entries; here each previous value is the content
    # of the entry before, which the stated chain of that entry repeats by construction.
    prev = F.when(F.col("pos") == 0, F.lit("GENESIS")).otherwise(F.lag("content").over(w))
    rows = rows.withColumn("previous", prev)
    chain = F.sha2(F.concat("content", "previous"), 256)
    entry = F.concat(
        F.lit("### Entry #"), F.col("pos").cast("string"), F.lit("\n**Content Hash**: "), "content", F.lit("\n**Previous Hash**: "), "previous",
        F.when(F.col("pos") > 0, F.concat(F.lit("\n**Chain Hash**: "), F.when(F.col("part") % 11 == 0, F.sha2("content", 256)).otherwise(chain)))
        .otherwise(F.lit("")), F.lit("\n"))
    return rows.withColumn("entry", entry).groupBy("ledger").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry"))), lambda x: x["entry"]), "").alias("text"))


@query(_CHAIN_LI.replace("trace_id", "ledger") + """
SELECT ledger, pos, 'chain_hash_mismatch' AS problem FROM c WHERE pos > 0 AND part % 11 = 0
UNION ALL SELECT ledger, pos, 'previous_not_linked' FROM c WHERE pos > 1""")
def ledger_chain(spark, sf):
    """Every third and later entry cites the content instead of the chain of its predecessor."""
    entries = K.ledger_entries(_ledger(spark, sf), "text", "ledger")
    return K.audit_ledger(entries, "ledger", block_size=2)


def _stages(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("bundle_id"), "l_linenumber").agg(F.min("l_partkey").alias("part"))
    from pyspark.sql import Window

    w = Window.partitionBy("bundle_id").orderBy("l_linenumber")
    rows = li.withColumn("pos", F.row_number().over(w) - 1)
    part, pos = F.col("part"), F.col("pos")
    status = F.when(part % 19 == 0, F.lit("failed")).when(part % 19 == 1, F.lit("unproven")).otherwise(F.lit("passed"))
    out = F.when((status == "passed") & (part % 23 != 0), F.concat(F.lit("o"), part.cast("string")))
    rows = rows.withColumns({
        "stage_id": element(K.STAGE_ORDER, pos), "status": status, "output_digest": out,
        "record_json": json_object({"p": part.cast("string")}),
        "evidence_class": F.when(status == "unproven", F.lit("none")).when(part % 29 == 0, F.lit("observed_live")).otherwise(F.lit("component")),
        "required_evidence_class": F.when(part % 2 == 0, F.lit("human_accepted")),
    })
    digest = F.concat(F.lit("sha256:"), F.sha2("record_json", 256))
    rows = rows.withColumn("stage_record_digest", F.when(part % 31 == 0, F.lit("sha256:bad")).otherwise(digest))
    return rows.withColumns({
        "prev_stage_id": F.lag("stage_id").over(w),
        "prev_stage_digest": F.when(part % 37 == 0, F.lit("sha256:old")).otherwise(F.lag("stage_record_digest").over(w)),
        "depends_on_outputs": F.when(pos > 0, F.array(F.struct(
            F.lag("stage_id").over(w).alias("stage_id"),
            F.when(part % 5 != 0, F.when(part % 7 == 0, F.lit("o?")).otherwise(F.lag("output_digest").over(w))).alias("output_digest"),
            F.when(part % 5 == 0, F.lit("an output")).alias("required_output"),
            F.when(part % 5 == 0, F.lit("missing")).alias("status")))),
    })


_ST = _CHAIN_LI.replace("trace_id", "bundle_id") + f""", s AS (SELECT *, CASE WHEN part % 19 = 0 THEN 'failed' WHEN part % 19 = 1 THEN 'unproven' ELSE 'passed' END AS status,
  ({K.STAGE_ORDER})[1 + pos] AS stage_id FROM c),
t AS (SELECT *, CASE WHEN status = 'passed' AND part % 23 <> 0 THEN 'o' || part END AS outd FROM s),
u AS (SELECT *, lag(outd) OVER w AS prev_out, lag(stage_id) OVER w AS prev_stage, min(CASE WHEN status <> 'passed' THEN pos END) OVER (PARTITION BY bundle_id) AS bad
  FROM t WINDOW w AS (PARTITION BY bundle_id ORDER BY pos))
"""


@query(_ST + """SELECT bundle_id, pos, 'record_digest_mismatch' AS problem FROM u WHERE part % 31 = 0
UNION ALL SELECT bundle_id, pos, 'link_broken' FROM u WHERE part % 37 = 0 AND pos > 0""")
def stage_chain(spark, sf):
    return K.audit_stage_chain(_stages(spark, sf))


@query(_ST + """, d AS (SELECT bundle_id, stage_id, prev_stage AS depends_on, CASE WHEN part % 5 = 0 THEN NULL WHEN part % 7 = 0 THEN 'o?' ELSE prev_out END AS cited,
  part % 5 = 0 AS misses, prev_out FROM u WHERE pos > 0),
p AS (SELECT bundle_id, stage_id, depends_on, CASE WHEN cited IS NULL AND NOT misses THEN 'exactly_one_of_digest_or_missing'
  WHEN cited IS NOT NULL AND prev_out IS NULL THEN 'no_output_artifacts' WHEN cited IS NOT NULL AND cited <> prev_out THEN 'output_digest_mismatch'
  WHEN misses AND prev_out IS NOT NULL THEN 'has_real_output' END AS problem FROM d)
SELECT * FROM p WHERE problem IS NOT NULL""")
def stage_dependencies(spark, sf):
    return K.audit_dependencies(_stages(spark, sf))


@query(_ST + """SELECT bundle_id, stage_id, 'passed_after_failed_or_unproven' AS problem FROM u WHERE status = 'passed' AND pos > bad
UNION ALL SELECT bundle_id, stage_id, 'passed_without_output' FROM u WHERE status = 'passed' AND outd IS NULL
UNION ALL SELECT bundle_id, stage_id, 'held_class_without_receipt' FROM u WHERE status = 'passed' AND part % 29 = 0
UNION ALL SELECT bundle_id, stage_id, 'required_class_missing' FROM u WHERE status = 'unproven' AND part % 2 = 1""")
def stage_status(spark, sf):
    return K.audit_status(_stages(spark, sf))


@query(_ST + """SELECT bundle_id, CASE WHEN bool_or(status = 'passed' AND part % 29 <> 0) THEN 'component' ELSE 'none' END AS strongest_class FROM u GROUP BY 1""")
def strongest_evidence(spark, sf):
    return K.strongest_class(_stages(spark, sf))


@query(TOKENS + """, m AS (SELECT event_id, event_type, user_id, k FROM r WHERE k % 20 = 16)
SELECT event_id, event_type AS stage_id, CASE WHEN user_id % 3 = 0 THEN 'unknown_email' ELSE 'outside_allowed_stage' END AS problem, CAST(1 AS BIGINT) AS n_values
  FROM m WHERE user_id % 3 = 0 OR event_type <> 'click'
UNION ALL SELECT event_id, event_type, 'sensitive_data', 1 FROM r WHERE k % 20 <= 14""")
def raw_samples(spark, sf):
    """Addresses of some users are allowed, in one stage only."""
    texts = secrets(spark, sf).select("event_id", F.col("event_type").alias("stage_id"), "text")
    users = table(spark, sf, "events").select("user_id").distinct().where("user_id % 3 <> 0")
    mail = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
    policy = users.select(F.concat(F.lit("sha256:"), F.sha2(mail, 256)).alias("value_digest"), F.array(F.lit("click")).alias("allowed_stage_ids"))
    return K.audit_raw_samples(texts, policy, ["event_id"])


@query("""
WITH a AS (SELECT l_orderkey, 'p/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS path, min(l_shipdate) AS d FROM lineitem GROUP BY ALL),
j AS (SELECT l_orderkey, path, '{"digest":"d' || strftime(d, '%Y%m%d') || '","path":"' || path || '"}' AS piece FROM a)
SELECT l_orderkey, 'sha256:' || sha256('[' || string_agg(piece, ',' ORDER BY path) || ']') AS aggregate_digest, count(*) AS n_artifacts FROM j GROUP BY 1""")
def aggregate_digests(spark, sf):
    path = F.concat_ws("/", F.lit("p"), "l_linenumber", "l_partkey", "l_suppkey")
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", path.alias("path")).agg(F.min("l_shipdate").alias("d"))
    return K.aggregate_digest(
        rows.withColumn("digest", F.concat(F.lit("d"), F.date_format("d", "yyyyMMdd"))), ["l_orderkey"])


@query("SELECT doc_id, sha256(text) = sha256(text) AS same FROM documents")
def sanitized_twice(spark, sf):
    """Redaction is idempotent on whole documents: the catalog finds nothing in its own output."""
    from sievelight.functions.sensitive import detect, redact

    docs = spread(table(spark, sf, "documents")).select("doc_id", redact(F.col("text")).alias("clean"))
    return docs.select("doc_id", (F.size(detect(F.col("clean"))) == 0).alias("same"))

