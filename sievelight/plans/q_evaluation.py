"""Queries for the redaction evaluation (operators L1-L11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievelight.operators import evaluation as E
from sievelight.plans.common import SQL_K, element, k_of, sql_element, struct, table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


_PATHS = ["$", "a.b[1]", "$.a.c", "a.b[9]", "a..c", "a.b[x]", "a.c.", "list[0].v", "$list[1]", "missing", "a['c']", ""]
_RESOLVED = ["object", "two", "EVENT", "path_does_not_resolve", "malformed_path", "malformed_path", "malformed_path", "IDv",
             "path_does_not_resolve", "path_does_not_resolve", "malformed_path", "malformed_path"]


def _docs(spark, sf):
    ev = table(spark, sf, "events")
    doc = F.to_json(struct(
        a=struct(b=F.array(F.lit("one"), F.lit("two")), c=F.col("event_type")),
        list=F.array(struct(v=F.col("event_id").cast("string"))), n=F.col("user_id")))
    return ev.select(F.col("event_id").alias("record_id"), doc.alias("doc"), k_of().alias("k"), "event_type", "user_id")


@query(f"""WITH e AS (SELECT event_id, event_type, {SQL_K} AS k FROM events), r AS (SELECT *, {sql_element(_RESOLVED, 'k')} AS v FROM e)
SELECT event_id AS record_id, CASE v WHEN 'EVENT' THEN event_type WHEN 'IDv' THEN CAST(event_id AS VARCHAR) ELSE v END AS value FROM r""")
def field_paths(spark, sf):
    rows = _docs(spark, sf).select(
        "record_id", F.try_parse_json("doc").alias("doc_v"), element(_PATHS, F.col("k")).alias("field_path"))
    out = E.resolve_path(rows)
    kind = F.schema_of_variant("value_v")
    value = F.coalesce("path_problem", F.when(kind.startswith("OBJECT"), F.lit("object")).otherwise(F.col("value_v").cast("string")))
    return out.select("record_id", value.alias("value"))


@query(f"""
WITH e AS (SELECT event_id AS record_id, event_type, {SQL_K} AS k FROM events),
x AS (SELECT *, unnest([0, 1]) AS i FROM e),
y AS (SELECT record_id, 'e' || CASE WHEN k % 11 = 0 THEN 0 ELSE i END AS entity_id, k, i, length(event_type) AS len FROM x)
SELECT record_id, entity_id, CASE WHEN k % 7 = 1 THEN 'not_a_string' WHEN k % 7 = 2 THEN 'path_does_not_resolve'
  WHEN k % 7 = 3 THEN 'start_not_before_end' ELSE 'span_exceeds_length' END AS problem
FROM y WHERE k % 7 IN (1, 2, 3) OR (k % 7 = 4 AND 3 > len) OR (k % 7 = 5)
UNION ALL SELECT DISTINCT record_id, 'e0', 'duplicate_entity_id' FROM y WHERE k % 11 = 0
UNION ALL SELECT record_id, min(entity_id), 'duplicate_span' FROM y WHERE k % 13 = 0 GROUP BY record_id""")
def expected_spans(spark, sf):
    docs = _docs(spark, sf)
    k, i = F.col("k"), F.col("i")
    path = F.when(k % 7 == 1, F.lit("n")).when(k % 7 == 2, F.lit("a.zz")).otherwise(F.lit("a.c"))
    start = F.when(k % 7 == 3, F.lit(3)).otherwise(F.lit(0))
    rows = docs.select("record_id", "k", F.explode(F.array(F.lit(0), F.lit(1))).alias("i")).select(
        "record_id", F.concat(F.lit("e"), F.when(k % 11 == 0, F.lit(0)).otherwise(i).cast("string")).alias("entity_id"),
        F.lit("pii").alias("category"), F.when(k % 13 == 0, F.lit("s")).otherwise(F.concat(F.lit("s"), i.cast("string"))).alias("subtype"),
        path.alias("field_path"), start.alias("start"), F.when(k % 7 == 5, F.lit(99)).otherwise(F.lit(3)).alias("end"))
    return E.audit_spans(rows, docs.select("record_id", "doc"))


@query(f"""
WITH e AS (SELECT event_id AS record_id, event_type, {SQL_K} AS k FROM events)
SELECT record_id, CASE WHEN k % 6 = 1 THEN 'a.zz' ELSE 'a.b' END AS item, CASE WHEN k % 6 = 1 THEN 'path_does_not_resolve' ELSE 'hash_mismatch' END AS problem
FROM e WHERE k % 6 IN (1, 2)
UNION ALL SELECT record_id, 'A', 'substring_absent' FROM e WHERE k % 5 = 1 AND NOT contains(event_type, 'click')
UNION ALL SELECT record_id, 'A', 'not_a_string' FROM e WHERE k % 5 = 2""")
def preserved_fields(spark, sf):
    import hashlib

    docs = _docs(spark, sf)
    k = F.col("k")
    good = hashlib.sha256(b'["one","two"]').hexdigest()
    protected = docs.select(
        "record_id", F.when(k % 6 == 1, F.lit("a.zz")).otherwise(F.lit("a.b")).alias("field_path"),
        F.when(k % 6 == 2, F.lit("0" * 64)).otherwise(F.lit(good)).alias("expected_value_sha256"))
    assertions = docs.select(
        "record_id", F.lit("A").alias("assertion_id"), F.when(k % 5 == 2, F.lit("a.b")).otherwise(F.lit("a.c")).alias("field_path"),
        F.when(k % 5 == 1, F.lit("click")).otherwise(F.col("event_type")).alias("required_substring"))
    return E.audit_preservation(protected, assertions, docs.select("record_id", "doc"))


@query("""
WITH d AS (SELECT doc_id, printf('r%06d', CASE WHEN doc_id % 50 = 7 THEN doc_id - 2 ELSE doc_id END) AS record_id, doc_id % 10 = 3 AS gone, doc_id % 10 = 4 AS changed,
  doc_id % 10 = 5 AS unlisted FROM documents), l AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS pos FROM d WHERE NOT unlisted)
SELECT 'in/' || doc_id AS item, 'file_not_found' AS problem FROM l WHERE gone
UNION ALL SELECT 'in/' || doc_id, 'sha256_mismatch' FROM l WHERE changed
UNION ALL SELECT 'in/' || doc_id, 'unlisted_file' FROM d WHERE unlisted
UNION ALL SELECT 'out/' || doc_id, 'unlisted_file' FROM d WHERE unlisted
UNION ALL SELECT record_id, 'duplicate_record_id' FROM l GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT a.record_id, 'not_sorted' FROM l a JOIN l b ON b.pos = a.pos + 1 WHERE a.record_id > b.record_id""")
def corpus_manifest(spark, sf):
    """Documents as a corpus: some files are gone, changed or unlisted, some ids out of order."""
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    did = F.col("doc_id")
    name = lambda folder: F.concat(F.lit(folder + "/"), did.cast("string"))
    rid = F.format_string("r%06d", F.when(did % 50 == 7, did - 2).otherwise(did))
    # Position among the listed documents: ids are dense, so it is the id minus the unlisted ones before it.
    pos = did - F.floor((did + 4) / 10)
    manifest = docs.where(did % 10 != 5).select(
        pos.alias("pos"), rid.alias("record_id"), name("in").alias("input_path"), name("out").alias("expected_path"),
        F.when(did % 10 == 4, F.lit("0")).otherwise(F.col("sha")).alias("input_sha256"), F.lit("e").alias("expected_sha256"))
    files = docs.where(did % 10 != 3).select(name("in").alias("path"), F.col("sha").alias("sha256")).unionByName(
        docs.select(name("out").alias("path"), F.lit("e").alias("sha256")))
    return E.audit_corpus(manifest, files)


def spans(spark, sf):
    """Expected spans from order lines and a detector that shifts, drops and invents some."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("part"), F.min(F.col("l_quantity").cast("int")).alias("qty"), F.min("l_returnflag").alias("flag"))
    part = F.col("part")
    start = part % 40
    base = li.select(
        F.col("l_orderkey").alias("record_id"), F.lit("body").alias("field_path"), F.col("flag").alias("category"), "part",
        F.col("l_linenumber").alias("n"), start.alias("start"), (start + F.col("qty")).alias("end"))
    expected = base.withColumn("entity_id", F.format_string("e%d", "n"))
    shift = (part % 9) - 4
    found = base.where(part % 10 != 3).withColumns({
        "found_id": F.format_string("f%d", "n"), "start": F.greatest(F.col("start") + shift, F.lit(0)),
        "end": F.greatest(F.col("end") + shift, F.lit(1))})
    extra = base.where(part % 6 == 0).withColumns({
        "found_id": F.format_string("x%d", "n"), "start": F.col("start") + 500, "end": F.col("start") + 510})
    return found.unionByName(extra), expected


_MATCHES = """
WITH RECURSIVE li AS (SELECT l_orderkey AS r, l_linenumber AS n, min(l_partkey) AS part, min(CAST(l_quantity AS INTEGER)) AS q, min(l_returnflag) AS c FROM lineitem GROUP BY ALL),
ex AS (SELECT r, c, 'e' || n AS e, part % 40 AS s, part % 40 + q AS t FROM li),
fo AS (SELECT r, c, 'f' || n AS f, greatest(part % 40 + part % 9 - 4, 0) AS s, greatest(part % 40 + q + part % 9 - 4, 1) AS t FROM li WHERE part % 10 <> 3
  UNION ALL SELECT r, c, 'x' || n, part % 40 + 500, part % 40 + 510 FROM li WHERE part % 6 = 0),
p AS (SELECT ex.r, ex.c, e, f, least(ex.t, fo.t) - greatest(ex.s, fo.s) AS overlap, ex.s = fo.s AND ex.t = fo.t AS exact
  FROM ex JOIN fo ON ex.r = fo.r AND ex.c = fo.c AND fo.s < ex.t AND ex.s < fo.t),
o AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY overlap DESC, e, f) AS rn FROM p),
w AS (SELECT r, c, CAST(0 AS BIGINT) AS rn, '' AS e, '' AS f, CAST([] AS VARCHAR[]) AS used, CAST(0 AS BIGINT) AS overlap, false AS exact, false AS keep FROM o GROUP BY ALL
  UNION ALL
  SELECT o.r, o.c, o.rn, o.e, o.f, CASE WHEN list_has_any(w.used, [o.e, o.f]) THEN w.used ELSE list_concat(w.used, [o.e, o.f]) END,
    CAST(o.overlap AS BIGINT), o.exact, NOT list_has_any(w.used, [o.e, o.f]) FROM w JOIN o ON o.r = w.r AND o.c = w.c AND o.rn = w.rn + 1)
SELECT r AS record_id, 'body' AS field_path, c AS category, f AS found_id, e AS entity_id, overlap, exact FROM w WHERE keep"""


@query(_MATCHES)
def span_matches(spark, sf):
    found, expected = spans(spark, sf)
    return E.match_spans(found, expected)


@query("""
WITH li AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part, min(l_returnflag) AS category FROM lineitem GROUP BY ALL)
SELECT category, count(*) AS expected, CAST(count(*) FILTER (part % 10 <> 3) + count(*) FILTER (part % 6 = 0) AS BIGINT) AS found FROM li GROUP BY 1""")
def span_accounting(spark, sf):
    """Every expectation is a hit or a miss, every detection a hit or a false alarm."""
    found, expected = spans(spark, sf)
    m = E.match_spans(found, expected)
    rows = E.label_spans(found, expected, m)
    return rows.groupBy("category").agg(
        F.count_if(F.col("outcome").isin("tp", "fn")).alias("expected"), F.count_if(F.col("outcome").isin("tp", "fp")).alias("found"))


@query("""
WITH o AS (SELECT lang, source, quality, contains(text, '@') OR contains(text, 'token') AS pred, toxic = 1 AS truth FROM documents JOIN labels USING (doc_id)),
c AS (SELECT lang, source, quality, CASE WHEN pred AND truth THEN 'tp' WHEN pred THEN 'fp' WHEN truth THEN 'fn' END AS outcome FROM o WHERE pred OR truth),
g AS (SELECT lang, source, quality, count(*) FILTER (outcome = 'tp') AS tp, count(*) FILTER (outcome = 'fp') AS fp, count(*) FILTER (outcome = 'fn') AS fn,
  count(*) FILTER (outcome = 'tp') AS exact, CAST(grouping_id(lang, source, quality) AS INTEGER) AS grouping
  FROM c GROUP BY GROUPING SETS ((lang), (lang, source), (lang, source, quality), ())),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS r FROM g),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END AS f1, CASE WHEN 4 * p + r > 0 THEN 5 * p * r / (4 * p + r) END AS f2 FROM p)
SELECT lang, source, quality, tp, fp, fn, exact, grouping, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, round(f2, 6) AS f2,
  CASE WHEN tp > 0 THEN round(exact / tp, 6) END AS exact_span_accuracy,
  concat_ws(',', CASE WHEN p IS NULL THEN 'no_detections' END, CASE WHEN r IS NULL THEN 'no_expectations' END, CASE WHEN f1 IS NULL THEN 'f_undefined' END) AS null_reason
FROM f""")
def document_metrics(spark, sf):
    """Document-level metrics against the labels, by language, source and quality."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    pred = F.contains("text", F.lit("@")) | F.contains("text", F.lit("token"))
    truth = F.col("toxic") == 1
    rows = docs.select(
        "lang", "source", "quality",
        F.when(pred & truth, F.lit("tp")).when(pred, F.lit("fp")).when(truth, F.lit("fn")).alias("outcome")).where(
        "outcome IS NOT NULL").withColumn("exact", F.col("outcome") == "tp")
    out = E.redaction_metrics(rows, ["lang", "source", "quality"])
    scores = ["precision", "recall", "f1", "f2", "exact_span_accuracy"]
    return out.withColumns({c: F.round(c, 6) for c in scores})


@query(f"""
WITH e AS (SELECT event_type, user_id, {SQL_K} AS k FROM events)
SELECT event_type, count(*) FILTER (k % 2 = 0) AS decision_records, count(*) FILTER (k % 2 = 0 AND k % 3 <> 0 AND k % 5 <> 0 AND k % 7 <> 0) AS decisions_preserved,
  round(count(*) FILTER (k % 2 = 0 AND k % 3 <> 0 AND k % 5 <> 0 AND k % 7 <> 0) / count(*) FILTER (k % 2 = 0), 6) AS decision_preservation,
  CAST(sum(k % 4) AS BIGINT) AS destructive_false_positives, count(*) FILTER (k % 4 = 1 AND k % 3 = 1) AS clean_records_modified,
  count(*) FILTER (k % 7 = 0) AS protected_field_mutations, count(*) FILTER (k % 5 = 0) AS schema_validation_failures FROM e GROUP BY 1""")
def preservation_scores(spark, sf):
    k = F.col("k")
    rows = table(spark, sf, "events").withColumn("k", k_of()).select(
        "event_type", (k % 2 == 0).alias("has_assertions"), (k % 3 != 0).alias("assertions_kept"), (k % 5 != 0).alias("schema_valid"),
        (k % 7 != 0).alias("identity_unchanged"), (k % 4 == 1).alias("is_clean"), (k % 3 == 1).alias("modified"), (k % 4).alias("destructive_fp"))
    return E.preservation_metrics(rows, "event_type").withColumn("decision_preservation", F.round("decision_preservation", 6))


@query(f"""
WITH e AS (SELECT event_type AS candidate, user_id AS record_id, {SQL_K} % 97 = 5 AS odd FROM events),
g AS (SELECT candidate, record_id, count(*) AS repeats, count(DISTINCT odd) AS digests FROM e GROUP BY ALL)
SELECT *, repeats >= 5 AND digests = 1 AS deterministic FROM g""")
def repeat_determinism(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("candidate"), F.col("user_id").alias("record_id"),
        F.when(k_of() % 97 == 5, F.lit("d2")).otherwise(F.lit("d1")).alias("digest"))
    return E.determinism(rows)


def _gates(spark, sf):
    """Customers as gate results of their nation: a gate per market segment."""
    c = table(spark, sf, "customer")
    status = F.when(F.col("c_acctbal") < -900, F.lit("failed")).when(F.col("c_acctbal") < -700, F.lit("pending")).otherwise(F.lit("passed"))
    worst = F.min(F.struct(F.when(status == "failed", 0).when(status == "pending", 1).otherwise(2).alias("r"), status.alias("status")))
    return c.groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("candidate"), F.col("c_mktsegment").alias("gate_id")).agg(
        worst.alias("w")).select("candidate", "gate_id", "w.status")


_GATES = """
WITH g AS (SELECT 'n' || c_nationkey AS candidate, c_mktsegment AS gate_id, CASE WHEN min(c_acctbal) < -900 THEN 'failed' WHEN min(c_acctbal) < -700
  THEN 'pending' ELSE 'passed' END AS status FROM customer GROUP BY ALL),
r AS (SELECT candidate, bool_and(status = 'passed') AS all_passed,
  coalesce(string_agg(gate_id, ',' ORDER BY gate_id) FILTER (status = 'pending'), '') AS pending,
  coalesce(string_agg(gate_id, ',' ORDER BY gate_id) FILTER (status = 'failed'), '') AS failed FROM g GROUP BY 1)
"""


@query(_GATES + "SELECT * FROM r")
def gate_states(spark, sf):
    return E.gate_rollup(_gates(spark, sf)).select(
        "candidate", "all_passed", F.array_join("pending_gate_ids", ",").alias("pending"), F.array_join("failed_gate_ids", ",").alias("failed"))


_SCORED = """, s AS (SELECT 'n' || c_nationkey AS candidate, CAST(count(*) % 10 AS DOUBLE) / 10 AS a, CAST(count(*) % 7 AS DOUBLE) / 10 AS b FROM customer GROUP BY 1),
w AS (SELECT candidate, round(a * 0.3 + b * 0.2 + a * 0.2 + b * 0.1 + a * 0.1 + b * 0.1, 6) AS weighted_score FROM s JOIN r USING (candidate) WHERE {cond})
SELECT candidate, weighted_score, CAST(rank() OVER (ORDER BY weighted_score DESC) AS INTEGER) AS rank FROM w"""


@query(_GATES + _SCORED.format(cond="all_passed OR len(string_split(failed, ',')) < 3"))
def candidate_ranking(spark, sf):
    """Candidates with fewer than three failed gates count as eligible here."""
    a, b = F.col("a"), F.col("b")
    scores = table(spark, sf, "customer").groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("candidate")).agg(
        ((F.count("*") % 10).cast("double") / 10).alias("a"), ((F.count("*") % 7).cast("double") / 10).alias("b"))
    scores = scores.select("candidate", a.alias("detection"), b.alias("precision"), a.alias("security"), b.alias("performance"),
                           a.alias("packaging"), b.alias("maintainability"))
    rollup = E.gate_rollup(_gates(spark, sf)).withColumn("all_passed", F.size("failed_gate_ids") < 3)
    return E.rank_candidates(scores, rollup).select("candidate", "weighted_score", "rank")


@query("""
WITH s AS (SELECT 'c' || o_custkey AS candidate, CAST(sum(o_orderkey % 10) AS DOUBLE) / 10 AS a FROM orders GROUP BY 1),
w AS (SELECT candidate, round(a * 0.3 + a * 0.2 + a * 0.2 + a * 0.1 + a * 0.1 + a * 0.1, 6) AS weighted_score FROM s)
SELECT candidate, weighted_score, rank() OVER (ORDER BY weighted_score DESC) AS rank FROM w""")
def customer_ranking(spark, sf):
    """Every customer as a candidate: a table that grows, with many ties."""
    scores = table(spark, sf, "orders").groupBy(F.concat(F.lit("c"), F.col("o_custkey")).alias("candidate")).agg(
        (F.sum(F.col("o_orderkey") % 10).cast("double") / 10).alias("a")).select("candidate", *[F.col("a").alias(k) for k in E.WEIGHTS])
    return E.rank_candidates(scores, scores.select("candidate", F.lit(True).alias("all_passed"))).select("candidate", "weighted_score", "rank")


@query(_GATES + """, n AS (SELECT r.*, n_nationkey AS nk FROM r JOIN nation ON candidate = 'n' || n_nationkey)
SELECT candidate, 'missing_in_metrics' AS problem FROM n WHERE nk % 5 = 1
UNION ALL SELECT candidate, 'hard_gates_inconsistent' FROM n WHERE nk % 5 = 2
UNION ALL SELECT candidate, 'configuration_digest_invalid' FROM n WHERE nk % 5 = 3
UNION ALL SELECT candidate, 'metric_corpus_digest_differs' FROM n WHERE nk % 5 = 4
UNION ALL SELECT candidate, 'pending_ids_drift' FROM n WHERE pending <> ''""")
def candidate_consistency(spark, sf):
    nk = F.col("n_nationkey")
    digest = "sha256:" + "a" * 64
    name = F.concat(F.lit("n"), nk.cast("string"))
    rollup = E.gate_rollup(_gates(spark, sf))
    base = table(spark, sf, "nation").select("n_nationkey", name.alias("candidate")).join(rollup, "candidate")
    matrix = base.select(
        "candidate", F.when(nk % 5 == 3, F.lit("bad")).otherwise(F.lit(digest)).alias("configuration_digest"),
        F.lit(digest).alias("corpus_digest"), (F.col("all_passed") != (nk % 5 == 2)).alias("hard_gates_passed"),
        F.col("all_passed").alias("selection_eligible"), F.array().cast("array<string>").alias("pending_gate_ids"))
    metrics = base.where(nk % 5 != 1).select(
        "candidate", F.when(nk % 5 == 4, F.lit("other")).otherwise(F.lit(digest)).alias("corpus_digest"))
    return E.audit_candidates(matrix, rollup, metrics)
