"""Queries for detection, redaction, receipts (operators E1-E18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.functions import sensitive as S
from sievelight.functions.canonical import canonical_digest
from sievelight.functions.text import pin
from sievelight.operators import mods, normalize, observe, redaction as R
from sievelight.plans.common import SQL_K, element, k_of, spread, struct, table, with_k
from sievelight.schemas import observation_columns

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


# --- payload text with one sensitive value per event ----------------------------------------------
# Token-shaped text is built from a hash of the event id, never written out.

CARDS = ["4111" + "1" * 12, "5500" + "00" + "5" * 9 + "9", "6011" + "0" * 11 + "4"]


def token_of():
    h, k = F.md5(F.col("event_id").cast("string")), F.col("k") % 20

    def cut(n: int):
        return F.left(h, F.lit(n))

    def say(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    card = element(CARDS, F.col("event_id"))
    cases = [
        say("AKIA", F.upper(cut(16))), say("ghp_", h, cut(4)), say("github_pat_", h, h, cut(18)),
        say("DefaultEndpointsProtocol=https;AccountName=abc;AccountKey=", h, cut(8), ";"),
        F.lit("-----BEGIN RSA PRIVATE" + " KEY-----"), say("eyJ", cut(10), ".eyJ", cut(8), ".", cut(6)),
        say("xoxb-", cut(12)), say("AIza", h, cut(3)), say("sk_live_", cut(24)), say("glpat-", cut(20)),
        say("npm_", h, cut(4)), say("sk-proj-", h),
        say("MRN: ", (F.col("event_id") + 100000).cast("string")), say("ssn=x", F.col("k").cast("string")), card,
        say("order_id: ", card), say("user", F.col("user_id").cast("string"), "@example.com"),
        F.lit("call 555-123-4567"), F.lit("tel 12 34 56 78"), F.lit("+44 20 7946 0958"),
    ]
    out = None
    for i, value in enumerate(cases):
        out = F.when(k == i, value) if out is None else out.when(k == i, value)
    return F.concat(F.lit("pre "), out, F.lit(" post"))


def secrets(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_k(spread(table(spark, sf, "events")).select("event_id", "event_type", "user_id", "props"))
    return pin(rows, {"text": token_of()}, drop=("props",))


_CARD_SQL = "(" + str(CARDS) + ")[1 + CAST(event_id % 3 AS INTEGER)]"
TOKENS = _TOKENS = f"""
WITH e AS (SELECT event_id, event_type, user_id, {SQL_K} AS k, md5(CAST(event_id AS VARCHAR)) AS h FROM events),
t AS (SELECT *, CASE k % 20
  WHEN 0 THEN 'AKIA' || upper(left(h, 16)) WHEN 1 THEN 'ghp_' || h || left(h, 4)
  WHEN 2 THEN 'github_pat_' || h || h || left(h, 18)
  WHEN 3 THEN 'DefaultEndpointsProtocol=https;AccountName=abc;AccountKey=' || h || left(h, 8) || ';'
  WHEN 4 THEN '-----BEGIN RSA PRIVATE' || ' KEY-----'
  WHEN 5 THEN 'eyJ' || left(h, 10) || '.eyJ' || left(h, 8) || '.' || left(h, 6)
  WHEN 6 THEN 'xoxb-' || left(h, 12) WHEN 7 THEN 'AIza' || h || left(h, 3) WHEN 8 THEN 'sk_live_' || left(h, 24)
  WHEN 9 THEN 'glpat-' || left(h, 20) WHEN 10 THEN 'npm_' || h || left(h, 4) WHEN 11 THEN 'sk-proj-' || h
  WHEN 12 THEN 'MRN: ' || (event_id + 100000) WHEN 13 THEN 'ssn=x' || k WHEN 14 THEN {_CARD_SQL}
  WHEN 15 THEN 'order_id: ' || {_CARD_SQL} WHEN 16 THEN 'user' || user_id || '@example.com'
  WHEN 17 THEN 'call 555-123-4567' WHEN 18 THEN 'tel 12 34 56 78' ELSE '+44 20 7946 0958' END AS tok FROM e),
r AS (SELECT *, 'pre ' || tok || ' post' AS raw, 'pre ' || CASE WHEN k % 20 < 12 THEN '[redacted:secret]'
  WHEN k % 20 < 14 THEN '[redacted:phi]' WHEN k % 20 = 14 THEN '[redacted:pan]' WHEN k % 20 = 15 THEN tok
  WHEN k % 20 = 16 THEN '[redacted:email]' WHEN k % 20 = 17 THEN 'call [redacted:phone]'
  WHEN k % 20 = 18 THEN 'tel [redacted:phone]' ELSE '[redacted:phone]' END || ' post' AS clean,
  CASE WHEN k % 20 < 12 THEN 1 ELSE 0 END AS secret, CASE WHEN k % 20 = 14 THEN 1 ELSE 0 END AS credential,
  CASE WHEN k % 20 IN (12, 13, 16, 17, 18, 19) THEN 1 ELSE 0 END AS pii FROM t)
"""


@query(_TOKENS + "SELECT event_type, CAST(sum(secret) AS BIGINT) AS n FROM r GROUP BY 1")
def detect_secrets(spark, sf):
    return secrets(spark, sf).groupBy("event_type").agg(F.sum(F.size(S.detect_secrets(F.col("text")))).alias("n"))


@query(_TOKENS + "SELECT event_type, count(*) FILTER (k % 20 IN (12, 13)) AS n FROM r GROUP BY 1")
def detect_phi(spark, sf):
    return secrets(spark, sf).groupBy("event_type").agg(F.sum(F.size(S.detect_phi(F.col("text")))).alias("n"))


@query(_TOKENS + "SELECT event_type, count(*) FILTER (k % 20 = 14) AS n FROM r GROUP BY 1")
def detect_cards(spark, sf):
    return secrets(spark, sf).groupBy("event_type").agg(F.sum(F.size(S.detect_pan(F.col("text")))).alias("n"))


@query(_TOKENS + """SELECT event_id, CASE WHEN k % 20 < 12 THEN 'secret' WHEN k % 20 < 14 THEN 'phi' ELSE 'pan' END AS cls,
  CAST(CASE WHEN k % 20 < 12 THEN k % 20 WHEN k % 20 = 13 THEN 1 ELSE 0 END AS INTEGER) AS pattern_id,
  CASE WHEN k % 20 < 12 THEN left(tok, 4) || repeat('*', CAST(least(length(tok), 64) - 8 AS INTEGER)) || right(left(tok, 64), 4)
       WHEN k % 20 < 14 THEN '[phi:redacted]' ELSE '[pan:redacted]' END AS match_excerpt
FROM r WHERE k % 20 <= 14""")
def sensitive_hits(spark, sf):
    return R.sensitive_hits(secrets(spark, sf).select("event_id", "text"), "text")


@query(_TOKENS + """SELECT event_id, CASE WHEN k % 20 < 15 THEN clean ELSE raw END AS clean FROM r""")
def catalog_redaction(spark, sf):
    return secrets(spark, sf).select("event_id", S.redact_catalog(F.col("text")).alias("clean"))


# A run of digits of a phone number's length, also inside a token; twice, as neighbours share the character between them.
_DIGITS = "regexp_replace({}, '(^|[^0-9])(?:[0-9]{{10,13}}|00[0-9]{{7,16}})($|[^0-9])', '\\1[redacted:phone]\\2', 'g')"


@query(_TOKENS + f"SELECT event_id, CASE WHEN k % 20 > 15 THEN clean ELSE {_DIGITS.format(_DIGITS.format('raw'))} END AS clean FROM r")
def pii_redaction(spark, sf):
    """E-mails and phones alone, over the texts of all events."""
    return secrets(spark, sf).select("event_id", S.redact_pii(F.col("text")).alias("clean"))


@query(_TOKENS + "SELECT event_id, clean AS text, credential, pii, secret FROM r")
def full_redaction(spark, sf):
    return secrets(spark, sf).select("event_id", S.redact_with_findings(F.col("text")).alias("r")).select(
        "event_id", "r.*")


# RE2 has no look-around: the oracle consumes the neighbours. Characters that can stand between two
# numbers are doubled first, so that each number has neighbours of its own. Card numbers are checked
# with a Luhn sum over their digits.
_DOC_SQL = r"""
WITH c AS (SELECT doc_id, source, text, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,63}')) AS mails,
  list_filter(regexp_extract_all(regexp_replace(text, '([^0-9A-Za-z_])', '\1\1', 'g'), '(?:^|[^0-9A-Za-z_])([0-9]{13,19})(?:$|[^0-9A-Za-z_])', 1), lambda x:
    list_sum(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN (len(x) - i) % 2 = 1 THEN
      (CASE WHEN CAST(x[i] AS INTEGER) * 2 > 9 THEN CAST(x[i] AS INTEGER) * 2 - 9 ELSE CAST(x[i] AS INTEGER) * 2 END)
      ELSE CAST(x[i] AS INTEGER) END)) % 10 = 0) AS cards FROM documents),
d AS (SELECT *, list_reduce(list_prepend(text, cards), lambda a, x: replace(a, x, '[redacted:pan]')) AS t2 FROM c),
m AS (SELECT *, regexp_replace(t2, '[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,63}', '[m]', 'g') AS t3 FROM d),
n AS (SELECT *, '(^|[^0-9])(?:(?:\+?[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|(?:\+|00)[ .\-]?[0-9]{1,3}[ .\-]?(?:[0-9][ .\-]?){5,12}[0-9])($|[^0-9])' AS pat FROM m),
p AS (SELECT *, len(regexp_extract_all(regexp_replace(t3, '([^0-9 .()+-])', '\1\1', 'g'), pat)) + len(regexp_extract_all(regexp_replace(t3, pat, '\1[p]\2', 'g'),
  '(?i)(?:tel|phone|call|ring|mobile|cell|fax|whatsapp)[ :.\-]{1,4}(?:[0-9][ .\-]?){6,13}[0-9]')) AS phones FROM n)
"""


@query(_DOC_SQL + """SELECT source, CAST(sum(len(cards)) AS BIGINT) AS credential, CAST(sum(mails + phones) AS BIGINT) AS pii,
  CAST(0 AS BIGINT) AS secret, count(*) FILTER (len(cards) + mails + phones > 0) AS documents_changed FROM p GROUP BY source""")
def document_findings(spark, sf):
    """What redaction finds in whole documents, by source."""
    docs = spread(table(spark, sf, "documents")).select("source", "text", S.redact_with_findings(F.col("text")).alias("r"))
    return docs.groupBy("source").agg(
        F.sum("r.credential").alias("credential"), F.sum("r.pii").alias("pii"), F.sum("r.secret").alias("secret"),
        F.count_if(F.col("r.text") != F.col("text")).alias("documents_changed"))


def document_observations(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents")).select(
        "doc_id", "source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"),
        F.col("text").alias("content"))
    return observe.observe_files(docs)


@query(_DOC_SQL + """SELECT source, count(*) AS emissions, count(*) FILTER (len(cards) + mails + phones > 0) AS restricted
FROM p GROUP BY source""")
def restricted_sources(spark, sf):
    """Which sources carry restricted text? Files, sanitizing, emissions, contract, classification."""
    valid, _ = normalize.normalize(document_observations(spark, sf), completed_at="2024-01-01T00:00:00Z")
    out = mods.prepare(valid, [mods.MODS["data-classification"]]).select(
        "source", F.size(mods.data_classification(mods.Row(mod="data-classification"))).alias("n"))
    return out.groupBy("source").agg(
        F.count("*").alias("emissions"), F.count_if(F.col("n") > 0).alias("restricted"))


#: Numbers that a parse would change, white space, an escape, an empty list, a repeated key.
_LEFT_ALONE = ' , "n" :\t[1.00,-0.0, 1e400,12345678901234567890.123 ,{"caf\\u00e9":"\\u00e9\\/"}],"n":[ ]'


@query(_TOKENS + f"""SELECT event_id, '{{"a":{{"note":"' || clean || '"{_LEFT_ALONE},"k":' || k || '}},"list":["' || clean || '",true,null]}}' AS doc
FROM r""")
def nested_json_redaction(spark, sf):
    text = F.col("text")
    doc = F.concat(F.lit('{"a":{"note":"'), text, F.lit(f'"{_LEFT_ALONE},"k":'), F.col("k").cast("string"), F.lit('},"list":["'), text,
                   F.lit('",true,null]}'))
    return R.redact_json(secrets(spark, sf).select("event_id", doc.alias("doc")), "doc")


def tracked(spark: SparkSession, sf: str, hostile: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Observations with a sensitive excerpt; ``hostile`` has bad ids and metadata keys by rule. ``keep`` names columns of ``secrets`` to carry along."""
    df = secrets(spark, sf)
    eid = F.col("event_id").cast("string")
    bad_ref = F.when(F.col("k") % 10 == 3, F.col("text")).otherwise(F.concat(F.lit("R-"), eid))
    key = F.when(F.col("k") % 10 == 7, F.concat(F.lit("user"), eid, F.lit("@example.com"))).otherwise(F.lit("channel"))
    cols = observation_columns(
        "slack", ref=bad_ref if hostile else F.concat(F.lit("R-"), eid), kind="message", excerpt=F.col("text"),
        mode="webhook", title=F.concat(F.lit("T "), F.col("event_type")), author=F.lit("alice"),
        timestamp=F.lit("2024-01-01"), provider_event_id=F.concat(F.lit("ev-"), eid),
        evidence_id=F.concat(F.lit("slack:"), eid), metadata={"channel": F.lit("C1"), "note": F.col("text")})
    if hostile:
        cols = [*cols, F.create_map(key, F.lit("C1")).alias("_keyed")]
    out = df.select("event_id", "event_type", *keep, *cols)
    return out.withColumn("metadata", F.col("_keyed")).drop("_keyed") if hostile else out


_JSON = ("'{\"author\":\"alice\",\"evidence_id\":\"slack:' || event_id || '\",\"evidence_metadata\":{},\"excerpt\":\"' || X || "
         "'\",\"metadata\":{\"channel\":\"C1\",\"note\":\"' || X || '\"},\"mode\":\"webhook\",\"provider_event_id\":\"ev-' || event_id || "
         "'\",\"provider_resource_id\":\"\",\"source_ref\":{\"kind\":\"message\",\"ref\":\"R-' || event_id || "
         "'\",\"source_id\":\"slack\",\"url\":\"\"},\"timestamp\":\"2024-01-01\",\"title\":\"T ' || event_type || '\"}'")


@query(_TOKENS + f"SELECT event_id, 'sha256:' || sha256({_JSON.replace('X', 'raw')}) AS digest FROM r")
def observation_digests(spark, sf):
    return tracked(spark, sf).select("event_id", canonical_digest(R.observation_json()).alias("digest"))


_FOUND = ("concat_ws(',', CASE WHEN credential > 0 THEN 'credential=' || credential * 2 END, "
          "CASE WHEN pii > 0 THEN 'pii=' || pii * 2 END, CASE WHEN secret > 0 THEN 'secret=' || secret * 2 END)")


@query(_TOKENS + f"""SELECT event_id, 'sha256:' || sha256({_JSON.replace('X', 'raw')}) AS input_digest,
  'sha256:' || sha256({_JSON.replace('X', 'clean')}) AS output_digest, {_FOUND} AS findings, clean AS excerpt FROM r""")
def sanitized_receipts(spark, sf):
    clean, _ = R.sanitize(tracked(spark, sf), "2024-01-01T00:00:00Z")
    r = "redaction_receipt."
    found = F.transform(r + "findings", lambda f: F.concat(f["category"], F.lit("="), f["count"].cast("string")))
    return clean.select(
        "event_id", F.col(r + "input_digest").alias("input_digest"), F.col(r + "output_digest").alias("output_digest"),
        F.array_join(found, ",").alias("findings"), "excerpt")


_RULESET = ('{"catalog":"FX-SEC-001/v1","detectors":["secret","phi","pan","email","phone"],"identity_policy":'
            '"preserve-opaque-identifiers; hard-catalog-fail-closed","metadata_policy":"recursive-values; '
            'sensitive-keys-rejected","replacement":"[redacted:<category>]"}')
_FOUND_JSON = ("concat_ws(',', CASE WHEN credential > 0 THEN '{\"action\":\"tokenized\",\"category\":\"credential\",\"count\":' || credential * 2 || '}' END, "
               "CASE WHEN pii > 0 THEN '{\"action\":\"tokenized\",\"category\":\"pii\",\"count\":' || pii * 2 || '}' END, "
               "CASE WHEN secret > 0 THEN '{\"action\":\"tokenized\",\"category\":\"secret\",\"count\":' || secret * 2 || '}' END)")


@query(_TOKENS + f"""SELECT event_id, 'sha256:' || sha256('{{"engine":"sievelight-redaction","engine_version":"1.0.0","findings":['
  || {_FOUND_JSON} || '],"input_digest":"sha256:' || sha256({_JSON.replace('X', 'raw')}) || '","output_digest":"sha256:'
  || sha256({_JSON.replace('X', 'clean')}) || '","ruleset_digest":"sha256:' || sha256('{_RULESET}')
  || '","ruleset_id":"fx-sec-001-plus-pii-v1","schema_version":1,"structural_fields_preserved":true}}') AS receipt_id FROM r""")
def receipt_digests(spark, sf):
    clean, _ = R.sanitize(tracked(spark, sf), "2024-01-01T00:00:00Z")
    return clean.select("event_id", R.receipt_digest(F.col("redaction_receipt")).alias("receipt_id"))


@query(_TOKENS + """SELECT event_id, CASE WHEN k % 10 = 3 AND k % 20 <= 14 THEN 'sensitive_identity_field:source_ref.ref'
  ELSE 'clean' END AS outcome FROM r""")
def identity_guard(spark, sf):
    good, bad = R.guard_identity(tracked(spark, sf, hostile=True))
    return good.select("event_id", F.lit("clean").alias("outcome")).unionByName(
        bad.select("event_id", F.col("reason").alias("outcome")))


@query(_TOKENS + """SELECT event_id, CASE WHEN k % 10 = 7 THEN 'sensitive_metadata_key:metadata' ELSE 'clean' END AS outcome FROM r""")
def sensitive_keys(spark, sf):
    good, bad = R.reject_sensitive_keys(tracked(spark, sf, hostile=True))
    return good.select("event_id", F.lit("clean").alias("outcome")).unionByName(
        bad.select("event_id", F.col("reason").alias("outcome")))


@query(_TOKENS + """SELECT event_type, CASE WHEN k % 10 = 3 AND k % 20 <= 14 THEN 'sensitive_identity_field:source_ref.ref'
  WHEN k % 10 = 7 THEN 'sensitive_metadata_key:metadata' ELSE 'clean' END AS outcome, count(*) AS n FROM r GROUP BY ALL""")
def sanitize_outcomes(spark, sf):
    rows = R.mark_sanitized(tracked(spark, sf, hostile=True)).select("event_type", F.coalesce("reason", F.lit("clean")).alias("outcome"))
    return rows.groupBy("event_type", "outcome").agg(F.count("*").alias("n"))


@query(_TOKENS + f"""SELECT event_type, count(*) FILTER (strlen({_JSON.replace('X', 'raw')}) > 330) AS oversized,
  count(*) FILTER (strlen({_JSON.replace('X', 'raw')}) <= 330) AS within FROM r GROUP BY 1""")
def size_gate(spark, sf):
    good, bad = R.gate_size(tracked(spark, sf), limit=330)
    rows = good.select("event_type", F.lit(0).alias("b")).unionByName(bad.select("event_type", F.lit(1).alias("b")))
    return rows.groupBy("event_type").agg(
        F.count_if(F.col("b") == 1).alias("oversized"), F.count_if(F.col("b") == 0).alias("within"))


@query(f"""
WITH e AS (SELECT event_id, event_type, {SQL_K} AS k FROM events)
SELECT event_id, true AS same_digest, true AS well_formed, 0 AS n_findings FROM e""")
def screened_receipts(spark, sf):
    """Zero-finding receipts of clean emissions."""
    em = normalize.to_emissions(tracked(spark, sf).withColumn("excerpt", F.lit("plain text")).withColumn(
        "metadata", F.create_map(F.lit("a"), F.lit("b"))))
    rows = em.select("event_id", R.screened_receipt(normalize.emission_json(), "2024-01-01T00:00:00Z").alias("receipt"))
    return R.audit_receipts(rows, "receipt").select(
        "event_id", (F.col("receipt.input_digest") == F.col("receipt.output_digest")).alias("same_digest"),
        F.col("reason").isNull().alias("well_formed"), F.size("receipt.findings").alias("n_findings"))


_DEFECTS = ["none", "extra_key", "version", "flag", "digest", "category", "action", "count", "time", "scalar"]


@query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id, (['ok','redaction_receipt_incomplete','redaction_receipt_version','structural_fields_not_preserved',
 'invalid_input_digest','redaction_finding_category','redaction_finding_action','redaction_finding_count',
 'invalid_completed_at','redaction_receipt_required'])[1 + k % 10] AS outcome FROM e""")
def receipt_audit(spark, sf):
    d = element(_DEFECTS, F.col("k"))
    bad = lambda name, wrong, right: F.when(d == name, F.lit(wrong)).otherwise(F.lit(right))
    digest = "sha256:" + "a" * 64
    receipt = F.to_json(struct(
        schema_version=bad("version", 2, 1), engine=F.lit("x"), engine_version=F.lit("1"), ruleset_id=F.lit("r"),
        ruleset_digest=F.lit(digest), input_digest=bad("digest", "sha256:xyz", digest), output_digest=F.lit(digest),
        findings=F.array(struct(category=bad("category", "phi", "pii"), action=bad("action", "masked", "removed"),
                                count=bad("count", 0, 2))),
        structural_fields_preserved=bad("flag", False, True),
        completed_at=bad("time", "yesterday", "2024-01-01T00:00:00Z"), extra=F.when(d == "extra_key", F.lit(1))))
    rows = table(spark, sf, "events").withColumn("k", k_of()).select(
        "event_id", F.when(d == "scalar", F.lit("7")).otherwise(receipt).alias("receipt"))
    return R.audit_receipts(rows, "receipt").select("event_id", F.coalesce("reason", F.lit("ok")).alias("outcome"))


@query(_TOKENS + """, f AS (SELECT event_type AS source, 'credential' AS category, credential * 2 AS n FROM r UNION ALL
  SELECT event_type, 'pii', pii * 2 FROM r UNION ALL SELECT event_type, 'secret', secret * 2 FROM r)
SELECT source, category, CAST(sum(n) AS BIGINT) AS findings FROM f WHERE n > 0 GROUP BY ROLLUP (source, category)""")
def findings_rollup(spark, sf):
    clean, _ = R.sanitize(tracked(spark, sf))
    return R.findings_summary(clean.withColumnRenamed("event_type", "source"), "source")
