"""Queries for signature checks and replay dedup (operators B1-B10, C1-C6).

Deliveries are derived from all events: the body is the event's JSON, the headers carry signatures made
with a fixed test key, some of them damaged by a rule on the event's ``k``.
"""

from __future__ import annotations

import base64

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievelight.functions.crypto import hmac_sha256_hex
from sievelight.operators import dedup, history, verify
from sievelight.plans.common import SQL_K, element, instant, k_of, run_folder, spread, struct, table
from sievelight.sources.landing import body_payload
from sievelight.streaming import dedup as stream_dedup, ingest

QUERIES, ORACLES = {}, {}

KEY = "unit-test-key"
STANDARD_KEY = "whsec_" + base64.b64encode(KEY.encode()).decode()


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream of files."""
    return spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _events(spark: SparkSession, sf: str, streaming: bool = False) -> DataFrame:
    body = F.to_json(struct(
        id=F.col("event_id"), type=F.lit("Issue"), kind=F.col("event_type"), k=k_of(),
        webhookTimestamp=F.unix_millis(instant("ts")) + F.when(k_of() % 5 == 4, 61_000).otherwise(0)))
    events = _landed(spark, sf) if streaming else spread(table(spark, sf, "events"))
    return events.select(
        "event_id", "event_type", "user_id", k_of().alias("k"), instant("ts").alias("received_at"),
        body.cast("binary").alias("body"))


def _pad(byte: int) -> str:
    key = KEY.encode().ljust(64, b"\0")
    return bytes(b ^ byte for b in key).hex()


# The body an oracle rebuilds from the same columns.
_SQL_BODY = (
    "'{\"id\":' || event_id || ',\"type\":\"Issue\",\"kind\":\"' || event_type || '\",\"k\":' || k || "
    "',\"webhookTimestamp\":' || (epoch_us(ts) // 1000 + CASE WHEN k % 5 = 4 THEN 61000 ELSE 0 END) || '}'"
)


@query(f"""
WITH e AS (SELECT *, {SQL_K} AS k FROM events), b AS (SELECT event_id, encode({_SQL_BODY}) AS body FROM e)
SELECT event_id, sha256(unhex('{_pad(0x5c)}') || unhex(sha256(unhex('{_pad(0x36)}') || body))) AS mac FROM b""")
def hmac_hex(spark, sf):
    return _events(spark, sf).select("event_id", hmac_sha256_hex(F.col("body"), KEY.encode()).alias("mac"))


def _damaged(good: Column) -> Column:
    """Good for k%5 in 0, 1 and 4; empty for 2; wrong for 3."""
    return F.when(F.col("k") % 5 == 2, F.lit("")).when(F.col("k") % 5 == 3, F.concat(F.lit("0"), good)).otherwise(good)


def _headers(**pairs: Column) -> Column:
    # Header names are lower-cased for odd k: lookups ignore case.
    entries = []
    for name, value in pairs.items():
        label = name.replace("_", "-")
        entries += [F.when(F.col("k") % 2 == 1, F.lit(label.lower())).otherwise(F.lit(label)), value]
    return F.create_map(*entries)


def _signed(spark: SparkSession, sf: str, provider: str, df: DataFrame | None = None) -> tuple[DataFrame, str]:
    df = _events(spark, sf) if df is None else df
    mac = hmac_sha256_hex(F.col("body"), KEY.encode())
    prefixed = F.concat(F.lit("sha256="), mac)
    # Time windows: k%5 = 4 is outside.
    stamp = (F.unix_seconds("received_at") - F.when(F.col("k") % 5 == 4, 400).otherwise(100)).cast("string")

    def over(*parts: Column) -> Column:
        return hmac_sha256_hex(F.concat(*[p.cast("binary") for p in parts]), KEY.encode())

    b64 = lambda hexed: F.base64(F.unhex(hexed))
    body = F.col("body")
    event = F.col("event_id").cast("string")
    bare = F.when(F.col("k") % 5 == 4, mac).otherwise(prefixed)
    headers = {
        "github": lambda: _headers(**{"X-Hub-Signature-256": _damaged(bare)}),
        "github_issues": lambda: _headers(**{"X-Hub-Signature-256": _damaged(bare)}),
        "jira": lambda: _headers(**{"X-Hub-Signature": _damaged(bare)}),
        "notion": lambda: _headers(**{"X-Notion-Signature": _damaged(bare)}),
        "sentry": lambda: _headers(**{"Sentry-Hook-Signature": _damaged(mac)}),
        "linear": lambda: _headers(**{"Linear-Signature": _damaged(mac)}),
        "pagerduty": lambda: _headers(**{
            "X-PagerDuty-Signature": F.concat(F.lit("v1=00, v1="), _damaged(mac))}),
        "gitlab": lambda: _headers(**{"X-Gitlab-Token": _damaged(F.lit(KEY))}),
        "slack": lambda: _headers(**{
            "X-Slack-Signature": _damaged(F.concat(F.lit("v0="), over(F.lit("v0:"), stamp, F.lit(":"), body))),
            "X-Slack-Request-Timestamp": stamp}),
        "zendesk": lambda: _headers(**{
            "X-Zendesk-Webhook-Signature": _damaged(b64(over(stamp, body))),
            "X-Zendesk-Webhook-Signature-Timestamp": stamp}),
        "fathom": lambda: _headers(**{
            "webhook-id": event, "webhook-timestamp": stamp,
            "webhook-signature": F.concat(
                F.lit("v1,AAAA v1,"), _damaged(b64(over(event, F.lit("."), stamp, F.lit("."), body))))}),
    }[provider]()
    return df.withColumn("headers", headers), STANDARD_KEY if provider == "fathom" else KEY


# Providers whose rule also rejects k%5 = 4: a time window, or a prefix that must be there.
_STRICT = {"slack", "fathom", "linear", "notion", "github_issues"}


def _verified(provider: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df, secret = _signed(spark, sf, provider)
        return verify.mark_deliveries(df, provider, secret).select("event_id", F.coalesce("reason", F.lit("accepted")).alias("outcome"))

    good = "0, 1" if provider in _STRICT else "0, 1, 4"
    query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT event_id, CASE WHEN k % 5 IN ({good}) THEN 'accepted' ELSE 'signature_rejected' END AS outcome FROM e""", f"verified_{provider}")(run)


for _p in ("github", "github_issues", "jira", "notion", "sentry", "linear", "pagerduty", "gitlab", "slack",
           "zendesk", "fathom"):
    _verified(_p)


def _identified(spark: SparkSession, sf: str, provider: str) -> DataFrame:
    """Deliveries with header ids for even k, body ids for k%3 > 0, no id otherwise."""
    df = table(spark, sf, "events").select("event_id", k_of().alias("k"))
    head = F.when(F.col("k") % 2 == 0, F.concat(F.lit("h-"), F.col("event_id").cast("string"))).otherwise(F.lit(""))
    bid = F.when(F.col("k") % 3 > 0, F.concat(F.lit("b-"), F.col("event_id").cast("string")))
    body = F.to_json(struct(
        id=bid, event_id=bid, webhookId=bid, issue=struct(id=bid), data=struct(issue=struct(id=bid)),
        event=struct(id=bid)))
    names = ["X-GitHub-Delivery", "X-Gitlab-Event-UUID", "X-Atlassian-Webhook-Identifier", "Request-ID", "webhook-id"]
    headers = F.create_map(*[x for n in names for x in (F.lit(n), head)])
    df = df.select("event_id", headers.alias("headers"), body.cast("binary").alias("body"))
    return dedup.with_delivery_id(body_payload(df), provider).select("source", "event_id", "delivery_id")


_ID_PROVIDERS = ["github", "gitlab", "jira", "notion", "sentry", "zendesk", "pagerduty", "slack", "linear", "fathom"]


@query(f"""
WITH e AS (SELECT event_id, {SQL_K} AS k FROM events),
i AS (SELECT event_id, CASE WHEN k % 2 = 0 THEN 'h-' || event_id ELSE '' END AS h,
             CASE WHEN k % 3 > 0 THEN 'b-' || event_id ELSE '' END AS b FROM e),
d AS (SELECT *, sha256(CASE WHEN b <> '' THEN '{{"id":"' || b || '","event_id":"' || b || '","webhookId":"' || b
      || '","issue":{{"id":"' || b || '"}},"data":{{"issue":{{"id":"' || b || '"}}}},"event":{{"id":"' || b || '"}}}}'
      ELSE '{{"issue":{{}},"data":{{"issue":{{}}}},"event":{{}}}}' END) AS digest FROM i),
p AS (SELECT unnest(['github','gitlab','jira','notion','sentry','zendesk','pagerduty','slack','linear','fathom']) AS source),
r AS (SELECT source, event_id, CASE
  WHEN source IN ('github','gitlab') THEN coalesce(nullif(h, ''), digest)
  WHEN source IN ('jira','sentry') THEN coalesce(nullif(h, ''), nullif(b, ''), digest)
  WHEN source IN ('notion','zendesk','pagerduty') THEN coalesce(nullif(b, ''), digest)
  WHEN source = 'fathom' THEN h ELSE b END AS delivery_id FROM d, p)
SELECT * FROM r WHERE NOT (source IN ('linear','fathom') AND delivery_id = '')""")
def delivery_ids(spark, sf):
    out = None
    for p in _ID_PROVIDERS:
        rows = _identified(spark, sf, p)
        out = rows if out is None else out.unionByName(rows)
    return out


def _ident() -> Column:
    """Delivery ids that repeat; null for some users and blank for others."""
    user = F.col("user_id")
    return F.when(user % 17 == 3, F.lit(None)).when(user % 17 == 5, F.lit("")).otherwise(
        F.concat(user.cast("string"), F.lit("/"), F.col("event_type")))


def _replays(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "event_type", _ident().alias("delivery_id"),
                                             instant("ts").alias("received_at"))


@query("""
SELECT event_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS rn
FROM events) WHERE rn = 1 OR user_id % 17 IN (3, 5)""")
def replay_dedup(spark, sf):
    return dedup.dedup_deliveries(
        _replays(spark, sf), ["event_type", "delivery_id"], ["received_at", "event_id"]).select("event_id")


@query("""
SELECT event_id, user_id % 17 NOT IN (3, 5) AND row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) > 1
  AS duplicate_delivery FROM events""")
def duplicate_marks(spark, sf):
    return dedup.mark_duplicates(
        _replays(spark, sf), ["event_type", "delivery_id"], ["received_at", "event_id"]).select(
        "event_id", "duplicate_delivery")


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id || '/' || event_type AS id, ts FROM events WHERE user_id % 17 NOT IN (3, 5)),
o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS rn FROM e),
w AS (SELECT id, rn, event_id, ts AS last, true AS keep FROM o WHERE rn = 1
  UNION ALL
  SELECT o.id, o.rn, o.event_id, CASE WHEN o.ts - w.last > INTERVAL 86400 SECOND THEN o.ts ELSE w.last END,
         o.ts - w.last > INTERVAL 86400 SECOND FROM w JOIN o ON o.id = w.id AND o.rn = w.rn + 1)
SELECT event_id FROM w WHERE keep UNION ALL SELECT event_id FROM events WHERE user_id % 17 IN (3, 5)""")
def ttl_dedup(spark, sf):
    return dedup.dedup_ttl(_replays(spark, sf), ["delivery_id"], "received_at", "event_id").select("event_id")


@query(ORACLES["ttl_dedup"])
def daily_ttl_dedup(spark, sf):
    """The same rule over runs of a third of the time each, with a history of the ids between them."""
    rows = _replays(spark, sf)
    low, high, n = rows.agg(F.min("received_at"), F.max("received_at"), F.count("*")).first()
    seen = history.SeenIds(spark, f"{run_folder(spark)}/seen", ["delivery_id"], history.buckets_for(n))
    edges = [low + (high - low) * k / 3 for k in range(3)]
    out = None
    for run, start in enumerate(edges):
        own = rows.where(F.col("received_at") >= start)
        if run < 2:
            own = own.where(F.col("received_at") < edges[run + 1])
        kept = history.dedup_run(own, run, seen, "received_at", "event_id", edges[run + 1] if run < 2 else high).select("event_id")
        out = kept if out is None else out.unionByName(kept)
    return out


_ACTIONS = ["opened", "edited", "created", "deleted", "labeled"]


@query(f"""
WITH e AS (SELECT event_id, event_type, {SQL_K} AS k FROM events),
a AS (SELECT *, (['opened','edited','created','deleted','labeled'])[1 + k % 5] AS action,
      CASE WHEN event_type IN ('click','view') THEN 'issues' ELSE 'issue_comment' END AS event_name FROM e)
SELECT 'github_issues' AS source, event_id FROM a WHERE (event_name = 'issues' AND action IN ('opened','edited'))
   OR (event_name = 'issue_comment' AND action IN ('created','edited','deleted'))
UNION ALL SELECT 'linear', event_id FROM a WHERE k % 3 <> 0 AND k % 7 <> 0
UNION ALL SELECT 'slack', event_id FROM a WHERE k % 3 <> 0""")
def admitted_events(spark, sf):
    k = k_of()
    body = F.to_json(struct(
        action=F.when(k % 7 == 0, F.lit("remove")).otherwise(element(_ACTIONS, k)),
        type=F.when(k % 3 == 0, F.lit("url_verification")).otherwise(F.lit("Issue")),
        data=struct(identifier=F.col("event_id").cast("string"))))  # text, as the provider sends it: a number 0 counts as none
    name = F.when(F.col("event_type").isin("click", "view"), F.lit("issues")).otherwise(F.lit("issue_comment"))
    df = table(spark, sf, "events").select(
        "event_id", name.alias("event_name"), F.try_parse_json(body).alias("payload_v"),
        F.try_parse_json(F.to_json(struct(action=element(_ACTIONS, k)))).alias("issue_v"))
    out = dedup.admit_events(df.withColumn("payload_v", F.col("issue_v")), "github_issues").select(
        F.lit("github_issues").alias("source"), "event_id")
    for p in ("linear", "slack"):
        out = out.unionByName(dedup.admit_events(df, p).select(F.lit(p).alias("source"), "event_id"))
    return out


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    return _landed(spark, sf).select("event_id", "event_type", _ident().alias("delivery_id"), instant("ts").alias("received_at"))


def _drain(stream: DataFrame) -> DataFrame:
    """Run a stream over everything that has landed and read its table back."""
    spark = stream.sparkSession
    folder = run_folder(spark)
    schema = stream.schema
    q = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out")


@query("""SELECT user_id || '/' || event_type AS delivery_id, 1 AS n FROM events WHERE user_id % 17 NOT IN (3, 5) GROUP BY 1
UNION ALL SELECT '', count(*) FROM events WHERE user_id % 17 IN (3, 5)""")
def stream_replay_dedup(spark, sf):
    kept = stream_dedup.dedup_watermark(_stream(spark, sf), ["delivery_id"], delay="60 days")
    rows = _drain(kept.select("event_id", F.coalesce("delivery_id", F.lit("")).alias("delivery_id")))
    return rows.groupBy("delivery_id").agg(F.count("*").alias("n"))


def _with_rocksdb(spark: SparkSession, run) -> DataFrame:
    """Run a stream with the state store that keyed judges need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, stream_dedup.ROCKSDB)
    try:
        return run()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _closed(stream: DataFrame, ts: str, key: str) -> DataFrame:
    """The stream and one row without an id in the far future, which closes all windows."""
    spark, folder = stream.sparkSession, run_folder(stream.sparkSession)
    spark.range(1).select(F.lit("2200-01-01").cast("timestamp").alias(ts), F.lit("").alias(key)).write.parquet(folder)
    last = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    return stream.unionByName(last, allowMissingColumns=True)


@query(ORACLES["ttl_dedup"])
def stream_ttl_dedup(spark, sf):
    def run():
        stream = _closed(_stream(spark, sf), "received_at", "delivery_id")
        return _drain(stream_dedup.dedup_ttl_stream(stream, ["delivery_id"], "received_at", "event_id").select("event_id"))

    return _with_rocksdb(spark, run).where("event_id IS NOT NULL")


_OUTCOME_SQL = f"""
WITH e AS (SELECT event_id, ts, user_id || '/' || event_type AS id, {SQL_K} AS k FROM events),
r AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'missing_body' WHEN k % 5 IN (2, 3) THEN 'signature_rejected'
  WHEN k % 7 = 6 THEN 'unparseable_body' END AS reason FROM e),
o AS (SELECT CASE WHEN reason IS NULL THEN id ELSE '' END AS delivery_id, coalesce(reason,
  CASE WHEN row_number() OVER (PARTITION BY id, reason ORDER BY ts) = 1 THEN 'accepted' ELSE 'duplicate' END) AS outcome FROM r)
SELECT delivery_id, outcome, count(*) AS n FROM o GROUP BY ALL"""


def _broken(spark: SparkSession, sf: str, streaming: bool = False) -> tuple[DataFrame, str]:
    """Signed deliveries of which some have no body, a damaged signature, or a body that is no JSON."""
    df = _events(spark, sf, streaming).withColumn("body", F.when(F.col("k") % 7 == 6, F.lit("{").cast("binary")).otherwise(F.col("body")))
    signed, secret = _signed(spark, sf, "jira", df)
    named = F.map_concat("headers", F.create_map(F.lit("X-Atlassian-Webhook-Identifier"), F.concat_ws("/", "user_id", "event_type")))
    body = F.when(F.col("k") % 11 != 0, F.col("body"))
    return signed.select("event_id", "received_at", named.alias("headers"), body.alias("body")), secret


def _outcomes(judged: DataFrame) -> DataFrame:
    """Ids of rejected rows are left out: whether one was read depends on the rule that failed."""
    judges = ("accepted", "duplicate", "late")
    return judged.select("event_id", "outcome", F.when(F.col("outcome").isin(*judges), F.col("delivery_id")).otherwise("").alias("delivery_id"))


@query(_OUTCOME_SQL)
def delivery_outcomes(spark, sf):
    """Accepted and rejected deliveries add up to all that landed."""
    df, secret = _broken(spark, sf)
    return _outcomes(ingest.judged_deliveries(df, "jira", secret)).groupBy("delivery_id", "outcome").agg(F.count("*").alias("n"))


@query(_OUTCOME_SQL)
def stream_delivery_outcomes(spark, sf):
    df, secret = _broken(spark, sf, True)
    year = 366 * 86_400
    rows = _with_rocksdb(spark, lambda: _drain(_outcomes(ingest.judged_deliveries(df, "jira", secret, "60 days", year))))
    return rows.groupBy("delivery_id", "outcome").agg(F.count("*").alias("n"))
