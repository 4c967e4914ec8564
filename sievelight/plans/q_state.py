"""Queries for cursors, incremental state and the resource catalogue (operators I1-I6, J1-J10)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from sievelight.operators import catalogue as C, cursors as I
from sievelight.plans.common import SQL_K, element, k_of, payload, run_folder, sql_element, struct, table
from sievelight.plans.q_redaction import CARDS
from sievelight.streaming import cursor as stream_cursor

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


_STATUS = ["201", "422", "422", "400", "400", "429", "503", "0", "403", "404", "302", "500", "410"]
_REASON = ["", "", "other", "GATEWAY_rejected", "bad field", "", "phi_detected upstream", "", "policy", "", "",
           "protocol_mismatch:x", ""]
_VERDICT = ["advance", "quarantine", "advance", "quarantine", "advance", "retry", "quarantine", "retry", "advance",
            "advance", "retry", "quarantine", "advance"]
_WHY = ["", "sensitive_data_rejected", "unknown_client_error", "schema_drift", "payload_invalid", "", "sensitive_data_rejected", "",
        "governance_veto", "unknown_client_error", "", "schema_drift", "unknown_client_error"]


def _results(spark, sf):
    df = table(spark, sf, "events").withColumn("k", k_of())
    return I.with_cursor_action(df.select(
        "event_id", "event_type", element(_STATUS, F.col("k")).cast("int").alias("status"), element(_REASON, F.col("k")).alias("reason")))


@query(f"""WITH e AS (SELECT event_id, {SQL_K} AS k FROM events) SELECT event_id, {sql_element(_VERDICT, 'k')} AS verdict,
  {sql_element(_WHY, 'k')} AS why FROM e""")
def cursor_verdicts(spark, sf):
    return _results(spark, sf).select(
        "event_id", "action.verdict",
        F.coalesce("action.terminal_reason", "action.quarantine_reason", F.lit("")).alias("why"))


@query(f"""WITH e AS (SELECT event_type, {SQL_K} AS k FROM events), v AS (SELECT event_type, {sql_element(_VERDICT, 'k')} AS v,
  {sql_element(_WHY, 'k')} AS w FROM e)
SELECT event_type, count(*) FILTER (v = 'advance') AS advance, count(*) FILTER (v = 'retry') AS retry,
  count(*) FILTER (v = 'quarantine') AS quarantine, count(*) FILTER (v = 'advance' AND w <> '') AS terminal FROM v GROUP BY 1""")
def verdict_counts(spark, sf):
    return I.verdict_summary(_results(spark, sf), "event_type")


def _versions(spark, sf):
    """Orders as versioned issues: the customer is the repository."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("repository_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
        F.format_string("d%010d", "o_orderkey").alias("provider_event_id"), F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "P").alias("is_pull"), F.col("o_orderpriority").alias("priority"))


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN '199' || (5 + c_custkey % 5) || '-06-01' END AS since FROM customer)
SELECT o_orderkey AS id FROM orders LEFT JOIN c ON o_custkey = c_custkey
WHERE o_orderstatus <> 'P' AND (since IS NULL OR strftime(o_orderdate, '%Y-%m-%d') >= since)""")
def incremental_pull(spark, sf):
    since = F.concat(F.lit("199"), (5 + F.col("c_custkey") % 5).cast("string"), F.lit("-06-01"))
    cursors = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("repository_id"), F.when(F.col("c_nationkey") < 20, since).alias("updated_at"))
    return I.in_order(I.incremental(_versions(spark, sf), cursors, is_pull="is_pull"), "updated_at", "id").select("id")


_NEXT = """
SELECT CAST(o_custkey AS VARCHAR) AS repository_id, max(strftime(o_orderdate, '%Y-%m-%d')) AS updated_at,
  arg_max(printf('d%010d', o_orderkey), (o_orderdate, o_orderkey)) AS last_provider_event_id, 1 AS schema_version
FROM orders GROUP BY o_custkey"""


@query(_NEXT)
def next_cursors(spark, sf):
    return I.next_cursor(_versions(spark, sf))


@query("""
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS repository_id, strftime(o_orderdate, '%Y-%m-%d') AS updated_at, printf('d%010d', o_orderkey) AS ev,
  CASE WHEN o_orderkey % 11 = 3 THEN 'retry' WHEN o_orderkey % 13 = 5 THEN 'quarantine' ELSE 'advance' END AS verdict FROM orders),
h AS (SELECT repository_id, min((updated_at, ev)) AS held FROM o WHERE verdict <> 'advance' GROUP BY 1)
SELECT repository_id, max(updated_at) AS updated_at, arg_max(ev, (updated_at, ev)) AS last_provider_event_id, 1 AS schema_version
FROM o LEFT JOIN h USING (repository_id) WHERE verdict = 'advance' AND (held IS NULL OR (updated_at, ev) < held) GROUP BY 1""")
def stream_cursors(spark, sf):
    """Store each micro-batch, then move the cursors over what was delivered."""
    folder = run_folder(spark)
    schema = table(spark, sf, "orders").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    rows = raw.select(
        F.col("o_custkey").cast("string").alias("repository_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
        F.format_string("d%010d", "o_orderkey").alias("provider_event_id"),
        F.when(F.col("o_orderkey") % 11 == 3, "retry").when(F.col("o_orderkey") % 13 == 5, "quarantine").otherwise("advance").alias("verdict"))
    q = stream_cursor.emit_with_cursor(rows, f"{folder}/out", f"{folder}/cursors", f"{folder}/state", verdict="verdict").trigger(
        availableNow=True).start()
    q.awaitTermination()
    return stream_cursor.read_cursors(spark, f"{folder}/cursors")


@query("""
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS repository_id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1 AND o_orderstatus <> 'P'""")
def latest_states(spark, sf):
    """Newest version per customer; status P stands for a deletion."""
    return I.latest_state(_versions(spark, sf), "repository_id", ["updated_at", "id"], "is_pull").select("id", "repository_id")


# --- catalogue ------------------------------------------------------------------------------------


@query("""SELECT c_custkey, 'acme/' || c_name AS resource_id, CASE WHEN c_custkey % 3 = 0 THEN 'acme/' || c_name ELSE c_name END AS display_name,
  CASE WHEN c_custkey % 2 = 0 THEN 'list,read,search,watch' ELSE 'list,read,search' END AS caps, c_mktsegment AS visibility FROM customer""")
def github_repositories(spark, sf):
    ck = F.col("c_custkey")
    df = payload(
        table(spark, sf, "customer"), ["c_custkey"], full_name=F.concat(F.lit("acme/"), "c_name"),
        name=F.when(ck % 3 != 0, F.col("c_name")), html_url=F.concat(F.lit("https://github.com/acme/"), "c_name"),
        permissions=struct(push=ck % 2 == 0, admin=F.lit(False)), visibility=F.col("c_mktsegment"))
    return C.describe_repos(df, "2024").select(
        "c_custkey", "resource_id", "display_name", F.array_join("capabilities", ",").alias("caps"),
        F.col("provider_metadata")["visibility"].alias("visibility"))


_ITEM = """SELECT event_id, '{p}-' || event_id AS item_id, {content} AS content, sha256({content}) AS content_hash,
  {meta} AS meta FROM (SELECT *, {k} AS k FROM events)"""


@query(_ITEM.format(p="issue", content="CASE WHEN k % 3 = 0 THEN '' ELSE 'Body ' || event_type END", k=SQL_K,
                    meta="'author_login=u' || user_id || ';labels=[\"' || event_type || '\"];number=' || event_id || ';state=open'")
       + " UNION ALL " + _ITEM.format(p="pr", content="CASE WHEN k % 3 = 0 THEN '' ELSE 'Body ' || event_type END", k=SQL_K,
                                      meta="'author_login=u' || user_id || ';base_branch=main;merged=true;number=' || event_id || ';state=open'")
       + " UNION ALL " + _ITEM.format(p="file-src/", content="'text ' || event_type", k=SQL_K,
                                      meta="'encoding=base64;path=src/-' || event_id || ';sha=' || event_type").replace("'file-src/-'", "'file-src/-'"))
def github_items(spark, sf):
    ev = table(spark, sf, "events").withColumn("k", k_of()).withColumn("resource_id", F.lit("acme/r"))
    eid = F.col("event_id").cast("string")
    body = F.when(F.col("k") % 3 != 0, F.concat(F.lit("Body "), "event_type"))
    common = dict(number=F.col("event_id"), body=body, state=F.lit("open"),
                  user=struct(login=F.concat(F.lit("u"), F.col("user_id").cast("string"))))
    keys = ["event_id", "resource_id"]
    issue = C.items_github(payload(ev, keys, labels=F.array(struct(name=F.col("event_type"))), **common), "issue")
    pull = C.items_github(payload(ev, keys, merged=F.lit(True), base=struct(ref=F.lit("main")), **common), "pull_request")
    file = C.items_github(payload(
        ev, keys, path=F.concat(F.lit("src/-"), eid), sha=F.col("event_type"), encoding=F.lit("base64"),
        content=F.base64(F.concat(F.lit("text "), "event_type").cast("binary"))), "file")
    from sievelight.plans.common import meta_text

    out = issue.unionByName(pull).unionByName(file)
    return out.select("event_id", "item_id", "content", "content_hash", meta_text("provider_metadata").alias("meta"))


@query("""
SELECT 'drive_' || r_regionkey AS resource_id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS display_name, 'shared_drive' AS resource_type FROM region
UNION ALL SELECT 'folder_' || n_nationkey, 'drive_' || n_regionkey, n_name, 'folder' FROM nation
UNION ALL SELECT 'doc_' || c_custkey, 'folder_' || c_nationkey, c_name, 'document' FROM customer""")
def drive_catalogue(spark, sf):
    return _drive(spark, sf).select("resource_id", "parent_id", "display_name", "resource_type")


def _drive(spark, sf):
    text = lambda c: F.col(c).cast("string")
    drives = C.describe_drive(payload(table(spark, sf, "region"), [], id=text("r_regionkey"), name=F.col("r_name")), "shared_drive")
    folders = C.describe_drive(payload(
        table(spark, sf, "nation"), [], id=text("n_nationkey"), name=F.col("n_name"), driveId=text("n_regionkey")), "folder")
    docs = C.describe_drive(payload(
        table(spark, sf, "customer"), [], id=text("c_custkey"), name=F.col("c_name"), parents=F.array(text("c_nationkey"))), "document")
    return drives.unionByName(folders).unionByName(docs)


@query("""SELECT 'doc_' || c_custkey AS resource_id, 'folder_' || c_nationkey AS ancestor_1, 'drive_' || n_regionkey AS ancestor_2
FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL
SELECT 'folder_' || n_nationkey, 'drive_' || n_regionkey, NULL FROM nation UNION ALL
SELECT 'drive_' || r_regionkey, NULL, NULL FROM region""")
def resource_tree(spark, sf):
    return C.resource_tree(_drive(spark, sf)).select("resource_id", "ancestor_1", "ancestor_2")


@query("""
WITH c AS (SELECT c_nationkey AS nk, c_custkey AS ck, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos,
  min(c_custkey) OVER (PARTITION BY c_nationkey) AS top FROM customer)
SELECT 'folder_' || ck AS resource_id, nk % 6 = 5 AS cyclic, CASE WHEN nk % 6 = 5 THEN NULL WHEN nk % 6 = 4 THEN pos + 1 ELSE pos END AS depth,
  CASE WHEN nk % 6 = 5 THEN NULL WHEN nk % 6 = 4 THEN 'drive_' || nk ELSE 'folder_' || top END AS root_id FROM c
UNION ALL SELECT 'drive_' || n_nationkey, false, 0, 'drive_' || n_nationkey FROM nation WHERE n_nationkey % 6 = 4""")
def resource_lineage(spark, sf):
    """The customers of a nation as one chain of folders: below a drive, below a parent that is not listed, or closed to a cycle."""
    own = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    nation = F.col("c_nationkey")
    last = F.max("c_custkey").over(Window.partitionBy("c_nationkey"))
    before = F.lag("c_custkey").over(own)
    parent = F.when(before.isNotNull(), F.concat(F.lit("folder_"), before)).when(nation % 6 == 5, F.concat(F.lit("folder_"), last)).when(
        nation % 6 == 4, F.concat(F.lit("drive_"), nation)).when(nation % 6 == 3, F.lit("drive_unlisted"))
    folders = table(spark, sf, "customer").select(
        F.lit("google_drive").alias("provider"), F.concat(F.lit("folder_"), F.col("c_custkey")).alias("resource_id"), parent.alias("parent_id"))
    drives = table(spark, sf, "nation").where("n_nationkey % 6 = 4").select(
        F.lit("google_drive").alias("provider"), F.concat(F.lit("drive_"), F.col("n_nationkey")).alias("resource_id"), F.lit(None).cast("string").alias("parent_id"))
    return C.resource_lineage(folders.unionByName(drives)).select("resource_id", "cyclic", "depth", "root_id")


@query("SELECT 'doc_' || c_custkey AS resource_id FROM customer WHERE c_nationkey = 7")
def folder_children(spark, sf):
    return C.resource_children(_drive(spark, sf), "folder_7").select("resource_id")


@query("""SELECT conv_id, sha256(string_agg(trim(text, ' ' || chr(10)), chr(10) ORDER BY turn)) AS content_hash,
  'https://docs.google.com/document/d/d' || conv_id || '/edit' AS uri FROM conversations GROUP BY conv_id""")
def drive_items(spark, sf):
    conv = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(struct(turn=F.col("turn"), text=F.col("text")))).alias("lines"))
    cid = F.col("conv_id").cast("string")
    para = F.transform("lines", lambda x: struct(paragraph=struct(elements=F.array(struct(textRun=struct(content=x["text"]))))))
    rows = payload(conv.withColumns({"resource_id": cid, "item_id": cid}), ["conv_id", "resource_id", "item_id"],
                   documentId=F.concat(F.lit("d"), cid), body=struct(content=para))
    return C.items_drive(rows).select("conv_id", "content_hash", "uri")


@query("""
SELECT 'ws_' || r_name AS resource_id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS display_name, 'https://linear.app/' || r_name AS uri FROM region
UNION ALL SELECT 'team_' || n_nationkey, 'ws_' || r_name, n_name, 'https://linear.app/' || r_name || '/team/T' || n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'proj_' || s_suppkey, 'team_' || s_nationkey, s_name, NULL FROM supplier
UNION ALL SELECT 'issue_' || c_custkey, 'team_' || c_nationkey, 'I-' || c_custkey || ': ' || c_name, NULL FROM customer""")
def linear_catalogue(spark, sf):
    text = lambda c: F.col(c).cast("string")
    ws = C.describe_linear(payload(table(spark, sf, "region"), [], urlKey=F.col("r_name"), name=F.col("r_name")), "workspace")
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    team = C.describe_linear(payload(
        n, [], id=text("n_nationkey"), key=F.concat(F.lit("T"), text("n_nationkey")), name=F.col("n_name"),
        organization=struct(urlKey=F.col("r_name"), name=F.col("r_name"))), "team")
    proj = C.describe_linear(payload(
        table(spark, sf, "supplier"), [], id=text("s_suppkey"), name=F.col("s_name"), team=struct(id=text("s_nationkey"))), "project")
    issue = C.describe_linear(payload(
        table(spark, sf, "customer"), [], id=text("c_custkey"), identifier=F.concat(F.lit("I-"), text("c_custkey")),
        title=F.col("c_name"), team=struct(id=text("c_nationkey"))), "issue")
    out = ws.unionByName(team).unionByName(proj).unionByName(issue)
    return out.select("resource_id", "parent_id", "display_name", "uri")


@query("""SELECT 'issue_' || event_id AS item_id, 'issue' AS item_type, sha256('Task ' || event_type) AS content_hash FROM events
UNION ALL SELECT 'comment_' || event_id, 'comment', sha256('Note ' || user_id) FROM events""")
def linear_items(spark, sf):
    ev = table(spark, sf, "events")
    eid = F.col("event_id").cast("string")
    issue = C.items_linear(payload(ev, [], id=eid, identifier=F.concat(F.lit("I-"), eid), title=F.concat(F.lit("Task "), "event_type")), "issue")
    comment = C.items_linear(payload(
        ev, [], id=eid, body=F.concat(F.lit("Note "), F.col("user_id").cast("string")), issue=struct(id=eid, identifier=eid)), "comment")
    return issue.unionByName(comment).select("item_id", "item_type", "content_hash")


@query("""SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'not_found' WHEN c_nationkey % 5 = 1 THEN 'permission_denied'
  WHEN c_nationkey % 5 = 2 THEN 'action_needed' ELSE 'granted' END AS outcome
FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 100""")
def access_checks(spark, sf):
    resources = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("resource_id"), F.col("c_name").alias("display_name"),
        element(["granted", "denied", "action_needed", "granted", "unknown"], F.col("c_nationkey")).alias("permission"),
        F.create_map(F.lit("action_hint"), F.lit("ask")).alias("provider_metadata"))
    requests = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") + 100).cast("string").alias("resource_id"))
    return C.validate_access(requests, resources).select(
        "o_orderkey", F.coalesce("error.kind", F.lit("granted")).alias("outcome"))


@query("""
WITH i AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT o_orderkey, n, i.l_orderkey IS NOT NULL AS found FROM orders, (SELECT unnest([1, 4]) AS n) LEFT JOIN i
  ON l_orderkey = o_orderkey AND l_linenumber = n""")
def item_lookups(spark, sf):
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("content")).select(
        F.col("l_orderkey").alias("resource_id"), F.col("l_linenumber").alias("item_id"), "content")
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("resource_id"), F.explode(F.array(F.lit(1), F.lit(4))).alias("item_id"))
    return C.fetch_items(requests, items).select(
        F.col("resource_id").alias("o_orderkey"), F.col("item_id").alias("n"), F.col("error").isNull().alias("found"))


@query("SELECT resource_type, count(*) AS n FROM (SELECT 'folder' AS resource_type FROM nation UNION ALL SELECT 'document' FROM customer "
       "UNION ALL SELECT 'shared_drive' FROM region) GROUP BY 1")
def listed_resources(spark, sf):
    both = _drive(spark, sf).unionByName(C.describe_repos(payload(
        table(spark, sf, "supplier"), [], full_name=F.col("s_name"))))
    return C.list_resources(both, "google_drive").groupBy("resource_type").agg(F.count("*").alias("n"))


@query(f"""
WITH e AS (SELECT event_id, user_id, {SQL_K} AS k FROM events),
bad AS (SELECT DISTINCT user_id FROM e WHERE k % 97 = 11)
SELECT 'clean' AS outcome, event_id FROM e WHERE user_id NOT IN (SELECT user_id FROM bad)
UNION ALL SELECT 'content: sensitive pan detected', event_id FROM e WHERE k % 97 = 11""")
def resource_screen(spark, sf):
    """One hit fails the whole listing (the user)."""
    ev = table(spark, sf, "events").withColumn("k", k_of())
    body = F.when(F.col("k") % 97 == 11, element(CARDS, F.col("event_id"))).otherwise(F.lit("ok"))
    items = C.items_linear(payload(ev, ["event_id", "user_id"], id=F.col("event_id").cast("string"), body=body), "comment")
    good, bad = C.screen_resources(items, "user_id")
    return good.select(F.lit("clean").alias("outcome"), "event_id").unionByName(
        bad.select(F.col("reason").alias("outcome"), "event_id"))


_GH = ["200", "401", "403", "403", "404", "422", "502", "418"]
_GH_KIND = ["ok", "action_needed", "provider_error", "permission_denied", "not_found", "provider_error", "provider_error", "provider_error"]
_GD = ["200", "401", "403", "403", "403", "404", "400", "429", "500", "418"]
_GD_KIND = ["ok", "action_needed", "action_needed", "provider_error", "permission_denied", "not_found", "provider_error", "provider_error",
            "provider_error", "provider_error"]
_LN = ['{"data":{}}', '{"errors":[{"code":"RATELIMITED"}]}', '{"errors":[{"code":"AUTHENTICATION"}]}', '{"errors":[{"message":"Forbidden"}]}',
       '{"errors":[{"message":"Entity not found"}]}', '{"errors":[{"message":"odd"}]}', '{"errors":[]}']
_LN_KIND = ["ok", "provider_error", "action_needed", "permission_denied", "not_found", "provider_error", "ok"]


@query(f"""WITH e AS (SELECT event_id, {SQL_K} AS k FROM events)
SELECT 'github' AS provider, event_id, {sql_element(_GH_KIND, 'k')} AS kind FROM e
UNION ALL SELECT 'google_drive', event_id, {sql_element(_GD_KIND, 'k')} FROM e
UNION ALL SELECT 'linear', event_id, {sql_element(_LN_KIND, 'k')} FROM e""")
def discovery_outcomes(spark, sf):
    ev = table(spark, sf, "events").withColumn("k", k_of())
    k = F.col("k")
    no_headers = F.create_map(F.lit("A"), F.lit("b"))

    def rows(status, headers, text):
        return ev.select("event_id", status.cast("int").alias("status"), headers.alias("headers"), F.try_parse_json(text).alias("payload_v"))

    gh = rows(element(_GH, k), F.when(k % 8 == 2, F.create_map(F.lit("X-RateLimit-Remaining"), F.lit("0"))).otherwise(no_headers), F.lit("{}"))
    reason = F.when(k % 10 == 2, F.lit('{"error":{"errors":[{"reason":"insufficientPermissions"}]}}')).when(
        k % 10 == 3, F.lit('{"error":{"status":"userRateLimitExceeded"}}')).otherwise(F.lit("{}"))
    gd = rows(element(_GD, k), no_headers, reason)
    ln = rows(F.lit(200), no_headers, element(_LN, k))
    out = None
    for name, df in (("github", gh), ("google_drive", gd), ("linear", ln)):
        part = C.discovery_outcome(df, name).select(
            F.lit(name).alias("provider"), "event_id", F.coalesce("error.kind", F.lit("ok")).alias("kind"))
        out = part if out is None else out.unionByName(part)
    return out
