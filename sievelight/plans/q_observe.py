"""Queries for the payload jobs (operators D1-D28).

Every job runs over payloads derived from a whole driver table; fields are missing, null or of another
type by rules on ``k``, which the oracle repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.operators import observe as ob
from sievelight.plans.common import (
    SQL_K, element, flat_observations, k_of, payload, spread, sql_observation, struct, table, with_k,
)

QUERIES, ORACLES = {}, {}

E = F.col  # column shorthand
_CTE = f"WITH e AS (SELECT *, {SQL_K} AS k, CAST(event_id AS VARCHAR) AS eid, CAST(user_id AS VARCHAR) AS uid FROM events) "


def query(oracle: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle is not None:
            ORACLES[name or fn.__name__] = oracle
        return fn

    return add


def over_events(sql: str):
    return _CTE + "SELECT event_id, " + sql + " FROM e"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return with_k(spread(table(spark, sf, "events"))).select(
        "event_id", "event_type", "user_id", "value", "k",
        E("event_id").cast("string").alias("eid"), E("user_id").cast("string").alias("uid"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))


def say(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def when(cond, value):
    return F.when(cond, value if not isinstance(value, str) else F.lit(value))



def kk():
    return F.col("k")


_DAY = "strftime(ts, '%Y-%m-%d')"

_PR_TITLE = "CASE WHEN k % 4 > 0 THEN 'Change ' || event_type END"
_PR_BODY = ("CASE WHEN k % 3 = 1 THEN 'Contact [redacted:email] now' WHEN k % 3 = 2 THEN 'Body of ' || event_type END")
_PR_REF = "'acme/' || event_type || '#' || eid"


def _pr_fields():
    return dict(
        title=when(kk() % 4 > 0, say("Change ", E("event_type"))),
        body=when(kk() % 3 == 1, say("Contact user", E("uid"), "@example.com now")).when(
            kk() % 3 == 2, say("Body of ", E("event_type"))),
        html_url=say("https://github.com/acme/pull/", E("eid")), user=struct(login=say("u", E("uid"))),
        base=struct(repo=struct(full_name=say("acme/", E("event_type")))),
        merged_at=when(kk() % 2 == 0, E("day")))


_PR_SQL = over_events(sql_observation(
    "github", ref=_PR_REF, kind="'pull_request'", url="'https://github.com/acme/pull/' || eid",
    excerpt=f"coalesce({_PR_BODY}, {_PR_TITLE}, {_PR_REF})", mode="active",
    title=f"coalesce({_PR_TITLE}, {_PR_REF})", author="'u' || uid", stamp=f"CASE WHEN k % 2 = 0 THEN {_DAY} ELSE '' END"))


@query(_PR_SQL)
def observe_github_pr(spark, sf):
    df = payload(events(spark, sf), ["event_id"], number=E("event_id"), **_pr_fields())
    return flat_observations(ob.observe_github_pr(df), "event_id")


@query(_PR_SQL)
def observe_github_webhook(spark, sf):
    """The envelope carries the number at its top level."""
    df = payload(events(spark, sf), ["event_id"], action=F.lit("opened"), number=E("event_id"),
                 pull_request=struct(**_pr_fields()))
    return flat_observations(ob.observe_github_pr(df, webhook=True), "event_id")


_ISSUE_ACTIONS = ["opened", "edited", "closed", "created", "deleted", "labeled"]


@query(f"""
{_CTE}, i AS (SELECT *, ({['opened', 'edited', 'closed', 'created', 'deleted', 'labeled']})[1 + k % 6] AS action,
  CASE WHEN event_type IN ('click', 'view') THEN 'issues' ELSE 'issue_comment' END AS event_name FROM e),
a AS (SELECT *, CASE WHEN event_name = 'issues' THEN 'issue' ELSE 'issue_comment' END AS kind,
  CASE WHEN event_name = 'issues' THEN eid ELSE 'c' || eid END AS sid,
  CASE WHEN event_name = 'issues' THEN 'n' || eid ELSE 'nc' || eid END AS node,
  CASE WHEN action = 'deleted' THEN '' WHEN k % 5 = 0 THEN 'LGTM' WHEN k % 5 = 1 THEN '<!-- tpl --> text'
       ELSE 'Body ' || event_type END AS body, 'Title ' || event_type AS title, {_DAY} AS updated,
  CASE WHEN k % 7 = 0 THEN 'dependabot[bot]' ELSE 'u' || uid END AS login FROM i
  WHERE (event_name = 'issues' AND action IN ('opened','edited','closed','reopened'))
     OR (event_name = 'issue_comment' AND action IN ('created','edited','deleted'))),
v AS (SELECT *, sha256(concat_ws(chr(31), kind, sid, node, action, updated, title, body)) AS ver FROM a)
SELECT event_id, 'acme/r#issues/' || eid || ':' || kind || ':' || sid || ':v:' || ver AS ref, kind,
  CASE WHEN action = 'deleted' THEN 'GitHub ' || kind || ' ' || sid || ' can no longer be read.'
       ELSE body END AS excerpt,
  CASE WHEN action = 'deleted' THEN 'GitHub issue #' || eid || ': no longer readable' ELSE title END AS title,
  login AS author, updated AS stamp, 'github:77:' || kind || ':' || sid || ':' || ver AS evidence_id,
  concat_ws(',', CASE WHEN k % 7 = 0 THEN 'bot_authored,dependency_automation' END,
     CASE WHEN body LIKE '<!--%' THEN 'template_dominant' END, CASE WHEN body = 'LGTM' THEN 'status_only' END) AS signals,
  CASE WHEN action = 'deleted' THEN 'true' ELSE 'false' END AS tombstone FROM v""")
def observe_github_issue(spark, sf):
    df = events(spark, sf)
    issues = E("event_type").isin("click", "view")
    action = element(_ISSUE_ACTIONS, kk())
    body = when(kk() % 5 == 0, "LGTM").when(kk() % 5 == 1, F.lit("<!-- tpl --> text")).otherwise(say("Body ", E("event_type")))
    user = struct(login=when(kk() % 7 == 0, "dependabot[bot]").otherwise(say("u", E("uid"))))
    issue = struct(id=E("event_id"), number=E("event_id"), node_id=say("n", E("eid")),
                   title=say("Title ", E("event_type")), body=body, updated_at=E("day"), user=user)
    comment = when(~issues, struct(id=say("c", E("eid")), node_id=say("nc", E("eid")), body=body, user=user))
    rows = payload(
        df.withColumns({"event_name": when(issues, "issues").otherwise(F.lit("issue_comment")),
                        "delivery_id": say("d", E("eid"))}),
        ["event_id", "event_name", "delivery_id"], action=action,
        repository=struct(id=F.lit(77), full_name=F.lit("acme/r")), issue=issue, comment=comment)
    out = ob.observe_github_issue(rows)
    return out.select(
        "event_id", E("source_ref.ref").alias("ref"), E("source_ref.kind").alias("kind"), "excerpt", "title", "author",
        E("timestamp").alias("stamp"), "evidence_id",
        F.array_join(F.transform("advisory_signals", lambda s: s["code"]), ",").alias("signals"),
        E("metadata")["tombstone"].alias("tombstone"))


_GL = "CASE WHEN event_type IN ('click', 'view') THEN 'merge_request' ELSE 'issue' END"
_GL_MARK = "CASE WHEN event_type IN ('click', 'view') THEN '!' ELSE '#' END"
_GL_TITLE = "CASE WHEN k % 3 > 0 THEN 'Fix ' || event_type END"
_GL_FLOOR = "CASE WHEN event_type IN ('click', 'view') THEN 'gitlab-merge-request' ELSE 'gitlab-issue' END"


@query(over_events(sql_observation(
    "gitlab", ref=f"'g/p' || {_GL_MARK} || eid", kind=_GL, url="'https://gitlab.com/' || eid",
    excerpt=f"coalesce(CASE WHEN k % 2 = 0 THEN 'Desc ' || uid END, {_GL_TITLE}, {_GL_FLOOR})", mode="webhook",
    title=f"coalesce({_GL_TITLE}, {_GL_FLOOR})", author="'u' || uid")) + " WHERE k % 10 <> 9 AND event_type <> 'error'")
def observe_gitlab(spark, sf):
    """Unknown kinds and titles of a wrong type are left out."""
    mr = E("event_type").isin("click", "view")
    kind = when(E("event_type") == "error", "pipeline").when(mr, F.lit("merge_request")).otherwise(F.lit("issue"))
    title = when(kk() % 3 > 0, say(" Fix ", E("event_type"), " "))
    good = struct(iid=E("event_id"), title=title, description=when(kk() % 2 == 0, say("Desc ", E("uid"))),
                  url=say("https://gitlab.com/", E("eid")))
    body = F.to_json(struct(object_kind=kind, project=struct(path_with_namespace=F.lit("g/p")),
                            user=struct(username=say("u", E("uid"))), object_attributes=good))
    bad = F.to_json(struct(object_kind=kind, object_attributes=struct(iid=E("event_id"), title=F.lit(7))))
    df = events(spark, sf).select("event_id", F.try_parse_json(F.when(kk() % 10 == 9, bad).otherwise(body)).alias("payload_v"))
    return flat_observations(ob.observe_gitlab(df), "event_id")


@query(f"""
WITH e AS (SELECT event_type, {SQL_K} AS k FROM events)
SELECT event_type, CASE WHEN k % 10 = 9 THEN 'parse_error' ELSE 'payload_not_object' END AS reason, count(*) AS n
FROM e WHERE k % 10 IN (8, 9) GROUP BY ALL""")
def payload_rejects(spark, sf):
    bad = F.lit('{"object_kind":"issue","object_attributes":{"iid":1,"title":{"x":1}}}')
    text = F.when(kk() % 10 == 9, bad).when(kk() % 10 == 8, F.lit("[]")).otherwise(F.lit('{"object_kind":"issue"}'))
    df = events(spark, sf).select("event_type", F.try_parse_json(text).alias("payload_v"))
    return ob.parse_rejects(df, "gitlab").groupBy("event_type", "reason").agg(F.count("*").alias("n"))


_JIRA_KEY = "CASE WHEN k % 4 = 0 THEN 'i' || eid ELSE 'K-' || eid END"
_JIRA_SUM = "CASE WHEN k % 3 > 0 THEN 'Summary ' || event_type END"


@query(over_events(sql_observation(
    "jira", ref=_JIRA_KEY, url="'https://jira/' || eid",
    kind="CASE WHEN k % 2 = 0 THEN 'issue_created' ELSE 'jira:issue_updated' END",
    excerpt=f"coalesce({_JIRA_SUM}, {_JIRA_KEY})", title=f"coalesce({_JIRA_SUM}, {_JIRA_KEY})", mode="webhook",
    stamp=f"CASE WHEN k % 5 = 0 THEN {_DAY} WHEN event_id = 0 THEN '' ELSE eid END",
    meta="'event=jira:issue_updated;issuetype=Bug;project=K;status=' || event_type")))
def observe_jira(spark, sf):
    """A zero timestamp counts as absent."""
    df = payload(
        events(spark, sf), ["event_id"], timestamp=E("event_id"), webhookEvent=F.lit("jira:issue_updated"),
        issue_event_type_name=when(kk() % 2 == 0, "issue_created"),
        issue=struct(**{
            "id": say("i", E("eid")), "key": when(kk() % 4 > 0, say("K-", E("eid"))),
            "self": say("https://jira/", E("eid")),
            "fields": struct(
                summary=when(kk() % 3 > 0, say(" Summary ", E("event_type"))), description=struct(type=F.lit("doc")),
                status=struct(name=E("event_type")), issuetype=struct(name=F.lit("Bug")),
                project=struct(key=F.lit("K")), updated=when(kk() % 5 == 0, E("day")))}))
    return flat_observations(ob.observe_jira(df), "event_id")


@query(_CTE + f"""
SELECT event_id, 'L-' || eid AS ref, 'L-' || eid || ': Task ' || event_type AS title,
  CASE WHEN k % 2 = 0 THEN 'Desc ' || uid ELSE 'Task ' || event_type END AS excerpt, 'issue' AS kind,
  'issue:id' || eid AS resource, 'linear:issue:id' || eid || ':' || {_DAY} AS evidence_id,
  concat_ws(',', CASE WHEN k % 3 = 0 THEN 'generated_sync_event' END,
            CASE WHEN k % 4 = 0 THEN 'administrative_only' END) AS signals
FROM e WHERE k % 5 > 0 AND k % 7 > 0""")
def observe_linear(spark, sf):
    changed = F.when(kk() % 4 == 0, struct(stateId=F.lit("s"), priority=F.lit(1))).otherwise(
        struct(stateId=F.lit("s"), priority=F.lit(None).cast("int")))
    other = F.when(kk() % 4 != 0, struct(title=F.lit("old")))
    df = payload(
        events(spark, sf), ["event_id"], type=when(kk() % 5 == 0, "Comment").otherwise(F.lit("Issue")),
        action=when(kk() % 7 == 0, "remove").otherwise(F.lit("update")),
        actor=struct(type=when(kk() % 3 == 0, "integration").otherwise(F.lit("user"))),
        data=struct(id=say("id", E("eid")), identifier=say("L-", E("eid")), title=say("Task ", E("event_type")),
                    description=when(kk() % 2 == 0, say("Desc ", E("uid")))),
        updatedFrom=F.when(kk() % 4 == 0, F.to_json(changed)).otherwise(F.to_json(other)), createdAt=E("day"),
        webhookId=say("w", E("eid")))
    # ``updatedFrom`` was built as text above; splice it in as an object.
    fixed = F.regexp_replace(
        F.regexp_replace(E("payload"), r'"updatedFrom":"(\{.*?\})"', '"updatedFrom":$1'), r'\\"', '"')
    df = df.withColumn("payload_v", F.try_parse_json(fixed))
    out = ob.observe_linear(df)
    return out.select(
        "event_id", E("source_ref.ref").alias("ref"), "title", "excerpt", E("source_ref.kind").alias("kind"),
        E("provider_resource_id").alias("resource"), "evidence_id",
        F.array_join(F.transform("advisory_signals", lambda s: s["code"]), ",").alias("signals"))


@query(over_events(sql_observation(
    "linear", ref="'L-' || eid", kind="'issue'", excerpt="'Task ' || event_type", mode="active",
    title="'L-' || eid || ': Task ' || event_type", stamp=_DAY, url="'https://linear.app/' || eid",
    meta="'state=' || event_type")))
def observe_linear_nodes(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], id=say("id", E("eid")), identifier=say("L-", E("eid")),
        title=say("Task ", E("event_type")), url=say("https://linear.app/", E("eid")), updatedAt=E("day"),
        state=struct(name=E("event_type")))
    return flat_observations(ob.observe_linear(df, "node"), "event_id")


_SLACK_PLACE = "'C' || uid || ':' || eid || '.' || k"


@query(over_events(sql_observation(
    "slack", ref=_SLACK_PLACE, kind="'message'",
    excerpt=f"CASE WHEN k % 3 = 0 THEN '(no text) ' || {_SLACK_PLACE} WHEN k % 3 = 1 THEN 'hello ' || event_type "
            "ELSE 'edited ' || event_type END",
    mode="webhook", author="CASE WHEN k % 3 = 2 THEN 'U' || uid ELSE '' END", stamp="eid || '.' || k",
    meta="'channel=C' || uid || ';type=message'")))
def observe_slack(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], team_id=F.lit("T"),
        event=struct(type=F.lit("message"), channel=say("C", E("uid")), ts=say(E("eid"), ".", kk().cast("string")),
                     text=when(kk() % 3 == 1, say(" hello ", E("event_type"))),
                     message=F.when(kk() % 3 == 2, struct(text=say("edited ", E("event_type")), user=say("U", E("uid"))))))
    return flat_observations(ob.observe_slack(df), "event_id")


@query(over_events(sql_observation(
    "notion", ref="CASE WHEN k % 3 > 0 THEN 'p' || eid ELSE 'notion-page' END", kind="'page'",
    excerpt="'Notion page.' || event_type || CASE WHEN k % 3 > 0 THEN ' (p' || eid || ')' ELSE '' END", mode="webhook",
    title="'Notion page.' || event_type", stamp=_DAY)))
def observe_notion_events(spark, sf):
    df = payload(events(spark, sf), ["event_id"], id=say("e", E("eid")), type=say("page.", E("event_type")),
                 entity=struct(id=when(kk() % 3 > 0, say("p", E("eid")))), timestamp=E("day"))
    return flat_observations(ob.observe_notion(df), "event_id")


_NT = "CASE WHEN k % 4 > 0 THEN 'Notes on ' || event_type ELSE 'p' || eid END"


@query(over_events(sql_observation(
    "notion", ref="'p' || eid", kind="'page'", url="'https://notion.so/' || eid", excerpt=_NT, title=_NT, mode="active",
    author="'u' || uid", stamp=_DAY)))
def observe_notion_pages(spark, sf):
    rich = F.array(struct(plain_text=F.lit("Notes ")), struct(plain_text=say("on ", E("event_type"))))
    df = payload(
        events(spark, sf), ["event_id"], id=say("p", E("eid")), url=say("https://notion.so/", E("eid")),
        created_by=struct(id=say("u", E("uid"))), created_time=E("day"),
        properties=struct(
            Status=struct(type=F.lit("select")),
            Name=struct(type=F.lit("title"), title=F.when(kk() % 4 > 0, rich))))
    return flat_observations(ob.observe_notion(df, "page"), "event_id")


_ZD_ID = "CASE WHEN k % 3 = 0 THEN eid WHEN k % 3 = 1 THEN 't' || eid ELSE 'zendesk-ticket' END"
_ZD_SUB = "CASE WHEN k % 2 = 0 THEN 'Subject ' || event_type END"
_ZD_DESC = "CASE WHEN k % 5 > 0 THEN 'write to [redacted:email] please' END"


@query(over_events(sql_observation(
    "zendesk", ref=_ZD_ID, kind="'ticket'", url="''", mode="webhook",
    excerpt=f"CASE WHEN k % 2 = 1 AND k % 5 = 0 THEN {_ZD_ID} ELSE concat_ws(' — ', {_ZD_SUB}, {_ZD_DESC}) END",
    title=f"coalesce({_ZD_SUB}, {_ZD_ID})", author="uid", stamp=_DAY,
    meta="'event_type=zen:event;priority=high;status=' || event_type || ';via=web'")))
def observe_zendesk(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], event=struct(type=F.lit("zen:event")), time=E("day"),
        subject=when(kk() % 3 == 0, say("zen:ticket:", E("eid"))),
        detail=struct(
            id=when(kk() % 3 == 1, say("t", E("eid"))), subject=when(kk() % 2 == 0, say("Subject ", E("event_type"))),
            description=when(kk() % 5 > 0, say("write to a.b@", E("event_type"), ".example.org please")),
            status=E("event_type"), priority=F.lit("high"), requester_id=E("uid"), via=struct(channel=F.lit("web"))))
    return flat_observations(ob.observe_zendesk(df), "event_id")


_SN_TITLE = "CASE WHEN k % 3 = 0 THEN 'Error in ' || event_type END"
_SN_CUL = "CASE WHEN k % 3 = 1 THEN 'mod.' || event_type END"


@query(over_events(sql_observation(
    "sentry", ref="CASE WHEN k % 7 = 0 THEN 'sentry-issue' ELSE 'i' || eid END", kind="'issue'",
    url="'https://sentry.io/' || eid", mode="webhook",
    excerpt=f"coalesce({_SN_TITLE}, {_SN_CUL}, 'S-' || eid)", title=f"coalesce({_SN_TITLE}, 'S-' || eid)", stamp=_DAY,
    meta="'action=created;level=error;short_id=S-' || eid || ';status=' || event_type")))
def observe_sentry(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], action=F.lit("created"),
        data=struct(issue=struct(
            id=when(kk() % 7 > 0, say("i", E("eid"))), shortId=say("S-", E("eid")),
            title=when(kk() % 3 == 0, say("Error in ", E("event_type"))),
            culprit=when(kk() % 3 == 1, say("mod.", E("event_type"))), level=F.lit("error"), status=E("event_type"),
            permalink=say("https://sentry.io/", E("eid")), firstSeen=E("day"))))
    return flat_observations(ob.observe_sentry(df), "event_id")


_PD = "CASE WHEN k % 3 = 0 THEN 'Down ' || event_type WHEN k % 3 = 1 THEN 'Sum ' || event_type ELSE 'P' || eid END"


@query(over_events(sql_observation(
    "pagerduty", ref="'P' || eid", kind="'incident'", url="'https://pd/' || eid", excerpt=_PD, title=_PD, mode="webhook",
    stamp=f"CASE WHEN k % 2 = 0 THEN {_DAY} ELSE 'later' END",
    meta="'event_type=incident.triggered;status=open;urgency=' || event_type")))
def observe_pagerduty(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"],
        event=struct(event_type=F.lit("incident.triggered"), occurred_at=F.lit("later"), data=struct(
            id=say("P", E("eid")), title=when(kk() % 3 == 0, say("Down ", E("event_type"))),
            summary=when(kk() % 3 == 1, say("Sum ", E("event_type"))), html_url=say("https://pd/", E("eid")),
            status=F.lit("open"), urgency=E("event_type"), created_at=when(kk() % 2 == 0, E("day")))))
    return flat_observations(ob.observe_pagerduty(df), "event_id")


def _turns(spark, sf):
    """Conversations as meetings: the lines in order, one of them no object."""
    conv = table(spark, sf, "conversations").where("text IS NOT NULL")
    line = struct(turn=E("turn"), text=E("text"))
    return conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("lines"))


# The driver's conversations hold neither e-mails nor phone-shaped runs, so their text passes unchanged.
_CONV = "WITH c AS (SELECT conv_id, string_agg({expr}, {sep} ORDER BY turn) AS said FROM conversations GROUP BY conv_id) "


@query(_CONV.format(expr="text", sep="chr(10)") + "SELECT conv_id, " + sql_observation(
    "fathom", ref="CAST(conv_id AS VARCHAR)", kind="'meeting'", excerpt="said", mode="passive",
    title="'Meeting ' || conv_id", url="'https://f/' || conv_id", stamp="'t' || conv_id") + " FROM c")
def observe_fathom(spark, sf):
    rows = _turns(spark, sf)
    segments = F.transform("lines", lambda x: struct(text=x["text"], speaker=struct(display_name=F.lit("Name"))))
    cid = E("conv_id").cast("string")
    df = payload(rows, ["conv_id"], recording_id=E("conv_id"), meeting_title=say("Meeting ", cid),
                 share_url=say("https://f/", cid), transcript=segments, recording_end_time=say("t", cid))
    return flat_observations(ob.observe_fathom(df), "conv_id")


@query(_CONV.format(expr="trim(text, ' ' || chr(10))", sep="' '") + "SELECT conv_id, " + sql_observation(
    "granola", ref="'n' || conv_id", kind="'transcript'", excerpt="said", mode="passive",
    title="'Note ' || conv_id", stamp="'t' || conv_id") + " FROM c")
def observe_granola(spark, sf):
    rows = _turns(spark, sf)
    cid = E("conv_id").cast("string")
    df = payload(rows, ["conv_id"], id=say("n", cid), title=say("Note ", cid), created_at=say("t", cid),
                 transcript=F.transform("lines", lambda x: struct(text=x["text"])))
    return flat_observations(ob.observe_granola(df), "conv_id")


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^<>]*>', ' ', 'g'),
  '[\s\x1c-\x1f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS plain
FROM pages""")
def page_text(spark, sf):
    """Tag stripping and white space on whole pages; character references stay as they are."""
    return spread(table(spark, sf, "pages")).select("page_id", ob.page_text(E("html"), lambda c: c).alias("plain"))


#: The text of a page without tags, with its character references decoded.
_PAGE_TEXT = r"""
WITH d AS (SELECT page_id, regexp_replace(html, '<[^<>]*>', ' ', 'g') AS t FROM pages),
u AS (SELECT page_id, regexp_replace(replace(replace(replace(t, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM d)
SELECT page_id, trim(regexp_replace(t, '[\s\x1c-\x1f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS plain FROM u"""


@query(_PAGE_TEXT)
def page_text_decoded(spark, sf):
    """Whole pages with their character references decoded."""
    return spread(table(spark, sf, "pages")).select("page_id", ob.page_text(E("html")).alias("plain"))


# Redaction of page text in SQL: card numbers that pass the check digit, e-mail addresses, then phone numbers. A phone number has no digit
# before or after it; it is replaced twice, as neighbours share the character between them.
_LUHN = """list_sum(list_transform(range(1, length(c) + 1), lambda i:
  CASE WHEN (length(c) - i) % 2 = 0 THEN c[i]::INTEGER ELSE (c[i]::INTEGER * 2) % 10 + (c[i]::INTEGER * 2) // 10 END)) % 10 = 0"""
_PHONE = r"""regexp_replace({}, '(^|[^0-9])(?:(?:\+?[0-9]{{1,3}}[ .\-]?)?(?:\([0-9]{{3}}\)|[0-9]{{3}})[ .\-]?[0-9]{{3}}[ .\-]?[0-9]{{4}}'
  '|(?:\+|00)[ .\-]?[0-9]{{1,3}}[ .\-]?(?:[0-9][ .\-]?){{5,12}}[0-9])($|[^0-9])', '\1[redacted:phone]\2', 'g')"""
_CALLED = r"""regexp_replace(t, '((?i:tel|phone|call|ring|mobile|cell|fax|whatsapp)\b[ :.\-]{1,4})(?:[0-9][ .\-]?){6,13}[0-9]', '\1[redacted:phone]', 'g')"""
_REDACTED = f"""
WITH x AS ({_PAGE_TEXT}),
c AS (SELECT page_id, plain, list_filter(list_distinct(regexp_extract_all(plain, '[0-9]{{13,19}}')), lambda c: {_LUHN}) AS cards FROM x),
p AS (SELECT page_id, list_reduce(cards, lambda t, n: replace(t, n, '[redacted:pan]'), plain) AS t FROM c),
m AS (SELECT page_id, regexp_replace(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+', '[redacted:email]', 'g') AS t FROM p),
f AS (SELECT page_id, {_PHONE.format(_PHONE.format('t'))} AS t FROM m),
r AS (SELECT page_id, {_CALLED} AS t FROM f)
SELECT page_id, """


@query(_REDACTED + sql_observation(
    "confluence", ref="CAST(page_id AS VARCHAR)", kind="'page'", excerpt="t", mode="active", title="'Page ' || page_id", url="'https://wiki/p/' || page_id") + " FROM r")
def observe_confluence(spark, sf):
    """Web pages as storage bodies, redacted."""
    df = payload(spread(table(spark, sf, "pages")), ["page_id"], id=E("page_id").cast("string"),
                 title=say("Page ", E("page_id").cast("string")), body=struct(storage=struct(value=E("html"))),
                 _links=struct(base=F.lit("https://wiki/"), webui=say("/p/", E("page_id").cast("string"))))
    return flat_observations(ob.observe_confluence(df), "page_id")


@query("""
WITH c AS (SELECT conv_id, string_agg(CASE WHEN turn % 3 = 0 THEN '## ' ELSE '' END || trim(text, ' ' || chr(10)), chr(10)
  ORDER BY turn) AS said FROM conversations GROUP BY conv_id) SELECT conv_id, """ + sql_observation(
    "google_drive", ref="'doc-0123456789-0123456789-' || conv_id", kind="'document'", excerpt="said", mode="active",
    title="'Doc ' || conv_id") + " FROM c")
def observe_google_doc(spark, sf):
    """Turns as paragraphs; every third one is a heading, every fourth sits in a table cell."""
    rows = _turns(spark, sf)
    cid = E("conv_id").cast("string")

    def para(x):
        half = F.floor(F.char_length(x["text"]) / 2).cast("int")
        return struct(
            paragraphStyle=F.when(x["turn"] % 3 == 0, struct(namedStyleType=F.lit("HEADING_2"))),
            elements=F.array(struct(textRun=struct(content=F.left(x["text"], half))),
                             struct(textRun=struct(content=F.substring(x["text"], half + 1, F.char_length(x["text"]))))))

    def block(x):
        cell = struct(tableRows=F.array(struct(tableCells=F.array(struct(content=F.array(struct(paragraph=para(x))))))))
        in_table = x["turn"] % 4 == 1
        return struct(paragraph=F.when(~in_table, para(x)), table=F.when(in_table, cell))

    df = payload(rows, ["conv_id"], documentId=say("doc-0123456789-0123456789-", cid), title=say("Doc ", cid),
                 body=struct(content=F.transform("lines", block)))
    return flat_observations(ob.observe_google_doc(df), "conv_id")


@query("""
SELECT conv_id, turn, 'u-' || conv_id || '-' || turn AS ref, role AS kind, trim(text, ' ' || chr(10)) AS excerpt,
  CASE role WHEN 'assistant' THEN 'claude' ELSE 'user' END AS author, '~/proj/' || conv_id AS cwd, 's' || conv_id AS session
FROM conversations WHERE role IN ('user', 'assistant')""")
def observe_transcript(spark, sf):
    conv = table(spark, sf, "conversations")
    cid, turn = E("conv_id").cast("string"), E("turn").cast("string")
    as_text = F.to_json(struct(type=E("role"), uuid=say("u-", cid, "-", turn), sessionId=say("s", cid),
                               cwd=say("/home/someone/proj/", cid), message=struct(content=E("text"))))
    as_blocks = F.to_json(struct(type=E("role"), uuid=say("u-", cid, "-", turn), sessionId=say("s", cid),
                                 cwd=say("C:\\Users\\someone\\proj/", cid), message=struct(content=F.array(
                                     struct(type=F.lit("thinking"), text=F.lit("x")), struct(type=F.lit("text"), text=E("text"))))))
    df = conv.select("conv_id", "turn", F.try_parse_json(F.when(E("turn") % 2 == 0, as_text).otherwise(as_blocks))
                     .alias("payload_v"))
    return ob.observe_transcript(df).select(
        "conv_id", "turn", E("source_ref.ref").alias("ref"), E("source_ref.kind").alias("kind"), "excerpt", "author",
        E("metadata")["cwd"].alias("cwd"), E("metadata")["session_id"].alias("session"))


@query(over_events(sql_observation(
    "continue_dev", ref="CASE WHEN k % 2 = 0 THEN 'id' || eid ELSE event_type || ':' || " + _DAY + " END", kind="event_type",
    excerpt="CASE WHEN k % 4 = 0 THEN 'ask ' || uid WHEN k % 4 = 1 THEN 'done ' || uid WHEN k % 4 = 2 THEN 'said ' || uid "
            "ELSE 'continue ' || event_type END",
    mode="passive", title="event_type", author="'u' || uid", stamp=_DAY,
    meta="'model=gpt;name=' || event_type || ';schema=0.2.0'")))
def observe_dev_data(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], eventName=E("event_type"), schema=F.lit("0.2.0"), timestamp=E("day"),
        userId=say("u", E("uid")), modelName=F.lit("gpt"), eventId=when(kk() % 2 == 0, say("id", E("eid"))),
        prompt=when(kk() % 4 == 0, say(" ask ", E("uid"))), completion=when(kk() % 4 == 1, say("done ", E("uid"))),
        message=when(kk() % 4 == 2, say("said ", E("uid"))))
    return flat_observations(ob.observe_dev_data(df), "event_id")


@query(_CTE + """SELECT event_id, """ + sql_observation(
    "aider", ref="md5(eid)", kind="'commit'", excerpt="'Fix ' || event_type", title="'Fix ' || event_type", mode="passive",
    author="CASE WHEN k % 4 = 0 THEN 'Dev (aider)' ELSE 'Dev' END", stamp=_DAY,
    meta="'attributed_by=' || CASE k % 4 WHEN 0 THEN 'author' WHEN 1 THEN 'committer' WHEN 2 THEN 'co-author' ELSE '' END "
         "|| ';short_hash=' || left(md5(eid), 7)") + " FROM e")
def observe_commits(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], hash=F.md5("eid"), message=say(" Fix ", E("event_type"), "\n\nlong text"),
        author_name=when(kk() % 4 == 0, "Dev (aider)").otherwise(F.lit("Dev")),
        committer_name=when(kk() % 4 == 1, "Bot (aider)"), authored_at=E("day"),
        trailers=F.when(kk() % 4 == 2, F.array(struct(key=F.lit("Co-authored-by"), value=F.lit("Aider <x>")))))
    return flat_observations(ob.observe_commits(df), "event_id")


@query("""
SELECT doc_id, 'local-' || left(sha256(source || '/' || doc_id || '.txt'), 16) AS ref, 'planning' AS kind,
  CAST(doc_id AS VARCHAR) AS title, lang AS stamp FROM documents""")
def observe_files(spark, sf):
    """Documents as dropped files (the redacted content is covered by the redaction queries)."""
    docs = spread(table(spark, sf, "documents")).select(
        "doc_id", say(E("source"), "/", E("doc_id").cast("string"), ".txt").alias("path"),
        E("text").alias("content"), E("lang").alias("modified"))
    return ob.observe_files(docs).select(
        "doc_id", E("source_ref.ref").alias("ref"), E("source_ref.kind").alias("kind"), "title",
        E("timestamp").alias("stamp"))


@query("""
SELECT l_orderkey, 'R' || l_linenumber || '@src/' || l_partkey || '.py:' || l_suppkey AS ref, 'finding' AS kind,
  'Finding ' || l_partkey AS excerpt, 'R' || l_linenumber AS title, 'level=' || l_returnflag || ';start_line=' ||
  l_suppkey || ';tool=scan' || l_linestatus || ';uri=src/' || l_partkey || '.py' AS meta FROM lineitem""")
def observe_sarif(spark, sf):
    """Orders as scan reports: one run per line status, one result per line."""
    li = table(spark, sf, "lineitem")
    part = E("l_partkey").cast("string")
    result = struct(
        ruleId=say("R", E("l_linenumber").cast("string")), level=E("l_returnflag"),
        message=struct(text=say("Finding ", part)),
        locations=F.array(struct(physicalLocation=struct(
            artifactLocation=struct(uri=say("src/", part, ".py")), region=struct(startLine=E("l_suppkey"))))))
    runs = li.groupBy("l_orderkey", "l_linestatus").agg(F.collect_list(result).alias("results"))
    reports = runs.groupBy("l_orderkey").agg(F.collect_list(struct(
        tool=struct(driver=struct(name=say("scan", E("l_linestatus")))), results=E("results"))).alias("runs"))
    out = ob.observe_sarif(payload(reports, ["l_orderkey"], version=F.lit("2.1.0"), runs=E("runs")))
    flat = flat_observations(out, "l_orderkey")
    return flat.select("l_orderkey", "ref", "kind", "excerpt", "title", "meta")


@query("SELECT p_partkey, " + sql_observation(
    "osv", ref="'OSV-' || p_partkey", kind="'vulnerability'", url="'https://osv/' || p_partkey",
    excerpt="CASE WHEN p_size % 3 > 0 THEN 'Flaw in ' || p_name ELSE 'Details of ' || p_name END", mode="active",
    title="CASE WHEN p_size % 3 > 0 THEN 'Flaw in ' || p_name ELSE 'OSV-' || p_partkey END", stamp="p_brand",
    meta="'aliases=CVE-' || p_size || ',GHSA-' || p_size || ';packages=' || p_name || ',' || p_type || ';severity=CVSS_V3:'"
         " || p_size || ',:'") + " FROM part")
def observe_osv(spark, sf):
    size = E("p_size").cast("string")
    df = payload(
        table(spark, sf, "part"), ["p_partkey"], id=say("OSV-", E("p_partkey").cast("string")), modified=E("p_brand"),
        aliases=F.array(say("CVE-", size), say("GHSA-", size)),
        summary=when(E("p_size") % 3 > 0, say("Flaw in ", E("p_name"))), details=say("Details of ", E("p_name")),
        severity=F.array(struct(type=F.lit("CVSS_V3"), score=size), struct(type=F.lit(None).cast("string"), score=F.lit(None).cast("string"))),
        affected=F.array(struct(package=struct(name=E("p_name"))), struct(package=struct(name=F.lit(""))),
                         struct(package=struct(name=E("p_type")))),
        references=F.array(struct(url=say("https://osv/", E("p_partkey").cast("string")))))
    return flat_observations(ob.observe_osv(df), "p_partkey")


@query("SELECT p_partkey, " + sql_observation(
    "mcp_registry", ref="'io.acme/' || p_partkey", kind="'mcp_server'", url="'https://repo/' || p_partkey",
    excerpt="CASE WHEN p_size % 2 = 0 THEN 'Serves ' || p_name ELSE p_name END", title="p_name", mode="active",
    meta="'repository_source=git;version=' || p_size") + " FROM part")
def observe_mcp_registry(spark, sf):
    pk = E("p_partkey").cast("string")
    df = payload(table(spark, sf, "part"), ["p_partkey"], name=say("io.acme/", pk), title=E("p_name"),
                 description=when(E("p_size") % 2 == 0, say("Serves ", E("p_name"))), version=E("p_size").cast("string"),
                 repository=struct(url=say("https://repo/", pk), source=F.lit("git")))
    return flat_observations(ob.observe_mcp_registry(df), "p_partkey")


_SNOW = "concat_ws(' — ', CASE WHEN k % 3 > 0 THEN 'Short ' || event_type END, CASE WHEN k % 2 = 0 THEN 'Long ' || uid END)"
_SNOW_TAG = "concat_ws(', ', CASE WHEN k % 5 > 0 THEN 'state=' || k % 5 END, CASE WHEN k % 7 > 0 THEN 'priority=' || k % 7 END)"


@query(_CTE + f", t AS (SELECT *, {_SNOW} AS body, {_SNOW_TAG} AS tag FROM e) SELECT event_id, " + sql_observation(
    "servicenow", ref="'INC' || eid", kind="'incident'", mode="active",
    excerpt="CASE WHEN body <> '' AND tag <> '' THEN body || ' (' || tag || ')' WHEN body <> '' THEN body "
            "WHEN tag <> '' THEN tag ELSE 'servicenow-incident' END",
    title="CASE WHEN k % 3 > 0 THEN 'Short ' || event_type ELSE 'INC' || eid END") + " FROM t")
def observe_servicenow(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], number=say("INC", E("eid")),
        short_description=when(kk() % 3 > 0, say("Short ", E("event_type"))),
        description=when(kk() % 2 == 0, say("Long ", E("uid"))), state=when(kk() % 5 > 0, (kk() % 5).cast("string")),
        priority=when(kk() % 7 > 0, (kk() % 7).cast("string")))
    return flat_observations(ob.observe_servicenow(df), "event_id")


@query(over_events(sql_observation(
    "devin", ref="'s' || eid", kind="'session'", url="CASE WHEN k % 2 = 0 THEN 'https://pr/' || eid ELSE '' END",
    excerpt="concat_ws(' ', '[' || event_type || ']', CASE WHEN k % 3 > 0 THEN 'Task ' || uid END, "
            "CASE WHEN k % 4 = 0 THEN 'out ' || uid END)",
    title="CASE WHEN k % 3 > 0 THEN 'Task ' || uid ELSE '' END", mode="active")))
def observe_devin(spark, sf):
    df = payload(
        events(spark, sf), ["event_id"], session_id=say("s", E("eid")), status_enum=E("event_type"),
        title=when(kk() % 3 > 0, say("Task ", E("uid"))), structured_output=when(kk() % 4 == 0, say("out ", E("uid"))),
        pull_requests=F.when(kk() % 2 == 0, F.array(struct(pr_url=F.lit("")), struct(pr_url=say("https://pr/", E("eid"))))))
    return flat_observations(ob.observe_devin(df), "event_id")


@query("""
WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS u
           FROM events GROUP BY ALL),
d AS (SELECT day, sum(n) AS n_in, sum(u) AS n_out, count(*) AS g, string_agg(event_type, ', ' ORDER BY event_type) AS m
      FROM r GROUP BY day)
SELECT day, 'anthropic:usage:' || day AS ref, 'Anthropic usage ' || day || ': ' || CAST(n_in * 2 + n_in AS BIGINT) || ' input / '
  || CAST(n_out AS BIGINT) || ' output tokens across ' || g || ' group(s); models ' || m AS excerpt FROM d""")
def observe_token_usage(spark, sf):
    """Events per day and type as usage buckets."""
    rows = events(spark, sf).groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("u"))
    result = struct(model=E("event_type"), uncached_input_tokens=E("n"), output_tokens=E("u"),
                    cache_creation=struct(ephemeral_1h_input_tokens=E("n") * 2))
    days = rows.groupBy("day").agg(F.array_sort(F.collect_list(result)).alias("results"))
    out = ob.observe_token_usage(payload(days, ["day"], starting_at=E("day"), results=E("results")))
    return out.select("day", E("source_ref.ref").alias("ref"), "excerpt")


@query(_CTE + """SELECT event_id, 'a' || eid AS ref, 'OpenAI audit ' || event_type || CASE WHEN k % 2 = 0 THEN
  ': project p' || uid ELSE '' END || ' via ' || CASE WHEN k % 3 = 0 THEN 'session' WHEN k % 3 = 1 THEN 'api_key'
  ELSE 'unknown' END || CASE WHEN k % 5 > 0 THEN ' at ' || strftime(to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC',
  '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS excerpt, 'OpenAI audit ' || event_type AS title FROM e""")
def observe_audit_log(spark, sf):
    from sievelight.plans.common import instant

    base = table(spark, sf, "events").withColumn("_sec", F.unix_seconds(instant("ts"))).select("event_id", "_sec")
    df = events(spark, sf).join(base, "event_id")
    rows = payload(
        df, ["event_id"], id=say("a", E("eid")), type=E("event_type"), effective_at=F.when(kk() % 5 > 0, E("_sec")),
        project=F.when(kk() % 2 == 0, struct(id=say("p", E("uid")))),
        actor=struct(type=element(["session", "api_key", "user"], kk())))
    return ob.observe_audit_log(rows).select("event_id", E("source_ref.ref").alias("ref"), "excerpt", "title")


@query(_CTE + f""", u AS (SELECT {_DAY} AS day, user_id, count(*) AS n,
  count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'view') AS v FROM e GROUP BY ALL)
SELECT day, user_id, 'cursor:usage:' || day || ':user:' || user_id AS ref, 'Cursor usage user ' || user_id || ' ' || day ||
  ': +' || n || ' accepted lines, ' || c || '/' || v || ' accepts, 0 agent + ' || c || ' chat + 0 composer requests, model m1'
  AS excerpt, 'Cursor usage ' || day AS title FROM u""")
def observe_usage_day(spark, sf):
    rows = events(spark, sf).groupBy("day", "user_id").agg(
        F.count("*").alias("n"), F.count_if(E("event_type") == "click").alias("c"),
        F.count_if(E("event_type") == "view").alias("v"))
    df = payload(rows, ["day", "user_id"], userId=E("user_id"), day=E("day"), email=F.lit("x@example.com"),
                 acceptedLinesAdded=E("n"), totalAccepts=E("c"), totalApplies=E("v"), agentRequests=F.lit(True),
                 chatRequests=E("c"), mostUsedModel=F.lit("m1"))
    return ob.observe_usage_day(df).select("day", "user_id", E("source_ref.ref").alias("ref"), "excerpt", "title")


@query(_CTE + f""", u AS (SELECT {_DAY} AS day, count(DISTINCT user_id) AS a, count(*) AS n FROM e GROUP BY ALL)
SELECT day, 'copilot:metrics:' || day AS ref, 'Copilot ' || day || ': ' || a || ' active / ? engaged users; IDE chat ' || n ||
  ' engaged; PR summaries ' || a || ' engaged' AS excerpt FROM u""")
def observe_org_metrics(spark, sf):
    rows = events(spark, sf).groupBy("day").agg(F.count_distinct("user_id").alias("a"), F.count("*").alias("n"))
    df = payload(rows, ["day"], date=E("day"), total_active_users=E("a"), total_engaged_users=F.lit("many"),
                 copilot_ide_chat=struct(total_engaged_users=E("n")), copilot_ide_code_completions=F.lit(3),
                 copilot_dotcom_pull_requests=struct(total_engaged_users=E("a")))
    return ob.observe_org_metrics(df).select("day", E("source_ref.ref").alias("ref"), "excerpt")


@query(_CTE + """, c AS (SELECT count(*) AS n FROM e)
SELECT 'pagerduty' AS source_id, 'webhook' AS mode, n FROM c UNION ALL SELECT 'devin', 'active', n FROM c
UNION ALL SELECT 'local_directory', 'passive', count(*) FROM documents""")
def observations_union(spark, sf):
    ev = events(spark, sf)
    a = ob.observe_pagerduty(payload(ev, ["event_id"], data=struct(id=E("eid"))))
    b = ob.observe_devin(payload(ev, ["event_id"], session_id=E("eid")))
    c = ob.observe_files(table(spark, sf, "documents").select(
        "doc_id", E("source").alias("path"), E("lang").alias("content")))
    rows = ob.all_observations([a, b, c])
    return rows.groupBy(E("source_ref.source_id").alias("source_id"), "mode").agg(F.count("*").alias("n"))
