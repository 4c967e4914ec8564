"""Provider resources and items: descriptors, envelopes, access checks, listings and their screen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievelight.functions import variant as V
from sievelight.functions.sensitive import detect
from sievelight.functions.text import first_text, let, non_blank, pin, strip
from sievelight.operators.normalize import suspicious_text
from sievelight.operators.observe import document_text
from sievelight.schemas import carried
from sievelight.session import cut_lineage

DOCUMENT_MIME = "application/vnd.google-apps.document"  # fixed value
DRIVE_SCOPE = "https://www.googleapis.com/auth/drive.readonly"  # fixed value


def _text(v: Column, path: str) -> Column:
    return V.text(v, path)


def _string_or_null(v: Column, path: str) -> Column:
    return F.when(V.kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def _metadata(**values: Column) -> Column:
    """String map without the null entries; scalars keep their JSON text."""
    pairs = F.create_map(*[x for k, c in values.items() for x in (F.lit(k), c)])
    return F.map_filter(pairs, lambda _, x: x.isNotNull())


def _raw(v: Column, path: str) -> Column:
    return F.when(V.kind(v, path) != "VOID", F.try_variant_get(v, path, "string"))


def _descriptor(df: DataFrame, provider: str, *, resource_id, display_name, resource_type: str, uri, capabilities,
                captured_at: str, last_modified=None, etag=None, parent_id=None, parent_name=None,
                metadata=None) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select(
        *carried(df),
        F.lit(provider).alias("provider"), resource_id.alias("resource_id"), display_name.alias("display_name"),
        F.lit(resource_type).alias("resource_type"), uri.alias("uri"), capabilities.alias("capabilities"),
        F.lit("granted").alias("permission"),
        (null if last_modified is None else last_modified).alias("last_modified"),
        (null if etag is None else etag).alias("etag"),
        (null if parent_id is None else parent_id).alias("parent_id"),
        (null if parent_name is None else parent_name).alias("parent_name"),
        (F.create_map().cast("map<string,string>") if metadata is None else metadata).alias("provider_metadata"),
        F.lit(captured_at).alias("captured_at"),
    )


def _caps(*names: str) -> Column:
    return F.array(*map(F.lit, names))


def _item(df: DataFrame, provider: str, *, resource_id, item_id, item_type: str, content, title, uri,
          last_modified=None, etag=None, metadata=None, fetched_at: str) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.withColumn("_content", content).select(
        *carried(df),
        F.lit(provider).alias("provider"), resource_id.alias("resource_id"), item_id.alias("item_id"),
        F.lit(item_type).alias("item_type"), title.alias("title"), F.col("_content").alias("content"),
        uri.alias("uri"), F.sha2("_content", 256).alias("content_hash"),
        (null if last_modified is None else last_modified).alias("last_modified"),
        (null if etag is None else etag).alias("etag"),
        (F.create_map().cast("map<string,string>") if metadata is None else metadata).alias("provider_metadata"),
        F.lit(fetched_at).alias("fetched_at"),
    )


# --- github ---------------------------------------------------------------------------------------


def describe_repos(df: DataFrame, captured_at: str = "") -> DataFrame:
    """Repository payloads; ``watch`` is offered when the permissions allow a subscription."""
    v = F.col("payload_v")
    full = _text(v, "$.full_name")
    watch = F.lit(False)
    for p in ("admin", "maintain", "push"):
        watch = watch | (V.loose(v, f"$.permissions.{p}") != "")
    caps = F.when(watch, _caps("list", "read", "search", "watch")).otherwise(_caps("list", "read", "search"))
    return _descriptor(
        df, "github", resource_id=full, display_name=first_text(_text(v, "$.name"), full), resource_type="repository",
        uri=non_blank(_text(v, "$.html_url")), capabilities=caps, captured_at=captured_at,
        last_modified=_string_or_null(v, "$.updated_at"), etag=_string_or_null(v, "$.node_id"),
        metadata=_metadata(default_branch=_raw(v, "$.default_branch"), visibility=_raw(v, "$.visibility"),
                           language=_raw(v, "$.language")),
    )


def items_github(df: DataFrame, kind: str, resource_id: str = "resource_id", fetched_at: str = "") -> DataFrame:
    """``issue``, ``pull_request`` or ``file`` payloads as item envelopes.

    A number that is absent prints as ``None``. File content is base64; undecodable text gives an
    empty content and invalid UTF-8 bytes become replacement characters.
    """
    v = F.col("payload_v")
    number = F.when(V.kind(v, "$.number").isNull(), F.lit("None")).otherwise(V.printed(v, "$.number"))
    common = dict(title=non_blank(_text(v, "$.title")), uri=non_blank(_text(v, "$.html_url")),
                  last_modified=_string_or_null(v, "$.updated_at"), fetched_at=fetched_at,
                  resource_id=F.col("_rid"))
    body = df.withColumnRenamed(resource_id, "_rid")
    if kind == "issue":
        labels = F.transform(V.objects(v, "$.labels"), lambda x: _text(x, "$.name"))
        out = _item(
            body, "github", item_id=F.concat(F.lit("issue-"), number), item_type="issue", content=_text(v, "$.body"),
            metadata=_metadata(number=_raw(v, "$.number"), state=_raw(v, "$.state"),
                               author_login=_raw(v, "$.user.login"),
                               labels=F.when(F.size(labels) > 0, F.to_json(labels))), **common)
    elif kind == "pull_request":
        out = _item(
            body, "github", item_id=F.concat(F.lit("pr-"), number), item_type="pull_request",
            content=_text(v, "$.body"),
            metadata=_metadata(number=_raw(v, "$.number"), state=_raw(v, "$.state"), merged=_raw(v, "$.merged"),
                               author_login=_raw(v, "$.user.login"), base_branch=_raw(v, "$.base.ref")), **common)
    else:
        path = _text(v, "$.path")
        # Characters outside the alphabet are skipped; a length that is no multiple of four fails.
        b64 = F.regexp_replace(_text(v, "$.content"), r"[^A-Za-z0-9+/=]", "")
        whole = F.when(F.pmod(F.char_length(b64), F.lit(4)) == 0, b64)
        raw = F.coalesce(F.try_to_binary(whole, F.lit("base64")), F.lit(b""))
        common |= dict(title=non_blank(_text(v, "$.name")), last_modified=None)
        out = _item(
            body, "github", item_id=F.concat(F.lit("file-"), path), item_type="file",
            content=F.make_valid_utf8(raw.cast("string")), etag=_string_or_null(v, "$.sha"),
            metadata=_metadata(path=non_blank(path), sha=_raw(v, "$.sha"), size=_raw(v, "$.size"),
                               encoding=_raw(v, "$.encoding")), **common)
    return out.drop("_rid")


# --- google drive ---------------------------------------------------------------------------------


def describe_drive(df: DataFrame, kind: str, captured_at: str = "") -> DataFrame:
    """``shared_drive``, ``folder`` or ``document`` payloads as descriptors."""
    v = F.col("payload_v")
    fid = _text(v, "$.id")
    name = first_text(_text(v, "$.name"), fid)

    def link(prefix: str, suffix: str = "") -> Column:
        return F.when(fid != "", F.concat(F.lit(prefix), fid, F.lit(suffix)))

    if kind == "shared_drive":
        return _descriptor(
            df, "google_drive", resource_id=F.concat(F.lit("drive_"), fid), display_name=name, resource_type=kind,
            uri=link("https://drive.google.com/drive/folders/"), capabilities=_caps("list", "read", "search"),
            captured_at=captured_at, last_modified=_string_or_null(v, "$.createdTime"))
    if kind == "folder":
        return _descriptor(
            df, "google_drive", resource_id=F.concat(F.lit("folder_"), fid), display_name=name, resource_type=kind,
            uri=link("https://drive.google.com/drive/folders/"), capabilities=_caps("list", "read"),
            captured_at=captured_at, last_modified=_string_or_null(v, "$.modifiedTime"),
            parent_id=F.concat(F.lit("drive_"), _text(v, "$.driveId")))
    return _descriptor(
        df, "google_drive", resource_id=F.concat(F.lit("doc_"), fid), display_name=name, resource_type="document",
        uri=link("https://docs.google.com/document/d/", "/edit"), capabilities=_caps("read"),
        captured_at=captured_at, last_modified=_string_or_null(v, "$.modifiedTime"),
        parent_id=F.concat(F.lit("folder_"), _text(v, "$.parents[0]")),
        metadata=_metadata(mime_type=first_text(_text(v, "$.mimeType"), DOCUMENT_MIME), version=_raw(v, "$.version")))


def items_drive(df: DataFrame, resource_id: str = "resource_id", item_id: str = "item_id",
                fetched_at: str = "") -> DataFrame:
    v = F.col("payload_v")
    doc = V.loose(v, "$.documentId")
    rows = df.withColumnsRenamed({resource_id: "_rid", item_id: "_iid"})
    return _item(
        rows, "google_drive", resource_id=F.col("_rid"), item_id=F.col("_iid"), item_type="document",
        content=document_text(v), title=non_blank(_text(v, "$.title")),
        uri=F.when(doc != "", F.concat(F.lit("https://docs.google.com/document/d/"), _text(v, "$.documentId"),
                                       F.lit("/edit"))),
        fetched_at=fetched_at).drop("_rid", "_iid")


# --- linear ---------------------------------------------------------------------------------------


def describe_linear(df: DataFrame, kind: str, captured_at: str = "") -> DataFrame:
    """``workspace``, ``team``, ``project`` or ``issue`` nodes as descriptors.

    Team and project rows may carry their context as columns ``ws_url_key``, ``ws_name``, ``team_id``;
    otherwise it is read from the node.
    """
    v = F.col("payload_v")

    def ctx(column: str, path: str) -> Column:
        return F.col(column) if column in df.columns else _text(v, path)

    nid = _text(v, "$.id")
    if kind == "workspace":
        key = _text(v, "$.urlKey")
        return _descriptor(
            df, "linear", resource_id=F.concat(F.lit("ws_"), key), display_name=first_text(_text(v, "$.name"), key),
            resource_type=kind, uri=F.when(key != "", F.concat(F.lit("https://linear.app/"), key)),
            capabilities=_caps("list", "search"), captured_at=captured_at)
    ws = ctx("ws_url_key", "$.organization.urlKey")
    if kind == "team":
        key = _text(v, "$.key")
        return _descriptor(
            df, "linear", resource_id=F.concat(F.lit("team_"), nid), display_name=first_text(_text(v, "$.name"), key),
            resource_type=kind,
            uri=F.when((ws != "") & (key != ""), F.concat(F.lit("https://linear.app/"), ws, F.lit("/team/"), key)),
            capabilities=_caps("list", "read", "search"), captured_at=captured_at,
            parent_id=F.concat(F.lit("ws_"), ws), parent_name=non_blank(ctx("ws_name", "$.organization.name")),
            metadata=_metadata(key=non_blank(key)))
    team = ctx("team_id", "$.team.id")
    if kind == "project":
        return _descriptor(
            df, "linear", resource_id=F.concat(F.lit("proj_"), nid), display_name=first_text(_text(v, "$.name"), nid),
            resource_type=kind,
            uri=F.when((ws != "") & (nid != ""), F.concat(F.lit("https://linear.app/"), ws, F.lit("/project/"), nid)),
            capabilities=_caps("list", "read"), captured_at=captured_at, parent_id=F.concat(F.lit("team_"), team))
    ident = _text(v, "$.identifier")
    label = strip(F.btrim(F.concat(ident, F.lit(": "), _text(v, "$.title")), F.lit(": ")))
    return _descriptor(
        df, "linear", resource_id=F.concat(F.lit("issue_"), nid), display_name=first_text(label, ident, nid),
        resource_type="issue", uri=non_blank(_text(v, "$.url")), capabilities=_caps("read"), captured_at=captured_at,
        last_modified=_string_or_null(v, "$.updatedAt"),
        parent_id=F.when(team != "", F.concat(F.lit("team_"), team)),
        metadata=_metadata(identifier=non_blank(ident), priority=_raw(v, "$.priority"), state=_raw(v, "$.state.name")))


def items_linear(df: DataFrame, kind: str, fetched_at: str = "") -> DataFrame:
    """``issue`` or ``comment`` nodes as items (the issue's own id names its resource)."""
    v = F.col("payload_v")
    nid = _text(v, "$.id")
    if kind == "comment":
        parent, ident = _text(v, "$.issue.id"), _text(v, "$.issue.identifier")
        return _item(
            df, "linear", resource_id=F.when(parent != "", F.concat(F.lit("issue_"), parent)).otherwise(F.lit("")),
            item_id=F.concat(F.lit("comment_"), nid), item_type="comment", content=_text(v, "$.body"),
            title=F.lit(None).cast("string"), uri=F.lit(None).cast("string"),
            last_modified=_string_or_null(v, "$.createdAt"),
            metadata=_metadata(parent_issue_identifier=non_blank(ident)), fetched_at=fetched_at)
    ident = first_text(V.loose(v, "$.identifier"), V.loose(v, "$.id"))
    name = V.loose(v, "$.title")
    label = strip(F.btrim(F.concat(ident, F.lit(": "), name), F.lit(": ")))
    return _item(
        df, "linear", resource_id=F.concat(F.lit("issue_"), nid), item_id=F.concat(F.lit("issue_"), nid),
        item_type="issue", content=first_text(V.loose(v, "$.description"), name, ident),
        title=non_blank(first_text(label, ident)), uri=non_blank(_text(v, "$.url")),
        last_modified=_string_or_null(v, "$.updatedAt"),
        metadata=_metadata(
            identifier=non_blank(_text(v, "$.identifier")), priority=_raw(v, "$.priority"),
            state=_raw(v, "$.state.name"), team_key=non_blank(_text(v, "$.team.key"))),
        fetched_at=fetched_at)


# --- listings, access, lookups --------------------------------------------------------------------


def resource_children(resources: DataFrame, parent: str) -> DataFrame:
    """Direct children of one resource: a pushed-down filter."""
    return resources.where(F.col("parent_id") == parent)


def resource_tree(resources: DataFrame, depth: int = 3) -> DataFrame:
    """Every resource with its chain of ancestors (``ancestor_1`` is the parent), by equi joins."""
    out = resources.select("provider", "resource_id", "resource_type", F.col("parent_id").alias("ancestor_1"))
    for level in range(1, depth):
        up = resources.select(
            F.col("provider").alias("_p"), F.col("resource_id").alias("_r"), F.col("parent_id").alias(f"ancestor_{level + 1}")
        )
        cond = (F.col("provider") == F.col("_p")) & (F.col(f"ancestor_{level}") == F.col("_r"))
        out = out.join(up, cond, "left").drop("_p", "_r")
    return out


def resource_lineage(resources: DataFrame) -> DataFrame:
    """``provider, resource_id, root_id, depth, cyclic`` of every resource, at any depth.

    ``root_id`` is the topmost ancestor that the catalogue lists and ``depth`` the number of steps to it; a resource without a listed
    parent is its own root. Where a chain runs into a cycle, both are null and ``cyclic`` is true. An id that is listed
    twice counts once, with its smallest parent. Null ids are left out.

    Pointer doubling: every round replaces a resource's pointer by that of the resource it points to, so chains of n levels
    take log2(n) rounds. A chain is never longer than the catalogue; what has not ended after that many rounds is cyclic. The
    catalogue is read once, each round is cut by a checkpoint.
    """
    key = ["provider", "resource_id"]
    listed = resources.where("resource_id IS NOT NULL").groupBy(*key).agg(F.min("parent_id").alias("parent_id"))
    listed = cut_lineage(listed)
    parents = listed.select("provider", F.col("resource_id").alias("parent_id"), F.lit(True).alias("_known"))
    known = F.col("_known").isNotNull()
    state = cut_lineage(listed.join(parents, ["provider", "parent_id"], "left").select(
        *key, F.when(known, F.col("parent_id")).otherwise(F.col("resource_id")).alias("root_id"),
        known.cast("long").alias("depth"), (~known).alias("_top"), (~known).alias("_done")))
    rounds = state.count().bit_length() + 1
    for _ in range(rounds):
        # A pointer to a root stays: the root points to itself, at no distance.
        if state.where("NOT _done").isEmpty():
            break
        up = state.select(
            "provider", F.col("resource_id").alias("root_id"), F.col("root_id").alias("_root"), F.col("depth").alias("_steps"),
            F.col("_top").alias("_ends"))
        state = cut_lineage(state.join(up, ["provider", "root_id"]).select(
            *key, F.col("_root").alias("root_id"), (F.col("depth") + F.col("_steps")).alias("depth"), "_top", F.col("_ends").alias("_done")))
    return state.select(*key, F.when(F.col("_done"), F.col("root_id")).alias("root_id"), F.when(F.col("_done"), F.col("depth")).alias("depth"),
                        (~F.col("_done")).alias("cyclic"))


def list_resources(resources: DataFrame, provider: str | None = None) -> DataFrame:
    return resources if not provider else resources.where(F.col("provider") == provider)


def _outcome(kind: Column, message: Column, state: Column, hint: Column) -> Column:
    return F.struct(
        kind.alias("kind"), message.alias("message"), state.alias("permission_state"), hint.alias("action_hint")
    )


def validate_access(requests: DataFrame, resources: DataFrame, key: str = "resource_id") -> DataFrame:
    """Requests with their descriptor and ``error`` (null when access is granted)."""
    null = F.lit(None).cast("string")
    r = resources.select(
        F.col("resource_id").alias(key), F.col("permission"), F.col("display_name"),
        F.col("provider_metadata")["action_hint"].alias("_hint"), F.lit(True).alias("_known"),
    )
    rid = F.col(key)
    error = (
        F.when(F.col("_known").isNull(), _outcome(
            F.lit("not_found"), F.concat(F.lit("Resource "), rid, F.lit(" is not in the catalogue")), null, null))
        .when(F.col("permission") == "denied", _outcome(
            F.lit("permission_denied"), F.concat(F.lit("No permission for "), rid), F.lit("denied"), F.col("_hint")))
        .when(F.col("permission") == "action_needed", _outcome(
            F.lit("action_needed"), F.concat(F.lit("The owner has to act on "), rid), F.lit("action_needed"), F.col("_hint")))
    )
    return requests.join(r, key, "left").withColumn("error", error).drop("_hint", "_known")


def fetch_items(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Items by (resource, item); ``error`` is set where none exists."""
    i = items.select("resource_id", "item_id", F.struct(*[c for c in items.columns if c not in (
        "resource_id", "item_id")]).alias("item"))
    message = F.concat(F.lit("Item "), F.col("item_id"), F.lit(" not found in resource "), F.col("resource_id"))
    null = F.lit(None).cast("string")
    return requests.join(i, ["resource_id", "item_id"], "left").withColumn(
        "error", F.when(F.col("item").isNull(), _outcome(F.lit("not_found"), message, null, null))
    )


def _leaf(path: str, value: Column) -> Column:
    return F.struct(F.lit(path).alias("path"), value.alias("text"))


def resource_leaves(df: DataFrame) -> Column:
    """``array<struct<path, text>>`` of every text leaf of a descriptor or item row."""
    fixed = ["provider", "resource_id", "item_id", "display_name", "item_type", "resource_type", "title", "content",
             "uri", "permission"]
    leaves = [_leaf(c, F.col(c)) for c in fixed if c in df.columns]
    for path, c in (("parent.resource_id", "parent_id"), ("parent.display_name", "parent_name"),
                    ("freshness.last_modified", "last_modified"), ("freshness.etag", "etag")):
        if c in df.columns and "item_id" not in df.columns:
            leaves.append(_leaf(path, F.col(c)))
    arrays = [F.array(*leaves)]
    if "capabilities" in df.columns:
        arrays.append(F.transform("capabilities", lambda x, i: F.struct(
            F.concat(F.lit("capabilities["), i.cast("string"), F.lit("]")).alias("path"), x.alias("text"))))
    arrays.append(F.transform(F.map_entries("provider_metadata"), lambda e: F.struct(
        F.concat(F.lit("provider_metadata."), e["key"]).alias("path"), e["value"].alias("text"))))
    return F.filter(F.concat(*arrays), lambda x: F.coalesce(x["text"], F.lit("")) != "")


def leaf_reason(leaves: Column) -> Column:
    """Path and class of the first hit; null when clean. Never carries the value."""

    def why(x: Column) -> Column:
        return let(F.get(detect(x["text"]), F.lit(0)), lambda h: F.when(
            h.isNotNull(), F.concat(x["path"], F.lit(": sensitive "), h["cls"], F.lit(" detected"))))

    return let(leaves, lambda ls: F.when(
        suspicious_text(F.array_join(F.transform(ls, lambda x: x["text"]), "\n")),
        F.get(F.array_compact(F.transform(ls, why)), F.lit(0)),
    ))


def screen_resources(df: DataFrame, listing: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with the leaf path and class). With ``listing`` one hit fails its
    whole listing: bad listings are aggregated map-side and removed by an anti join."""
    marked = pin(df, {"reason": leaf_reason(resource_leaves(df))})
    rejected = marked.where("reason IS NOT NULL")
    clean = marked.where("reason IS NULL").drop("reason")
    if listing is not None:
        bad = rejected.groupBy(listing).agg(F.min("reason").alias("reason"))
        clean = clean.join(bad.select(listing), listing, "left_anti")
    return clean, rejected


# --- response outcomes ----------------------------------------------------------------------------


def _case(rules: list[tuple[Column, str, str | Column, str | None, str | None]], default: Column) -> Column:
    null = F.lit(None).cast("string")
    out = None
    for cond, kind, message, state, hint in rules:
        value = _outcome(
            F.lit(kind), F.lit(message) if isinstance(message, str) else message,
            null if state is None else F.lit(state), null if hint is None else F.lit(hint),
        )
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default)


def _header(name: str) -> Column:
    hits = F.filter(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))),
                    lambda e: F.lower(e["key"]) == name)
    return F.coalesce(F.get(hits, F.lit(0))["value"], F.lit(""))


def discovery_outcome(df: DataFrame, provider: str) -> DataFrame:
    """Add ``error`` (null on success) for response rows ``status, headers, payload_v``."""
    v, status = F.col("payload_v"), F.col("status")
    failed, needed, denied = "provider_error", "action_needed", "permission_denied"
    null = F.lit(None).cast("string")
    unexpected = _outcome(
        F.lit(failed), F.concat(F.lit("the provider answered with status "), status.cast("string")), null, null)
    if provider == "github":
        message = F.lower(V.printed(v, "$.message"))
        limited = (_header("x-ratelimit-remaining") == "0") | message.contains("rate limit")
        error = _case([
            (status == 401, needed, "the app's credentials are no longer accepted", needed,
             "Install the GitHub App again or issue new credentials."),
            ((status == 403) & limited, failed, "GitHub refused the call for its rate", None,
             "Wait for the limit to reset, then try again."),
            (status == 403, denied, "the app may not read this resource", "denied",
             "Add this repository to the app's access list."),
            (status == 404, "not_found", "there is no such resource", None, None),
            (status == 422, failed, "the page cursor is no longer valid", None, "List again from the first page."),
            (status >= 500, failed, "GitHub did not answer properly", None, "Retry later."),
        ], unexpected)
        ok = status == 200
    elif provider == "google_drive":
        has_list = V.is_object(v, "$.error.errors[0]")
        reason = F.lower(F.when(has_list, V.printed(v, "$.error.errors[0].reason")).otherwise(
            V.printed(v, "$.error.status")))
        limited = reason.contains("ratelimitexceeded") | (_header("retry-after") != "")
        error = _case([
            (status == 401, needed, "the Google grant has ended", needed,
             "Grant read access to Drive and Documents again."),
            ((status == 403) & (reason.contains("insufficientpermissions") | reason.contains("insufficientscopes")),
             needed, "the grant does not cover listing Drive files", needed,
             f"Grant {DRIVE_SCOPE}, which listing needs."),
            ((status == 403) & limited, failed, "Google Drive refused the call for its rate", None,
             "Wait until the limit has passed, then try again."),
            (status == 403, denied, "the account is no member of this shared drive", "denied",
             "Add the account to the shared drive."),
            (status == 404, "not_found", "there is no such resource any more", None, None),
            (status == 400, failed, "the page token is no longer valid", None, "List again from the first page."),
            (status == 429, failed, "Google Drive refused the call for its rate", None, "Wait until the limit has passed, then try again."),
            (status >= 500, failed, "Google Drive did not answer properly", None, "Retry later."),
        ], unexpected)
        ok = status == 200
    elif provider == "linear":
        errors = V.objects(v, "$.errors")
        any_error = F.size(V.array(v, "$.errors")) > 0
        sig = F.lower(F.array_join(F.flatten(F.transform(errors, lambda e: F.array(
            V.printed(e, "$.code"), V.printed(e, "$.message")))), " "))
        words = lambda *ws: F.exists(F.array(*map(F.lit, ws)), lambda w: F.contains(sig, w))
        error = _case([
            (F.exists(errors, lambda e: V.text(e, "$.code") == "RATELIMITED"), failed,
             "Linear refused the call for its rate", None, "Wait until the limit has passed, then try again."),
            ((status == 400) | ~any_error, failed,
             F.concat(F.lit("Linear answered with an error (status "), status.cast("string"), F.lit(")")), None,
             "Retry later."),
            (words("authentication", "unauthenticated", "invalid api key"), needed, "Linear did not accept the key",
             needed, "Create a Linear key that can read the workspace."),
            (words("forbidden", "access denied", "not authorized"), denied,
             "the key may not read this Linear resource", "denied",
             "Extend the key to this team or workspace."),
            (words("not_found", "not found", "entitynotfound"), "not_found", "Linear has no such resource", None, None),
        ], _outcome(F.lit(failed), F.lit("Linear reported a query error"), null, F.lit("Retry later.")))
        ok = (status == 200) & ~any_error
    else:
        raise ValueError(f"unknown provider: {provider}")
    return df.withColumn("error", F.when(~ok, error))
