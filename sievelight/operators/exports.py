"""Emissions to external envelopes, labels and evidence rows, and the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievelight.functions.crypto import sha256_tag
from sievelight.functions.sensitive import redact
from sievelight.functions.text import first_text, let, pin, strip, strip_lower
from sievelight.operators.normalize import EMISSION_TYPES, screen_reason

OWNED_FIELDS = ["content_hash", "level", "snapshot_content"]  # fixed values: set by the receiver only


# A token as it should be: no rule matches letters and underscores alone but those of the token families that need no other character.
_PLAIN_TOKEN = r"\A(?!.*(?:gh[opsur]_|github_pat_|k_live_|npm_))[a-z](?:[a-z_]{0,118}[a-z])?\z"


def label_token(col: Column, fallback: str = "unknown") -> Column:
    def whole(v: Column) -> Column:
        tok = F.btrim(F.regexp_replace(strip_lower(redact(v)), r"[^a-z0-9._-]+", "_"), F.lit("_"))
        return F.left(first_text(tok, fallback), F.lit(120))

    return let(F.coalesce(col, F.lit("")), lambda v: F.when(v.rlike(_PLAIN_TOKEN), v).otherwise(whole(v)))


def first_excerpt() -> Column:
    texts = F.filter(F.transform("evidence", lambda e: strip(F.coalesce(e["excerpt"], F.lit("")))), lambda t: t != "")
    return F.coalesce(F.get(texts, F.lit(0)), F.lit(""))


def source_uri() -> Column:
    """First non-blank url, then ``source:ref``, then the source id; url and ref are redacted."""

    def first(name: str) -> Column:
        values = F.transform("evidence", lambda e: strip(F.coalesce(e["source_ref"][name], F.lit(""))))
        return F.coalesce(F.get(F.filter(values, lambda t: t != ""), F.lit(0)), F.lit(""))

    picked = F.struct(first("url").alias("url"), first("ref").alias("ref"))
    return let(
        picked,
        lambda p: let(
            redact(first_text(p["url"], p["ref"])),
            lambda clean: F.when(p["url"] != "", clean)
            .when(p["ref"] != "", F.concat(F.col("source_id"), F.lit(":"), clean))
            .otherwise(F.col("source_id")),
        ),
    )


def envelope_labels(receipt: str | None = "redaction_receipt") -> Column:
    """Ordered labels: emission type, routing, advisories (two each), provenance, redaction."""
    none = F.array().cast("array<string>")

    def one(cond: Column, value: Column) -> Column:
        return F.when(cond, F.array(value)).otherwise(none)

    def adv(a: Column) -> Column:
        m = a["metadata"]
        # All tokens of an advisory go through one copy of the rules.
        raw = F.array(a["kind"], m["scope"], m["confidence"], m["recommended_effect"], m["basis"])
        fallback = F.array(*map(F.lit, ("unknown", "universal", "unknown", "annotate", "unspecified")))
        return let(
            F.zip_with(F.transform(raw, lambda x: label_token(x, "")), fallback, lambda t, f: first_text_col(t, f)),
            lambda t: F.array(
                F.concat(F.lit("advisory:"), F.get(t, F.lit(0))),
                F.concat(F.lit("advisory_v"), F.coalesce(m["schema_version"], F.lit("1")), F.lit(":"),
                         F.array_join(t, ":")),
            ),
        )

    p = "provenance."
    ids = F.transform(
        F.filter(
            F.array(
                F.struct(F.lit("provider_event_id:").alias("k"), F.col(p + "provider_event_id").alias("v")),
                F.struct(F.lit("provider_resource_id:").alias("k"), F.col(p + "provider_resource_id").alias("v")),
            ),
            lambda x: F.coalesce(x["v"], F.lit("")) != "",
        ),
        lambda x: F.concat(x["k"], redact(x["v"])),
    )
    prov = F.when(
        F.col("provenance").isNotNull(),
        F.concat(
            F.array(F.concat(F.lit("delivery:"), F.col(p + "delivery_mode")),
                    F.concat(F.lit("verification:"), F.col(p + "verification"))),
            ids,
        ),
    ).otherwise(none)
    parts = [
        one(F.col("emission_type").isin(*EMISSION_TYPES), F.concat(F.lit("emission_type:"), F.col("emission_type"))),
        F.transform("routing_hints", lambda h: F.concat(
            F.lit("routing:"), label_token(h["role"]), F.lit(":"), h["priority"])),
        F.flatten(F.transform("advisories", adv)),
        prov,
    ]
    if receipt:
        r = F.col(receipt)
        parts.append(F.when(r.isNotNull(), F.array(
            F.concat(F.lit("redaction:v"), F.coalesce(r["schema_version"].cast("string"), F.lit("unknown"))),
            F.concat(F.lit("redaction_ruleset:"), label_token(r["ruleset_id"])),
        )).otherwise(none))
    return F.concat(*parts)


def first_text_col(a: Column, b: Column) -> Column:
    return F.when(a != "", a).otherwise(b)


def to_envelopes(df: DataFrame) -> DataFrame:
    """Authority-free wire rows. Key columns travel along; the receipt stays when present."""
    has_receipt = "redaction_receipt" in df.columns
    used = {
        "source_id", "title", "body", "evidence", "emission_type", "adapter_version", "confidence", "routing_hints",
        "advisories", "provenance", "metadata", "advisory_signals", "redaction_receipt",
    }
    keep = [c for c in df.columns if c not in used]
    title = first_text(strip(F.coalesce("title", F.lit(""))), first_excerpt(), F.col("source_id"))
    content = first_text(
        strip(F.coalesce("body", F.lit(""))), strip(F.coalesce("title", F.lit(""))), first_excerpt(),
        F.col("source_id"),
    )
    rows = df.withColumns({"_title": title, "_content": content})
    hint = F.struct(
        F.col("_title").alias("title"), F.col("_content").alias("body"),
        envelope_labels("redaction_receipt" if has_receipt else None).alias("labels"),
    )
    return rows.select(
        *keep,
        F.col("source_id").alias("source_system"),
        source_uri().alias("source_uri"),
        F.col("_content").alias("content"),
        F.transform("evidence", lambda e: F.struct(e["excerpt"].alias("excerpt"))).alias("evidence"),
        F.array(hint).alias("candidate_hints"),
        *(["redaction_receipt"] if has_receipt else []),
    )


def envelope_json() -> Column:
    """Canonical JSON of an envelope row."""
    from sievelight.functions.canonical import json_array, json_object, json_string
    from sievelight.operators.redaction import receipt_json

    hints = json_array(F.transform("candidate_hints", lambda h: json_object({
        "title": json_string(h["title"]), "body": json_string(h["body"]),
        "labels": json_array(F.transform(h["labels"], json_string)),
    })))
    return json_object({
        **{k: json_string(F.col(k)) for k in ("source_system", "source_uri", "content")},
        "evidence": json_array(F.transform("evidence", lambda e: json_object({"excerpt": json_string(e["excerpt"])}))),
        "candidate_hints": hints,
        "redaction_receipt": receipt_json(F.col("redaction_receipt"), with_time=True),
    })


def audit_envelopes(df: DataFrame, json_col: str | None = None) -> DataFrame:
    """Rows that carry a receiver-owned field, with the field name.

    The declared columns and hint fields are checked on the schema, once. ``json_col`` names landed
    envelope text, whose keys are checked per row at the top level and inside every hint.
    """
    if json_col is None:
        hint_fields = df.schema["candidate_hints"].dataType.elementType.fieldNames()
        owned = [f for f in OWNED_FIELDS if f in df.columns or f in hint_fields]
        if not owned:
            return df.where(F.lit(False)).withColumn("owned_field", F.lit(None).cast("string"))
        return df.withColumn("owned_field", F.lit(owned[0]))
    v = F.try_parse_json(F.col(json_col))
    no_keys = F.array().cast("array<string>")

    def keys(x: Column, path: str = "$") -> Column:
        return F.coalesce(F.map_keys(F.try_variant_get(x, path, "map<string,variant>")), no_keys)

    hints = F.coalesce(F.try_variant_get(v, "$.candidate_hints", "array<variant>"), F.array().cast("array<variant>"))
    names = F.concat(keys(v), F.flatten(F.transform(hints, lambda h: keys(h))))
    owned = F.array_sort(F.array_intersect(names, F.array(*map(F.lit, OWNED_FIELDS))))
    return df.withColumn("owned_field", F.get(owned, F.lit(0))).where("owned_field IS NOT NULL")


def _sdk_struct(ref: Column, excerpt: Column, evidence_id: Column, version: Column, method: Column,
                captured_at: Column) -> Column:
    digest = sha256_tag(excerpt)
    return F.struct(
        first_text(F.coalesce(evidence_id, F.lit("")), F.coalesce(ref["ref"], F.lit("")), digest).alias("id"),
        F.struct(ref["source_id"].alias("system"), ref["ref"].alias("resourceId"), ref["kind"].alias("resourceType"),
                 ref["url"].alias("url")).alias("source"),
        F.struct(excerpt.alias("excerpt"), captured_at.alias("capturedAt")).alias("excerpt"),
        F.struct(
            captured_at.alias("capturedAt"),
            F.struct(ref["source_id"].alias("actorId"), F.lit("connector").alias("actorType")).alias("capturedBy"),
            method.alias("captureMethod"), version.alias("pipelineVersion"), digest.alias("sourceHash"),
        ).alias("provenance"),
        F.lit("raw").alias("status"),
        captured_at.alias("capturedAt"),
    )


def to_sdk_evidence(
    df: DataFrame, capture_method: str = "active", captured_at: str | None = None, keys: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(evidence rows, rejected). Works on emissions (one row per evidence element) and observations.

    Every exported text is screened again; a hit rejects the row with a masked reason.
    """
    keys = keys or []
    when = (lambda t: F.lit(captured_at)) if captured_at is not None else (lambda t: t)
    if "evidence" in df.columns:
        rows = df.select(*keys, "adapter_version", F.explode("evidence").alias("_e"))
        e = F.col("_e")
        ref, excerpt, eid = e["source_ref"], e["excerpt"], e["evidence_id"]
        stamp, method = e["timestamp"], F.lit(capture_method)
    else:
        rows = df if "adapter_version" in df.columns else df.withColumn("adapter_version", F.lit(""))
        ref, excerpt, eid = F.col("source_ref"), F.col("excerpt"), F.lit("")
        stamp, method = F.col("timestamp"), F.col("mode")
    made = rows.select(
        *keys,
        _sdk_struct(ref, excerpt, eid, F.col("adapter_version"), method, when(stamp)).alias("_s"),
    )
    leaves = F.array("_s.excerpt.excerpt", "_s.source.system", "_s.source.resourceId", "_s.source.url",
                     "_s.source.resourceType")
    marked = pin(made, {"reason": screen_reason(F.filter(leaves, lambda x: x.isNotNull() & (x != "")))})
    good = marked.where("reason IS NULL").select(*keys, "_s.*")
    return good, marked.where("reason IS NOT NULL").select(*keys, "reason")


def write_emissions(df: DataFrame, kind: str, path: str, mode: str = "append", partition: str | None = None) -> None:
    """``table``: parquet emissions; ``sdk``: parquet evidence rows; ``envelope``: JSON lines.

    ``partition`` (for example the source column) lays files out for pruning.
    """
    if kind == "table":
        out, col = df, partition or "source_id"
        writer = out.write.mode(mode).partitionBy(col)
        writer.parquet(path)
    elif kind == "sdk":
        good, _ = to_sdk_evidence(df)
        good.withColumn("system", F.col("source.system")).write.mode(mode).partitionBy(partition or "system").parquet(path)
    elif kind == "envelope":
        out = to_envelopes(df)
        wire = out.select("source_system", "source_uri", "content", "evidence", "candidate_hints",
                          *(["redaction_receipt"] if "redaction_receipt" in out.columns else []))
        wire.write.mode(mode).json(path)
    else:
        raise ValueError(f"unknown sink kind: {kind}")




def write_by_outcome(marked: DataFrame, path: str, reason: str = "reason") -> None:
    """Write a marked table once, kept and rejected rows in partitions of their own (``outcome=kept``, ``outcome=rejected``).

    Readers of one outcome read its partition alone, and no rule runs a second time.
    """
    outcome = F.when(F.col(reason).isNull(), F.lit("kept")).otherwise(F.lit("rejected"))
    marked.withColumn("outcome", outcome).write.partitionBy("outcome").parquet(path)
