"""Observations to emissions: provenance, versions, advisories, contract and sensitive screen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievelight.functions import sensitive as S
from sievelight.functions.text import first_text, is_blank, let, pin, strip, strip_lower, token
from sievelight.operators.observe import STATUS_ONLY
from sievelight.operators.redaction import signals_json
from sievelight.schemas import ADVISORY, EVIDENCE, HINT, PROVENANCE, SIGNAL

VERSION_BASELINE = "0.1.0"  # fixed value
EMISSION_TYPES = ["advisory", "candidate", "evidence", "hint"]  # fixed values
DELIVERY_MODES = {"webhook": "webhook", "active": "poll", "passive": "active-fetch", "discovery": "poll"}  # fixed


# --- provenance and shape ------------------------------------------------------------------------


def provenance(channel_mode: bool = False) -> Column:
    """Delivery mode, verification and ids. Ids pass through ``redact``.

    The mode is the parser's, not the channel's: a signed delivery parsed as an active pull leaves
    as an unsigned poll. ``channel_mode=True`` uses the column ``channel`` instead.
    """
    mode = F.col("channel") if channel_mode else F.col("mode")
    delivery = F.lit("poll")
    for name, value in DELIVERY_MODES.items():
        delivery = F.when(mode == name, F.lit(value)).otherwise(delivery)
    resource = first_text(F.col("provider_resource_id"), F.col("source_ref.ref"))
    return F.struct(
        delivery.alias("delivery_mode"),
        F.when(mode == "webhook", F.lit("signed")).otherwise(F.lit("unsigned")).alias("verification"),
        S.redact(F.coalesce(F.col("provider_event_id"), F.lit(""))).alias("provider_event_id"),
        S.redact(resource).alias("provider_resource_id"),
    ).cast(PROVENANCE)


def with_provenance(df: DataFrame, channel_mode: bool = False) -> DataFrame:
    return df.withColumn("provenance", provenance(channel_mode))


def with_version(df: DataFrame, descriptors: DataFrame | None = None) -> DataFrame:
    """Add ``adapter_version = <source>/<version>``.

    ``descriptors`` (``source_id, version``) has one row per source; Spark broadcasts it while it
    is below the session's size threshold. A missing or empty version falls back to the baseline.
    """
    src = F.col("source_ref.source_id")
    if descriptors is None:
        return df.withColumn("adapter_version", F.concat(src, F.lit("/" + VERSION_BASELINE)))
    d = descriptors.select(F.col("source_id").alias("_sid"), F.nullif("version", F.lit("")).alias("_ver"))
    return (
        df.join(d, src == F.col("_sid"), "left")
        .withColumn("adapter_version", F.concat(src, F.lit("/"), F.coalesce("_ver", F.lit(VERSION_BASELINE))))
        .drop("_sid", "_ver")
    )


def to_emissions(df: DataFrame, adapter_version: str | None = None, channel_mode: bool = False) -> DataFrame:
    """One ``evidence`` emission per observation, with one evidence element.

    Key columns travel along; ``redaction_receipt`` stays its own column.
    """
    if adapter_version is not None:
        df = df.withColumn("adapter_version", F.lit(adapter_version))
    elif "adapter_version" not in df.columns:
        df = with_version(df)
    gone = {
        "source_ref", "excerpt", "mode", "author", "timestamp", "provider_event_id", "provider_resource_id",
        "evidence_metadata", "channel",
    }
    made = {"title", "evidence_id", "metadata", "advisory_signals", "redaction_receipt", "adapter_version"}
    keep = [c for c in df.columns if c not in gone | made]
    df = pin(df, {"_provenance": provenance(channel_mode)})
    evidence = F.array(
        F.struct(
            "source_ref", "excerpt", "author", "timestamp", "evidence_id",
            F.col("evidence_metadata").alias("metadata"),
        )
    ).cast(f"array<{EVIDENCE}>")
    return df.select(
        *keep,
        F.col("source_ref.source_id").alias("source_id"),
        "title",
        F.col("excerpt").alias("body"),
        evidence.alias("evidence"),
        F.lit("evidence").alias("emission_type"),
        "adapter_version",
        F.lit(None).cast("struct<dimensions:map<string,string>,rationale:string>").alias("confidence"),
        F.array().cast(f"array<{HINT}>").alias("routing_hints"),
        F.array().cast(f"array<{ADVISORY}>").alias("advisories"),
        F.col("_provenance").alias("provenance"),
        "metadata",
        "advisory_signals",
        *(["redaction_receipt"] if "redaction_receipt" in df.columns else []),
    )


# --- advisories ---------------------------------------------------------------------------------


def advisory(code, scope, basis, confidence, effect, message) -> Column:
    def c(x):
        return F.lit(x) if isinstance(x, str) else x

    return F.struct(
        c(code).alias("kind"), c(message).alias("message"),
        F.array().cast("array<string>").alias("evidence_ids"),
        F.create_map(
            F.lit("scope"), c(scope), F.lit("basis"), c(basis), F.lit("confidence"), c(confidence),
            F.lit("recommended_effect"), c(effect), F.lit("schema_version"), F.lit("1"),
        ).alias("metadata"),
    ).cast(ADVISORY)


def schema_error(reason: Column | str) -> Column:
    return advisory(
        "heuristic_schema_error", "universal", reason, "high", "annotate",
        "A signal of the integration could not be read; the evidence itself is kept.",
    )


def integration_advisories() -> Column:
    """One advisory per signal; a malformed signal becomes a schema error, the evidence stays."""

    def judge(s: Column) -> Column:
        t = F.struct(
            token(s["code"]).alias("code"),
            token(first_text(s["scope"], "integration")).alias("scope"),
            token(s["basis"]).alias("basis"),
            token(first_text(s["confidence"], "medium")).alias("confidence"),
            token(first_text(s["recommended_effect"], "annotate")).alias("effect"),
        )
        return let(
            t,
            lambda x: let(
                F.when(s.isNull(), F.lit("advisory_signal_not_object"))
                .when(x["code"] == "", F.lit("advisory_code_missing"))
                .when(~x["scope"].isin("integration", "universal"), F.lit("advisory_scope_invalid"))
                .when(~x["confidence"].isin("low", "medium", "high"), F.lit("advisory_confidence_invalid"))
                .when(~x["effect"].isin("annotate", "rank_lower", "route"), F.lit("advisory_effect_invalid"))
                .when(F.coalesce(s["schema_version"], F.lit("1")) != "1",
                      F.lit("advisory_schema_version_invalid")),
                lambda why: F.when(why.isNotNull(), schema_error(why)).otherwise(
                    advisory(
                        x["code"], x["scope"], first_text(x["basis"], "integration_rule"), x["confidence"],
                        x["effect"], first_text(s["explanation"], "A signal that the integration gave."),
                    )
                ),
            ),
        )

    raw = F.col("metadata")["advisory_signals"]
    return F.when(
        F.coalesce(raw, F.lit("")) != "", F.array(schema_error("advisory_signals_not_sequence"))
    ).otherwise(F.transform(F.coalesce(F.col("advisory_signals"), F.array().cast(f"array<{SIGNAL}>")), judge))


def _authors() -> Column:
    return F.filter(F.transform("evidence", lambda e: strip_lower(e["author"])), lambda a: a != "")


def _flag(name: str) -> Column:
    """Any non-empty text is true, ``"false"`` included."""
    return F.coalesce(F.col("metadata")[name], F.lit("")) != ""


def adv_bot() -> tuple[Column, Column]:
    actor = strip_lower(F.coalesce(F.col("metadata")["actor_type"], F.lit("")))
    return (actor == "bot") | F.exists(_authors(), lambda a: a.endswith("[bot]")), advisory(
        "bot_authored", "universal", "provider_actor_type_or_author_suffix", "high", "annotate",
        "An automation account wrote this.")


def adv_dependency() -> tuple[Column, Column]:
    return F.exists(_authors(), lambda a: a.contains("dependabot") | a.contains("renovate")), advisory(
        "dependency_automation", "universal", "known_dependency_automation_identity", "high", "rank_lower",
        "A dependency bot made this.")


def adv_status() -> tuple[Column, Column]:
    return strip_lower(F.col("body")).isin(*STATUS_ONLY), advisory(
        "status_only", "universal", "exact_status_vocabulary", "high", "rank_lower",
        "The text is a stock phrase and nothing else.")


def adv_template() -> tuple[Column, Column]:
    body = strip_lower(F.col("body"))
    return body.startswith("<!--") | body.contains("issue template"), advisory(
        "template_dominant", "universal", "template_marker", "medium", "rank_lower",
        "The text still carries the marks of its template.")


def adv_flags() -> list[tuple[Column, Column]]:
    low = strip_lower(F.coalesce(F.col("metadata")["source_trust"], F.lit(""))) == "low"
    return [
        (_flag("duplicate_delivery"), advisory(
            "duplicate_delivery", "universal", "connector_delivery_identity", "high", "annotate",
            "The connector has seen this delivery before.")),
        (_flag("generated_sync_event"), advisory(
            "generated_sync_event", "universal", "connector_sync_marker", "high", "rank_lower",
            "A synchronization made this event, not a person.")),
        (_flag("stale_source"), advisory(
            "stale_source", "universal", "connector_freshness_marker", "high", "route",
            "The connector says that the source is out of date.")),
        (low, advisory(
            "low_source_trust", "universal", "connector_source_trust_marker", "medium", "route",
            "The connector trusts this source little.")),
    ]


def universal_advisories() -> Column:
    rules = [adv_bot(), adv_dependency(), adv_status(), adv_template(), *adv_flags()]
    return F.array_compact(F.array(*[F.when(cond, adv) for cond, adv in rules])).cast(f"array<{ADVISORY}>")


def merge_advisories(existing: Column, integration: Column, universal: Column) -> Column:
    """Existing, integration, universal, in that order.

    A universal advisory is dropped when an integration code equals it; afterwards the first of each
    (kind, scope) stays.
    """

    def merged(parts: Column) -> Column:
        codes = F.transform(parts["integration"], lambda a: a["kind"])
        rest = F.filter(parts["universal"], lambda a: ~F.array_contains(codes, a["kind"]))
        scope = lambda a: F.coalesce(a["metadata"]["scope"], F.lit(""))
        return F.aggregate(
            F.concat(parts["existing"], parts["integration"], rest),
            F.array().cast(f"array<{ADVISORY}>"),
            lambda acc, a: F.when(
                F.exists(acc, lambda b: (b["kind"] == a["kind"]) & (scope(b) == scope(a))), acc
            ).otherwise(F.concat(acc, F.array(a))),
        )

    return let(
        F.struct(existing.alias("existing"), integration.alias("integration"), universal.alias("universal")),
        merged,
    )


def with_advisories(df: DataFrame) -> DataFrame:
    """Attach integration and universal advisories without changing evidence."""
    return pin(
        df, {"advisories": merge_advisories(F.col("advisories"), integration_advisories(), universal_advisories())}
    ).select(*df.columns)


# --- contract and screen --------------------------------------------------------------------------


def contract_reason() -> Column:
    """First broken rule of the emission contract; null when all hold."""
    return (
        F.when(~F.coalesce(F.col("source_id"), F.lit("")).rlike(r"\A[A-Za-z0-9._-]+\n?\z"), F.lit("source_id_invalid"))
        .when(F.char_length("source_id") > 128, F.lit("source_id_too_long"))
        .when(F.coalesce(F.size("evidence"), F.lit(0)) <= 0, F.lit("evidence_required"))
        .when(F.exists("evidence", lambda e: is_blank(e["excerpt"])), F.lit("evidence_excerpt_blank"))
        .when(strip(F.coalesce(F.col("adapter_version"), F.lit(""))) == "", F.lit("adapter_version_required"))
        .when(~F.coalesce(F.col("emission_type"), F.lit("")).isin(*EMISSION_TYPES), F.lit("emission_type_invalid"))
        .when(
            F.col("confidence").isNotNull() & (F.coalesce(F.size("confidence.dimensions"), F.lit(0)) <= 0),
            F.lit("confidence_not_dimensional"),
        )
    )


def _map_leaves(m: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.coalesce(F.concat(F.map_keys(m), F.map_values(m)), empty)


def emission_leaves() -> Column:
    """Every text leaf of an emission, in screening order. Fields are never joined."""

    def flat(arr: Column, make) -> Column:
        return F.flatten(F.transform(arr, make))

    # Body and excerpt are mostly one text; a repeated leaf can not change the first hit.
    return F.filter(
        F.array_distinct(F.concat(
            F.array("title", "body", "source_id"),
            flat(F.col("evidence"), lambda e: F.array(
                e["excerpt"], e["source_ref"]["url"], e["source_ref"]["ref"], e["source_ref"]["source_id"],
                e["source_ref"]["kind"], e["author"], e["timestamp"], e["evidence_id"])),
            flat(F.col("routing_hints"), lambda h: F.array(h["role"], h["reason"], h["priority"])),
            flat(F.col("advisories"), lambda a: F.array(a["kind"], a["message"])),
            F.when(F.col("provenance").isNotNull(), F.array(
                "provenance.delivery_mode", "provenance.verification", "provenance.provider_event_id",
                "provenance.provider_resource_id")).otherwise(F.array().cast("array<string>")),
            _map_leaves(F.col("metadata")),
            flat(F.col("evidence"), lambda e: _map_leaves(e["metadata"])),
            flat(F.col("advisories"), lambda a: _map_leaves(a["metadata"])),
            flat(F.coalesce(F.col("advisory_signals"), F.array().cast(f"array<{SIGNAL}>")),
                 lambda s: F.array(s["code"], s["scope"], s["basis"], s["confidence"],
                                   s["recommended_effect"], s["explanation"])),
        )),
        lambda x: x.isNotNull() & (x != ""),
    )


def suspicious_text(v: Column) -> Column:
    """Necessary condition of any catalog hit, cheap enough for joined leaves."""
    return S.maybe_hit(v)


def screen_reason(leaves: Column) -> Column:
    """Class, pattern and masked excerpt of the first hit over the leaves; null when clean.

    The joined text is only used for a necessary condition. Leaves are scanned one by one, so an id
    label that ends one field can not excuse a card number that starts the next.
    """
    first = lambda ls: F.get(F.flatten(F.transform(ls, S.detect)), F.lit(0))
    return let(
        leaves,
        lambda ls: F.when(
            suspicious_text(F.array_join(ls, "\n")),
            let(
                first(ls),
                lambda h: F.when(
                    h.isNotNull(),
                    F.concat(
                        F.lit("sensitive_data:"), h["cls"], F.lit(" (pattern="), h["pattern_id"].cast("string"),
                        F.lit(", excerpt='"), h["match_excerpt"], F.lit("', catalog=v1)"),
                    ),
                ),
            ),
        ),
    )


def screen(df: DataFrame) -> DataFrame:
    """Add ``screen_reason`` to an emission table."""
    return df.withColumn("screen_reason", screen_reason(emission_leaves()))


def validate_emissions(df: DataFrame, mode: str = "quarantine"):
    """``quarantine``: (valid, rejected with ``reason``). ``failfast``: the valid table, which raises
    when any row breaks a rule."""
    marked = pin(df, {"reason": F.coalesce(contract_reason(), screen_reason(emission_leaves()))})
    if mode == "failfast":
        return marked.where(
            F.when(F.col("reason").isNull(), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("emission contract: "), F.col("reason"))).cast("boolean")
            )
        ).drop("reason")
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def gate_batches(df: DataFrame, batch: str, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(rows of clean batches, rejected batches with counts). One bad row rejects its batch.

    The bad batches are aggregated map-side; only their ids meet the rows, as an anti join.
    """
    bad = (
        df.where(F.col(reason).isNotNull()).groupBy(batch)
        .agg(F.count("*").alias("n_bad"), F.min(reason).alias("reason"))
    )
    return df.where(F.col(reason).isNull()).join(bad.select(batch), batch, "left_anti"), bad


def normalize(
    observations: DataFrame, adapter_version: str | None = None, completed_at: str = "",
    batch: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The one seam: redaction, emission, advisories, contract.

    Returns (emissions, rejects). Rejects are quarantined rows; with ``batch`` a reject takes its
    whole batch with it. Both outputs share the input's key columns.
    """
    from sievelight.operators.redaction import sanitize

    clean, rejected = sanitize(observations, completed_at)
    emissions = with_advisories(to_emissions(clean, adapter_version))
    valid, invalid = validate_emissions(emissions)
    keys = [c for c in rejected.columns if c in invalid.columns and c not in ("title", "metadata", "advisory_signals", "evidence_id")]
    rejects = rejected.select(*keys).unionByName(invalid.select(*keys))
    if batch is not None:
        valid = valid.join(rejects.select(batch).distinct(), batch, "left_anti")
    return valid, rejects


def mark_normalized(observations: DataFrame, adapter_version: str | None = None, completed_at: str = "") -> DataFrame:
    """All rows of ``normalize`` in one pass: emissions with ``reason``, null for valid ones.

    Redaction, contract and screen stand once in the plan, which reads its input once. A row that the guards reject is an
    emission by its columns, but its text is what came in: never let one through whose reason is set.
    """
    from sievelight.operators.redaction import mark_sanitized

    emissions = with_advisories(to_emissions(mark_sanitized(observations, completed_at).withColumnRenamed("reason", "_gate"), adapter_version))
    return pin(emissions, {"reason": F.coalesce("_gate", contract_reason(), screen_reason(emission_leaves()))}, drop=("_gate",))


def emission_json() -> Column:
    """Canonical JSON of an emission, used for the zero-finding receipt."""
    from sievelight.functions.canonical import json_array, json_map, json_object, json_string

    def ref(r: Column) -> Column:
        return json_object({k: json_string(r[k]) for k in ("source_id", "ref", "url", "kind")})

    signals = signals_json(F.col("advisory_signals"))
    evidence = json_array(F.transform("evidence", lambda e: json_object({
        "source_ref": ref(e["source_ref"]), "metadata": json_map(e["metadata"], {"advisory_signals": signals}),
        **{k: json_string(e[k]) for k in ("excerpt", "author", "timestamp", "evidence_id")},
    })))
    hints = json_array(F.transform("routing_hints", lambda h: json_object(
        {k: json_string(h[k]) for k in ("role", "reason", "priority")})))
    advisories = json_array(F.transform("advisories", lambda a: json_object({
        "kind": json_string(a["kind"]), "message": json_string(a["message"]),
        "evidence_ids": json_array(F.transform(a["evidence_ids"], json_string)),
        "metadata": json_map(a["metadata"], flags=("schema_version",)),
    })))
    null = F.lit("null")
    return json_object({
        **{k: json_string(F.col(k)) for k in ("source_id", "title", "body", "emission_type", "adapter_version")},
        "evidence": evidence, "routing_hints": hints, "advisories": advisories,
        "metadata": json_map(F.col("metadata"), {"advisory_signals": signals}),
        "confidence": F.when(F.col("confidence").isNull(), null).otherwise(json_object({
            "dimensions": json_map(F.col("confidence.dimensions")),
            "rationale": json_string(F.col("confidence.rationale")),
        })),
        "provenance": F.when(F.col("provenance").isNull(), null).otherwise(json_object({
            k: json_string(F.col(f"provenance.{k}")) for k in (
                "delivery_mode", "verification", "provider_event_id", "provider_resource_id")
        })),
    })
