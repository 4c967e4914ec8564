"""Redaction jobs over observation tables: sanitizing, guards, receipts and their audits."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sievelight.functions import sensitive as S, variant as V
from sievelight.functions.canonical import canonical, canonical_digest, json_array, json_map, json_object, json_string
from sievelight.functions.json_text import decoded, replaced, value_spans
from sievelight.functions.text import each_once, let, pin
from sievelight.schemas import FINDING, RECEIPT, SIGNAL, empty_map

MAX_OBSERVATION_BYTES = 1_048_576  # fixed value
ENGINE = "sievelight-redaction"
SCREEN_ENGINE = "sievelight-screen"
ENGINE_VERSION = "1.0.0"
RULESET_ID = "fx-sec-001-plus-pii-v1"  # fixed value
# Fixed value: the rule set the digest names.
RULESET = {
    "catalog": "FX-SEC-001/v1",
    "detectors": ["secret", "phi", "pan", "email", "phone"],
    "replacement": "[redacted:<category>]",
    "identity_policy": "preserve-opaque-identifiers; hard-catalog-fail-closed",
    "metadata_policy": "recursive-values; sensitive-keys-rejected",
}


def _ruleset_digest() -> str:
    import hashlib

    text = json.dumps(RULESET, sort_keys=True, separators=(",", ":"))
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


RULESET_DIGEST = _ruleset_digest()

# Fields that must stay byte-identical.
IDENTITY_FIELDS = [
    "source_ref.source_id", "source_ref.ref", "source_ref.url", "source_ref.kind",
    "provider_event_id", "provider_resource_id", "evidence_id", "timestamp",
]
FLAG_KEYS = ("content_truncated", "title_truncated", "tombstone")
OBSERVATION_TEXTS = ("excerpt", "title", "author", "mode", "timestamp", "provider_event_id", "provider_resource_id", "evidence_id")
OBSERVATION_MAPS = ("evidence_metadata", "metadata")
SIGNAL_TEXTS = ("code", "scope", "basis", "confidence", "recommended_effect", "explanation")


# --- hits ---------------------------------------------------------------------------------------


def sensitive_hits(df: DataFrame, col: str) -> DataFrame:
    """One row per hit: the other columns plus ``cls, pattern_id, match_excerpt`` (masked)."""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(S.detect(F.col(col))).alias("_h")).select(*keep, "_h.*")


def findings_array(credential: Column, pii: Column, secret: Column) -> Column:
    """Categories with a positive count, in name order."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("category"), F.lit("tokenized").alias("action"), n.cast("int").alias("count")
            )
            for name, n in (("credential", credential), ("pii", pii), ("secret", secret))
        ]
    )
    return F.filter(rows, lambda r: r["count"] > 0).cast(f"array<{FINDING}>")


# --- nested JSON --------------------------------------------------------------------------------


def redact_map(m: Column) -> Column:
    return F.transform_values(m, lambda _, v: S.redact(v))


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_leaves(docs: pd.Series) -> pd.Series:
    """The string values of each text, in order; null when it is not JSON."""
    def leaves(doc: str) -> list[str] | None:
        spans = value_spans(doc)
        return None if spans is None else [decoded(doc[a:b]) for a, b in spans]

    return docs.map(leaves, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_keys(docs: pd.Series) -> pd.Series:
    """Every object key at any depth."""

    def walk(node, out: set) -> set:
        for k, v in node.items() if isinstance(node, dict) else enumerate(node):
            if isinstance(node, dict):
                out.add(k)
            if isinstance(v, (dict, list)):
                walk(v, out)
        return out

    def keys(doc: str) -> list[str] | None:
        try:
            node = json.loads(doc)
            return sorted(walk(node, set())) if isinstance(node, (dict, list)) else []
        except (ValueError, RecursionError):
            return None

    return docs.map(keys, na_action="ignore")


@F.pandas_udf(T.StringType())
def json_rebuild(docs: pd.Series, leaves: pd.Series) -> pd.Series:
    return pd.Series([None if d is None or ls is None else replaced(d, value_spans(d), list(ls)) for d, ls in zip(docs, leaves)], dtype=object)


UNREADABLE = "[redacted:unreadable]"


def redact_json(df: DataFrame, col: str) -> DataFrame:
    """Redact every string value of a JSON text column of any depth; every other character stays as it is.

    Python only finds the values by position and puts redacted ones in their places. The rules run as the same built-in
    expressions as everywhere else, over the array of leaves. Text without any character a
    rule needs (``@ : =`` a digit run or a token prefix) skips Python altogether. Text that is not JSON is
    redacted as one text; if it has escapes, which could hide a value, it is replaced whole. All values of a repeated
    key stay, each redacted. Keys are not values: ``reject_sensitive_keys`` judges them.
    """
    may_hit = F.coalesce(
        F.col(col).contains("@") | F.col(col).rlike(r"(?U)\d[\d .\-]{5,}\d") | S._maybe_secret(F.col(col))
        | F.col(col).rlike(S.PHI_WORDS)
        | F.col(col).contains("\\u"),
        F.lit(False),
    )
    walk = df.where(may_hit)
    rest = df.where(~may_hit)
    order = df.columns
    raw = F.when(F.col(col).contains("\\u"), F.lit(UNREADABLE)).otherwise(S.redact(F.col(col)))
    leaves = pin(walk.withColumn("_leaves", json_leaves(F.col(col))), {"_clean": F.transform("_leaves", S.redact)})
    rebuilt = leaves.withColumn("_new", json_rebuild(F.col(col), F.col("_clean")))
    redacted = rebuilt.withColumn(col, F.when(F.col("_leaves").isNull(), raw).otherwise(F.col("_new")))
    return redacted.select(*order).unionByName(rest)


def sensitive_key(m: Column) -> Column:
    """True when redaction would change a key of the map."""
    return F.coalesce(F.exists(F.map_keys(m), lambda k: S.redact(k) != k), F.lit(False))


def key_reason() -> Column:
    """First metadata map with a sensitive key; both maps share one copy of the rules."""
    maps = F.array(
        *[F.struct(F.lit(n).alias("name"), F.map_keys(F.col(n)).alias("keys")) for n in ("evidence_metadata", "metadata")]
    )
    bad = F.filter(maps, lambda m: F.coalesce(F.exists(m["keys"], lambda k: S.redact(k) != k), F.lit(False)))
    return F.concat(F.lit("sensitive_metadata_key:"), F.get(bad, F.lit(0))["name"])


def reject_sensitive_keys(df: DataFrame, json_cols: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): a metadata key that redaction would change rejects the row.

    ``json_cols`` name JSON text columns whose keys are checked at every depth; text that can not be
    read rejects the row.
    """
    cols = df.columns
    for c in json_cols:
        df = df.withColumn(f"_keys_{c}", json_keys(F.col(c)))
    reason = key_reason()
    for c in json_cols:
        reason = F.coalesce(
            reason,
            F.when(F.col(c).isNotNull() & F.col(f"_keys_{c}").isNull(), F.lit(f"unreadable_json:{c}"))
            .when(F.exists(F.col(f"_keys_{c}"), lambda k: S.redact(k) != k), F.lit(f"sensitive_metadata_key:{c}")),
        )
    clean, rejected = _split(df, reason)
    return clean.select(*cols), rejected.select(*cols, "reason")


# --- guards -------------------------------------------------------------------------------------


def _split(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    marked = pin(df, {"reason": reason})
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def identity_reason() -> Column:
    """Reason of the first identity field with a catalog hit; null when all are clean.

    A null identity field cannot be scanned and counts as ``engine_unavailable``. One cheap test over
    the joined fields decides for almost all rows; it is only a necessary condition of a hit, so
    joining can not hide one. The field-wise scan that names the field runs for the others.
    """
    fields = F.array(
        *[F.struct(F.lit(f).alias("name"), F.col(f).alias("value")) for f in IDENTITY_FIELDS]
    )

    def why(f: Column) -> Column:
        return F.when(f["value"].isNull(), F.lit("engine_unavailable")).when(
            S.has_hit(f["value"]), F.concat(F.lit("sensitive_identity_field:"), f["name"])
        )

    def check(fs: Column) -> Column:
        suspicious = let(F.array_join(F.transform(fs, lambda f: f["value"]), "\n"), S.maybe_hit)
        any_null = F.exists(fs, lambda f: f["value"].isNull())
        return F.when(any_null | suspicious, F.get(F.array_compact(F.transform(fs, why)), F.lit(0)))

    return let(fields, check)


def guard_identity(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split(df, identity_reason())


def signals_json(signals: Column) -> Column:
    """Encoded ``advisory_signals`` list; null when the source has none."""
    item = lambda s: json_object(
        {
            **{k: json_string(s[k]) for k in SIGNAL_TEXTS},
            "schema_version": F.when(s["schema_version"].rlike(r"\A-?[0-9]+\z"), s["schema_version"]).otherwise(
                json_string(s["schema_version"])
            ),
        }
    )
    return F.when(signals.isNotNull(), json_array(F.transform(signals, item)))


def observation_fields(prefix: str = "") -> dict[str, Column]:
    """Encoded JSON values of an observation by key (``prefix`` selects a struct, such as ``o.``).

    Sources with signals carry them in both metadata objects.
    """
    signals = {"advisory_signals": signals_json(F.col(prefix + "advisory_signals"))}
    return {
        "source_ref": json_object(
            {k: json_string(F.col(f"{prefix}source_ref.{k}")) for k in ("source_id", "ref", "url", "kind")}
        ),
        **{k: json_string(F.col(prefix + k)) for k in OBSERVATION_TEXTS},
        **{k: json_map(F.col(prefix + k), signals, FLAG_KEYS) for k in OBSERVATION_MAPS},
    }


def observation_text(prefix: str = "") -> Column:
    """JSON of an observation row, keys in order; see ``canonical`` for its control escapes.

    Without signals and flags every value is text: one writer call encodes the row, keys in order.
    """
    col = lambda k: F.col(prefix + k)
    texts = {k: F.coalesce(col(k), F.lit("")) for k in OBSERVATION_TEXTS}
    ref = {k: F.coalesce(col(f"source_ref.{k}"), F.lit("")) for k in ("kind", "ref", "source_id", "url")}
    maps = {k: sorted_map(col(k)) for k in OBSERVATION_MAPS}
    fields = texts | maps | {"source_ref": F.struct(*[v.alias(k) for k, v in ref.items()])}
    plain = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))
    special = col("advisory_signals").isNotNull()
    for k in OBSERVATION_MAPS:
        special = special | has_flags(col(k))
    return F.when(special, json_object(observation_fields(prefix))).otherwise(plain)


def observation_json(prefix: str = "") -> Column:
    """Canonical JSON of an observation row."""
    return canonical(observation_text(prefix))


def has_flags(m: Column) -> Column:
    """True when a map holds a value that is no text at its source."""
    return F.coalesce(F.arrays_overlap(F.map_keys(m), F.array(*map(F.lit, FLAG_KEYS))), F.lit(False))


def sorted_map(m: Column) -> Column:
    """A string map with its keys in order and null values as empty text."""
    entries = F.sort_array(F.map_entries(F.coalesce(m, empty_map())))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], F.coalesce(e["value"], F.lit("")))))


def gate_size(df: DataFrame, limit: int = MAX_OBSERVATION_BYTES) -> tuple[DataFrame, DataFrame]:
    """(within the budget, rejected as ``oversized_payload``), by bytes of the canonical JSON."""
    return _split(df, F.when(F.octet_length(observation_json()) > limit, F.lit("oversized_payload")))


# --- sanitizing and receipts ---------------------------------------------------------------------


def sanitize(
    df: DataFrame, completed_at: str = "", engine: str = ENGINE, limit: int = MAX_OBSERVATION_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(clean observations with ``redaction_receipt``, rejected rows with a value-free reason).

    Size gate, identity guard, key guard, redaction of every free-text leaf, receipt. All leaves of
    a row go through one copy of the rules as an array, equal ones once. ``completed_at`` is an argument, so a replay
    gives equal rows.
    """
    marked = _gated(df, limit)
    rejected = marked.where("reason IS NOT NULL").drop("_in_digest")
    clean = _redacted(marked.where("reason IS NULL").drop("reason"), completed_at, engine)
    return clean.select(*df.columns, "redaction_receipt"), rejected.select(*df.columns, "reason")


def mark_sanitized(
    df: DataFrame, completed_at: str = "", engine: str = ENGINE, limit: int = MAX_OBSERVATION_BYTES
) -> DataFrame:
    """All rows of ``sanitize`` in one pass, with ``redaction_receipt`` and ``reason``.

    Clean rows are redacted and have a null reason; rejected rows stay as they came and have no receipt. Each rule stands once in the
    plan: write the table once, by outcome (``exports.write_by_outcome``), when both kinds of rows are wanted.
    """
    out = _redacted(_gated(df, limit), completed_at, engine, F.col("reason").isNull())
    return out.select(*df.columns, "redaction_receipt", "reason")


def _gated(df: DataFrame, limit: int) -> DataFrame:
    """The rows with ``reason``, null when they pass, and the digest of what came in."""
    gate = F.when(F.octet_length("_in_json") > limit, F.lit("oversized_payload")).otherwise(
        F.coalesce(identity_reason(), key_reason())
    )
    return pin(
        pin(df, {"_in_json": observation_json()}),
        {"reason": gate, "_in_digest": canonical_digest(F.col("_in_json"))}, drop=("_in_json",),
    )


def _redacted(marked: DataFrame, completed_at: str, engine: str, passed: Column | None = None) -> DataFrame:
    """Free text redacted and a receipt added, for the rows that have ``passed`` (all by default)."""
    no_text = F.array().cast("array<string>")
    texts = F.flatten(F.transform(
        F.coalesce("advisory_signals", F.array().cast(f"array<{SIGNAL}>")),
        lambda s: F.array(*[s[k] for k in SIGNAL_TEXTS]),
    ))
    leaves = F.concat(
        F.array("excerpt", "title", "author"),
        F.coalesce(F.map_values("evidence_metadata"), no_text), F.coalesce(F.map_values("metadata"), no_text), texts,
    )
    def where(value: Column, otherwise: Column | None = None) -> Column:
        return value if passed is None else F.when(passed, value) if otherwise is None else F.when(passed, value).otherwise(otherwise)

    cleaned = pin(marked, {"_r": where(each_once(leaves, S.redact_with_findings))})
    n_evidence = F.greatest(F.size("evidence_metadata"), F.lit(0))
    n_meta = F.greatest(F.size("metadata"), F.lit(0))
    first_signal = F.lit(3) + n_evidence + n_meta

    def remap(original: str, start: Column, size: Column) -> Column:
        # ``slice`` counts from one.
        return F.map_from_arrays(
            F.map_keys(original), F.transform(F.slice("_r", start + 1, size), lambda r: r["text"])
        )

    signals = F.when(
        F.col("advisory_signals").isNotNull(),
        F.transform(
            "advisory_signals",
            lambda s, i: F.struct(
                *[
                    F.get("_r", first_signal + i * len(SIGNAL_TEXTS) + pos)["text"].alias(k)
                    for pos, k in enumerate(SIGNAL_TEXTS)
                ],
                s["schema_version"].alias("schema_version"),
            ),
        ),
    )

    def total(name: str) -> Column:
        # Sources with signals carry them in both metadata objects, so their leaves count twice.
        twice = F.size("_r") - first_signal
        rows = F.concat(F.col("_r"), F.slice("_r", first_signal + 1, twice))
        return F.aggregate(rows, F.lit(0), lambda acc, x: acc + x[name])

    values = {
        "excerpt": F.get("_r", F.lit(0))["text"], "title": F.get("_r", F.lit(1))["text"],
        "author": F.get("_r", F.lit(2))["text"],
        "evidence_metadata": remap("evidence_metadata", F.lit(3), n_evidence),
        "metadata": remap("metadata", F.lit(3) + n_evidence, n_meta),
        "advisory_signals": signals,
    }
    findings = findings_array(total("credential"), total("pii"), total("secret"))
    out = cleaned.withColumns({**{k: where(v, F.col(k)) for k, v in values.items()}, "_findings": where(findings)})
    receipt = receipt_struct(F.col("_in_digest"), canonical_digest(observation_json()), F.col("_findings"), completed_at, engine)
    return out.withColumn("redaction_receipt", where(receipt))


def receipt_struct(
    input_digest: Column, output_digest: Column, findings: Column, completed_at: str, engine: str = ENGINE
) -> Column:
    return F.struct(
        F.lit(1).alias("schema_version"), F.lit(engine).alias("engine"),
        F.lit(ENGINE_VERSION).alias("engine_version"), F.lit(RULESET_ID).alias("ruleset_id"),
        F.lit(RULESET_DIGEST).alias("ruleset_digest"), input_digest.alias("input_digest"),
        output_digest.alias("output_digest"), findings.alias("findings"),
        F.lit(True).alias("structural_fields_preserved"), F.lit(completed_at).alias("completed_at"),
    ).cast(RECEIPT)


def receipt_json(r: Column, with_time: bool = False) -> Column:
    found = F.transform(
        r["findings"],
        lambda f: json_object(
            {"category": json_string(f["category"]), "action": json_string(f["action"]),
             "count": f["count"].cast("string")}
        ),
    )
    fields = {k: json_string(r[k]) for k in (
        "engine", "engine_version", "ruleset_id", "ruleset_digest", "input_digest", "output_digest")}
    fields |= {
        "schema_version": r["schema_version"].cast("string"), "findings": json_array(found),
        "structural_fields_preserved": r["structural_fields_preserved"].cast("string"),
    }
    if with_time:
        fields["completed_at"] = json_string(r["completed_at"])
    return json_object(fields)


def receipt_digest(r: Column) -> Column:
    """Identity of a receipt: every field except the completion time."""
    return canonical_digest(receipt_json(r))


def screened_receipt(emission_json: Column, completed_at: str = "", engine: str = SCREEN_ENGINE) -> Column:
    """Zero-finding receipt of an emission that is already clean: one digest used twice."""
    return let(
        canonical_digest(emission_json),
        lambda d: receipt_struct(d, d, F.array().cast(f"array<{FINDING}>"), completed_at, engine),
    )


# --- receipt audit --------------------------------------------------------------------------------

DIGEST_PATTERN = r"\Asha256:[0-9a-f]{64}\z"  # fixed value
RFC3339_PATTERN = (  # fixed value
    r"(?U)\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})\z"
)
# Vocabularies of a receipt.
CATEGORIES = ["credential", "pii", "secret"]
ACTIONS = ["removed", "tokenized"]
RECEIPT_KEYS = [
    "completed_at", "engine", "engine_version", "findings", "input_digest", "output_digest", "ruleset_digest",
    "ruleset_id", "schema_version", "structural_fields_preserved",
]
FINDING_KEYS = ["action", "category", "count"]


def _keys(v: Column, path: str = "$") -> Column:
    return F.array_sort(F.map_keys(F.try_variant_get(v, path, "map<string,variant>")))


def receipt_reason(v: Column) -> Column:
    """First reason why a receipt (VARIANT) is malformed; null when it is well formed."""
    findings = V.array(v, "$.findings")
    keys = F.array(*map(F.lit, RECEIPT_KEYS))

    def any_finding(bad) -> Column:
        return F.exists(findings, bad)

    def object_ok(f: Column) -> Column:
        return F.coalesce(
            V.is_object(f) & (_keys(f) == F.array(*map(F.lit, FINDING_KEYS))), F.lit(False))

    reason = (
        F.when(~V.is_object(v), F.lit("redaction_receipt_required"))
        .when(F.coalesce(_keys(v) != keys, F.lit(True)), F.lit("redaction_receipt_incomplete"))
        .when(~F.try_variant_get(v, "$.schema_version", "double").eqNullSafe(F.lit(1.0)),
              F.lit("redaction_receipt_version"))
        .when(
            ~((V.kind(v, "$.structural_fields_preserved") == "BOOLEAN")
              & F.try_variant_get(v, "$.structural_fields_preserved", "boolean")),
            F.lit("structural_fields_not_preserved"),
        )
    )
    for key in ("engine", "engine_version", "ruleset_id"):
        reason = reason.when(V.stripped(v, f"$.{key}") == "", F.lit(f"invalid_{key}"))
    for key in ("ruleset_digest", "input_digest", "output_digest"):
        reason = reason.when(~V.text(v, f"$.{key}").rlike(DIGEST_PATTERN), F.lit(f"invalid_{key}"))
    return (
        reason.when(~F.coalesce(V.kind(v, "$.findings").startswith("ARRAY"), F.lit(False)),
                    F.lit("redaction_findings_invalid"))
        .when(any_finding(lambda f: ~object_ok(f)), F.lit("redaction_finding_shape"))
        .when(any_finding(lambda f: ~V.text(f, "$.category").isin(*CATEGORIES)), F.lit("redaction_finding_category"))
        .when(any_finding(lambda f: ~V.text(f, "$.action").isin(*ACTIONS)), F.lit("redaction_finding_action"))
        .when(any_finding(lambda f: F.coalesce(V.integer(f, "$.count"), F.lit(0)) <= 0),
              F.lit("redaction_finding_count"))
        .when(~V.text(v, "$.completed_at").rlike(RFC3339_PATTERN), F.lit("invalid_completed_at"))
    )


def audit_receipts(df: DataFrame, col: str = "redaction_receipt") -> DataFrame:
    """Add ``reason`` (null = well formed) for a receipt column: VARIANT, JSON text or struct."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.VariantType):
        v = F.col(col)
    elif isinstance(kind, T.StringType):
        v = F.try_parse_json(F.col(col))
    else:
        v = F.try_parse_json(F.to_json(F.col(col)))
    return df.withColumn("_rv", v).withColumn("reason", receipt_reason(F.col("_rv"))).drop("_rv")


def findings_summary(df: DataFrame, source: str = "source_id") -> DataFrame:
    """Counts by source and category, with subtotals (rollup); partial sums run map-side."""
    src = F.col(source) if source in df.columns else F.col("source_ref.source_id").alias(source)
    rows = df.select(src, F.explode("redaction_receipt.findings").alias("f"))
    return rows.rollup(source, F.col("f.category").alias("category")).agg(F.sum("f.count").alias("findings"))
