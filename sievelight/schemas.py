"""Table shapes shared by the batch and streaming jobs, and the observation row builder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SOURCE_REF = "struct<source_id:string,ref:string,url:string,kind:string>"
SIGNAL = (
    "struct<code:string,scope:string,basis:string,confidence:string,"
    "recommended_effect:string,explanation:string,schema_version:string>"
)
EVIDENCE = (
    f"struct<source_ref:{SOURCE_REF},excerpt:string,author:string,timestamp:string,"
    "evidence_id:string,metadata:map<string,string>>"
)
ADVISORY = "struct<kind:string,message:string,evidence_ids:array<string>,metadata:map<string,string>>"
HINT = "struct<role:string,reason:string,priority:string>"
PROVENANCE = (
    "struct<delivery_mode:string,verification:string,provider_event_id:string,provider_resource_id:string>"
)
FINDING = "struct<category:string,action:string,count:int>"
RECEIPT = (
    "struct<schema_version:int,engine:string,engine_version:string,ruleset_id:string,"
    f"ruleset_digest:string,input_digest:string,output_digest:string,findings:array<{FINDING}>,"
    "structural_fields_preserved:boolean,completed_at:string>"
)
OUTPUT = (
    "struct<mod_id:string,output_type:string,kind:string,message:string,evidence_ids:array<string>,"
    "metadata:map<string,string>,role:string,reason:string,priority:string>"
)
DELIVERIES = "headers map<string,string>, body binary, received_at timestamp"

OBSERVATION_FIELDS = [
    "source_ref", "excerpt", "mode", "title", "author", "timestamp", "provider_event_id",
    "provider_resource_id", "evidence_id", "evidence_metadata", "metadata", "advisory_signals",
]


def string_map(values: dict[str, Column] | None = None) -> Column:
    if not values:
        return F.lit(None).cast("map<string,string>") if values is None else empty_map()
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])


def empty_map() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def observation_columns(
    source_id: str,
    ref: Column,
    kind: Column | str,
    excerpt: Column,
    mode: Column | str,
    url: Column | None = None,
    title: Column | None = None,
    author: Column | None = None,
    timestamp: Column | None = None,
    provider_event_id: Column | None = None,
    provider_resource_id: Column | None = None,
    evidence_id: Column | None = None,
    metadata: dict[str, Column] | None = None,
    evidence_metadata: dict[str, Column] | None = None,
    advisory_signals: Column | None = None,
) -> list[Column]:
    empty = F.lit("")

    def lit(x: Column | str) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return [
        F.struct(
            F.lit(source_id).alias("source_id"),
            ref.alias("ref"),
            (empty if url is None else url).alias("url"),
            lit(kind).alias("kind"),
        ).alias("source_ref"),
        excerpt.alias("excerpt"),
        lit(mode).alias("mode"),
        (empty if title is None else title).alias("title"),
        (empty if author is None else author).alias("author"),
        (empty if timestamp is None else timestamp).alias("timestamp"),
        (empty if provider_event_id is None else provider_event_id).alias("provider_event_id"),
        (empty if provider_resource_id is None else provider_resource_id).alias("provider_resource_id"),
        (empty if evidence_id is None else evidence_id).alias("evidence_id"),
        string_map(evidence_metadata or {}).alias("evidence_metadata"),
        string_map(metadata or {}).alias("metadata"),
        (F.lit(None) if advisory_signals is None else advisory_signals)
        .cast(f"array<{SIGNAL}>")
        .alias("advisory_signals"),
    ]


def carried(df: DataFrame, *drop: str) -> list[Column]:
    """Key columns that travel along with the rows (everything but the payload itself)."""
    hidden = {"payload", "payload_v", "body", "headers", *OBSERVATION_FIELDS, *drop}
    return [F.col(c) for c in df.columns if c not in hidden]
