"""URL routing, declared filters and quotas over observation-shaped tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values: (exact host, host suffix) per source.
SOURCE_HOSTS = {
    "github": ("github.com", ".github.com"),
    "gitlab": ("gitlab.com", ".gitlab.com"),
    "confluence": (None, ".atlassian.net"),
}
DOCUMENT_URL = (  # fixed value
    r"\Ahttps?://(?:docs\.google\.com/document/d/|drive\.google\.com/file/d/)"
    r"([A-Za-z0-9_-]{25,128})(?:[/?#].*)?\n?\z"
)


def url_host(col: Column) -> Column:
    return F.lower(F.try_parse_url(col, F.lit("HOST")))


def document_id(col: Column) -> Column:
    """Document id of a docs or drive URL; null when the URL has another shape."""
    from sievelight.functions.text import strip

    return F.nullif(F.regexp_extract(strip(col), DOCUMENT_URL, 1), F.lit(""))


def matches_source(host: Column, source: str) -> Column:
    """Exact host or host suffix; never a substring of the URL."""
    exact, suffix = SOURCE_HOSTS[source]
    found = host.endswith(suffix)
    return F.coalesce(found | (host == exact) if exact else found, F.lit(False))


def route_by_url(df: DataFrame, url_col: str) -> DataFrame:
    """Add ``url_host``, ``document_id`` and ``route`` (null when no source claims the URL)."""
    host = url_host(F.col(url_col))
    route = F.when(document_id(F.col(url_col)).isNotNull(), F.lit("google_drive"))
    for source in SOURCE_HOSTS:
        route = route.when(matches_source(F.col("url_host"), source), F.lit(source))
    return df.withColumn("url_host", host).withColumns(
        {"document_id": document_id(F.col(url_col)), "route": route}
    )


@dataclass(frozen=True)
class FilterSpec:
    include_keywords: list[str] = field(default_factory=list)
    exclude_keywords: list[str] = field(default_factory=list)
    include_authors: list[str] = field(default_factory=list)
    exclude_authors: list[str] = field(default_factory=list)
    after: str | None = None
    before: str | None = None


@dataclass(frozen=True)
class QuotaSpec:
    max_items_per_pull: int | None = None
    max_payload_bytes: int | None = None


def apply_filters(
    df: DataFrame, spec: FilterSpec, text: str = "excerpt", author: str = "author", timestamp: str = "timestamp"
) -> DataFrame:
    """Plain predicates, so author and time bounds reach the scan."""
    conds: list[Column] = []
    low = F.lower(F.col(text))
    if spec.after is not None:
        conds.append(F.col(timestamp) >= F.lit(spec.after))
    if spec.before is not None:
        conds.append(F.col(timestamp) < F.lit(spec.before))
    if spec.include_authors:
        conds.append(F.col(author).isin(*spec.include_authors))
    if spec.exclude_authors:
        conds.append(~F.col(author).isin(*spec.exclude_authors))
    if spec.include_keywords:
        conds.append(reduce(or_, [F.contains(low, F.lit(k.lower())) for k in spec.include_keywords]))
    if spec.exclude_keywords:
        conds.append(~reduce(or_, [F.contains(low, F.lit(k.lower())) for k in spec.exclude_keywords]))
    return df.where(reduce(and_, conds)) if conds else df


def apply_quota(
    df: DataFrame, spec: QuotaSpec, source: str, order: list[str], payload: str | None = None, salts: int = 64
) -> DataFrame:
    """At most ``max_items_per_pull`` rows per source, in the given order; payloads within the byte cap.

    Ranking runs first inside a hash slice of each source, then over the slices' winners, so a
    source with a third of all rows never sorts in one task.
    """
    if spec.max_payload_bytes is not None and payload is not None:
        df = df.where(F.octet_length(F.col(payload)) <= spec.max_payload_bytes)
    if spec.max_items_per_pull is None:
        return df
    n = spec.max_items_per_pull
    cols = df.columns
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salts)))
    inner = Window.partitionBy(source, "_slice").orderBy(*order)
    outer = Window.partitionBy(source).orderBy(*order)
    best = sliced.withColumn("_rn", F.row_number().over(inner)).where(F.col("_rn") <= n)
    return best.withColumn("_rn", F.row_number().over(outer)).where(F.col("_rn") <= n).select(*cols)
