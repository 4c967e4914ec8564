"""Landed response pages: unwrap, run-level gates, caps and continuation checks.

A page row is ``run_id, provider, page_no (1-based), url, status, body``; ``body`` is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.functions import variant as V
from sievelight.functions.text import pin
from sievelight.sources.landing import parsed

# Where the items of a provider's page sit ("$" = the page itself is the list), and
# for wrapped items the path inside each element.
ITEM_PATHS = {
    "anthropic_admin": ("$.data", None), "openai_admin": ("$.data", None), "cursor": ("$.data", None),
    "devin": ("$.items", None), "copilot": ("$", None), "granola": ("$.notes", None),
    "servicenow": ("$.result", None), "mcp_registry": ("$.servers", "$.server"),
}
# Token pagers as (query parameter, token path, has-more path or None).
TOKEN_PAGERS = {
    "anthropic_admin": ("page", "$.next_page", "$.has_more"),
    "openai_admin": ("after", "$.last_id", "$.has_more"),
    "devin": ("after", "$.end_cursor", "$.has_next_page"),
    "granola": ("cursor", "$.cursor", "$.hasMore"),
    "mcp_registry": ("cursor", "$.metadata.nextCursor", None),
}
# Run caps.
MAX_PAGES, MAX_ITEMS, MAX_RUN_BYTES, MAX_PAGE_BYTES = 100, 50_000, 64 * 1_048_576, 8 * 1_048_576


def with_page(pages: DataFrame) -> DataFrame:
    """The pages with ``page_v``, parsed once a row: a filter on it would parse the body again for each of its uses."""
    return pin(parsed(pages, "body", "page_v"), {"page_v": F.col("page_v")})


def _by_provider(make) -> Column:
    out = None
    for name in ITEM_PATHS:
        cond = F.col("provider") == name
        out = F.when(cond, make(name)) if out is None else out.when(cond, make(name))
    return out


def item_array(v: Column) -> Column:
    """The page's items by provider; an absent list is empty."""

    def items(name: str) -> Column:
        path, inner = ITEM_PATHS[name]
        arr = V.array(v, path)
        if inner:
            return F.transform(V.objects(v, path), lambda e: V.sub(e, inner))
        return arr

    return _by_provider(items)


def _items_bad(v: Column) -> Column:
    """A present value that is no list fails the run (a bare-list provider reads it as empty)."""

    def bad(name: str) -> Column:
        path, _ = ITEM_PATHS[name]
        if path == "$":
            return F.lit(False)
        return V.kind(v, path).isNotNull() & ~F.coalesce(V.kind(v, path).startswith("ARRAY"), F.lit(False))

    return _by_provider(bad)


def page_failure(v: Column) -> Column:
    """Reason why a page fails its run; null when the page is fine."""
    kind = F.schema_of_variant(v)
    return (
        F.when(F.col("status") != 200, F.lit("unexpected_status_expected_200"))
        .when(v.isNull(), F.lit("unparseable_body"))
        .when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), F.lit("non_object_body"))
        .when(_items_bad(v), F.lit("items_not_a_list"))
    )


def gate_runs(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages of clean runs, rejected runs with the first failure). One bad page rejects its run.

    The reject list is aggregated map-side to one row per run before it is joined.
    """
    df = with_page(pages).withColumn("_why", page_failure(F.col("page_v")))
    rejected = (
        df.where("_why IS NOT NULL").groupBy("run_id")
        .agg(F.min_by("_why", "page_no").alias("reason"), F.min("page_no").alias("page_no"))
    )
    return df.drop("_why").join(rejected.select("run_id"), "run_id", "left_anti"), rejected


def unwrap_pages(pages: DataFrame) -> DataFrame:
    """One row per item: ``run_id, provider, page_no, item_no, payload_v``."""
    df = pages if "page_v" in pages.columns else with_page(pages)
    return df.select(
        "run_id", "provider", "page_no", F.posexplode(item_array(F.col("page_v"))).alias("item_no", "payload_v")
    )


def audit_run_caps(pages: DataFrame, items: str = "n_items", size: str = "n_bytes", order: str = "page_no",
                   run: str = "run_id", max_pages: int = MAX_PAGES, max_items: int = MAX_ITEMS,
                   max_bytes: int = MAX_RUN_BYTES, max_page_bytes: int = MAX_PAGE_BYTES) -> DataFrame:
    """First breach per run, in the order of its landed pages: ``run_id, page_no, reason``.

    Pages are counted as they landed: numbers may have gaps, start anywhere, or repeat. Landed page
    ``max_pages + 1`` is a breach whatever it holds, so only that many pages of a run are looked at; the
    rank filter limits them per task before the shuffle.
    """
    by = [F.col(order), F.col(size), F.col(items)]
    ranked = pages.select(run, order, items, size, F.row_number().over(Window.partitionBy(run).orderBy(*by)).alias("_rank"))
    w = Window.partitionBy(run).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    df = ranked.where(F.col("_rank") <= max_pages + 1).withColumns(
        {"_bytes": F.sum(size).over(w), "_items": F.sum(items).over(w)})
    reason = (
        F.when(F.col("_rank") > max_pages, F.lit("max_pages_exceeded"))
        .when(F.col(size) > max_page_bytes, F.lit("oversized_body"))
        .when(F.col("_bytes") > max_bytes, F.lit("aggregate_bytes_exceeded"))
        .when(F.col("_items") > max_items, F.lit("aggregate_items_exceeded"))
    )
    return (
        df.withColumn("_why", reason).where("_why IS NOT NULL").groupBy(run)
        .agg(F.min_by(order, "_rank").alias(order), F.min_by("_why", "_rank").alias("reason"))
    )


def query_param(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def next_token(v: Column, token_path: str, more_path: str | None) -> Column:
    """The token the page asks to follow; null when the run ends here."""
    token = F.nullif(V.text(v, token_path), F.lit(""))
    if more_path is None:
        return token
    return F.when(V.loose(v, more_path) != "", token)


def check_page_chain(
    pages: DataFrame, kind: str, param: str, token_path: str = "$.next_page", more_path: str | None = "$.has_more",
    limit: int = 100, start: int = 0, items: str = "n_items",
) -> DataFrame:
    """Compare each page's continuation with the next landed page: ``run_id, page_no, problem``.

    ``kind`` is ``token``, ``offset`` or ``page``. The successor is found by an equi join on
    (run, page number), so a run of any length spreads over all tasks.
    """
    if kind == "token":
        df = with_page(pages)
        expected = next_token(F.col("page_v"), token_path, more_path)
        given = F.col("next_given")
        df = df.withColumn("expected", expected)
    else:
        step = limit if kind == "offset" else 1
        here = F.coalesce(F.expr(f"try_cast({_sql_param('url', param)} AS BIGINT)"), F.lit(start))
        df = pages.withColumn(
            "expected", F.when(F.col(items) >= limit, (here + step).cast("string"))
        )
        given = F.col("next_given")
    follow = pages.select(
        "run_id", (F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("has_next"),
        F.url_decode(query_param(F.col("url"), param)).alias("next_given") if kind == "token"
        else query_param(F.col("url"), param).alias("next_given"),
    )
    joined = df.select("run_id", "page_no", "expected").join(follow, ["run_id", "page_no"], "left")
    problem = (
        F.when(F.col("expected").rlike(r"[\x00-\x1f\x7f]"), F.lit("control_characters"))
        .when(F.col("expected").isNull() & F.col("has_next"), F.lit("page_after_end"))
        .when(F.col("expected").isNotNull() & F.col("has_next").isNull(), F.lit("missing_page"))
        .when(F.col("expected").isNotNull() & ~F.col("expected").eqNullSafe(given), F.lit("wrong_continuation"))
    )
    return joined.withColumn("problem", problem).where("problem IS NOT NULL").select("run_id", "page_no", "problem")


def _sql_param(url: str, name: str) -> str:
    return f"try_parse_url({url}, 'QUERY', '{name}')"


def graphql_failure(v: Column, nodes_path: str) -> Column:
    """Reason why a query response fails its run; null when fine."""
    limited = F.exists(V.objects(v, "$.errors"), lambda e: V.text(e, "$.code") == "RATELIMITED")
    oversized = F.octet_length("body") > MAX_PAGE_BYTES
    return (
        F.when((F.col("status") == 400) & ~oversized & V.is_object(v) & limited, F.lit("rate_limited"))
        .when(F.col("status") != 200, F.lit("http_error"))
        .when(oversized, F.lit("oversized_body"))
        .when(v.isNull(), F.lit("unparseable_body"))
        .when(~V.is_object(v), F.lit("non_object_body"))
        .when(V.loose(v, "$.errors") != "", F.lit("graphql_errors"))
        .when(~V.is_object(v, "$.data"), F.lit("missing_data"))
        .when(~F.coalesce(V.kind(v, nodes_path).startswith("ARRAY"), F.lit(False)), F.lit("nodes_not_a_list"))
    )


def unwrap_graphql(pages: DataFrame, nodes_path: str) -> tuple[DataFrame, DataFrame]:
    """(one row per object node of clean runs, rejected runs with the first failure)."""
    df = with_page(pages).withColumn("_why", graphql_failure(F.col("page_v"), nodes_path))
    rejected = (
        df.where("_why IS NOT NULL").groupBy("run_id")
        .agg(F.min_by("_why", "page_no").alias("reason"), F.min("page_no").alias("page_no"))
    )
    nodes = df.join(rejected.select("run_id"), "run_id", "left_anti").select(
        "run_id", "page_no", F.posexplode(V.objects(F.col("page_v"), nodes_path)).alias("item_no", "payload_v")
    )
    return nodes, rejected


def relay_cursor(v: Column, info_path: str) -> Column:
    """The end cursor to follow: only when ``hasNextPage`` is the boolean true."""
    more = V.kind(v, f"{info_path}.hasNextPage") == "BOOLEAN"
    more = more & (F.try_variant_get(v, f"{info_path}.hasNextPage", "boolean"))
    return F.when(more, F.nullif(V.text(v, f"{info_path}.endCursor"), F.lit("")))


def check_relay_chain(cursors: DataFrame) -> DataFrame:
    """First repeated end cursor per run (``run_id, page_no, end_cursor``): ``circular_cursor``.

    The second page of a (run, cursor) is its first repeat; the rank filter sends at most the first two
    pages of a cursor and task. The pages are read once.
    """
    w = Window.partitionBy("run_id", "end_cursor").orderBy("page_no")
    ranked = cursors.where(F.col("end_cursor").isNotNull()).select("run_id", "end_cursor", "page_no", F.dense_rank().over(w).alias("_rank"))
    return (
        ranked.where("_rank = 2").groupBy("run_id").agg(F.min("page_no").alias("page_no"))
        .withColumn("problem", F.lit("circular_cursor"))
    )
