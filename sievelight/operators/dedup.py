"""Delivery ids, admission filters and replay dedup (batch). See ``streaming.dedup`` for streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.functions import variant as V
from sievelight.functions.text import first_text
from sievelight.operators.observe import admitted_issue_event, admitted_linear_event
from sievelight.operators.skew import HOT_ROWS, attach_per_key
from sievelight.operators.verify import header
from sievelight.session import cut_lineage

TTL_SECONDS = 86_400  # fixed value
MAX_FOLD = 10_000  # distinct instants of one id folded inside a row; beyond it the rounds take over
MAX_BROADCAST_IDS = 200_000  # more hot ids than this are joined by a shuffle instead


def delivery_id(provider: str) -> Column:
    """Header, body field, then a digest of the body, by the provider's rule; ``''`` = no id."""
    v, digest = F.col("payload_v"), F.sha2(F.col("body"), 256)

    def h(name: str) -> Column:
        return F.coalesce(header(name), F.lit(""))

    rules = {
        "github": lambda: first_text(h("X-GitHub-Delivery"), digest),
        "github_issues": lambda: first_text(h("X-GitHub-Delivery"), digest),
        "gitlab": lambda: first_text(h("X-Gitlab-Event-UUID"), digest),
        "jira": lambda: first_text(h("X-Atlassian-Webhook-Identifier"), V.loose(v, "$.issue.id"), digest),
        "notion": lambda: first_text(V.loose(v, "$.id"), digest),
        "sentry": lambda: first_text(
            h("Request-ID"), V.loose(v, "$.data.issue.id"), digest),
        "zendesk": lambda: first_text(V.stripped(v, "$.id"), V.stripped(v, "$.detail.id"), digest),
        "pagerduty": lambda: first_text(V.loose(v, "$.event.id"), digest),
        "slack": lambda: V.loose(v, "$.event_id"),
        "linear": lambda: V.loose(v, "$.webhookId"),
        "fathom": lambda: h("webhook-id"),
    }
    return rules[provider]()


# Providers whose id-less deliveries are dropped when dedup is on (fixed values).
DROP_WITHOUT_ID = ("linear", "fathom")


def with_delivery_id(df: DataFrame, provider: str) -> DataFrame:
    out = df.withColumn("source", F.lit(provider)).withColumn("delivery_id", delivery_id(provider))
    return out.where("delivery_id <> ''") if provider in DROP_WITHOUT_ID else out


def is_admitted(provider: str) -> Column:
    """The event-type gate of a provider; never null."""
    v = F.col("payload_v")
    if provider == "github_issues":
        gate = admitted_issue_event(F.col("event_name"), V.text(v, "$.action"))
    elif provider == "linear":
        gate = admitted_linear_event(v)
    elif provider == "slack":
        gate = V.is_object(v) & (V.text(v, "$.type") != "url_verification")
    elif provider == "github":
        gate = V.is_object(v, "$.pull_request")
    elif provider == "gitlab":
        gate = V.text(v, "$.object_kind").isin("merge_request", "issue")
    else:
        gate = V.is_object(v)
    return F.coalesce(gate, F.lit(False))


def admit_events(df: DataFrame, provider: str) -> DataFrame:
    """Event-type gates that run before the payload job."""
    return df.where(is_admitted(provider))


def refused_events(df: DataFrame, provider: str) -> DataFrame:
    """The rows that ``admit_events`` leaves out."""
    return df.where(~is_admitted(provider))


def _split_ids(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an id, and rows without one (those are never duplicates)."""
    return df.where(F.coalesce(F.col(id_col), F.lit("")) != ""), df.where(F.coalesce(F.col(id_col), F.lit("")) == "")


def dedup_deliveries(df: DataFrame, keys: list[str], order: list[str], id_col: str | None = None) -> DataFrame:
    """First delivery per key in ``order``.

    ``row_number() = 1`` is planned with a per-task group limit below the shuffle, so each task sends
    at most one row of an id, however often that id was replayed.
    """
    with_id, without = _split_ids(df, id_col or keys[-1])
    w = Window.partitionBy(*keys).orderBy(*order)
    first = with_id.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return first.unionByName(without)


def mark_duplicates(df: DataFrame, keys: list[str], order: list[str], hot_rows: int = HOT_ROWS, id_col: str | None = None) -> DataFrame:
    """All rows, with ``duplicate_delivery`` true for every copy after the first.

    Rows without an id are never duplicates. Of copies that tie in ``order`` one is the first: rows are
    numbered once, in a checkpoint. The first copy comes from a map-side aggregate; it is joined back
    with hot ids salted.
    """
    with_id, without = _split_ids(df, id_col or keys[-1])
    rows = cut_lineage(with_id.withColumn("_uid", F.monotonically_increasing_id()))
    place = F.struct(*order, "_uid")
    per_key = rows.groupBy(*keys).agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
    out = attach_per_key(rows, per_key, keys, "_n", [*order, "_uid"], hot_rows)
    marked = out.withColumn("duplicate_delivery", place != F.col("_first")).drop("_first", "_uid")
    return marked.unionByName(without.withColumn("duplicate_delivery", F.lit(False)))


def dedup_ttl(
    df: DataFrame, keys: list[str], ts: str, tiebreak: str, ttl: int = TTL_SECONDS,
    max_fold: int = MAX_FOLD, id_col: str | None = None,
) -> DataFrame:
    """Accepted deliveries: the first copy, then the first copy more than ``ttl`` seconds after the
    last accepted one. Replays do not extend the window. Rows without an id are all accepted, and of
    copies that tie in time and ``tiebreak`` one is.

    Rows are counted per id first, map-side. An id of at most ``max_fold`` rows is settled where its
    rows meet (``_ttl_light``); larger ones are listed and settled apart (``_ttl_heavy``), so that no task
    holds all copies of a hot id.
    """
    df, without = _split_ids(df, id_col or keys[-1])
    rows = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    step = ttl * 1_000_000
    heavy = cut_lineage(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > max_fold).select(*keys))
    n_heavy = heavy.count()
    if not n_heavy:
        return _ttl_light(rows, keys, tiebreak, step).drop("_t").unionByName(without)
    listed = F.broadcast(heavy) if n_heavy <= MAX_BROADCAST_IDS else heavy
    light = _ttl_light(rows.join(listed, keys, "left_anti"), keys, tiebreak, step)
    hot = _ttl_heavy(rows.join(listed, keys, "left_semi"), keys, tiebreak, step, max_fold)
    return light.unionByName(hot).drop("_t").unionByName(without)


def _fold(instants: Column, step: int) -> Column:
    """The accepted ones of a sorted array of instants."""
    return F.aggregate(
        instants, F.array().cast("array<bigint>"),
        lambda acc, t: F.when(
            (F.size(acc) == 0) | (t - F.element_at(acc, -1) > step), F.concat(acc, F.array(t))
        ).otherwise(acc),
    )


def _one_per_instant(rows: DataFrame, keys: list[str], tiebreak: str) -> DataFrame:
    """The first row of each id and instant by ``tiebreak``; the rank filter sends one row of a key and task."""
    first = Window.partitionBy(*keys, "_t").orderBy(F.col(tiebreak).asc_nulls_last())
    return rows.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def _ttl_light(rows: DataFrame, keys: list[str], tiebreak: str, step: int) -> DataFrame:
    """Ids of few rows: their instants are folded in one row per id, and meet the rows by id.

    Instants and rows are shuffled once each; join, rank and fold all use the partitions of the id.
    """
    folded = rows.select(*keys, "_t").repartition(*keys).groupBy(*keys).agg(
        _fold(F.array_sort(F.collect_list("_t")), step).alias("_accepted"))
    met = rows.join(folded, keys).where(F.array_contains("_accepted", F.col("_t"))).drop("_accepted")
    return _one_per_instant(met, keys, tiebreak)


def _ttl_heavy(rows: DataFrame, keys: list[str], tiebreak: str, step: int, max_fold: int) -> DataFrame:
    """Ids of many rows. Copies are first reduced map-side to distinct instants per id.

    An id whose instants all lie within one ``step`` needs nothing but its minimum. Other ids fold their sorted
    instants inside one row while there are at most ``max_fold`` of them; ids beyond that advance
    together, one accepted copy per round, each round being a distributed minimum over their
    remaining instants (at most time span / step rounds).
    """
    instants = rows.select(*keys, "_t").distinct()
    spans = instants.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi")
    )
    spans = cut_lineage(spans)
    simple = spans.where(F.col("_hi") - F.col("_lo") <= step).select(*keys, F.col("_lo").alias("_t"))
    long = spans.where(F.col("_hi") - F.col("_lo") > step)
    fold_keys = long.where(F.col("_n") <= max_fold).select(*keys)
    hot_keys = long.where(F.col("_n") > max_fold).select(*keys, F.col("_lo").alias("_t"))

    folded = (
        instants.join(fold_keys, keys, "left_semi").groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_t")).alias("_ts"))
        .select(*keys, F.explode(_fold(F.col("_ts"), step)).alias("_t"))
    )
    accepted = simple.unionByName(folded)
    n_hot = hot_keys.count()
    if n_hot:
        small = F.broadcast if n_hot <= MAX_BROADCAST_IDS else (lambda side: side)
        accepted = accepted.unionByName(_ttl_rounds(instants, hot_keys, keys, step, small))
    # Ranked before they are joined: a task sends one copy of an instant, however many there are.
    return _one_per_instant(rows, keys, tiebreak).join(accepted, [*keys, "_t"], "left_semi")


def _ttl_rounds(instants: DataFrame, start: DataFrame, keys: list[str], step: int, small) -> DataFrame:
    """Advance all hot ids by one accepted instant per round.

    ``small`` marks a side with one row per hot id for broadcast when their number was checked.
    """
    rest = cut_lineage(instants.join(small(start.select(*keys)), keys, "left_semi").select(*keys, "_t"))
    frontier = cut_lineage(start)
    accepted = frontier
    rounds = 0
    while True:
        ahead = frontier.withColumnRenamed("_t", "_f")
        frontier = cut_lineage(
            rest.join(small(ahead), keys).where(F.col("_t") > F.col("_f") + step)
            .groupBy(*keys).agg(F.min("_t").alias("_t"))
        )
        if frontier.isEmpty():
            return accepted
        accepted = accepted.unionByName(frontier)
        rounds += 1
        if rounds % 20 == 0:
            accepted = cut_lineage(accepted)
