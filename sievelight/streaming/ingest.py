"""Signed deliveries to emissions and envelopes: one declarative plan for batch and stream.

Order: size cap, signature, parse, admission, delivery id, replay dedup, payload job, redaction,
emission, advisories, contract. Everything before the dedup is a filter or projection, so rejected
deliveries never reach the shuffle; ``delivery_rejects`` returns them with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievelight.functions.text import pin
from sievelight.operators.dedup import (
    DROP_WITHOUT_ID, admit_events, dedup_deliveries, delivery_id, is_admitted, mark_duplicates, refused_events, with_delivery_id)
from sievelight.operators.exports import to_envelopes
from sievelight.operators.normalize import normalize
from sievelight.operators.observe import OBSERVERS, observe_github_pr
from sievelight.operators.verify import header, verified, verify_deliveries
from sievelight.session import cut_lineage
from sievelight.sources.landing import body_payload, body_reason, cap_bodies
from sievelight.streaming.dedup import ACCEPTED, DUPLICATE, dedup_watermark, judge_replays


def deliveries_to_emissions(
    deliveries: DataFrame, provider: str, secret: str, completed_at: str = "", delay: str = "1 day"
) -> tuple[DataFrame, DataFrame]:
    """(emissions, rejects) for one provider's deliveries (``headers, body, received_at``).

    On a stream the dedup is the watermark form; on a table it is the first delivery per id.
    """
    accepted, _ = verify_deliveries(cap_bodies(deliveries), provider, secret)
    events = with_delivery_id(admit_events(_named(body_payload(accepted)), provider), provider)
    if events.isStreaming:
        fresh = dedup_watermark(events, ["source", "delivery_id"], "received_at", delay)
    else:
        fresh = dedup_deliveries(events, ["source", "delivery_id"], ["received_at"])
    rows = fresh.select("delivery_id", "received_at", "event_name", "payload_v")
    obs = observe_github_pr(rows, webhook=True) if provider == "github" else OBSERVERS[provider](rows)
    return normalize(obs.withColumn("provider_event_id", F.col("delivery_id")), completed_at=completed_at)


def _named(events: DataFrame) -> DataFrame:
    """The event's name, which some providers send as a header."""
    return events.withColumn("event_name", F.coalesce(header("X-GitHub-Event"), F.lit("")))


def delivery_rejects(deliveries: DataFrame, provider: str, secret: str) -> DataFrame:
    """Deliveries that never become events, with a value-free ``reason``; for batch and stream.

    Each row gets the first that holds: ``missing_body``, ``oversized_body``, ``signature_rejected``, ``unparseable_body``,
    ``not_admitted``, ``missing_delivery_id``. Bodies are not returned. Rejects after this (contract, identity) are the
    second output of ``deliveries_to_emissions``.
    """
    kept = deliveries.columns
    unread = deliveries.withColumn("reason", body_reason()).where("reason IS NOT NULL")
    good, unsigned = verify_deliveries(cap_bodies(deliveries), provider, secret)
    events = _named(body_payload(good))
    parsed = events.where("payload_v IS NOT NULL").withColumn("delivery_id", delivery_id(provider))
    parts = [unread, unsigned, events.where("payload_v IS NULL").withColumn("reason", F.lit("unparseable_body"))]
    if provider in DROP_WITHOUT_ID:
        parts.append(admit_events(parsed, provider).where("delivery_id = ''").withColumn("reason", F.lit("missing_delivery_id")))
    parts.append(refused_events(parsed, provider).withColumn("reason", F.lit("not_admitted")))
    out = None
    for part in parts:
        rows = part.select(*[c for c in kept if c != "body"], "reason")
        out = rows if out is None else out.unionByName(rows)
    return out


def judged_deliveries(
    deliveries: DataFrame, provider: str, secret: str, delay: str = "1 day", window_seconds: int = 86_400, id_of=delivery_id,
) -> DataFrame:
    """Every delivery once, with ``source, delivery_id, outcome``; for batch and stream.

    The outcome is ``accepted``, ``duplicate``, ``late`` (streams only), or a reason of ``delivery_rejects``; each rule is evaluated
    once per row, and accepted and rejected rows add up to all that landed. Write it partitioned by ``outcome``: accepted rows go
    on to ``accepted_emissions``, late ones to a backfill. A stream needs the RocksDB state store and an event time in ``received_at``.
    """
    read = pin(deliveries, {"_reason": F.coalesce(body_reason(), F.when(~verified(provider, secret), F.lit("signature_rejected")))})
    events = _named(body_payload(read)).withColumn("_id", F.when(F.col("payload_v").isNotNull(), id_of(provider)))
    missing = F.col("_id") == "" if provider in DROP_WITHOUT_ID else F.lit(False)
    reason = F.coalesce(
        F.col("_reason"), F.when(F.col("payload_v").isNull(), F.lit("unparseable_body")).when(~is_admitted(provider), F.lit("not_admitted"))
        .when(missing, F.lit("missing_delivery_id")))
    marked = pin(events, {"_why": reason, "source": F.lit(provider), "delivery_id": F.coalesce("_id", F.lit(""))},
                 drop=("payload", "payload_v", "event_name", "_reason", "_id"))
    if marked.isStreaming:
        judged = judge_replays(marked, ["source", "delivery_id"], "received_at", delay, window_seconds, F.col("_why").isNull(), F.crc32("body"))
    else:
        # Rows with a reason get no id here: they are never the first of their copies.
        fresh = cut_lineage(marked.withColumn("_key", F.when(F.col("_why").isNull(), F.col("delivery_id"))))
        judged = mark_duplicates(fresh, ["source", "_key"], ["received_at"]).withColumn(
            "outcome", F.when(F.col("duplicate_delivery"), F.lit(DUPLICATE)).otherwise(F.lit(ACCEPTED))).drop("duplicate_delivery", "_key")
    return judged.withColumn("outcome", F.coalesce("_why", "outcome")).drop("_why")


def accepted_emissions(judged: DataFrame, provider: str, completed_at: str = "") -> tuple[DataFrame, DataFrame]:
    """(emissions, rejects) of the accepted rows of ``judged_deliveries``."""
    rows = _named(body_payload(judged.where(F.col("outcome") == ACCEPTED))).select("delivery_id", "received_at", "event_name", "payload_v")
    obs = observe_github_pr(rows, webhook=True) if provider == "github" else OBSERVERS[provider](rows)
    return normalize(obs.withColumn("provider_event_id", F.col("delivery_id")), completed_at=completed_at)


def deliveries_to_envelopes(deliveries: DataFrame, provider: str, secret: str, completed_at: str = "") -> DataFrame:
    return to_envelopes(deliveries_to_emissions(deliveries, provider, secret, completed_at)[0])
