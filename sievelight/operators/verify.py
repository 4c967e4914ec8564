"""Signature checks over a delivery table (``headers, body, received_at``). Everything fails closed.

Keys become plan literals (see ``hmac_sha256_hex``). Time windows compare with ``received_at``, never
with the wall clock, so replaying a table or stream gives the same verdicts.
"""

from __future__ import annotations

import base64
import binascii

from pyspark.sql import Column, DataFrame, functions as F

from sievelight.functions import variant as V
from sievelight.functions.text import pin
from sievelight.functions.crypto import hmac_sha256_hex
from sievelight.functions.text import strip

TOLERANCE_S = 300  # fixed value
LINEAR_WINDOW_MS = 60_000  # fixed value


def header(name: str, headers: Column | None = None) -> Column:
    """First header whose name matches without regard to case; null when absent."""
    headers = F.col("headers") if headers is None else headers
    hits = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name.lower())
    return F.get(hits, F.lit(0))["value"]


def _present(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def _received_epoch() -> Column:
    return F.unix_micros(F.col("received_at").cast("timestamp")) / F.lit(1_000_000)


def _int_text(col: Column) -> Column:
    """Python-style integer text (blanks and a sign allowed) as bigint; null otherwise."""
    return F.when(strip(col).rlike(r"\A[+-]?[0-9]+\z"), strip(col).try_cast("bigint"))


def _fresh(ts: Column, tolerance: int = TOLERANCE_S) -> Column:
    return F.abs(_received_epoch() - ts) <= tolerance


def signature_prefix(sig: Column, required: bool) -> Column:
    """Cut ``sha256=``. A bare digest passes unless the prefix is required (then null)."""
    cut = F.substring(sig, F.lit(8), F.char_length(sig))
    has = F.lower(F.left(sig, F.lit(7))) == "sha256="
    return F.when(has, cut) if required else F.when(has, cut).otherwise(sig)


def verify_hmac_hex(sig: Column, body: Column, secret: str) -> Column:
    if not secret:
        return F.lit(False)
    return _present(sig) == hmac_sha256_hex(body, secret.encode())


def verify_hmac_multi(sig: Column, body: Column, secret: str) -> Column:
    """Comma-separated ``v1=<hex>`` list (key rotation); any match is accepted."""
    if not secret:
        return F.lit(False)
    wanted = F.concat(F.lit("v1="), hmac_sha256_hex(body, secret.encode()))
    return F.array_contains(F.transform(F.split(_present(sig), ","), strip), wanted)


def verify_standard(headers: Column, body: Column, secret: str) -> Column:
    """Base64 HMAC over ``id.ts.body`` with a ``whsec_`` key and a time window."""
    if not secret.startswith("whsec_"):
        return F.lit(False)
    try:
        key = base64.b64decode(secret[6:], validate=True)
    except (binascii.Error, ValueError):
        return F.lit(False)
    wid = _present(header("webhook-id", headers))
    ts = _int_text(_present(header("webhook-timestamp", headers)))
    dot = F.lit(b".")
    signed = F.concat(wid.cast("binary"), dot, ts.cast("string").cast("binary"), dot, body)
    expected = F.base64(F.unhex(hmac_sha256_hex(signed, key)))
    candidates = F.transform(
        F.split(_present(header("webhook-signature", headers)), " "),
        lambda p: F.regexp_extract(p, r"(?s)\A[^,]*,(.+)\z", 1),
    )
    return F.array_contains(candidates, expected) & _fresh(ts)


def verify_token(tok: Column, secret: str) -> Column:
    """Shared-token equality, compared as digests so the token itself stays out of the plan."""
    import hashlib

    if not secret:
        return F.lit(False)
    return F.sha2(_present(tok), 256) == F.lit(hashlib.sha256(secret.encode()).hexdigest())


def verify_slack(sig: Column, ts: Column, body: Column, secret: str) -> Column:
    """``v0=<hex>`` over ``v0:{ts}:{body}`` with the raw timestamp text, plus a time window."""
    if not secret:
        return F.lit(False)
    raw = _present(ts)
    signed = F.concat(F.lit(b"v0:"), raw.cast("binary"), F.lit(b":"), body)
    mac = F.concat(F.lit("v0="), hmac_sha256_hex(signed, secret.encode()))
    return (_present(sig) == mac) & _fresh(_int_text(raw))


def verify_zendesk(sig: Column, ts: Column, body: Column, secret: str) -> Column:
    """Base64 HMAC over ``ts + body``; no window."""
    if not secret:
        return F.lit(False)
    signed = F.concat(_present(ts).cast("binary"), body)
    return _present(sig) == F.base64(F.unhex(hmac_sha256_hex(signed, secret.encode())))


def verify_linear(sig: Column, body: Column, secret: str) -> Column:
    """Hex HMAC plus a 60 s window on the body's own millisecond timestamp."""
    v = F.try_parse_json(body.cast("string"))
    stamp = V.integer(v, "$.webhookTimestamp")
    stamp = F.coalesce(stamp, _int_text(V.text(v, "$.webhookTimestamp")))
    fresh = F.abs(_received_epoch() * 1000 - stamp) <= LINEAR_WINDOW_MS
    return verify_hmac_hex(sig, body, secret) & V.is_object(v) & fresh


def verified(provider: str, secret: str) -> Column:
    """Boolean column for one provider's rule; never null."""
    body = F.col("body")
    rules = {
        "github": lambda: verify_hmac_hex(
            signature_prefix(header("X-Hub-Signature-256"), False), body, secret),
        "github_issues": lambda: verify_hmac_hex(
            _strict_prefix(header("X-Hub-Signature-256")), body, secret),
        "jira": lambda: verify_hmac_hex(signature_prefix(header("X-Hub-Signature"), False), body, secret),
        "notion": lambda: verify_hmac_hex(signature_prefix(header("X-Notion-Signature"), True), body, secret),
        "sentry": lambda: verify_hmac_hex(header("Sentry-Hook-Signature"), body, secret),
        "linear": lambda: verify_linear(header("Linear-Signature"), body, secret),
        "pagerduty": lambda: verify_hmac_multi(header("X-PagerDuty-Signature"), body, secret),
        "gitlab": lambda: verify_token(header("X-Gitlab-Token"), secret),
        "slack": lambda: verify_slack(
            header("X-Slack-Signature"), header("X-Slack-Request-Timestamp"), body, secret),
        "zendesk": lambda: verify_zendesk(
            header("X-Zendesk-Webhook-Signature"), header("X-Zendesk-Webhook-Signature-Timestamp"), body, secret),
        "fathom": lambda: verify_standard(F.col("headers"), body, secret),
    }
    return F.coalesce(rules[provider](), F.lit(False))


def _strict_prefix(sig: Column) -> Column:
    """The issue-ingest path wants the lower-case prefix exactly."""
    return F.when(sig.startswith("sha256="), F.substring(sig, F.lit(8), F.char_length(sig)))


def mark_deliveries(df: DataFrame, provider: str, secret: str) -> DataFrame:
    """All rows with ``reason``: null, or ``signature_rejected``. The keyed hash is evaluated once per row."""
    return pin(df, {"reason": F.when(~verified(provider, secret), F.lit("signature_rejected"))})


def verify_deliveries(df: DataFrame, provider: str, secret: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows; the rejected carry a value-free reason.

    Each output evaluates the rule for itself. A job that needs both writes ``mark_deliveries`` once, by its reason.
    """
    marked = mark_deliveries(df, provider, secret)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")
