"""Digest and keyed-hash expressions built from ``sha2`` only, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BLOCK = 64


def hmac_sha256_hex(body: Column, key: bytes) -> Column:
    """HMAC-SHA256 of a binary (or string) column as lower-case hex.

    The two pads are literals made from the key. They are key material: like the key, they belong
    in a session that only trusted readers can inspect (plans show them).
    """
    import hashlib

    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in key))
    outer = F.lit(bytearray(b ^ 0x5C for b in key))
    body = body.cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, body), 256))), 256)


def sha256_tag(col: Column) -> Column:
    """``sha256:<hex>`` over the UTF-8 bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(col.cast("binary"), 256))
