"""Typed reads from a parsed JSON column (VARIANT).

``try_variant_get(v, path, 'string')`` turns numbers and objects into text, while the payload rules
treat a non-string as absent. These helpers look at the value's own type first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sievelight.functions.text import strip


def sub(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def kind(v: Column, path: str) -> Column:
    """SQL type name of the value at ``path``; null when absent."""
    return F.schema_of_variant(sub(v, path))


def is_object(v: Column, path: str = "$") -> Column:
    # The type name of an object spells out all that is in it; a cast to a struct without fields looks at the value alone.
    return F.try_variant_get(v, path, "struct<>").isNotNull()


def text(v: Column, path: str) -> Column:
    """The string at ``path``; ``''`` for anything else."""
    return F.when(kind(v, path) == "STRING", F.try_variant_get(v, path, "string")).otherwise(F.lit(""))


def stripped(v: Column, path: str) -> Column:
    return strip(text(v, path))


def loose(v: Column, path: str) -> Column:
    """Text of any truthy scalar: ``0``, ``false``, null, ``""`` give ``''``; ``true`` is ``True``.

    Lists and objects give their JSON text (``''`` when empty).
    """
    value = F.try_variant_get(v, path, "string")
    t = kind(v, path)
    return (
        F.when(t == "STRING", value)
        .when(t.isNull() | (t == "VOID"), F.lit(""))
        .when(t == "BOOLEAN", F.when(value == "true", F.lit("True")).otherwise(F.lit("")))
        .when(value.isin("0", "0.0", "-0.0", "[]", "{}"), F.lit(""))
        .otherwise(F.coalesce(value, F.lit("")))
    )


def scalar(v: Column, path: str) -> Column:
    """Like ``loose`` but keeps zero (used where a present value is printed as it is)."""
    value = F.try_variant_get(v, path, "string")
    t = kind(v, path)
    return (
        F.when(t.isin("STRING", "BIGINT"), F.coalesce(value, F.lit("")))
        .when(t.isNull() | (t == "VOID"), F.lit(""))
        .when(t == "BOOLEAN", F.initcap(value))
        .otherwise(F.coalesce(value, F.lit("")))
    )


def integer(v: Column, path: str) -> Column:
    """The integer at ``path``; null for anything else (booleans are no numbers)."""
    return F.when(kind(v, path) == "BIGINT", F.try_variant_get(v, path, "bigint"))


def array(v: Column, path: str) -> Column:
    """Elements of the list at ``path``; an empty array when it is no list."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def element_kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def objects(v: Column, path: str) -> Column:
    """The object members of the list at ``path``."""
    return F.filter(array(v, path), lambda e: is_object(e))


def printed(v: Column, path: str) -> Column:
    """How a present value prints in a label: an explicit null is ``None``, an absent one ``''``."""
    return F.when(kind(v, path) == "VOID", F.lit("None")).otherwise(scalar(v, path))


def element_text(v: Column) -> Column:
    """The string a list element is; null for any other type."""
    return F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
