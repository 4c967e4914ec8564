"""Canonical JSON (sorted keys, compact separators, raw UTF-8) and its digest."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sievelight.functions.crypto import sha256_tag
from sievelight.functions.text import let, literal_array
from sievelight.schemas import empty_map


def json_string(col: Column) -> Column:
    """One JSON string token (null as the empty string).

    The writer's one-element array text starts ``["`` and ends ``"]``, so trimming brackets can not
    touch the value. Control escapes are put right once per document, see ``canonical``.
    """
    return F.btrim(F.to_json(F.array(F.coalesce(col, F.lit("")))), F.lit("[]"))


def canonical(encoded: Column) -> Column:
    """Write the hex digits of control escapes in lower case, over a whole encoded document."""

    def lower_escapes(v: Column) -> Column:
        codes = literal_array(("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"))
        # An even number of backslashes before the escape: it is no escaped backslash itself.
        return F.aggregate(
            codes, v,
            lambda acc, c: F.regexp_replace(
                acc, F.concat(F.lit(r"((?<!\\)(?:\\\\)*\\u00)"), c), F.concat(F.lit("$1"), F.lower(c))
            ),
        )

    return let(encoded, lambda v: F.when(F.contains(v, F.lit("\\u00")), lower_escapes(v)).otherwise(v))


def json_object(fields: dict[str, Column]) -> Column:
    """Object text from already encoded values; keys are sorted when the plan is built."""
    parts: list[Column] = []
    for i, key in enumerate(sorted(fields)):
        parts += [F.lit(("," if i else "{") + f'"{key}":'), fields[key]]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def json_array(items: Column) -> Column:
    """Array text from an array of already encoded values."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def json_map(m: Column, extra: dict[str, Column] | None = None, flags: tuple[str, ...] = ()) -> Column:
    """Object text of a string map, keys sorted; ``extra`` adds encoded values (null = left out).

    Values of the ``flags`` keys are booleans or integers at their source: written without quotes.
    """

    def encode(e: Column) -> Column:
        text = json_string(e["value"])
        if not flags:
            return text
        return F.when(e["key"].isin(*flags) & e["value"].rlike(r"\A(?:true|false|-?[0-9]+)\z"), e["value"]).otherwise(text)

    entries = F.transform(
        F.map_entries(F.coalesce(m, empty_map())),
        lambda e: F.struct(e["key"].alias("k"), encode(e).alias("v")),
    )
    for key, value in (extra or {}).items():
        entries = F.concat(
            entries,
            F.filter(F.array(F.struct(F.lit(key).alias("k"), value.alias("v"))), lambda e: e["v"].isNotNull()),
        )
    return F.concat(
        F.lit("{"),
        F.array_join(
            F.transform(F.array_sort(entries), lambda e: F.concat(json_string(e["k"]), F.lit(":"), e["v"])), ","
        ),
        F.lit("}"),
    )


def canonical_digest(encoded: Column) -> Column:
    return sha256_tag(canonical(encoded))


def ascii_json(encoded: Column) -> Column:
    """The variant that escapes every UTF-16 unit beyond ``~`` as ``\\uXXXX``.

    Only rows that hold such characters pay for the per-character walk.
    """

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def escape(ch: Column) -> Column:
        # The numeric code point comes from the UTF-32 bytes; beyond the BMP it is a surrogate pair.
        code = F.conv(F.hex(F.encode(ch, "UTF-32")), 16, 10).cast("bigint")
        return (
            F.when(code < 127, ch)
            .when(code < 65536, unit(code))
            .otherwise(
                F.concat(
                    unit(F.lit(55296) + F.shiftright(code - 65536, 10)),
                    unit(F.lit(56320) + (code - 65536).bitwiseAND(F.lit(1023).cast("bigint"))),
                )
            )
        )

    return let(
        encoded,
        lambda v: F.when(
            v.rlike(r"[^\x00-\x7e]"),
            F.array_join(F.transform(F.regexp_extract_all(v, F.lit("(?s)."), F.lit(0)), escape), ""),
        ).otherwise(v),
    )
