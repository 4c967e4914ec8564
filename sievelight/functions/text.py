"""String helpers with the whitespace and blank rules the evidence contract uses.

Every helper takes and returns a Column, so Catalyst sees plain built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# The code points a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    Nested ``when(test(x), f(x)).otherwise(x)`` steps would triple the expression tree at each
    level; a one-element ``transform`` evaluates ``value`` once and keeps the tree linear.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def each_once(values: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of every text of an array (null as empty text), evaluated once for equal ones."""
    def spread(texts: Column, distinct: Column) -> Column:
        return let(
            F.transform(distinct, step),
            lambda done: F.transform(texts, lambda v: F.element_at(done, F.array_position(distinct, v).cast("int"))),
        )

    return let(
        F.transform(values, lambda v: F.coalesce(v, F.lit(""))), lambda texts: let(F.array_distinct(texts), lambda distinct: spread(texts, distinct)))


def literal_array(values) -> Column:
    """A constant string array. Splitting one literal is folded by the optimizer and builds faster
    than an array of many literals."""
    values = list(values)
    if not values:
        return F.array().cast("array<string>")
    return F.split(F.lit("\x1f".join(values)), "\x1f")


def pin(df: DataFrame, values: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add computed columns that are evaluated once per row.

    A filter on a computed column is pushed below the projection, which copies the expression: a
    row would then pay for it in the filter and again in the output. A one-row ``inline`` keeps the
    values where they are. Use it for expensive columns that later filters test.
    """
    keep = [F.col(c) for c in df.columns if c not in values and c not in drop]
    made = F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()])))
    return df.select(*keep, made)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def rstrip_chars(col: Column, chars: str) -> Column:
    return F.rtrim(col, F.lit(chars))


def strip_lower(col: Column) -> Column:
    return F.lower(strip(col))


def non_blank(col: Column) -> Column:
    """The value, or null when it is null or the empty string (Python ``x or ...``)."""
    return F.when(col != "", col)


def first_text(*cols: Column | str) -> Column:
    """First non-empty string; literals may be given as plain text. ``''`` when none."""
    parts = [F.lit(c) if isinstance(c, str) else c for c in cols]
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts], F.lit(""))


def is_blank(col: Column) -> Column:
    """True when no visible character is present; format characters count as blank."""
    return ~F.coalesce(col, F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f\p{Cf}]")


def token(col: Column) -> Column:
    """Lower-case label token: other characters become ``_``, outer ``_`` are cut."""
    return F.btrim(
        F.regexp_replace(strip_lower(F.coalesce(col, F.lit(""))), r"[^a-z0-9._-]+", "_"), F.lit("_")
    )


def join_non_empty(sep: str, *cols: Column) -> Column:
    """Join the non-empty parts with ``sep`` (nulls are skipped by ``concat_ws``)."""
    return F.concat_ws(sep, *[F.nullif(c, F.lit("")) for c in cols])


def safe_id(col: Column) -> Column:
    """A contract-shaped id, or ``unknown``."""
    return F.when(col.rlike(r"\A[A-Za-z0-9._-]{1,128}\n?\z"), col).otherwise(F.lit("unknown"))
