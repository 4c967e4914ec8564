"""Text expressions that several operators share. All are plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. The fast lower() serves where no other letter would change."""
    return F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
