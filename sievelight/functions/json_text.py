"""JSON text by position: where its string values are, and the text with some of them replaced.

All other characters, white space, keys, numbers and repeated keys included, stay as they are. Depth is not bounded:
what is nested too deep for the parser is checked by a loop over tokens with a stack of its own.
"""

from __future__ import annotations

import json
import re

_STRING = re.compile(r'"(?:[^"\\]|\\.)*+"', re.DOTALL)
_AFTER = re.compile(r"[ \t\n\r]*+:")
_TOKEN = re.compile(
    r"""[ \t\n\r]*+(?:(?P<mark>[\[\]{},:])|(?P<text>"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+")"""
    r"""|(?P<other>-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null|NaN|-?Infinity))""")
# Numbers are not converted: any length and range is fine.
_PARSER = json.JSONDecoder(parse_int=str, parse_float=str)
#: What may follow: a value, a value or the end of a list, a key, a key or the end of an object, a colon, a comma or an end.
VALUE, ITEM, KEY, FIELD, COLON, NEXT = range(6)


def _is_json(doc: str) -> bool:
    """The grammar, without recursion."""
    stack: list[str] = []
    wanted, at, size = VALUE, 0, len(doc.rstrip(" \t\n\r"))
    while at < size:
        token = _TOKEN.match(doc, at)
        if token is None or (wanted == NEXT and not stack):
            return False
        at, mark = token.end(), token["mark"]
        if wanted in (VALUE, ITEM) and mark in ("[", "{"):
            stack.append(mark)
            wanted = ITEM if mark == "[" else FIELD
        elif (mark == "]" and wanted in (ITEM, NEXT) and stack[-1] == "[") or (mark == "}" and wanted in (FIELD, NEXT) and stack[-1] == "{"):
            stack.pop()
            wanted = NEXT
        elif wanted in (VALUE, ITEM) and mark is None:
            wanted = NEXT
        elif wanted in (KEY, FIELD) and token["text"] is not None:
            wanted = COLON
        elif wanted == COLON and mark == ":":
            wanted = VALUE
        elif wanted == NEXT and mark == ",":
            wanted = VALUE if stack[-1] == "[" else KEY
        else:
            return False
    return wanted == NEXT and not stack


def value_spans(doc: str) -> list[tuple[int, int]] | None:
    """``(start, end)`` of every string value with its quotes, in order; None when the text is not JSON."""
    try:
        _PARSER.decode(doc)
    except RecursionError:
        if not _is_json(doc):
            return None
    except ValueError:
        return None
    return [m.span() for m in _STRING.finditer(doc) if not _AFTER.match(doc, m.end())]


def decoded(literal: str) -> str:
    """The value of a string literal; half of a surrogate pair, which no text can hold, becomes a replacement mark."""
    value = json.loads(literal)
    return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if "\\u" in literal else value


def replaced(doc: str, spans: list[tuple[int, int]], values: list[str]) -> str:
    """``doc`` with each span's string set to its value; a literal that has this value already is copied."""
    out, at = [], 0
    for (start, end), value in zip(spans, values):
        literal = doc[start:end]
        if decoded(literal) != value:
            out += [doc[at:start], json.dumps(value, ensure_ascii=False)]
            at = end
    return "".join([*out, doc[at:]])
