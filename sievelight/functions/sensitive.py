"""Sensitive-data catalog as column expressions: detection, masking, redaction, counts.

Three classes are detected: ``secret`` (token shapes), ``phi`` (labelled health values) and ``pan``
(card numbers: Luhn-valid digit runs without an id label in the 30 characters before them).
Redaction adds e-mail addresses and phone numbers. Every regex sits behind a cheap literal test,
so clean text costs a few byte searches instead of thirty regex passes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from sievelight.functions.text import let

# Catalog patterns. (label, pattern, literals of which one occurs in every match)
SECRET_PATTERNS: list[tuple[str, str, tuple[str, ...]]] = [
    ("aws-access-key", r"\bAKIA[0-9A-Z]{16}\b", ("AKIA",)),
    ("github-pat", r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}\b",
     ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    ("github-fine-grained-pat", r"\bgithub_pat_[0-9A-Za-z_]{82}\b", ("github_pat_",)),
    ("azure-storage-key",
     r"DefaultEndpointsProtocol=https;AccountName=[a-z0-9]+;AccountKey=[A-Za-z0-9+/]{40,};",
     ("DefaultEndpointsProtocol=https;",)),
    ("private-key-pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("PRIVATE KEY-----",)),
    ("jwt", r"\beyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b", (".eyJ",)),
    ("slack-token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}\b",
     ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    ("google-api-key", r"\bAIza[0-9A-Za-z_-]{35}\b", ("AIza",)),
    ("stripe-live-key", r"\b(?:sk|rk)_live_[0-9A-Za-z]{24,}\b", ("k_live_",)),
    ("gitlab-pat", r"\bglpat-[0-9A-Za-z_-]{20}\b", ("glpat-",)),
    ("npm-token", r"\bnpm_[0-9A-Za-z]{36}\b", ("npm_",)),
    ("openai-key", r"\bsk-(?:proj-)?[A-Za-z0-9]{32,}\b", ("sk-",)),
]
PHI_PATTERNS: list[tuple[str, str]] = [
    ("mrn-with-label",
     r"(?i)\b(?:mrn|medical\s+record(?:\s+number)?|patient\s+id)\s*[:=]\s*\d{5,12}\b"),
    ("phi-field-label",
     r"(?i)\b(?:patient_(?:id|name|email)|date_of_birth|dob|ssn|social_security(?:_number)?)\s*[:=]"),
]
PHI_VALUE_PATTERN = PHI_PATTERNS[1][1] + r"\s*[\w@.\-]*"
CARD_PATTERN = r"\b\d{13,19}\b"
CARD_LABEL_PATTERN = (
    r"(?i)\b(?:order_id|order|ref|ref_id|transaction_id|txn_id|id|user_id|account_id|invoice_id|receipt)"
    r"\s*[:=]\s*\z"
)
# A domain has any number of labels. A plain repeated group needs stack for each of them, and a hostile
# "a.a.a..." text would overflow it: labels are taken in blocks, which repeat without a stack, so no level
# repeats more than 128 times.
_LABEL = r"(?:[A-Za-z0-9-]{1,63}\.)"
EMAIL_PATTERN = (
    rf"\b[A-Za-z0-9._%+-]{{1,64}}@(?:{_LABEL}{{8192}}+){{0,128}}(?:{_LABEL}{{128}}+){{0,64}}{_LABEL}{{1,128}}[A-Za-z]{{2,63}}\b"
)
PHONE_PATTERN = (
    r"(?<!\d)(?:(?:\+?\d{1,3}[ .\-]?)?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}"
    r"|(?:\+|00)[ .\-]?\d{1,3}[ .\-]?(?:\d[ .\-]?){5,12}\d)(?!\d)"
)
PHONE_KEYWORD_PATTERN = (
    r"(?i)((?:tel|phone|call|ring|mobile|cell|fax|whatsapp)\b[ :.\-]{1,4})((?:\d[ .\-]?){6,13}\d)"
)
CARD_LOOKBACK = 30
EXCERPT_MAX = 64

# One of these words is part of every health-value match.
PHI_WORDS = r"(?iU)mrn|medical|patient|date_of_birth|dob|ssn|social_security"
# Seven digits with optional separators occur in every phone-shaped match.
_PHONE_GUARD = r"(?U)\d[\d .\-]{5,}\d"
_CARD_GUARD = r"(?U)\d{13}"
# Each secret holds one of these. ``sk-`` alone is part of ordinary words, so it needs its run. The class of first characters
# comes first: without it the scan would try every alternative at every position.
_SECRET_STARTS = "".join(sorted({x[0] for _, _, lits in SECRET_PATTERNS for x in lits} - {"-"}))
_SECRET_LITERALS = "|".join(
    [re.escape(x) for _, _, lits in SECRET_PATTERNS for x in lits if x != "sk-"] + [r"sk-(?:proj-)?[A-Za-z0-9]{32}"])
_SECRET_GUARD = f"(?=[{_SECRET_STARTS}])(?:{_SECRET_LITERALS})"
# A health label ends in one of these pairs of letters before its separator. ``[redacted:`` does not: text with a placeholder stays cheap.
_LABEL_END = r"(?iU)(?:[rs]n|rd|er|id|me|il|th|ob|ty)\s*[:=]"
# Every rule's match holds one of these: text without any of them stays as it is. ``\p{Nd}`` is the Unicode-aware ``\d``. The colon of
# a placeholder follows no health label, so it is part of no match.
_ANY_GUARD = rf"(?=[@:=\p{{Nd}}{_SECRET_STARTS}])(?:[@=]|(?<!\[redacted):|\p{{Nd}}[\p{{Nd}} .\-]{{5,}}\p{{Nd}}|{_SECRET_LITERALS})"

HIT_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("cls", T.StringType()),
            T.StructField("pattern_id", T.IntegerType()),
            T.StructField("match_excerpt", T.StringType()),
        ]
    )
)


def _u(pattern: str) -> str:
    """Unicode-aware classes and word boundaries, as the rules are written for."""
    return "(?U)" + pattern


def _has_any(v: Column, literals: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(v, F.lit(x)) for x in literals])


def maybe_any(v: Column) -> Column:
    """Necessary condition of a match of any rule: one scan decides for most text."""
    return v.rlike(_ANY_GUARD)


def maybe_hit(v: Column) -> Column:
    """Necessary condition of a catalog hit."""
    return _maybe_secret(v) | v.rlike(_CARD_GUARD) | (_maybe_phi(v) & v.rlike(PHI_WORDS))


def _maybe_secret(v: Column) -> Column:
    """Necessary condition of a secret."""
    return v.rlike(_SECRET_GUARD)


def _matches(v: Column, patterns) -> Column:
    """The matches of each pattern, an array per pattern. The patterns are literals: one that changes by row is compiled by row."""
    return F.array(*[F.regexp_extract_all(v, F.lit(_u(p)), F.lit(0)) for p in patterns])


def _maybe_phi(v: Column) -> Column:
    return _has_any(v, (":", "=")) & v.rlike(_LABEL_END)


def _guarded(col: Column, guard: Callable[[Column], Column], step: Callable[[Column], Column]) -> Column:
    return let(col, lambda v: F.when(guard(v), step(v)).otherwise(v))


def card_runs(v: Column) -> Column:
    """Candidate digit runs in text order as ``array<struct<ctx, run, valid>>``.

    ``ctx`` is the 30-character slice before the run (fewer at the text start), taken by a bounded
    look-behind so that neighbouring runs keep their own context.
    """
    pattern = _u(r"(?s)\b(?=\d{13})(?<=(\A.{0,%d}|.{%d}))(\d{13,19})\b" % (CARD_LOOKBACK - 1, CARD_LOOKBACK))
    return F.zip_with(
        F.regexp_extract_all(v, F.lit(pattern), F.lit(1)),
        F.regexp_extract_all(v, F.lit(pattern), F.lit(2)),
        lambda ctx, run: F.struct(
            ctx.alias("ctx"),
            run.alias("run"),
            (F.call_function("luhn_check", run) & ~ctx.rlike(_u(CARD_LABEL_PATTERN))).alias("valid"),
        ),
    )


def detect_secrets(v: Column) -> Column:
    """Matches of the 12 token families as ``array<struct<cls, pattern_id, match_excerpt>>``."""

    def family(found: Column, idx: Column) -> Column:
        return F.transform(found, lambda m: _hit("secret", idx, mask_secret(m)))

    found = _matches(v, (p for _, p, _ in SECRET_PATTERNS))
    return F.when(_maybe_secret(v), F.flatten(F.transform(found, family))).otherwise(F.array().cast(HIT_TYPE))


def detect_phi(v: Column) -> Column:
    def label(found: Column, idx: Column) -> Column:
        return F.transform(found, lambda _: _hit("phi", idx, F.lit("[phi:redacted]")))

    found = _matches(v, (p for _, p in PHI_PATTERNS))
    return F.when(_maybe_phi(v) & v.rlike(PHI_WORDS), F.flatten(F.transform(found, label))).otherwise(F.array().cast(HIT_TYPE))


def detect_pan(v: Column) -> Column:
    return F.when(
        v.rlike(_CARD_GUARD),
        F.transform(
            F.filter(card_runs(v), lambda r: r["valid"]),
            lambda r: _hit("pan", F.lit(0), F.lit("[pan:redacted]")),
        ),
    ).otherwise(F.array().cast(HIT_TYPE))


def _hit(cls: str, pattern_id: Column, excerpt: Column) -> Column:
    return F.struct(
        F.lit(cls).alias("cls"), pattern_id.cast("int").alias("pattern_id"), excerpt.alias("match_excerpt")
    )


def mask_secret(m: Column) -> Column:
    """First and last four characters of the (64-character) excerpt, the rest starred."""
    cut = F.left(m, F.lit(EXCERPT_MAX))
    size = F.char_length(cut)
    return F.when(
        size > 8, F.concat(F.left(cut, F.lit(4)), F.repeat(F.lit("*"), size - 8), F.right(cut, F.lit(4)))
    ).otherwise(F.repeat(F.lit("*"), size))


def detect(col: Column) -> Column:
    """All catalog hits in class order: secret, phi, pan."""
    return let(
        F.coalesce(col, F.lit("")),
        lambda v: F.concat(
            detect_secrets(v),
            detect_phi(v),
            detect_pan(v),
        ),
    )


def has_hit(col: Column) -> Column:
    """True when the catalog matches anywhere; cheaper than building the hit list."""
    secrets = "|".join(f"(?:{p})" for _, p, _ in SECRET_PATTERNS)
    phi = "|".join(f"(?:{p})" for _, p in PHI_PATTERNS)
    return let(
        F.coalesce(col, F.lit("")),
        lambda v: (_maybe_secret(v) & v.rlike(_u(secrets)))
        | (_maybe_phi(v) & v.rlike(_u(phi)))
        | (v.rlike(_CARD_GUARD) & F.exists(card_runs(v), lambda r: r["valid"])),
    )


def redact_cards(col: Column) -> Column:
    """Replace the valid runs only; equal digits behind an id label stay."""

    def rebuild(v: Column) -> Column:
        return let(
            F.struct(
                F.split(v, _u(CARD_PATTERN), -1).alias("pieces"), card_runs(v).alias("runs")
            ),
            lambda s: F.array_join(
                F.transform(
                    s["pieces"],
                    lambda piece, i: F.concat(
                        piece,
                        F.coalesce(
                            F.when(F.get(s["runs"], i)["valid"], F.lit("[redacted:pan]")).otherwise(
                                F.get(s["runs"], i)["run"]
                            ),
                            F.lit(""),
                        ),
                    ),
                ),
                "",
            ),
        )

    return _guarded(col, lambda v: v.rlike(_CARD_GUARD), rebuild)


def redact_catalog(col: Column) -> Column:
    """Secret, then phi (value-consuming), then card placeholders."""

    return _redact_phi_cards(_guarded(col, _maybe_secret, _redact_secrets))


def _redact_phi_cards(col: Column) -> Column:
    def phi(v: Column) -> Column:
        out = F.regexp_replace(v, _u(PHI_PATTERNS[0][1]), "[redacted:phi]")
        return F.regexp_replace(out, _u(PHI_VALUE_PATTERN), "[redacted:phi]")

    return redact_cards(_guarded(col, _maybe_phi, phi))


def _families(v: Column) -> Column:
    """The token families whose literals occur in the text, by number."""
    return F.array_compact(F.array(*[F.when(_has_any(v, lits), F.lit(i)) for i, (_, _, lits) in enumerate(SECRET_PATTERNS)]))


def _redact_secrets(v: Column) -> Column:
    """The families one after the other; text with the literals of one alone goes to its pattern at once."""
    every = v
    for _, p, lits in SECRET_PATTERNS:
        every = _guarded(every, lambda t, lits=lits: _has_any(t, lits), lambda t, p=p: _replace_secret(t, p))

    def pick(found: Column) -> Column:
        out = F.when(F.size(found) > 1, every)
        for i, (_, p, _) in enumerate(SECRET_PATTERNS):
            out = out.when(F.get(found, F.lit(0)) == i, _replace_secret(v, p))
        return out.otherwise(v)

    return let(_families(v), pick)


def _replace_secret(v: Column, pattern: str) -> Column:
    return F.regexp_replace(v, F.lit(_u(pattern)), F.lit("[redacted:secret]"))


def _redact_email(col: Column) -> Column:
    return _guarded(
        col,
        lambda v: F.contains(v, F.lit("@")),
        lambda v: F.regexp_replace(v, _u(EMAIL_PATTERN), "[redacted:email]"),
    )


def redact_pii(col: Column) -> Column:
    """E-mail, phone, then keyword-anchored phone."""
    return _guarded(
        _redact_email(col),
        lambda v: v.rlike(_PHONE_GUARD),
        lambda v: F.regexp_replace(
            F.regexp_replace(v, _u(PHONE_PATTERN), "[redacted:phone]"),
            _u(PHONE_KEYWORD_PATTERN),
            "$1[redacted:phone]",
        ),
    )


def redact(col: Column) -> Column:
    """Emit-safe text. ``detect(redact(x))`` is empty: the catalog also runs last."""
    return _guarded(col, maybe_any, lambda v: redact_catalog(redact_pii(redact_catalog(v))))


def _count(v: Column, pattern: str) -> Column:
    return F.regexp_count(v, F.lit(_u(pattern)))


def _added(before: Column, after: Column, placeholder: str) -> Column:
    """How many placeholders a replacement has put in: no match holds one, so none is lost."""
    def size(v: Column) -> Column:
        return F.octet_length(v) - F.octet_length(F.replace(v, F.lit(placeholder), F.lit("")))

    return F.when(before == after, F.lit(0)).otherwise(((size(after) - size(before)) / len(placeholder)).cast("int"))


def redact_with_findings(col: Column) -> Column:
    """``struct<text, credential, pii, secret>``: redacted text and the count of each category.

    Catalog classes are counted on the text before redaction (cards as ``credential``, health
    values under ``pii``), e-mails and phones on the text each of their steps sees.
    """
    none = F.lit(0)

    def whole(v: Column) -> Column:
        runs = F.size(F.filter(card_runs(v), lambda r: r["valid"]))
        secrets = let(
            F.when(_maybe_secret(v), _redact_secrets(v)).otherwise(v),
            lambda t: F.struct(t.alias("t"), _count_secrets(v, t).alias("secret")),
        )
        start = let(secrets, lambda s: F.struct(
            _redact_phi_cards(s["t"]).alias("t"),
            s["secret"].alias("secret"),
            F.when(_maybe_phi(v) & v.rlike(PHI_WORDS), _count(v, PHI_PATTERNS[0][1]) + _count(v, PHI_PATTERNS[1][1])).otherwise(none).alias("phi"),
            F.when(v.rlike(_CARD_GUARD), runs).otherwise(none).alias("pan"),
        ))
        return _redact_counted(start)

    clean = lambda v: F.struct(v.alias("text"), none.alias("credential"), none.alias("pii"), none.alias("secret"))
    return let(F.coalesce(col, F.lit("")), lambda v: F.when(maybe_any(v), whole(v)).otherwise(clean(v)))


def _count_secrets(v: Column, redacted: Column) -> Column:
    """Matches of all families in a text, each by itself: those of one alone are the placeholders it got."""
    every = F.aggregate(
        F.array(*[F.when(_has_any(v, lits), _count(v, p)).otherwise(F.lit(0)) for _, p, lits in SECRET_PATTERNS]), F.lit(0), lambda acc, n: acc + n)
    one = F.size(_families(v)) == 1
    return F.when(v == redacted, F.lit(0)).when(one, _added(v, redacted, "[redacted:secret]")).otherwise(every)


def _redact_counted(start: Column) -> Column:
    """E-mails and phones of a text whose catalog matches are counted and replaced, then the catalog once more."""

    def phones(v: Column) -> Column:
        def keyword(t: Column) -> Column:
            return let(
                F.when(t.rlike(_PHONE_GUARD), F.regexp_replace(t, _u(PHONE_KEYWORD_PATTERN), "$1[redacted:phone]")).otherwise(t),
                lambda k: F.struct(k.alias("t"), _added(v, k, "[redacted:phone]").alias("n")),
            )

        plain = F.struct(v.alias("t"), F.lit(0).alias("n"))
        return F.when(v.rlike(_PHONE_GUARD), let(F.regexp_replace(v, _u(PHONE_PATTERN), "[redacted:phone]"), keyword)).otherwise(plain)

    def mails(t: Column) -> Column:
        return let(_redact_email(t), lambda m: F.struct(m.alias("t"), _added(t, m, "[redacted:email]").alias("n")))

    return let(start, lambda s: let(mails(s["t"]), lambda m: let(phones(m["t"]), lambda p: F.struct(
        redact_catalog(p["t"]).alias("text"),
        s["pan"].alias("credential"),
        (s["phi"] + m["n"] + p["n"]).alias("pii"),
        s["secret"].alias("secret"),
    ))))
