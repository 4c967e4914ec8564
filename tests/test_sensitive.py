import hmac
import hashlib
import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sievelight.functions import canonical as J, crypto as C, sensitive as S, text as X

H = "0123456789abcdef" * 3
CARD = "4111" + "1" * 12
PIECES = [
    "plain ", "AKIA" + "A" * 16, "ghp_" + "a" * 36, "sk-" + "b" * 40, "MRN: 1234567", "ssn=", "dob : ", CARD, "order_id: ", "a.b@x.org",
    "555-123-4567", "+44 20 7946 0958", "tel 12 34 56 78", "é", "​", "\n", "-", ".", "eyJab.eyJcd.ef", "xoxb-" + "1" * 12, "5500", "@", "00",
]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), min_size=20, max_size=60))
def test_redacted_text_is_clean(spark, texts):
    clean = S.redact(F.col("t"))
    assert not any(column(spark, texts, S.has_hit(clean)))
    assert column(spark, texts, clean) == column(spark, texts, S.redact_with_findings(F.col("t"))["text"])


def test_card_context_is_per_field_and_per_run(spark):
    texts = [f"order_id: {CARD}", f"x {CARD}", f"order_id: {CARD} and {CARD}", f"id={CARD[:-1]}2", f"order_id:{' ' * 40}{CARD}"]
    hits = column(spark, texts, F.size(S.detect_pan(F.col("t"))))
    assert hits == [0, 1, 1, 0, 1]
    assert column(spark, texts, S.redact_cards(F.col("t")))[2] == f"order_id: {CARD} and [redacted:pan]"


def test_findings_and_masks(spark):
    text = "ghp_" + "a" * 36 + " mrn=12345 " + CARD + " a@b.org call 555-123-4567"
    (r,) = column(spark, [text], S.redact_with_findings(F.col("t")))
    assert (r.secret, r.credential, r.pii) == (1, 1, 3)
    assert r.text == "[redacted:secret] [redacted:phi] [redacted:pan] [redacted:email] call [redacted:phone]"
    (hits,) = column(spark, [text], S.detect(F.col("t")))
    assert [(h.cls, h.pattern_id) for h in hits] == [("secret", 1), ("phi", 0), ("pan", 0)]
    assert hits[0].match_excerpt == "ghp_" + "*" * 32 + "aaaa"


def test_long_domain_does_not_overflow(spark):
    hostile = "a@" + "a." * 20000
    assert column(spark, [hostile, "b@" + "x" * 200000], F.char_length(S.redact(F.col("t")))) is not None


def test_canonical_json_and_mac(spark):
    texts = ["", 'q"\\/', "\x00\x0b\x1f\x7f", "\\u000B", "é \U0001f600", "a\tb\nc"]
    enc = J.json_object({"t": J.json_string(F.col("t"))})
    assert column(spark, texts, J.canonical(enc)) == [
        json.dumps({"t": t}, ensure_ascii=False, separators=(",", ":")) for t in texts]
    assert column(spark, texts, J.ascii_json(J.canonical(enc))) == [json.dumps({"t": t}, separators=(",", ":")) for t in texts]
    for key in (b"k", b"x" * 100):
        assert column(spark, texts, C.hmac_sha256_hex(F.col("t"), key)) == [
            hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in texts]


def test_strip_blank_and_tokens(spark):
    texts = ["\x1c a　", "​ ﻿", "A b!c", "", "__x__"]
    assert column(spark, texts, X.strip(F.col("t"))) == [t.strip() for t in texts]
    assert column(spark, texts, X.is_blank(F.col("t"))) == [False, True, False, True, False]
    assert column(spark, texts, X.token(F.col("t"))) == ["a", "​ ﻿" and "", "a_b_c", "", "x"]
