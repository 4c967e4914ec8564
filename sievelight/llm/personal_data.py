"""Personal data by weak supervision, in SQL expressions.

Exact patterns find e-mail and IP addresses, card and phone numbers. On top, long tokens that mix letters and
digits are candidates for secrets and account ids. Labelers vote on each (a key pattern, a gazetteer of key
prefixes, cue words before it, the mix of characters, and cue words for harmless codes); expectation-maximisation
estimates each labeler's reliability from the counts of vote patterns alone, and a logistic classifier is trained on
the resulting probabilities over features of the span and its left neighbour. Candidates that it accepts are added.

Only counts per pattern of votes and features reach the driver: their number is bounded by the number of
patterns, whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
# The base patterns. Runs are taken whole and once (possessive, and a match starts only
# at the start of a run or where the last match ended), which finds the same matches in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
CANDIDATE = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{12,}+"
# Fixed values of the labelers: key prefixes, cue words for private and for harmless codes.
GAZETTEER = ("AKIA", "ASIA", "AIza", "ghp", "gho", "xoxb", "xoxp", "sk", "pk")
PRIVATE_CUES = ("password", "passwd", "pwd", "token", "secret", "apikey", "key", "auth", "login", "account", "iban", "passport", "ssn")
HARMLESS_CUES = ("commit", "sha", "md5", "isbn", "doi", "version", "build", "release", "checksum", "uuid")
#: Code points before a candidate that the context labelers see.
CONTEXT = 24
LABELERS = ("pattern", "gazetteer", "cue", "mixture", "harmless")
FEATURES = ("long", "very_long", "upper", "lower", "many_digits", "few_digits", "after_equals", "after_quote", "after_space")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -(i + 1), F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    n = F.length(_digits(x))
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(r"^(\d|[1-9]\d|1\d\d|2[0-4]\d|25[0-5])$"))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(x))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _found(text: Column, kind: str, pattern: str, needs: str | None, keep: Callable[[Column, Column], list[Column]]) -> Column:
    """Per match its number, the lengths of the gap before it and of itself, and what ``keep(match, gap)`` makes of it."""
    maybe = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    value = F.when(maybe, text).otherwise("")
    return F.transform(
        F.arrays_zip(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)).alias("m"), F.split(value, pattern, -1).alias("g")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), *keep(x["m"], x["g"])))


def _share(x: Column) -> Column:
    return F.length(_digits(x)) / F.length(x)


def _votes(m: Column, before: Column) -> dict[str, Column]:
    """1 for private, 0 for harmless, -1 for no opinion."""
    kinds = F.size(F.array_distinct(F.split(m, "")))
    cue = F.lower(before)
    return {
        "pattern": F.when(m.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$|^[0-9a-f]{16,}$|^[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}$"), 1).otherwise(-1),
        "gazetteer": F.when(m.rlike("^(" + "|".join(GAZETTEER) + ")"), 1).otherwise(-1),
        "cue": F.when(cue.rlike("(" + "|".join(PRIVATE_CUES) + ")[^a-z0-9]{1,6}$"), 1).otherwise(-1),
        "mixture": F.when((kinds >= 8) & _share(m).between(0.1, 0.9), 1).when(kinds <= 4, 0).otherwise(-1),
        "harmless": F.when(cue.rlike("(" + "|".join(HARMLESS_CUES) + ")[^a-z0-9]{1,6}$"), 0).otherwise(-1),
    }


def _features(m: Column, before: Column) -> dict[str, Column]:
    last = F.substring(before, -1, 1)
    return {
        "long": F.length(m) >= 16, "very_long": F.length(m) >= 32, "upper": m.rlike("[A-Z]"), "lower": m.rlike("[a-z]"),
        "many_digits": _share(m) >= 0.5, "few_digits": _share(m) <= 0.15, "after_equals": last.isin("=", ":"),
        "after_quote": last.isin('"', "'"), "after_space": last.isin(" ", "\n", "\t", ""),
    }


def _judged(m: Column, g: Column) -> list[Column]:
    before = F.substring(g, -CONTEXT, CONTEXT)
    return [F.struct(*[v.cast("int").alias(k) for k, v in _votes(m, before).items()]).alias("votes"),
            F.struct(*[v.cast("int").alias(k) for k, v in _features(m, before).items()]).alias("features")]


def estimate(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 50) -> list[float]:
    """Probability of each vote pattern to be private, by expectation-maximisation over ``(votes, count)``.

    Each labeler has a reliability per class, smoothed; the classes start from the majority of the votes cast.
    """
    p = []
    for votes, _ in patterns:
        cast = [v for v in votes if v >= 0]
        p.append((0.5 + sum(cast)) / (1 + len(cast)))
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = min(0.99, max(0.01, sum(q * n for q, (_, n) in zip(p, patterns)) / max(total, 1e-9)))
        table = []
        for j in range(len(patterns[0][0]) if patterns else 0):
            counts = {c: {v: 0.5 for v in (-1, 0, 1)} for c in (0, 1)}
            for q, (votes, n) in zip(p, patterns):
                counts[1][votes[j]] += q * n
                counts[0][votes[j]] += (1 - q) * n
            table.append({c: {v: x / sum(own.values()) for v, x in own.items()} for c, own in counts.items()})
        p = []
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[j][1][v] / table[j][0][v]) for j, v in enumerate(votes))
            p.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return p


def train(rows: list[tuple[tuple[int, ...], float, float]], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> list[float]:
    """Logistic weights (bias first) on ``(features, probability, count)``, by gradient descent."""
    size = len(rows[0][0]) + 1 if rows else len(FEATURES) + 1
    w, total = [0.0] * size, sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        g = [decay * x for x in w]
        for features, q, n in rows:
            x = (1, *features)
            e = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x)))) - q
            for j, b in enumerate(x):
                g[j] += e * b * n / total
        w = [a - rate * b for a, b in zip(w, g)]
    return w


def classifier(texts: DataFrame, text_col: str = "text") -> list[float] | None:
    """Weights of the span classifier, learned without labels from all candidates; None without candidates."""
    found = texts.select(F.explode(_found(F.col(text_col), SECRET, CANDIDATE, None, _judged)).alias("c")).where("c.len is not null")
    counts = [(tuple(r["votes"]), tuple(r["features"]), float(r["n"])) for r in found.groupBy(
        F.col("c.votes").alias("votes"), F.col("c.features").alias("features")).agg(F.count("*").alias("n")).collect()]
    if not counts:
        return None
    by_votes: dict[tuple, float] = {}
    for votes, _, n in counts:
        by_votes[votes] = by_votes.get(votes, 0.0) + n
    names = sorted(by_votes)
    chance = dict(zip(names, estimate([(v, by_votes[v]) for v in names])))
    by_features: dict[tuple, list[float]] = {}
    for votes, features, n in counts:
        own = by_features.setdefault(features, [0.0, 0.0])
        own[0] += chance[votes] * n
        own[1] += n
    return train([(f, a / n, n) for f, (a, n) in sorted(by_features.items())])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``(id, n_email, n_ip, n_card, n_phone, base, spans)``.

    ``base`` and ``spans`` are arrays of ``kind:start:end`` in code points (end exclusive), by start, then kind. ``base``
    has the exact kinds, ``spans`` also the secrets that the classifier accepts and that overlap no base span.
    A null or empty text has none; repeated rows are separate; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    weights = classifier(docs, text_col)
    # Matches that fail a kind's test stay in the list, as the gaps count from them.
    kinds = [_found(text, k, PATTERNS[k], NEEDS[k], lambda m, g, k=k: [F.coalesce(_valid(k, m), F.lit(False)).alias("ok")]) for k in KINDS]
    if weights:
        def accepted(m: Column, g: Column) -> list[Column]:
            own = _features(m, F.substring(g, -CONTEXT, CONTEXT))
            score = F.lit(weights[0])
            for w, k in zip(weights[1:], FEATURES):
                score = score + F.lit(w) * own[k].cast("int")
            return [F.coalesce(score > 0, F.lit(False)).alias("ok")]

        kinds.append(_found(text, SECRET, CANDIDATE, None, accepted))
    found = F.filter(F.concat(*kinds), lambda x: x["len"].isNotNull())
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), found.alias("found")).select(
        "uid", "id", F.explode_outer("found").alias("s"))
    before = Window.partitionBy("uid", "s.kind").orderBy("s.i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("s.gap") + F.col("s.len")).over(before)
    placed = rows.select("uid", "id", F.when(F.col("s.ok"), F.struct(
        (end - F.col("s.len")).alias("start"), F.array_position(F.array(*map(F.lit, (*KINDS, SECRET))), F.col("s.kind")).alias("order"),
        F.col("s.kind").alias("kind"), end.alias("end"))).alias("p"))
    grouped = placed.groupBy("uid", "id").agg(F.sort_array(F.collect_list("p")).alias("p")).drop("uid")
    base = F.filter("p", lambda x: x["kind"] != SECRET)
    # Spans are in order of their start, so a secret overlaps a base span only if a neighbour in this short list does.
    free = F.filter("p", lambda x: (x["kind"] != SECRET) | ~F.exists(
        base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text_of(x: Column) -> Column:
        return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))

    return grouped.select(
        F.col("id").alias(id_col), *map(number, KINDS),
        F.transform(base, text_of).alias("base"), F.transform(free, text_of).alias("spans"))
