"""Secret scan: exact patterns, and a battery of randomness tests under a length-aware false-discovery control.

Long tokens of the alphabets in which keys are written are candidates. The characters of a candidate decide its
encoding, the smallest alphabet that holds them all. Three tests ask whether it could be a uniform draw from that alphabet:
chi-squared over groups of its symbols, runs above and below its middle, and the serial correlation of neighbours. Their
p-values join by Fisher's rule to one p, high for random tokens and near 0 for words and names.

A short token can look random by chance. For every candidate the text's own words, joined and written in the same alphabet
at the same length, are judged as a decoy. Per stratum (encoding, class of lengths) the counts of candidates and decoys by
score give the share of candidates that are not random and the false discoveries among those that pass; the limit is
the lowest p at which these stay within ``RATE``. Where the tests have no power, at small lengths, decoys pass as easily as
candidates and nothing is added. Only these counts reach the driver: strata x bins, whatever the corpus.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sievelight.llm.tables import saved

KINDS = ("assign", "access", "hex")
RANDOM = "random"
# The base patterns, with the lengths below which a match is dropped. Runs of one class are taken whole, so
# that the least length can stand in the pattern of ``access`` and ``hex``.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS, ASSIGN_LENGTH = ("password", "passwd", "secret", "token", "apikey", "api_key"), 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
DIGIT, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets from the smallest on. Numbers alone are no candidates: counters, dates and card numbers are no keys.
ALPHABETS = {
    "hex": DIGIT + LOWER[:6], "hex_upper": DIGIT + UPPER[:6], "lower": LOWER, "upper": UPPER, "base32": UPPER + DIGIT[2:8],
    "base36": DIGIT + LOWER, "base36_upper": DIGIT + UPPER, "base62": DIGIT + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGIT + "+/", "base64url": UPPER + LOWER + DIGIT + "-_", "all": UPPER + LOWER + DIGIT + "+/-_",
}
#: Upper ends of the classes of lengths, and the false discoveries allowed among the added spans.
LENGTHS, RATE = (20, 28, 40, 64), 0.05
#: Bins of -log10 p, how many make a power of ten, and the first bin that speaks for words (p < 0.01).
BINS, STEPS, WORDS = 40, 4, 8
#: Symbol groups of the chi-squared test at most, and candidates judged at once.
GROUPS, AT_ONCE = 16, 4096
NAMES = list(ALPHABETS)
SIZES = np.array([len(a) for a in ALPHABETS.values()])
INDEX = np.full((len(NAMES), 128), -1, np.int16)
for _i, _a in enumerate(ALPHABETS.values()):
    INDEX[_i, [ord(c) for c in _a]] = range(len(_a))
#: How a letter is written in each alphabet: as itself, in the other case, or folded.
_WRITTEN = np.where(INDEX >= 0, INDEX, np.where(INDEX[:, np.arange(128) ^ 32] >= 0, INDEX[:, np.arange(128) ^ 32], (np.arange(128) & 31) % SIZES[:, None])).astype(np.int64)
_FITS = [re.compile(f"[{re.escape(a)}]+") for a in ALPHABETS.values()]


def encoding(token: str) -> int:
    """Number of the smallest alphabet that holds the token, -1 for digits alone."""
    return -1 if token.isdigit() else next(i for i, fits in enumerate(_FITS) if fits.fullmatch(token))


def _tail(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def battery(symbols: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Joint p-value that each token is random: ``symbols`` of all tokens in a row, their lengths and alphabet sizes."""
    if len(lengths) > AT_ONCE:
        at = int(lengths[:AT_ONCE].sum())
        return np.concatenate([battery(symbols[:at], lengths[:AT_ONCE], sizes[:AT_ONCE]), battery(symbols[at:], lengths[AT_ONCE:], sizes[AT_ONCE:])])
    m, n = len(lengths), lengths.astype(float)
    token = np.repeat(np.arange(m), lengths)
    # Chi-squared over groups of neighbouring symbols, five expected in each; the tail by Wilson and Hilferty.
    groups = np.clip(lengths // 5, 2, np.minimum(sizes, GROUPS))
    seen = np.bincount(token * GROUPS + symbols * groups[token] // sizes[token], minlength=m * GROUPS).reshape(m, GROUPS)
    edge = -(-np.arange(GROUPS + 1)[None, :] * sizes[:, None] // groups[:, None])
    wanted = np.diff(np.minimum(edge, sizes[:, None]), axis=1) * (n / sizes)[:, None]
    square = np.where(wanted > 0, (seen - wanted) ** 2 / np.where(wanted > 0, wanted, 1), 0).sum(1)
    spread = 2 / (9 * (groups - 1))
    uniform = _tail((np.cbrt(square / (groups - 1)) - 1 + spread) / np.sqrt(spread))
    # Runs of symbols above and below the middle.
    above = symbols * 2 >= sizes[token]
    inside = token[1:] == token[:-1]
    high = np.bincount(token, above, m)
    runs = 1 + np.bincount(token[1:], inside & (above[1:] != above[:-1]), m)
    mean = 2 * high * (n - high) / n + 1
    deviation = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 0))
    one_sided = (high == 0) | (high == n)
    z = np.where(deviation > 0, np.abs(runs - mean) / np.where(deviation > 0, deviation, 1), 0)
    order = np.where(one_sided, 2.0 ** (1 - np.minimum(n, 1000)), 2 * _tail(z))
    # Serial correlation around the alphabet's mean.
    x = symbols - (sizes[token] - 1) / 2
    follow = np.bincount(token[1:], np.where(inside, x[1:] * x[:-1], 0), m) / np.bincount(token, x**2, m)
    serial = 2 * _tail(np.abs(follow) * np.sqrt(n))
    half = -sum(np.log(np.maximum(p, 1e-300)) for p in (uniform, order, serial))
    return np.exp(-half) * (1 + half + half**2 / 2)


def _bins(p: np.ndarray) -> np.ndarray:
    return np.minimum(BINS - 1, np.floor(-STEPS * np.log10(np.maximum(p, 1e-300)))).astype(int)


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """``(start, number of the kind, kind, end)`` of the exact kinds; a span is a whole match."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text)]
    return out + [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]


def _decoys(text: str, taken: list[tuple[int, int]], tokens: list[tuple[int, int]]) -> list[np.ndarray | None]:
    """A decoy per ``(length, encoding)``: the words outside of ``taken``, joined in camel case, piece after piece from the start.

    Letters that an alphabet has are written as themselves, in the other case where it has but that; others fold into it.
    """
    prose, at = [], 0
    for start, end in taken:
        prose.append(text[at:start])
        at = max(at, end)
    raw = np.frombuffer(" ".join([*prose, text[at:]]).encode("ascii", "replace").lower(), np.uint8)
    letter = (raw >= 97) & (raw <= 122)
    first = letter & ~np.concatenate([[False], letter[:-1]])
    words = np.where(first, raw - 32, raw)[letter]
    out, at = [], 0
    for n, k in tokens:
        if n > len(words):
            out.append(None)
            continue
        if at + n > len(words):
            at = 0
        piece = words[at:at + n]
        out.append(_WRITTEN[k, piece])
        at += n
    return out


def _stratum(kind: int, length: int) -> int:
    return kind * (len(LENGTHS) + 1) + sum(length >= e for e in LENGTHS)


_SPAN = pa.struct([("start", pa.int32()), ("order", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("stratum", pa.int32()), ("bin", pa.int32())])
_SPAN_SQL = "struct<start:int,order:int,kind:string,end:int,stratum:int,bin:int>"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, decoys, symbols, kinds, where = [], [], [], [], []
        for i, text in enumerate(batch.column(1)):
            text = text.as_py() or ""
            base = base_spans(text)
            spans = [(start, order, kind, end, -1, -1) for start, order, kind, end in base]
            tokens = [(m.start(), m.end(), k) for m in CANDIDATE.finditer(text) if (k := encoding(m[0])) >= 0]
            if tokens:
                covered = sorted([(s, e) for s, _, _, e in base] + [(s, e) for s, e, _ in tokens])
                own = _decoys(text, covered, [(e - s, k) for s, e, k in tokens])
                for (start, end, k), prose in zip(tokens, own):
                    free = not any(s < end and start < e for s, _, _, e in base)
                    where.append((i, start if free else -1, end))
                    symbols.append(INDEX[k, np.frombuffer(text[start:end].encode(), np.uint8)].astype(np.int64))
                    kinds.append(k)
                    if prose is not None:
                        where.append((i, None, end))
                        symbols.append(prose)
                        kinds.append(k)
            found.append(spans)
            decoys.append([])
        if symbols:
            lengths = np.array([len(s) for s in symbols])
            score = _bins(battery(np.concatenate(symbols), lengths, SIZES[kinds])).tolist()
            for (i, start, end), k, n, b in zip(where, kinds, lengths.tolist(), score):
                if start is None:
                    decoys[i].append(_stratum(k, n) * BINS + b)
                else:
                    # A candidate that meets a base span counts, under an order of its own, but is never returned.
                    found[i].append((start, len(KINDS) if start >= 0 else -1, RANDOM, end, _stratum(k, n), b))
        names = [f.name for f in _SPAN]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([[dict(zip(names, s)) for s in sorted(spans)] for spans in found], pa.list_(_SPAN)),
            pa.array(decoys, pa.list_(pa.int32()))], ["row", "found", "decoys"])


def limits(counts: list[tuple[int, int, int, int]], rate: float = RATE) -> dict[int, int]:
    """Highest accepted bin per stratum, from ``(stratum, bin, candidates, decoys)``; strata that accept none are left out."""
    tables: dict[int, np.ndarray] = {}
    for stratum, b, candidates, decoys in counts:
        tables.setdefault(stratum, np.zeros((2, BINS)))[:, b] += (candidates, decoys)
    out = {}
    for stratum, (candidates, decoys) in tables.items():
        if not candidates.sum() or not decoys.sum():
            continue
        # The share of words among the candidates, from where words score; all of them if the decoys do not score there.
        words = min(1.0, (candidates[WORDS:].sum() + 0.5) / candidates.sum() * decoys.sum() / (decoys[WORDS:].sum() + 0.5))
        false = words * candidates.sum() * (np.cumsum(decoys) + 1) / (decoys.sum() + 1)
        # What the battery itself rejects (p < 0.01) is not accepted, however few words a stratum has.
        fine = np.flatnonzero((false <= rate * np.maximum(np.cumsum(candidates), 1e-9))[:WORDS])
        if len(fine):
            out[stratum] = int(fine[-1])
    return out


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rate: float = RATE) -> DataFrame:
    """Per row of ``docs``: ``(row, n_assign, n_access, n_hex, base, spans)``.

    ``row`` is a struct of the columns ``keep`` (all but the text by default). ``base`` and ``spans`` are arrays of
    ``kind:start:end`` in code points, end exclusive, by start, then kind; ``spans`` also has the random tokens that pass the
    battery and meet no base span. A null or empty text has none; repeated rows are separate and count each; equal starts
    follow the order of the kinds; an empty table gives an empty result. ``rate`` bounds the expected share of words among the
    added tokens of a stratum.
    """
    others = keep if keep is not None else [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    judged = saved(rows.mapInArrow(_judge, f"row {rows.schema['row'].dataType.simpleString()}, found array<{_SPAN_SQL}>, decoys array<int>"))
    one, none = F.lit(1), F.lit(0)
    tokens = judged.select(F.explode(F.filter("found", lambda x: x["bin"] >= 0)).alias("s")).select(
        (F.col("s.stratum") * BINS + F.col("s.bin")).alias("cell"), one.alias("c"), none.alias("d"))
    prose = judged.select(F.explode("decoys").alias("cell")).select("cell", none.alias("c"), one.alias("d"))
    counts = tokens.unionByName(prose).groupBy("cell").agg(F.sum("c").alias("c"), F.sum("d").alias("d")).collect()
    allowed = limits([(*divmod(r["cell"], BINS), r["c"], r["d"]) for r in counts], rate)

    def passes(x: Column) -> Column:
        added = F.lit(False)
        for stratum, most in sorted(allowed.items()):
            added = added | ((x["stratum"] == stratum) & (x["bin"] <= most))
        return (x["bin"] < 0) | ((x["order"] >= 0) & added)

    def text_of(x: Column) -> Column:
        return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))

    def of(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return judged.select(
        "row", *map(of, KINDS), F.transform(F.filter("found", lambda x: x["bin"] < 0), text_of).alias("base"),
        F.transform(F.filter("found", passes), text_of).alias("spans"))
