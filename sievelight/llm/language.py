"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all labelled training rows. The weights are fitted on the driver from a bounded sample
(``SAMPLE`` rows, an equal share per language, chosen by hash) with follow-the-regularised-leader and an
elastic-net penalty, which leaves most weights at zero; a temperature is then calibrated on rows the weights did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.llm.shingles import mix, steps, text_bytes

#: Hashed n-gram features, lengths of n-grams, labelled rows in the fitted sample.
BUCKETS, ORDERS, SAMPLE = 1 << 15, (1, 2, 3), 1500
#: FTRL: learning rate, smoothing, L1 and L2 penalties, passes over the sample; scale of the features.
ALPHA, BETA, L1, L2, EPOCHS, SCALE = 0.5, 1.0, 0.02, 0.02, 4, 8.0
UNKNOWN = "und"
_LIMIT = 1 << 18


def _fold_table() -> np.ndarray:
    """Code point -> lower-cased letter, or 32 for anything that is not a letter (BMP; beyond it, letters stay)."""
    table = np.full(0x10000, 32, np.uint32)
    for i in range(0x10000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


_CACHE: dict[str, np.ndarray] = {}


def ngrams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of rows: (first row, end row, bucket of every n-gram, row of every n-gram). Spaces pad each text."""
    if "fold" not in _CACHE:
        _CACHE["fold"] = _fold_table()
    fold = _CACHE["fold"]
    data, offsets = text_bytes(column)
    for low, high in steps(offsets, _LIMIT):
        own = offsets[low:high + 1]
        raw = data[own[0]:own[-1]]
        if not len(raw):
            yield low, high, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        ends = first[own - own[0]]
        folded = np.where(points < 0x10000, fold[np.minimum(points, 0xFFFF)], points)
        rows = np.repeat(np.arange(high - low), np.diff(ends))
        # A space on both sides of each text.
        chars = np.full(len(folded) + 2 * (high - low), 32, np.uint32)
        at = np.arange(len(folded)) + 2 * rows + 1
        chars[at] = folded
        owner = np.repeat(np.arange(high - low), np.diff(ends) + 2)
        buckets, owners = [], []
        for n in ORDERS:
            h = np.zeros(len(chars) - n + 1, np.uint64)
            blank = np.ones(len(h), bool)
            for i in range(n):
                c = chars[i:i + len(h)]
                h = h * np.uint64(1_000_003) + c
                blank &= c == 32
            if n == 3:
                blank |= chars[1:1 + len(h)] == 32  # the middle of a trigram is a letter
            keep = ~blank & (owner[:len(h)] == owner[n - 1:])
            buckets.append((mix(h[keep], n) >> np.uint64(64 - 15)).astype(np.int64))
            owners.append(owner[:len(h)][keep])
        yield low, high, np.concatenate(buckets), np.concatenate(owners) + low


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(BUCKETS, np.int64), 0
    seen = np.zeros(BUCKETS, bool)
    for batch in batches:
        docs += batch.num_rows
        for low, high, bucket, row in ngrams(batch.column(0)):
            by = np.argsort(row, kind="stable")
            bucket, ends = bucket[by], np.cumsum(np.bincount(row - low, minlength=high - low))
            for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
                seen[:] = False
                seen[bucket[a:b]] = True
                total += seen
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(total[used], docs))], ["bucket", "docs"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of every row: two arrays of up to BUCKETS entries."""
    for batch in batches:
        index, count = [], []
        for low, high, bucket, row in ngrams(batch.column(1)):
            for i in range(low, high):
                b, c = np.unique(bucket[row == i], return_counts=True)
                index.append(b)
                count.append(c)
        for i in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(i, 1), pa.array([index[i].astype(np.int32)], pa.list_(pa.int32())),
                pa.array([count[i].astype(np.int32)], pa.list_(pa.int32()))], ["lang", "index", "count"])


@dataclass
class Model:
    """Languages in order, ``weights[bucket, language]`` (with the IDF folded in), biases, temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net on ``(class, indices, values)``; the last coordinate is the bias."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            label, i, x = rows[k]
            w = weights(i)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    every = np.arange(BUCKETS + 1)
    w = weights(every)
    return w[:-1], w[-1]


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, sample: int = SAMPLE) -> Model | None:
    """A model from the rows with a language and a text; None when there are none.

    ``sample`` bounds the rows that the weights see (at least one per language is kept).
    """
    rows = train.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        (key if key is not None else F.xxhash64(text_col)).alias("k")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    df = {r["bucket"]: r["docs"] for r in rows.select("text").mapInArrow(
        _document_frequency, "bucket int, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).collect()}
    total = df.pop(-1, 0)
    idf = np.full(BUCKETS, np.log1p(total))
    for b, n in df.items():
        idf[b] = np.log((1 + total) / (1 + n)) + 1
    each = max(1, sample // len(languages))
    order = Window.partitionBy("lang").orderBy("k")
    # A hash threshold leaves about four times the share of a language; the exact choice is made among these.
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, min(1.0, 4 * each / sizes[name])).otherwise(share)
    near = F.shiftrightunsigned("k", 1) <= share * float(1 << 63)
    picked = rows.where(near).select("lang", "k").withColumn("r", F.row_number().over(order)).where(F.col("r") <= each).select("lang", "k").distinct()
    # At most ``sample`` keys (or one per language): bounded whatever the corpus.
    chosen = rows.join(F.broadcast(picked), ["lang", "k"], "left_semi").dropDuplicates(["lang", "k"])
    data = []
    for r in chosen.select("lang", "text", "k").orderBy("k", "lang").select("lang", "text").mapInArrow(
            _sparse, "lang string, index array<int>, count array<int>").toLocalIterator():
        i, c = np.array(r["index"], np.int64), np.array(r["count"], float)
        if len(i):
            data.append((languages.index(r["lang"]), np.append(i, BUCKETS), np.append(c / c.sum() * idf[i] * SCALE, 0.1)))
    held = [x for j, x in enumerate(data) if j % 5 == 4]
    w, bias = fit_ftrl([x for j, x in enumerate(data) if j % 5 != 4] or data, len(languages))
    full = np.vstack([w, bias[None, :]])
    temperature = 1.0
    if held:
        logits = np.array([x @ full[i] for _, i, x in held])
        gold = np.array([y for y, _, _ in held])
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
        losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(gold)), gold], 1e-9)).mean() for t in grid]
        temperature = float(grid[int(np.argmin(losses))])
    return Model(languages, (w * idf[:, None] * SCALE).astype(np.float32), (bias * 0.1).astype(np.float32), temperature)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            logits = np.zeros((batch.num_rows, len(m.languages)))
            counts = np.zeros(batch.num_rows)
            for low, high, bucket, row in ngrams(batch.column(1)):
                counts[low:high] = np.bincount(row - low, minlength=high - low)
                for c in range(len(m.languages)):
                    logits[low:high, c] = np.bincount(row - low, m.weights[:, c][bucket], high - low)
            p = _softmax((logits / np.maximum(counts, 1)[:, None] + m.bias) / m.temperature)
            best = p.argmax(axis=1)
            known = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([m.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)]),
                pa.array([float(s) if k else 0.0 for s, k in zip(p.max(axis=1), known)])], ["row", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, lang_pred, score)`` of every row; ``row`` is a struct of the columns ``keep`` (all by default).

    The whole text is read, and nothing but the text. ``und`` with score 0 if the text is null or has no letter
    (or nothing could be learned); ties go to the first language in order. Repeated rows get equal answers.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)])
    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(row.alias("row"), F.col(text_col).alias("text"), known.alias("known"))
    if model is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), schema)


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Train on the labelled rows that are not held out and predict all rows: ``(row, lang_pred, score)``.

    Rows without id, text or language are not learned from. An empty table gives an empty result.
    """
    train = docs.where(F.col(id_col).isNotNull() & ~is_held_out(id_col))
    key = F.xxhash64(F.lit(3), F.col(id_col), F.col(text_col))
    return predict(docs, fit(train, text_col, lang_col, key), text_col, keep)
