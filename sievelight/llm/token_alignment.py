"""Alignment of two tokenizers, with corpus-wide pair counts by external spill counting.

Both encodings of a text cover the same bytes, so the union of their token ends cuts these into segments that each
belong to one token of either side: the segments are the links. Every link is a pair-document record. A task keeps
records in a buffer; when it is full they are sorted by pair, second tokenizer (side B) first, and radix-partitioned by
the B id into runs: a head of distinct pairs with their sums and a body of documents and counts, both compressed. The runs are
written as a table. A merge per partition walks the heads with a heap of chunk ends and sums equal pairs; the
order by side B yields the highest count of each B id when its last pair has passed. Then every run is read once more,
beside the counts, and streams what its links contribute back to its documents.

No id makes a group of its own. A partition whose records exceed ``GROUP_RECORDS`` is dealt, run by run, to as many salts as
it takes; their merged heads are merged once more. What is gathered per radix partition is distinct pairs of ids, so
that the vocabularies bound it, not the corpus.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from sievelight.llm.tables import saved

#: Radix partitions, records that fill a task's buffer, and records of a group of runs.
RADIX, BUFFER_RECORDS, GROUP_RECORDS = 16, 2_000_000, 16_000_000
#: Distinct pairs that the merge takes from a run at a time.
MERGE_CHUNK = 65_536
#: A pair is one integer: radix, B id, A id.
ID_BITS = 24
_ID = (1 << ID_BITS) - 1
_ENCODERS: dict[tuple[str, str], tuple] = {}


def _encoders(ranks: str, pieces: str):
    """The two tokenizers, the bytes of every id of side B, and how many each id has."""
    if (ranks, pieces) not in _ENCODERS:
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        first = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        a_sizes = np.zeros(max(table.values()) + 1, np.int64)
        a_sizes[list(table.values())] = [len(token) for token in table]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, second.id_to_piece(i)) for i in range(second.vocab_size()))]
        _ENCODERS[ranks, pieces] = first, second, b_bytes, a_sizes, np.array([len(x) for x in b_bytes], np.int64)
    return _ENCODERS[ranks, pieces]


def _aligned(text: str, encoders: tuple) -> tuple[np.ndarray, ...]:
    """Ids of both sides; per link the place of its tokens; per group the number of tokens before its end. Empty if bytes differ."""
    first, second, b_bytes, a_sizes, b_sizes = encoders
    none = np.zeros(0, np.int64)
    if not text:
        return none, none, none, none, none, none
    whole = " " + text
    octets, spelled = whole.encode(), second.encode(text, num_threads=1)
    # Side A has all bytes and drops none, so its tokens always spell the text.
    if b"".join(map(b_bytes.__getitem__, spelled)) != octets:
        return none, none, none, none, none, none
    a, b = first.encode_to_numpy(whole, disallowed_special=()).astype(np.int64), np.array(spelled, np.int64)
    # Ends as flags per byte: their running counts give the token of each segment and the tokens before each common end.
    a_ends, b_ends = np.zeros((2, len(octets) + 1), bool)
    a_ends[a_sizes[a].cumsum()], b_ends[b_sizes[b].cumsum()] = True, True
    a_before, b_before = a_ends.cumsum(), b_ends.cumsum()
    ends, common = np.flatnonzero(a_ends | b_ends), np.flatnonzero(a_ends & b_ends)
    return a, b, a_before[ends - 1], b_before[ends - 1], a_before[common], b_before[common]


def _groups_sha(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> str:
    parts, i, j = [], 0, 0
    a_text, b_text = [str(x) for x in a.tolist()], [str(x) for x in b.tolist()]
    for m, n in zip(a_cuts.tolist(), b_cuts.tolist()):
        if m - i == 1 == n - j:
            parts.append(a_text[i] + "|" + b_text[j])
        else:
            parts.append(",".join(a_text[i:m]) + "|" + ",".join(b_text[j:n]))
        i, j = m, n
    return hashlib.sha256(";".join(parts).encode()).hexdigest()


def _zip(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in arrays))


def _unzip(block: bytes, *kinds: tuple[int, str]) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(block), [], 0
    for n, kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _runs(pairs: list[np.ndarray], docs: list[np.ndarray], first: int, count: int) -> Iterator[tuple]:
    """The buffer's records as one run per radix partition that has any."""
    if not pairs:
        return
    key, doc = np.concatenate(pairs), np.concatenate(docs)
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]))
    times = np.diff(np.append(starts, len(key))).astype(np.int32)
    key, doc = key[starts], doc[starts]
    edges = np.searchsorted(key >> 2 * ID_BITS, np.arange(RADIX + 1))
    for radix in range(RADIX):
        low, high = edges[radix], edges[radix + 1]
        if low == high:
            continue
        own, n = key[low:high], times[low:high]
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        yield (radix, first, count, len(heads), high - low, int(n.sum()),
               _zip(own[heads], np.diff(np.append(heads, len(own))).astype(np.int32), np.add.reduceat(n, heads, dtype=np.int64)),
               _zip(doc[low:high], n))


def _encode(ranks: str, pieces: str, buffer_records: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoders = _encoders(ranks, pieces)
        uid = TaskContext.get().partitionId() << 33
        pairs, docs, held, first = [], [], 0, uid
        schema = None
        for batch in batches:
            schema = batch.schema.field(0).type
            rows = [[], [], [], [], [], []]
            for text in batch.column(1):
                a, b, a_at, b_at, a_cuts, b_cuts = _aligned(text.as_py() or "", encoders)
                for column, value in zip(rows, (uid, len(a), len(b), len(a_cuts), len(a_at), _groups_sha(a, b, a_cuts, b_cuts) if len(a) else "")):
                    column.append(value)
                if len(a):
                    a_ids, b_ids = a[a_at], b[b_at]
                    pairs.append((b_ids % RADIX) << 2 * ID_BITS | b_ids << ID_BITS | a_ids)
                    docs.append(np.full(len(a_at), uid - first, np.int32))
                    held += len(a_at)
                uid += 1
                if held >= buffer_records:
                    yield _run_batch(list(_runs(pairs, docs, first, uid - first)), schema)
                    pairs, docs, held, first = [], [], 0, uid
            yield _doc_batch(batch.column(0), rows)
        if pairs:
            yield _run_batch(list(_runs(pairs, docs, first, uid - first)), schema)

    return run


_RUN_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
_RUN_NAMES = ["radix", "first_uid", "docs", "pairs", "records", "links", "head", "body"]
_DOC_TYPES = [pa.int64()] * 5 + [pa.string()]
_DOC_NAMES = ["uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _doc_batch(row: pa.Array, columns: list[list]) -> pa.RecordBatch:
    n = len(row)
    return pa.RecordBatch.from_arrays(
        [row, *[pa.array(c, t) for c, t in zip(columns, _DOC_TYPES)], *[pa.nulls(n, t) for t in _RUN_TYPES]], ["row", *_DOC_NAMES, *_RUN_NAMES])


def _run_batch(runs: list[tuple], row: pa.DataType) -> pa.RecordBatch:
    n = len(runs)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, row), *[pa.nulls(n, t) for t in _DOC_TYPES], *[pa.array(c, t) for c, t in zip(zip(*runs), _RUN_TYPES)]],
        ["row", *_DOC_NAMES, *_RUN_NAMES])


def merged(runs: list[tuple[np.ndarray, np.ndarray]], chunk: int = MERGE_CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted ``(pairs, counts)``: blocks in order, each pair once with its sum.

    The heap holds the end of every run's chunk. All pairs up to the least end are complete, whichever run they are in.
    """
    at = [0] * len(runs)

    def end(i: int) -> int:
        return int(runs[i][0][min(at[i] + chunk, len(runs[i][0])) - 1])

    heap = [(end(i), i) for i in range(len(runs)) if len(runs[i][0])]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        taken = []
        for _, i in heap:
            stop = int(np.searchsorted(runs[i][0][at[i]:at[i] + chunk], bound, "right")) + at[i]
            taken.append((runs[i][0][at[i]:stop], runs[i][1][at[i]:stop]))
            at[i] = stop
        # A run whose chunk is used up brings its next one; the others keep theirs.
        while heap and heap[0][0] <= bound:
            _, i = heapq.heappop(heap)
            if at[i] < len(runs[i][0]):
                heapq.heappush(heap, (end(i), i))
        keys, place = np.unique(np.concatenate([k for k, _ in taken]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, place, np.concatenate([c for _, c in taken]))
        yield keys, sums


def _heads(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for n, head in zip(table.column("pairs").to_pylist(), table.column("head")):
        keys, _, sums = _unzip(head.as_py(), (n, "<i8"), (n, "<i4"), (n, "<i8"))
        out.append((keys, sums))
    return out


def _count(table: pa.Table) -> pa.Table:
    """The distinct pairs of a group of runs with their counts, as one sorted block."""
    blocks = list(merged(_heads(table)))
    keys, sums = np.concatenate([k for k, _ in blocks]), np.concatenate([c for _, c in blocks])
    return pa.table({
        "radix": table.column("radix")[:1], "salts": table.column("salts")[:1], "pairs": pa.array([len(keys)], pa.int32()),
        "counts": pa.array([_zip(keys, sums)], pa.binary())})


def _total(table: pa.Table) -> pa.Table:
    """The counts of a radix partition from those of its salts, and whether each is its B id's highest: one row per salt."""
    salted = [tuple(_unzip(x.as_py(), (n, "<i8"), (n, "<i8"))) for n, x in zip(table.column("pairs").to_pylist(), table.column("counts"))]
    blocks = list(merged(salted))
    keys, sums = np.concatenate([k for k, _ in blocks]), np.concatenate([c for _, c in blocks])
    side = keys >> ID_BITS
    starts = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    highest = np.maximum.reduceat(sums, starts)
    best = sums == np.repeat(highest, np.diff(np.append(starts, len(side))))
    salts = table.column("salts")[0].as_py()
    block = _zip(keys, sums, best.astype(np.int8))
    return pa.table({
        "radix": pa.array([table.column("radix")[0].as_py()] * salts, pa.int32()), "salt": pa.array(range(salts), pa.int32()),
        "pairs": pa.array([len(keys)] * salts, pa.int32()), "totals": pa.array([block] * salts, pa.binary())})


def _contribute(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """Per run and document that it holds: links of highest pairs, and the sum of the counts over its links."""
    out = [[], [], []]
    if runs.num_rows and totals.num_rows:
        n = totals.column("pairs")[0].as_py()
        keys, counts, best = _unzip(totals.column("totals")[0].as_py(), (n, "<i8"), (n, "<i8"), (n, "<i1"))
        for run in runs.select(["first_uid", "docs", "pairs", "records", "head", "body"]).to_batches():
            for first, docs, pairs, records, head, body in zip(*(c.to_pylist() for c in run.columns)):
                own, lengths, _ = _unzip(head, (pairs, "<i8"), (pairs, "<i4"), (pairs, "<i8"))
                doc, times = _unzip(body, (records, "<i4"), (records, "<i4"))
                place = np.repeat(np.searchsorted(keys, own), lengths)
                n_best, total = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
                np.add.at(n_best, doc, times * best[place].astype(np.int64))
                np.add.at(total, doc, times * counts[place])
                held = np.flatnonzero(total)
                for column, value in zip(out, (held + first, n_best[held], total[held])):
                    column.append(value)
    return pa.table({name: pa.array(np.concatenate(x) if x else [], pa.int64()) for name, x in zip(("uid", "n_best", "count_sum"), out)})


def align(
    docs: DataFrame, text_col: str = "text", ranks: str | None = None, pieces: str | None = None, keep: list[str] | None = None,
    buffer_records: int = BUFFER_RECORDS, group_records: int = GROUP_RECORDS,
) -> DataFrame:
    """``(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of ``docs``.

    ``row`` is a struct of the columns ``keep`` (all but the text by default). Side A encodes a space and the text by the ranks
    file ``ranks``, side B the text by the sentencepiece model ``pieces`` (by default the public byte-level vocabulary and
    the public pieces); strings of special tokens are plain text. A text that is null, empty, or whose tokens do not spell a
    space and the text on both sides has zeros and an empty digest, and takes no part in the counts. Repeated rows
    count each. All pairs that share a B id's highest count are its best. An empty table gives an empty result.
    """
    if ranks is None or pieces is None:
        import public_tokenizers

        ranks, pieces = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pieces or public_tokenizers.path("piece_bpe_32k.model")
    others = keep if keep is not None else [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    schema = (f"row {rows.schema['row'].dataType.simpleString()}, uid long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, radix int, first_uid long, docs int, pairs int, records int, links long, head binary, body binary")
    table = saved(rows.mapInArrow(_encode(ranks, pieces, buffer_records), schema))
    runs = table.where("radix is not null").select(*_RUN_NAMES)
    # One row per radix partition: how many salts hold its records.
    sizes = runs.groupBy("radix").agg(F.sum(F.col("records").cast("long")).alias("n")).collect()
    salts = {r["radix"]: max(1, -(-r["n"] // group_records)) for r in sizes}
    number = F.coalesce(*[F.when(F.col("radix") == r, n) for r, n in sorted(salts.items())], F.lit(1))
    runs = runs.withColumn("salts", number.cast("int")).withColumn("salt", F.pmod(F.xxhash64("first_uid"), F.col("salts")).cast("int"))
    counted = runs.select("radix", "salt", "salts", "pairs", "head").groupBy("radix", "salt").applyInArrow(
        _count, "radix int, salts int, pairs int, counts binary")
    totals = counted.groupBy("radix").applyInArrow(_total, "radix int, salt int, pairs int, totals binary")
    parts = runs.groupBy("radix", "salt").cogroup(totals.groupBy("radix", "salt")).applyInArrow(
        _contribute, "uid long, n_best long, count_sum long")
    sums = parts.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return table.where("radix is null").select("row", *_DOC_NAMES).join(sums, "uid", "left").select(
        "row", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
