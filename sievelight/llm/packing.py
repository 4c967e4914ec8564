"""Best-fit-decreasing sequence packing, certified by dual-feasible functions.

Documents are tokenised once and cut into pieces; full pieces are sequences of their own. The others are
dealt by hash to partitions of bounded size and packed there, longest first, each into the fullest bin that
still takes it. A dual-feasible function f bounds the bins of any packing by ``sum f(length) / f(capacity)``; a
partition that needs no more bins than its best bound is certified and final. Partitions with a gap keep their full
bins and give the documents of the others into a common exchange: these are dealt anew to fewer partitions and
packed again, until no gap or one partition is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievelight.llm.tables import saved

CAPACITY = 2048
#: Pieces of a partition, on average, and rounds of exchange.
PARTITION_ROWS, ROUNDS = 20_000, 6
_ENCODERS: dict[tuple, tuple] = {}


def _encoders(tokenizer: str, ranks: str | None):
    """The tokenizer, and a faster encoder of the same vocabulary where its ranks are given."""
    if (tokenizer, ranks) not in _ENCODERS:
        from tokenizers import Tokenizer

        fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        full = Tokenizer.from_file(tokenizer)
        special = [t.content for t in full.get_added_tokens_decoder().values()]
        _ENCODERS[tokenizer, ranks] = full, fast, special
    return _ENCODERS[tokenizer, ranks]


def _cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _pieces(tokenizer: str, ranks: str | None, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        full, fast, special = _encoders(tokenizer, ranks)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            index, out = [], [[], [], [], [], []]
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                if fast is None or any(s in text for s in special):
                    ids = full.encode(text, add_special_tokens=False).ids
                else:
                    ids = fast.encode_ordinary(text)
                ids = np.array([*ids, end], "<u4")
                for k, (start, length) in enumerate(_cut(len(ids), capacity)):
                    index.append(i)
                    for column, value in zip(out, (uid, k, start, length, zlib.crc32(ids[start:start + length].tobytes()))):
                        column.append(value)
                    uid += 1
            uids, piece, start, length, crc = out
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(index, pa.int64())), pa.array(uids, pa.int64()), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["row", "uid", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of every item, and the free space of every bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free: list[int] = []
    mask = 0  # bit r: some bin has r free
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            b = open_bins[space].pop()
            if not open_bins[space]:
                mask ^= 1 << space
        else:
            b, space = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        space -= length
        free[b] = space
        if space:
            if not open_bins[space]:
                mask |= 1 << space
            open_bins[space].append(b)
    return bins, offsets, np.array(free, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    size, count = np.unique(lengths, return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    # Items over capacity - e count whole, items under e not at all.
    small = np.concatenate([[0], np.cumsum(size * count)])
    number = np.concatenate([[0], np.cumsum(count)])
    for e in np.unique(np.minimum(size, capacity - size))[np.newaxis].ravel().tolist():
        if 0 < e <= capacity // 2:
            low, high = np.searchsorted(size, e, "left"), np.searchsorted(size, capacity - e, "right")
            total = int(small[high] - small[low]) + capacity * int(number[-1] - number[high])
            best = max(best, -(-total // capacity))
    # Rounding to k-ths: x (k+1)/capacity whole stays x, else floor((k+1) x / capacity) / k of the capacity.
    for k in range(1, 33):
        scaled = size * (k + 1)
        value = np.where(scaled % capacity == 0, k * size, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return int(best)


def _pack_partition(capacity: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        lengths = rows["length"].to_numpy()
        bins, offsets, free = best_fit(lengths, capacity)
        sure = len(free) <= lower_bound(lengths, capacity)
        return pd.DataFrame({
            "uid": rows["uid"].to_numpy(), "length": lengths, "part": np.int64(key[0]), "bin": bins, "offset": offsets,
            "certified": sure, "full": free[bins] == 0})

    return run


def assign(items: DataFrame, capacity: int = CAPACITY, partition_rows: int = PARTITION_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """``(uid, sequence_id, offset, certified)`` for ``items(uid, length)`` with lengths of 1 to ``capacity``."""
    alone = items.where(F.col("length") == capacity).select(
        "uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    done, pool = [alone], saved(items.where(F.col("length") < capacity).select("uid", "length"))
    parts = None
    for turn in range(rounds):
        wanted = -(-pool.count() // partition_rows)
        parts = max(1, wanted if parts is None else min(wanted, (parts + 1) // 2))
        packed = saved(
            pool.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "uid"), F.lit(parts)))
            .groupBy("part").applyInPandas(
                _pack_partition(capacity), "uid long, length long, part long, bin long, offset long, certified boolean, full boolean"))
        last = parts == 1 or turn == rounds - 1
        stays = packed if last else packed.where("certified or full")
        name = F.lit(turn << 56) + F.shiftleft("part", 24) + F.col("bin")
        done.append(stays.select("uid", name.alias("sequence_id"), "offset", "certified"))
        if last:
            break
        pool = packed.where("not certified and not full").select("uid", "length")
        if pool.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack(
    docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, ranks: str | None = None, end: int = 0,
    capacity: int = CAPACITY, keep: list[str] | None = None,
) -> DataFrame:
    """One row per piece: ``(row, piece, start, length, ids_crc32, sequence_id, offset, certified)``.

    ``row`` is a struct of the columns ``keep`` (all but the text by default). A document's ids are those of its whole
    text followed by ``end``; a null text is empty, so each row has one piece at least. Repeated rows are
    separate documents. Only documents of more than ``capacity`` ids are cut; the first piece takes the remainder.
    ``tokenizer`` is the path of a tokenizers file, ``ranks`` that of the same vocabulary for the faster encoder (by default
    the public byte-level vocabulary in both forms); texts that hold a special token's string go to the first.
    An empty table gives an empty result.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    others = keep if keep is not None else [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text_col).alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, uid long, piece int, start long, length long, ids_crc32 long"
    pieces = saved(rows.mapInArrow(_pieces(tokenizer, ranks, end, capacity), schema))
    return pieces.join(assign(pieces, capacity), "uid").select(
        "row", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")
