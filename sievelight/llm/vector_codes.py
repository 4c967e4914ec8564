"""Vector code compression by Lloyd rounds over resident members.

A vector is cut into equal parts, one per position, and each position learns a codebook of its own. A part of a vector is
a member of the entry that it is nearest to, and lives in the partition that owns its (position, entry, salt). Per round
the owners sum their members, the sums of all salts give the new entries (a small table, positions x entries
x dimensions, the only thing that reaches the driver), and every member is judged against them where it lies. Members
that keep their entry stay in their partition; the others migrate in the round's one shuffle. Both halves have one
partitioner, so that their union is not dealt again.

The salt of a member never changes and its partition is ``position * salts + (salt + entry) mod salts``: an entry that
owns all members of a position still spreads evenly, and its members per partition are bounded.
Components are integers, so sums and distances are exact and do not depend on the order of rows or partitions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from sievelight.llm.tables import saved
from sievelight.operators.skew import attach_per_key
from sievelight.session import ensure_checkpoint_dir

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Members of a position per partition, rows in a row that share a salt, and rounds between two checkpoints.
RESIDENT_ROWS, SALT_ROWS, CUT_EVERY = 1 << 18, 4096, 3
#: Rows whose components stay below this are compared in float64, where all their distances are exact integers.
NARROW, MOST_DIMS, CHUNK = 1 << 20, 1024, 16384
LONGEST = (1 << 63) - 1


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of finite doubles: int64, or Python integers where one does not fit ``NARROW``."""
    scaled = np.floor(vectors * SCALE) if not vectors.size or np.abs(vectors).max() < NARROW else None
    if scaled is not None and (not scaled.size or np.abs(scaled).max() < NARROW):
        return scaled.astype(np.int64)
    out = np.empty(vectors.shape, object)
    for at, x in np.ndenumerate(vectors):
        x = float(x)
        out[at] = int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(x * SCALE)
    return out


def nearest(members: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the first of equally near ones, and the squared distance, both exact."""
    if not len(members):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    narrow = members.dtype != object and members.shape[1] <= MOST_DIMS and all(abs(c) <= NARROW for entry in book for c in entry)
    if not narrow:
        rows = [[sum((x - c) ** 2 for x, c in zip(row, entry)) for entry in book] for row in members.tolist()]
        best = [min(range(len(book)), key=row.__getitem__) for row in rows]
        return np.array(best, np.int64), np.array([row[b] for row, b in zip(rows, best)], object)
    entries = np.array(book, np.float64).reshape(len(book), members.shape[1])
    own = (entries**2).sum(1)
    index, distance = [], []
    for at in range(0, len(members), CHUNK):
        x = members[at:at + CHUNK].astype(np.float64)
        score = own - 2 * (x @ entries.T)
        best = score.argmin(1)
        index.append(best)
        distance.append((x**2).sum(1) + score[np.arange(len(x)), best])
    return np.concatenate(index), np.concatenate(distance).astype(np.int64)


def _stacked(blocks: list[np.ndarray]) -> np.ndarray:
    return blocks[0] if len(blocks) == 1 else np.concatenate(blocks)


def _packed(members: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds the members: what moves and rests is a quarter of int64, mostly."""
    if members.dtype == object:
        return members
    most = int(np.abs(members).max()) if members.size else 0
    return members.astype(np.int16 if most < 1 << 15 else np.int32)


def _parts(vectors: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    step = vectors.shape[1] // parts
    return (vectors[:, p * step:(p + 1) * step] for p in range(parts))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _deal(books: list[list[list[int]]], salts: int):
    """Members by owner, from the vectors of one task."""
    def run(task: int, blocks: Iterator[np.ndarray]) -> Iterator[tuple[tuple[int, int, int], np.ndarray]]:
        seen = 0
        for block in blocks:
            vectors = integers(block)
            for at in range(0, len(vectors), SALT_ROWS):
                salt = (task + (seen + at) // SALT_ROWS) % salts
                for p, members in enumerate(_parts(vectors[at:at + SALT_ROWS], len(books))):
                    entry = nearest(members, books[p])[0]
                    for e in np.unique(entry).tolist():
                        yield (p, e, salt), _packed(members[entry == e])
            seen += len(vectors)

    return run


def _settle(books: list[list[list[int]]]):
    """Judge the members of a partition against the entries: ``(moves, owner, members)``."""
    def run(records: Iterator[tuple[tuple[int, int, int], np.ndarray]]) -> Iterator[tuple[bool, tuple[int, int, int], np.ndarray]]:
        residents: dict[tuple[int, int, int], list[np.ndarray]] = {}
        for owner, members in records:
            # Members with large components rest apart, so that one of them does not slow down the others.
            residents.setdefault((*owner, members.dtype == object), []).append(members)
        for (p, e, s, _), blocks in residents.items():
            members = _stacked(blocks)
            entry = nearest(members, books[p])[0]
            for now in np.unique(entry).tolist():
                yield now != e, (p, now, s), members[entry == now]

    return run


def _sums(entries: int):
    """Sum and number of the resident members, per position and entry, as exact integers."""
    def run(records: Iterator[tuple[tuple[int, int, int], np.ndarray]]) -> Iterator[tuple[int, tuple[list[int], int]]]:
        totals: dict[int, tuple[list[int], int]] = {}
        for (p, e, _), members in records:
            own = members.sum(0) if members.dtype == object else members.sum(0, dtype=np.int64)
            totals[p * entries + e] = _added(totals.get(p * entries + e), (own.tolist(), len(members)))
        yield from totals.items()

    return run


def _added(a, b):
    return b if a is None else ([x + y for x, y in zip(a[0], b[0])], a[1] + b[1])


def _blocks(df: DataFrame, column: str, dims: int) -> RDD:
    """The vectors as matrices of doubles, one RDD element per Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_matrix(batch.column(0), dims).tobytes()], pa.binary())], ["block"])

    return df.select(column).mapInArrow(run, "block binary").rdd.map(lambda row: np.frombuffer(row["block"]).reshape(-1, dims))


def train(
    vectors: DataFrame, column: str, dims: int, books: list[list[list[int]]], rows: int, rounds: int = ROUNDS,
    resident_rows: int = RESIDENT_ROWS, on_round: Callable[[int, RDD], None] | None = None,
) -> list[list[list[int]]]:
    """The codebooks after ``rounds``, from the first ones; ``on_round(number, moved members)`` may watch the migration."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    parts, entries = len(books), len(books[0])
    salts = max(-(-rows // resident_rows), -(-spark.sparkContext.defaultParallelism // parts))
    owners = parts * salts

    def owner(key: tuple[int, int, int]) -> int:
        return key[0] * salts + (key[2] + key[1]) % salts

    deal = _deal(books, salts)
    state = _blocks(vectors, column, dims).mapPartitionsWithIndex(deal).partitionBy(owners, owner)
    held: list[RDD] = []
    for turn in range(rounds):
        totals = dict(state.mapPartitions(_sums(entries)).reduceByKey(_added, parts).collect())
        for before in held[:-1]:
            before.unpersist()
        held = held[-1:]
        books = [[
            [x // totals[p * entries + e][1] for x in totals[p * entries + e][0]] if p * entries + e in totals else entry
            for e, entry in enumerate(book)] for p, book in enumerate(books)]
        if turn == rounds - 1:
            break
        judged = state.mapPartitions(_settle(books), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % CUT_EVERY == CUT_EVERY - 1:
            judged.checkpoint()
        held.append(judged)
        moved = judged.filter(lambda x: x[0]).map(lambda x: x[1:])
        if on_round:
            on_round(turn, moved)
        stays = judged.filter(lambda x: not x[0]).map(lambda x: x[1:], preservesPartitioning=True)
        state = stays.union(moved.partitionBy(owners, owner))
    for last in held:
        last.unpersist()
    return books


def _encode(books: list[list[list[int]]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.array(batch.column(2).to_pylist(), bool)
            codes, errors = np.full(len(fits), None, object), np.full(len(fits), None, object)
            if fits.any():
                vectors = integers(_matrix(batch.column(1).filter(pa.array(fits)), dims))
                digits, total = np.zeros((len(vectors), len(books)), np.uint8), np.zeros(len(vectors), object)
                for p, members in enumerate(_parts(vectors, len(books))):
                    digits[:, p], distance = nearest(members, books[p])
                    total += distance.astype(object)
                codes[fits], errors[fits] = [x.tobytes().hex() for x in digits], [min(x, LONGEST) for x in total]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes.tolist(), pa.string()), pa.array(errors.tolist(), pa.int64())], ["row", "code", "error"])

    return run


def book_text(books: list[list[list[int]]]) -> str:
    """All components in decimal, by position, entry and place, joined by commas."""
    return ",".join(str(x) for book in books for entry in book for x in entry)


def compress(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, resident_rows: int = RESIDENT_ROWS,
) -> DataFrame:
    """``(row, code, error, label_error, codebooks_sha256)``; ``row`` is a struct of all columns of ``df``.

    Rows whose vector is null, or holds a null, NaN or infinity, are left out. The codebooks start with the ``entries`` rows of
    smallest id (null ids last; rows of equal id by their vector); of fewer rows, each makes one entry. The table's dimension
    is the length of most kept vectors that ``parts`` divides, the shorter of two that tie; a vector of any other length, the empty one
    included, teaches nothing, and its code and error are null. Repeated rows are separate members. Rows of equal labels share a
    ``label_error``, those of a null label too. Errors beyond the range of a long are given as its largest
    value. An empty table gives an empty result.
    """
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    kept = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    size = F.size("vector")
    common = kept.where((size > 0) & (size % parts == 0)).groupBy(size.alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims, rows = (common["dims"], common["count"]) if common else (0, 0)
    books: list[list[list[int]]] = []
    if rows:
        usable = kept.where(size == dims)
        first = usable.orderBy(F.col(f"row.`{id_col}`").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
        start = integers(np.array([r["vector"] for r in first], np.float64))
        books = [p.tolist() for p in _parts(start, parts)]
        books = train(usable, "vector", dims, books, rows, rounds, resident_rows)
    coded = saved(
        kept.select("row", "vector", ((size == dims) & F.lit(rows > 0)).alias("fits"))
        .mapInArrow(_encode(books, dims), f"row {kept.schema['row'].dataType.simpleString()}, code string, error long")
        .select("*", F.monotonically_increasing_id().alias("uid"), *_label(f"row.`{label_col}`")))
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy("no_label", "label").agg(
        F.when(exact > LONGEST, F.lit(LONGEST)).otherwise(exact.cast("long")).alias("label_error"), F.count("*").alias("n"))
    return attach_per_key(coded, totals, ["no_label", "label"], "n", ["uid"]).select(
        "row", "code", "error", "label_error", F.lit(hashlib.sha256(book_text(books).encode()).hexdigest()).alias("codebooks_sha256"))


def _label(name: str):
    """A label as two columns that are equal where labels are, null ones included."""
    text = F.col(name).cast("string")
    return text.isNull().alias("no_label"), F.coalesce(text, F.lit("")).alias("label")
