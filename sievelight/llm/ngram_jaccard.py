"""Near-duplicate documents by a Jaccard self-join on word shingles with token-combination prefixes.

Tokens are the distinct shingles of a document. Of two sets of similarity t or more at most ``e = n - ceil(t n)``
tokens of either miss in the other. Nodes are distinct sets, so copies never form pairs. The steps:

1. Counting. Prefixes of ``e + 1 + x`` tokens in hash order, ``x = max(1, ceil(n / 10))``, share at least ``x + 1`` tokens.
   Sets with fewer prefix tokens that other sets have too leave: most texts, also those that share a passage.
2. Order. Over all tokens of the sets that stay, the number of sets with each token is counted exactly. Sets of which
   under ``ceil(t n)`` tokens occur elsewhere leave; the others order their tokens from rare to frequent.
3. Index. Tokens of up to ``RARE`` sets are rare and indexed singly. Frequent ones are dealt into classes by hash and
   indexed as pairs within a class. The prefix is extended until the rare tokens plus, per class, the tokens
   beyond the first exceed ``e``; then similar sets share a rare token or a pair. The number of classes
   follows the set size in bands of a factor of 4 (sets near a band's end are indexed in the next band, too).
4. Verification. Sets that share index entries form small clusters (found with one link per entry, never with all pairs).
   The members of a cluster are compared in blocks of bounded size by a product of their token matrices, which returns
   the links of a spanning forest and, per set, the number of documents linked to it in that block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sievelight.llm.components import components
from sievelight.llm.shingles import mix, shingle_sets
from sievelight.llm.tables import saved

#: Sets that may share a token that is indexed singly.
RARE = 16
#: Sets of up to this size index single tokens only (pairs need some slack in the prefix).
SMALL = 10
#: Members of a block of a cluster, columns of a token matrix, rows of a token in a task's buffer that make it hot.
BLOCK, COLUMNS, HOT = 256, 4096, 32
#: Bits of the filter of remaining sets, at most (8 MB); false positives only cost transport.
FILTER_BITS = 1 << 26


def _key(tokens: np.ndarray) -> int:
    """Identity of a set: a 64-bit hash of its tokens and size."""
    return int(mix(np.array([np.bitwise_xor.reduce(mix(tokens, 11)) + np.uint64(len(tokens))], np.uint64), 12).view(np.int64)[0])


def _identity(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            for s in shingle_sets(batch.column(1), words):
                keys.append(_key(s) if len(s) else None)
                sizes.append(len(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], ["id", "n", "key"])

    return run


def _missing(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den)


def _extension(n: int) -> int:
    return max(1, -(-n // 10))


def _shared_least(n: Column, num: int, den: int) -> Column:
    """Prefix tokens that a set of n shares with any partner, which has ceil(t n) tokens or more."""
    partner = F.ceil(n * num / den)
    return 1 + F.greatest(F.lit(1), F.ceil(partner / 10))


def _prefixes(words: int, num: int, den: int):
    """(token, key, known) of the prefix of every set; a task sends each set once.

    A token that the task holds many times is known to be shared: two of its rows go to the token's partition, for
    the rows of other tasks, and the rest are dealt out by key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens, keys, count = [], [], 0

        def out() -> pa.RecordBatch:
            t = np.concatenate(tokens).view(np.int64)
            k = np.repeat(np.array(keys, np.int64), [len(x) for x in tokens])
            by = np.argsort(t, kind="stable")
            t, k = t[by], k[by]
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            length = np.diff(np.append(first, len(t)))
            rank = np.arange(len(t)) - np.repeat(first, length)
            known = (np.repeat(length, length) >= HOT) & (rank >= 2)
            return pa.RecordBatch.from_arrays([pa.array(t), pa.array(k), pa.array(known)], ["token", "key", "known"])

        for batch in batches:
            for s in shingle_sets(batch.column(0), words):
                n = len(s)
                if n and (key := _key(s)) not in seen:
                    seen.add(key)
                    tokens.append(s[:_missing(n, num, den) + 1 + _extension(n)])
                    keys.append(key)
                    count += len(tokens[-1])
                    if count > 200_000:
                        yield out()
                        tokens, keys, count = [], [], 0
        if tokens:
            yield out()

    return run


def _shared_per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (known, token, key) -> (key, number of its tokens that other sets have)."""
    token, last, decided = None, None, False  # of the last row; decided: its token is shared, its rows are counted

    def counted(keys: np.ndarray) -> pa.RecordBatch:
        k, c = np.unique(keys, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(c.astype(np.int64))], ["key", "shared"])

    for batch in batches:
        t, k, known = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        yield counted(k[known])
        t, k = t[~known], k[~known]
        if not len(t):
            continue
        if token is not None:
            t, k = np.append(token, t), np.append(last, k)
        fresh = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
        t, k = t[fresh], k[fresh]
        same = t[1:] == t[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        if decided:
            shared |= t == token
            yield counted(k[1:][shared[1:]])
        else:
            yield counted(k[shared])
        token, last, decided = t[-1], k[-1], bool(shared[-1])


def _positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of the keys in the filter, three rows."""
    return np.stack([(mix(keys.view(np.uint64), 31 + i) % np.uint64(bits)).astype(np.int64) for i in range(3)])


def _filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of bounded size, as words of 64 bits."""
    bits = min(FILTER_BITS, 1 << max(10, (16 * max(1, keys.count())).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _positions(batch.column(0).to_numpy(zero_copy_only=False), bits).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["p"])

    parts = keys.mapInArrow(places, "p long").groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(p, 64) AS INT))")).alias("b")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[parts["w"].to_numpy(np.int64)] = parts["b"].to_numpy(np.int64).view(np.uint64)
    return out


def _sets(words: int, words64):
    """(key, n, tokens) of every set that passes the filter; a task sends each set once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        table = words64.value
        bits = len(table) * 64

        def passes(key: int) -> bool:
            p = _positions(np.array([key], np.int64), bits)[:, 0]
            return bool(((table[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).all())

        for batch in batches:
            keys, sets, count = [], [], 0
            for s in [*shingle_sets(batch.column(0), words), None]:
                if s is not None and len(s) and (key := _key(s)) not in seen and passes(key):
                    seen.add(key)
                    keys.append(key)
                    sets.append(s.view(np.int64))
                    count += len(s)
                if sets and (s is None or count > 500_000):
                    offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys, pa.int64()), pa.array(np.diff(offsets).astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, np.concatenate(sets))], ["key", "n", "tokens"])
                    keys, sets, count = [], [], 0

    return run


def signatures(tokens: np.ndarray, counts: np.ndarray, n: int, num: int = 80, den: int = 100) -> np.ndarray:
    """Index entries of a set of n tokens, given those that other sets have and the number of sets with each.

    The other tokens come first in the order, and fill the prefix without entries. Complete for thresholds of 0.8 or more.
    """
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    need = _missing(n, num, den) + 1 - (n - len(tokens))
    if need <= 0:
        return tokens[:0]
    rare = int(np.searchsorted(counts, RARE, "right"))
    out = []
    if n <= SMALL:
        out.append(mix(tokens[:need], 21))
    if n * den > SMALL * num:
        out.append(tokens[:min(rare, need)])
        if rare < need:
            hot, least = tokens[rare:], need - rare
            band = 16
            while band < n:
                band *= 4
            for size in (band, band * 4) if n * den > band * num else (band,):
                own = (mix(hot, 22) % np.uint64(max(1, size // 20))).astype(np.int64)
                gain = np.ones(len(hot), np.int64)
                gain[np.unique(own, return_index=True)[1]] = 0
                end = int(np.searchsorted(np.cumsum(gain), least)) + 1
                by = np.argsort(own[:end], kind="stable")
                t, c = hot[:end][by], own[:end][by]
                for step in range(1, len(t)):
                    same = c[step:] == c[:-step]
                    if not same.any():
                        break
                    out.append(mix(mix(t[:-step][same], 23) + t[step:][same], size))
    return np.unique(np.concatenate(out))


def _index(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            prefix = batch.column(2)
            ends = np.cumsum([0, *(len(x) for x in prefix)])
            pairs = prefix.flatten()
            tokens = pairs.field(0).to_numpy(zero_copy_only=False).view(np.uint64)
            counts = pairs.field(1).to_numpy(zero_copy_only=False)
            for low in range(0, len(keys), 500):
                sigs = [signatures(tokens[ends[i]:ends[i + 1]], counts[ends[i]:ends[i + 1]], int(sizes[i]), num, den)
                        for i in range(low, min(low + 500, len(keys)))]
                own = np.repeat(keys[low:low + 500], [len(x) for x in sigs])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(own)], ["sig", "key"])

    return run


def remaining(texts: DataFrame, identity: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Step 1: ``(key, n, tokens, copies)`` of the sets that can have a partner; copies: documents with the set."""
    rows = texts.mapInArrow(_prefixes(words, num, den), "token long, key long, known boolean")
    dealt = rows.repartition(F.when(F.col("known"), F.xxhash64("token", "key")).otherwise(F.col("token")))
    shared = dealt.sortWithinPartitions("known", "token", "key").mapInArrow(_shared_per_key, "key long, shared long")
    sizes = identity.where("n > 0").groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("copies"))
    live = saved(
        shared.groupBy("key").agg(F.sum("shared").alias("shared")).join(sizes, "key")
        .where(F.col("shared") >= _shared_least(F.col("n"), num, den)).select("key", "copies"))
    words64 = texts.sparkSession.sparkContext.broadcast(_filter(live.select("key")))
    # The filter drops most sets in the task that made them; the join then is exact.
    kept = texts.mapInArrow(_sets(words, words64), "key long, n int, tokens array<long>")
    return saved(kept.join(live, "key").dropDuplicates(["key"]))


def index(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Steps 2 and 3: ``(sig, key)`` of all sets of which enough tokens occur elsewhere."""
    rows = sets.select("key", F.explode("tokens").alias("token"))
    counts = rows.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    own = rows.join(counts, "token").groupBy("key").agg(F.collect_list(F.struct("token", "sets")).alias("prefix"))
    ordered = own.join(sets.select("key", "n"), "key").where(F.size("prefix") >= F.ceil(F.col("n") * num / den))
    return ordered.select("key", "n", "prefix").mapInArrow(_index(num, den), "sig long, key long")


def _compare(sets: list[np.ndarray], own: np.ndarray, copies: np.ndarray, num: int, den: int):
    """Links of a spanning forest of a pair of blocks (positions a, b) and the linked documents of each set.

    ``own`` is the block of each set; of two different blocks only the pairs across count.
    """
    m, block = len(sets), own
    tokens, own = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    ids, at, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    shared = counts[at] > 1
    at, own = column[at[shared]], own[shared]
    both = np.zeros((m, m), np.float32)
    by = np.argsort(at, kind="stable")
    at, own = at[by], own[by]
    for low in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        matrix = np.zeros((m, COLUMNS), np.float32)
        matrix[own[a:b], at[a:b] - low] = 1
        both += matrix @ matrix.T
    size = np.array([len(s) for s in sets])
    both = both.astype(np.int64)
    linked = both * den >= num * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, False)
    across = block[:, None] != block[None, :] if (block != block[0]).any() else True
    count = (linked & across) @ copies
    label = np.full(m, -1)
    left, right = [], []
    for root in range(m):
        if label[root] < 0:
            label[root], front = root, [root]
            while front:
                x = front.pop()
                new = np.flatnonzero(linked[x] & (label < 0))
                label[new] = root
                left += [x] * len(new)
                right += new.tolist()
                front += new.tolist()
    return np.array(left, np.int64), np.array(right, np.int64), count


def _verify(num: int, den: int):
    """Rows sorted by (cluster, i, j, key) -> verified links ``(a, b, null)`` and counts ``(a, null, n)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, keys, sets, blocks, copies = None, [], [], [], []

        def out() -> Iterator[pa.RecordBatch]:
            # Of two blocks, one may be empty: its members come in the groups of the other blocks.
            if len(keys) > 1 and (group[1] == group[2] or len(set(blocks)) == 2):
                a, b, count = _compare(sets, np.array(blocks), np.array(copies, np.int64), num, den)
                k, some = np.array(keys, np.int64), count > 0
                n = len(a) + int(some.sum())
                none = np.arange(n) >= len(a)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([k[a], k[some]])), pa.array(np.append(k[b], np.zeros(n - len(a), np.int64)), mask=none),
                    pa.array(np.append(np.zeros(len(a), np.int64), count[some]), mask=~none)], ["a", "b", "n"])

        for batch in batches:
            names = zip(*(batch.column(i).to_pylist() for i in range(6)))
            for (*own, key, block, copy), tokens in zip(names, batch.column(6)):
                if own != group:
                    yield from out()
                    group, keys, sets, blocks, copies = own, [], [], [], []
                if not keys or keys[-1] != key:
                    keys.append(key)
                    sets.append(tokens.values.to_numpy())
                    blocks.append(block)
                    copies.append(copy)
        yield from out()

    return run


def links(entries: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Step 4: verified ``(a, b, null)``, enough to connect all linked sets, and ``(a, null, n)``, whose n add up to the
    number of documents with other sets that a is linked to."""
    first = entries.groupBy("sig").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("sig", "a")
    star = entries.join(first, "sig").where("key <> a").select("a", F.col("key").alias("b")).distinct()
    member = components(star).select(F.col("node").alias("key"), F.col("component").alias("cluster"))
    sizes = member.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(9), "key"), "blocks").cast("int")
    # A row goes to all pairs of its block and another; a cluster of one block is one group.
    dealt = member.join(sizes, "cluster").withColumn("own", own).select(
        "cluster", "key", "own", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
            F.least("own", x).alias("i"), F.greatest("own", x).alias("j")))).alias("p")).select("cluster", "p.i", "p.j", "key", "own")
    rows = dealt.join(sets.select("key", "tokens", "copies"), "key").select("cluster", "i", "j", "key", "own", "copies", "tokens")
    return (
        rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "key")
        .mapInArrow(_verify(num, den), "a long, b long, n long"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``(id, n_shingles, component_id, n_links)`` for every row of ``docs``; n_links: other rows linked to it.

    Rows are linked when their shingle sets have a Jaccard similarity of at least ``num/den`` (not
    below 0.8); ``component_id`` is the smallest id reachable over links. Words are maximal runs without ASCII white
    space, A-Z lower-cased; a text of fewer than ``words`` words is one shingle; an empty or null text has none and
    stays alone. Equal rows are linked like any others, a null id is returned and is never the component's id unless
    all are null. Other columns of ``docs`` are not looked at. An empty table gives an empty result. Shingles and sets
    are identified by 64-bit hashes.
    """
    num, den = threshold
    if num * 10 < 8 * den:
        raise ValueError("the index is complete for thresholds of 0.8 and more")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = rows.select("text")
    identity = saved(rows.mapInArrow(_identity(words), f"id {dict(rows.dtypes)['id']}, n long, key long"))
    sets = remaining(texts, identity, words, num, den)
    found = saved(links(saved(index(sets, num, den)), sets, num, den))
    member = components(found.where("b is not null").select("a", "b")).select(F.col("node").alias("key"), "component")
    counts = found.where("n is not null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    copies = identity.where("key is not null").groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
    # Written, so that the joins can split a group of many copies.
    final = saved(member.join(counts, "key", "full").join(copies, "key", "full"))
    grouped = identity.join(final, "key", "left").select(
        "id", "n", F.coalesce("component", "key").alias("component"),
        (F.coalesce("others", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"))
    least = saved(grouped.where("component is not null").groupBy("component").agg(F.min("id").alias("least")))
    return grouped.join(least, "component", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"), "n_links")
