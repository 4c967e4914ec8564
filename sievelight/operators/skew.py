"""Ordered and keyed steps that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.session import cut_lineage

HOT_ROWS = 1_000_000
#: A longer list of hot keys is joined by a shuffle.
MAX_HOT_KEYS = 100_000
SALTS = 64


def attach_per_key(
    rows: DataFrame, per_key: DataFrame, keys: list[str], count: str, spread: list[str],
    hot_rows: int = HOT_ROWS, salts: int = SALTS, how: str = "inner",
) -> DataFrame:
    """Join a per-key summary back to its rows without sending a hot key to one task.

    ``count`` is the number of rows of the key. Keys above ``hot_rows`` are counted first: without any the join is a
    plain one, up to ``MAX_HOT_KEYS`` their list is broadcast, beyond that it is joined by a shuffle. Rows of hot keys get a salt
    from the ``spread`` columns and their summary row is repeated once per salt; all other keys join as usual, in the
    same single shuffle.
    """
    hot = per_key.where(F.col(count) > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    many = hot.limit(MAX_HOT_KEYS + 1).count()
    if not many:
        return rows.join(per_key.drop(count), keys, how)
    salted = rows.join(F.broadcast(hot) if many <= MAX_HOT_KEYS else hot, keys, "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)))
        .otherwise(F.lit(0)).cast("int"),
    ).drop("_hot")
    copies = per_key.withColumn(
        "_salt",
        F.explode(
            F.when(F.col(count) > hot_rows, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    ).drop(count)
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def blocked_lag(
    df: DataFrame, keys: list[str], order: list[str], block: Column, values: dict[str, Column]
) -> DataFrame:
    """``lag(value)`` over ``keys`` ordered by ``order``, added under the given names.

    ``block`` must not decrease along the order (for example ``pos div 10000``). Rows are windowed per
    (key, block); only the last row of each block is windowed per key. A key with a billion rows
    thus becomes many tasks of one block each.
    """
    df = df.withColumn("_block", block)
    packed = F.struct(*[c.alias(n) for n, c in values.items()])
    inner = Window.partitionBy(*keys, "_block").orderBy(*order)
    rows = df.withColumns({"_prev": F.lag(packed).over(inner), "_rn": F.row_number().over(inner)})
    last = df.groupBy(*keys, "_block").agg(F.max_by(packed, F.struct(*order)).alias("_last"))
    carry = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block"))).drop("_last")
    joined = rows.join(carry, [*keys, "_block"])
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    out = joined.withColumn("_p", prev)
    return out.withColumns({n: F.col(f"_p.{n}") for n in values}).drop("_p", "_prev", "_carry", "_rn", "_block")


def blocked_before(
    df: DataFrame, keys: list[str], order: list[str], block: Column,
    values: dict[str, tuple[Column, Callable[[Column], Column], Callable[[Column, Column], Column]]],
) -> DataFrame:
    """Running minima and maxima over the rows before the current one, all in one pass over the blocks.

    ``values`` holds (value, aggregate, combine) by name. ``combine`` is ``least`` or ``greatest``, which
    skip nulls, so a side without rows needs no case.
    """
    df = df.withColumns({"_block": block, **{f"_v_{n}": v for n, (v, _, _) in values.items()}})
    inner = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumns({f"_in_{n}": agg(F.col(f"_v_{n}")).over(inner) for n, (_, agg, _) in values.items()})
    totals = df.groupBy(*keys, "_block").agg(*[agg(F.col(f"_v_{n}")).alias(f"_t_{n}") for n, (_, agg, _) in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "_block", *[
        agg(F.col(f"_t_{n}")).over(earlier).alias(f"_carry_{n}") for n, (_, agg, _) in values.items()])
    out = rows.join(carry, [*keys, "_block"])
    out = out.withColumns({n: combine(F.col(f"_carry_{n}"), F.col(f"_in_{n}")) for n, (_, _, combine) in values.items()})
    return out.drop("_block", *[f"{p}_{n}" for n in values for p in ("_v", "_in", "_carry")])


def blocked_running(
    df: DataFrame, keys: list[str], order: list[str], block: Column, value: Column, name: str,
    agg: Callable[[Column], Column], combine: Callable[[Column, Column], Column], inclusive: bool = True,
) -> DataFrame:
    """Running aggregate (``sum``, ``min``, ``max``) over ``keys`` in ``order``, split into blocks as above.

    ``combine`` merges the carry of earlier blocks with the value inside the block; either is null
    when it covers no row. ``inclusive=False`` leaves the current row out.
    """
    df = df.withColumn("_block", block).withColumn("_v", value)
    end = Window.currentRow if inclusive else -1
    inner = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    rows = df.withColumn("_in", agg(F.col("_v")).over(inner))
    totals = df.groupBy(*keys, "_block").agg(agg(F.col("_v")).alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("_carry", agg(F.col("_t")).over(before)).drop("_t")
    out = rows.join(carry, [*keys, "_block"])
    both = F.when(F.col("_carry").isNull(), F.col("_in")).when(F.col("_in").isNull(), F.col("_carry")).otherwise(
        combine(F.col("_carry"), F.col("_in"))
    )
    return out.withColumn(name, both).drop("_block", "_v", "_in", "_carry")


def ranked(df: DataFrame, value: str, name: str) -> DataFrame:
    """``rank()`` over all rows by ``value``, highest first and nulls last, added as ``name``.

    Rows are counted per distinct value, the values are range-partitioned, and each range adds the number of rows in the ranges
    above it: no task sees all rows. Only one row per range meets in one place. Equal values share a rank.
    """
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    # The ranges are drawn from a sample, so they are kept before they are numbered.
    placed = cut_lineage(counts.repartitionByRange(F.col("_value").desc()).withColumn("_block", F.spark_partition_id()))
    above = placed.groupBy("_block").agg(F.sum("_n").alias("_total")).select(
        "_block", F.coalesce(F.sum("_total").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"))
    inside = Window.partitionBy("_block").orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = placed.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(above, "_block").select(
        "_value", (F.col("_above") + F.col("_before") + 1).alias(name))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
