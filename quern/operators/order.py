"""Order-dependent operators without a single-task window: running sums, ranks, splits and seeded shuffles.

A total order is always given by columns; row numbers of the engine are never used as meaning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import broadcast_if_small, checkpointed

#: Totals of ranges (24 bytes each) that are broadcast; beyond, they are joined by a shuffle.
MAX_BROADCAST_ROWS = 500_000


def ranged(df: DataFrame, keys: Sequence[str], order: str, value: Column) -> DataFrame:
    """``df`` sorted into even ranges of (a hash of ``keys``, ``order``), written to the checkpoint folder, with ``__rs_key``, ``__rs_range`` and ``__rs_in``.

    The ranges' ends are quantiles that the shuffle samples, so any order spreads evenly: far-apart groups of numbers, stray large ones, structs. Their number
    is that of shuffle partitions, which adaptive execution joins by size. ``__rs_in`` is the sum of ``value`` over the earlier rows of the same keys and range.
    """
    key = F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")
    rows = df.withColumn("__rs_key", key).withColumn("__rs_value", F.coalesce(value, F.lit(0)).cast("bigint"))
    rows = rows.repartitionByRange("__rs_key", order).sortWithinPartitions("__rs_key", order)
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            k, v = b.column("__rs_key").to_numpy(), b.column("__rs_value").to_numpy()
            new = np.append(last is None or k[0] != last, k[1:] != k[:-1])
            before = np.cumsum(v) - v
            starts = np.flatnonzero(new)
            group = np.cumsum(new)  # 0: goes on from the batch before
            base = np.append(-total, before[starts])
            inside = before - base[group]
            last, total = k[-1], int(inside[-1] + v[-1])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(inside)], names=[*names, "__rs_in"])

    return checkpointed(rows.mapInArrow(run, f"{schema}, __rs_in bigint").withColumn("__rs_range", F.spark_partition_id()))


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of the whole numbers ``value`` over the rows of the same ``keys`` before this one in ``order``, as BIGINT.

    Two levels: rows are summed inside of ``ranged``'s ranges, and the ranges' totals (a row a range and key) are added up. So a key that holds any share of
    the rows, or no key at all, is spread over tasks. Rows of equal order are summed in any order; ``order``, of any type that can be sorted, must not be null, a null
    ``value`` is 0. ``df`` is evaluated twice (to sample its order, then whole) and all its columns travel along: give it what is narrow and cheap to make.
    """
    held = ranged(df, keys, order, value)
    totals = held.groupBy("__rs_key", "__rs_range").agg(F.sum("__rs_value").alias("__rs_sum"))
    earlier = Window.partitionBy("__rs_key").orderBy("__rs_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__rs_key", "__rs_range", F.coalesce(F.sum("__rs_sum").over(earlier), F.lit(0)).alias("__rs_start"))
    # without keys there is a row a range
    starts = broadcast_if_small(starts, MAX_BROADCAST_ROWS) if keys else F.broadcast(starts)
    return held.join(starts, ["__rs_key", "__rs_range"]).select(*df.columns, (F.col("__rs_start") + F.col("__rs_in")).alias(name))


def position(df: DataFrame, keys: Sequence[str], order: str, name: str = "position") -> DataFrame:
    """``df`` with the number of rows of the same ``keys`` before each, as BIGINT."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), name)


def hashed_rank(seed: int, *columns: str) -> Column:
    """A hexadecimal hash of the seed and the columns; ordering by it is a shuffle that any engine can repeat."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]), 256)


def shuffle_number(seed: int, *columns: str) -> Column:
    """The first 52 bits of ``hashed_rank`` as a BIGINT: a random order that can be cut into even ranges."""
    return F.conv(F.substring(hashed_rank(seed, *columns), 1, 13), 16, 10).cast("bigint")


def ratio_split(df: DataFrame, keys: Sequence[str], order: str, ratio: Column, name: str = "split") -> DataFrame:
    """``train`` for the first ``floor(n ratio)`` rows of each key in order, else ``val``."""
    counted = position(df, keys, order, "__at").join(df.groupBy(*keys).agg(F.count("*").alias("__n")), list(keys)) if keys else position(df, keys, order, "__at").crossJoin(F.broadcast(df.agg(F.count("*").alias("__n"))))
    return counted.withColumn(name, F.when(F.col("__at") < F.floor(F.col("__n") * ratio), "train").otherwise("val")).drop("__at", "__n")


def shard_numbers(df: DataFrame, keys: Sequence[str], order: str, rows_per_shard: int, name: str = "shard") -> DataFrame:
    """Shards of a fixed number of rows in order, from 0."""
    return position(df, keys, order, "__at").withColumn(name, F.floor(F.col("__at") / rows_per_shard).cast("bigint")).drop("__at")


def systematic_sample(df: DataFrame, keys: Sequence[str], order: str, interval: int, most: int | None = None) -> DataFrame:
    """Every ``interval``-th row of each key from the first on, ``most`` at the most."""
    at = position(df, keys, order, "__at").where(F.col("__at") % interval == 0)
    return (at if most is None else at.where(F.col("__at") < most * interval)).drop("__at")


def head(df: DataFrame, keys: Sequence[str], order: str, n: int | Column) -> DataFrame:
    """The first ``n`` rows of each key in order."""
    return position(df, keys, order, "__at").where(F.col("__at") < n).drop("__at")
