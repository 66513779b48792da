"""Packing token sequences into rows of fixed length, and batching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.order import position, running_sum

IGNORED = -100


def pack_stream(df: DataFrame, keys: Sequence[str], order: str, tokens: str, length: int) -> DataFrame:
    """``(keys, row, tokens)``: all tokens of a key in order, cut into rows of ``length``; the rest is left out.

    Rows are cut from slices: a sequence is exploded into one slice for each row that it touches, never into tokens.
    """
    df = df.where(F.size(tokens) > 0)
    at = running_sum(df.select(*keys, order, tokens), keys, order, F.size(tokens).cast("bigint"), "__start")
    first, last = F.floor(F.col("__start") / length), F.floor((F.col("__start") + F.size(tokens) - 1) / length)
    cut = at.withColumn("row", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.lit(0), F.col("row") * length - F.col("__start"))
    end = F.least(F.size(tokens).cast("bigint"), (F.col("row") + 1) * length - F.col("__start"))
    pieces = cut.select(*keys, "row", F.col("__start").alias("at"), F.slice(F.col(tokens), (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece"))
    rows = pieces.groupBy(*keys, "row").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("p"))  # at most `length` pieces
    return rows.select(*keys, "row", F.flatten(F.transform("p", lambda x: x["piece"])).alias("tokens")).where(F.size("tokens") == length)


def shifted(tokens: Column) -> tuple[Column, Column]:
    """Input (without the last token) and label (without the first) of a sequence."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n)


def sliding_windows(df: DataFrame, keys: Sequence[str], order: str, tokens: str, length: int, stride: int) -> DataFrame:
    """``(keys, window, tokens)``: windows of ``length`` tokens over a key's whole stream, one every ``stride`` tokens, all full."""
    df = df.where(F.size(tokens) > 0)
    at = running_sum(df.select(*keys, order, tokens), keys, order, F.size(tokens).cast("bigint"), "__start")
    stop = F.col("__start") + F.size(tokens)
    first = F.greatest(F.lit(0), F.floor((F.col("__start") - length) / stride) + 1)
    last = F.floor((stop - 1) / stride)
    cut = at.where(first <= last).withColumn("window", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.lit(0), F.col("window") * stride - F.col("__start"))
    end = F.least(F.size(tokens).cast("bigint"), F.col("window") * stride + length - F.col("__start"))
    pieces = cut.where(end > begin).select(*keys, "window", F.col("__start").alias("at"), F.slice(F.col(tokens), (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece"))
    rows = pieces.groupBy(*keys, "window").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("p"))
    return rows.select(*keys, "window", F.flatten(F.transform("p", lambda x: x["piece"])).alias("tokens")).where(F.size("tokens") == length)


def _fold(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """Next-fit over runs of equal lengths, shortest first: ``(length, row, room, each)``.

    The first ``room`` items of a length go to ``row``, the others to the rows after it, ``each`` to a row.
    """
    out, row, fill, empty = [], 0, 0, True
    for n, c in counts:
        if n > capacity:  # cut, a row each; the open row is closed before the first
            start = row if empty else row + 1
            out.append((n, start, 1, 1))
            row, fill, empty = start + c, 0, True
            continue
        room = min(c, (capacity - fill) // n) if n else c
        each = capacity // n if n else c
        rest = c - room
        out.append((n, row, room, each))
        if rest == 0:
            fill, empty = fill + room * n, False
        else:
            rows = -(-rest // each)
            row, fill, empty = row + rows, (rest - (rows - 1) * each) * n, False
    return out


def next_fit(df: DataFrame, order: str, length: str, capacity: int) -> DataFrame:
    """``df`` with ``row``: items sorted by length, then ``order``, are put in the open row if they fit, else in a new one.

    Items longer than ``capacity`` fill a row each (cut), in ``order``. As items of one length follow each other, the fold runs over the histogram of
    lengths: lengths over the capacity are one class, so it has ``capacity`` + 1 entries at the most. Only then are items placed, by
    their rank within their length. Null lengths are left out.
    """
    spark: SparkSession = df.sparkSession
    sized = df.where(F.col(length).isNotNull()).withColumn("__l", F.least(F.col(length), F.lit(capacity + 1)).cast("int"))
    counts = [(r["__l"], r["c"]) for r in sized.groupBy("__l").agg(F.count("*").alias("c")).orderBy("__l").collect()]
    plan = spark.createDataFrame(_fold(counts, capacity), "__l int, __row bigint, __room bigint, __each bigint")
    placed = position(sized, ["__l"], order, "__at").join(F.broadcast(plan), "__l")
    row = F.when(F.col("__at") < F.col("__room"), F.col("__row")).otherwise(F.col("__row") + 1 + F.floor((F.col("__at") - F.col("__room")) / F.col("__each")))
    return placed.withColumn("row", row).drop("__l", "__at", "__row", "__room", "__each")


def packing_statistics(placed: DataFrame, length: str, capacity: int) -> DataFrame:
    """Rows, padding and efficiency of ``next_fit``."""
    rows = placed.groupBy("row").agg(F.least(F.sum(length), F.lit(capacity)).alias("used"), F.count("*").alias("items"))
    return rows.agg(F.count("*").alias("rows"), F.sum("items").alias("items"), F.sum("used").cast("bigint").alias("real_tokens")).select(
        "rows", "items", "real_tokens", (F.col("rows") * capacity - F.col("real_tokens")).alias("padding"),
        F.round(F.col("real_tokens") * 100.0 / (F.col("rows") * capacity), 2).alias("efficiency"), F.round(F.col("items") / F.col("rows"), 2).alias("items_per_row"),
    )


def packed_rows(placed: DataFrame, order: str, tokens: str, capacity: int, pad: int) -> DataFrame:
    """``(row, input_ids, attention_mask, labels)``: the items of each row joined and filled up."""
    rows = placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.size(tokens).alias("n"), F.col(order).alias("o"), F.col(tokens).alias("t")))).alias("p"))
    rows = rows.select("row", F.slice(F.flatten(F.transform("p", lambda x: x["t"])), 1, capacity).alias("ids"))
    return rows.select("row", padded(F.col("ids"), F.lit(capacity), pad).alias("input_ids"), mask(F.col("ids"), F.lit(capacity)).alias("attention_mask"), padded(F.col("ids"), F.lit(capacity), IGNORED).alias("labels"))


def padded(ids: Column, to: Column, pad: int, left: bool = False) -> Column:
    fill = F.array_repeat(F.lit(pad), F.greatest(to - F.size(ids), F.lit(0)).cast("int"))
    return F.concat(fill, ids) if left else F.concat(ids, fill)


def mask(ids: Column, to: Column, left: bool = False) -> Column:
    ones, zeros = F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.greatest(to - F.size(ids), F.lit(0)).cast("int"))
    return F.concat(zeros, ones) if left else F.concat(ones, zeros)


def batches(df: DataFrame, order: str, ids: str, size: int, pad: int = 0, drop_last: bool = False, left: bool = False) -> DataFrame:
    """``(batch, order, input_ids, attention_mask, labels)``: batches of ``size`` rows in order, each padded to its longest."""
    b = position(df, [], order, "__at").withColumn("batch", F.floor(F.col("__at") / size)).drop("__at")
    per = b.groupBy("batch").agg(F.max(F.size(ids)).alias("__longest"), F.count("*").alias("__rows"))
    j = b.join(per.where(F.col("__rows") == size) if drop_last else per, "batch")
    to = F.col("__longest")
    return j.select("batch", order, padded(F.col(ids), to, pad, left).alias("input_ids"), mask(F.col(ids), to, left).alias("attention_mask"), padded(F.col(ids), to, IGNORED, left).alias("labels"))
