"""Shards capped by tokens or documents, cut in order."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.order import MAX_BROADCAST_ROWS, ranged
from quern.session import broadcast_if_small


@dataclass(frozen=True)
class Cap:
    """When a shard is closed before a row: once it has ``tokens`` or ``docs``; with ``overflow``, if the row would take it over ``tokens``."""

    tokens: int
    docs: int | None = None
    overflow: bool = False

    def first(self, p: np.ndarray, used: int, docs: int) -> int:
        """The row before which a shard that comes with ``used`` tokens and ``docs`` documents is closed, of rows whose running sum is ``p`` (one longer than they)."""
        if self.overflow:
            return max(int(np.searchsorted(p, self.tokens - used, "right")) - 1, int(np.searchsorted(p, -used, "right")))
        full = int(np.searchsorted(p, self.tokens - used, "left"))
        return full if self.docs is None else min(full, max(0, self.docs - docs))

    def following(self, p: np.ndarray) -> np.ndarray:
        """For each row at which a shard begins, the row at which the next one does, or the number of rows."""
        n = len(p) - 1
        begins = p[:-1]
        if self.overflow:
            after = np.maximum(np.searchsorted(p, begins + self.tokens, "right") - 1, np.searchsorted(p, begins, "right"))
        else:
            after = np.searchsorted(p, begins + self.tokens, "left")
            if self.docs is not None:
                after = np.minimum(after, np.arange(n) + self.docs)
        return np.minimum(after, n)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of each stream in a range, in order, and their running sum. A range is held whole."""
    held = list(batches)
    if not held:
        return
    whole = pa.Table.from_batches(held).combine_chunks()
    if not whole.num_rows:
        return
    key, range_ = whole["__rs_key"].to_numpy(), whole["__rs_range"].to_numpy()
    new = np.append(True, (key[1:] != key[:-1]) | (range_[1:] != range_[:-1]))
    starts = np.append(np.flatnonzero(new), whole.num_rows)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        rows = whole.slice(a, b - a)
        yield rows, np.append(0, np.cumsum(rows["__rs_value"].to_numpy()))


def capped_shards(df: DataFrame, stream: str, order: str, tokens: str, max_tokens: int, max_docs: int | None = None, overflow: bool = False) -> DataFrame:
    """``(stream, order, shard)``: each stream cut into shards in order, which must be unique in a stream.

    A shard is closed before a row once it has ``max_tokens`` tokens or ``max_docs`` documents; with ``overflow``, before a row that would take it over
    ``max_tokens`` (a longer row has a shard of its own; ``max_docs`` doesn't count). Null tokens count as 0, null is a stream.

    Where a shard ends depends on where the one before ended, yet a stream of any size is cut in parallel: in each range of rows the first end depends on what the
    open shard brings along, and all others follow from the first. So each range tells, for every row that may be its first end, how many shards follow
    and what it hands on (a row for each document of about one shard); these are put together, a step a range and stream; then the ranges are cut. Only orders and counts
    are read, never texts.
    """
    if max_tokens < 1 or max_docs is not None and max_docs < 1:
        raise ValueError("a shard holds at least one token and one document")
    cap = Cap(max_tokens, max_docs, overflow)
    held = ranged(df.select(stream, order, F.col(tokens).alias("__tokens")), [stream], order, F.col("__tokens"))

    def outlook(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, p in _groups(batches):
            n = len(p) - 1
            after = cap.following(p).tolist()
            closed, last = [0] * n, list(range(n))  # shards that follow one that begins here, and where the last of them begins
            for j in range(n - 1, -1, -1):
                if after[j] < n:
                    closed[j], last[j] = closed[after[j]] + 1, last[after[j]]
            most = min(cap.first(p, 0, 0), n - 1) + 1  # no first end lies beyond that of an empty shard
            left = n - np.array(last[:most])
            columns = [p[: most + 1], np.array(closed[:most]) + 1, p[-1] - p[last[:most]], left]
            lists = [pa.array([c.tolist()], pa.list_(pa.int64())) for c in columns]
            yield pa.RecordBatch.from_arrays([rows["__rs_key"].chunk(0).slice(0, 1), rows["__rs_range"].chunk(0).slice(0, 1), pa.array([n]), pa.array([int(p[-1])]), *lists], names=["__rs_key", "__rs_range", "n", "total", "sums", "shards", "used", "docs"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, used, docs = None, 0, 0, 0
        for b in batches:
            out = []
            for key, n, total, sums, *after in zip(*(b.column(c).to_pylist() for c in ("__rs_key", "n", "total", "sums", "shards", "used", "docs")), strict=True):
                if key != at:
                    at, shard, used, docs = key, 0, 0, 0
                out.append((shard, used, docs))
                j = cap.first(np.array(sums), used, docs)
                if j < min(n, len(after[0])):
                    shard, used, docs = shard + after[0][j], after[1][j], after[2][j]
                else:
                    used, docs = used + total, docs + n
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([b.column("__rs_key"), b.column("__rs_range"), *columns], names=["__rs_key", "__rs_range", "shard0", "used0", "docs0"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, p in _groups(batches):
            n = len(p) - 1
            after = cap.following(p)
            j = cap.first(p, rows["used0"][0].as_py(), rows["docs0"][0].as_py())
            begins = np.zeros(n, np.int64)
            while j < n:
                begins[j] = 1
                j = int(after[j])
            shard = np.cumsum(begins) + rows["shard0"][0].as_py()
            yield pa.RecordBatch.from_arrays([*[rows[c].chunk(0) for c in (stream, order)], pa.array(shard)], names=[stream, order, "shard"])

    numbers = held.select("__rs_key", "__rs_range", "__rs_value")
    outlooks = numbers.mapInArrow(outlook, "__rs_key bigint, __rs_range int, n bigint, total bigint, sums array<bigint>, shards array<bigint>, used array<bigint>, docs array<bigint>")
    states = outlooks.repartition("__rs_key").sortWithinPartitions("__rs_key", "__rs_range").mapInArrow(joined, "__rs_key bigint, __rs_range int, shard0 bigint, used0 bigint, docs0 bigint")
    known = held.join(broadcast_if_small(states, MAX_BROADCAST_ROWS), ["__rs_key", "__rs_range"]).sortWithinPartitions("__rs_key", "__rs_range", order)
    types = {f.name: f.dataType.simpleString() for f in df.select(stream, order).schema}
    return known.mapInArrow(cut, f"`{stream}` {types[stream]}, `{order}` {types[order]}, shard bigint")
