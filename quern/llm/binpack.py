"""Filling rows of fixed capacity with items: bounded-space online best-fit, and an audit of packed rows.

The packer keeps a fixed number of open bins. Their free space is a bitset (bit *f* is set if a bin with
*f* free places is open), so the best fit for an item of length *l* is the lowest bit from *l* on; if
there is none and all bins are in use, the fullest (the lowest bit of all) is closed. Items are read once, in
one pass, with memory for the open bins only. An item is cut only if it is longer than the capacity: into
full bins and a remainder that is packed like any item.

A stream of items (a run, a capacity) is cut into shards by a hash of the item, each packed on its own, so
that one stream may hold any share of the data. A shard holds about ``items_per_shard`` items, so a small stream is packed whole and
the price, at most ``open_bins`` part-filled bins a shard, stays a small share of the bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.session import broadcast_if_small, checkpointed


class BestFit:
    """Bounded-space online best-fit for bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # the bitset
        self.bins: dict[int, list[int]] = {}  # free space -> open bins with it, the oldest last
        self.in_use = self.made = 0

    def _take(self, space: int) -> int:
        held = self.bins[space]
        found = held.pop()
        if not held:
            del self.bins[space]
            self.free &= ~(1 << space)
        self.in_use -= 1
        return found

    def _keep(self, bin_no: int, space: int) -> None:
        if space:
            self.bins.setdefault(space, []).insert(0, bin_no)
            self.free |= 1 << space
            self.in_use += 1

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for an item of ``1 <= length <= capacity``."""
        fitting = self.free >> length
        if fitting:
            space = (fitting & -fitting).bit_length() - 1 + length
            found = self._take(space)
        else:
            if self.in_use >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            found, space = self.made, self.capacity
            self.made += 1
        self._keep(found, space - length)
        return found, self.capacity - space

    def pieces(self, length: int) -> list[tuple[int, int, int]]:
        """``(bin, offset, length)`` of an item of any length; none if it has none."""
        out = []
        while length > self.capacity:
            out.append((self.made, 0, self.capacity))
            self.made += 1
            length -= self.capacity
        if length > 0:
            out.append((*self.place(length), length))
        return out


def pack(items: DataFrame, stream: str, item: list[str], length: str, capacity: str, items_per_shard: int = 50_000, open_bins: int = 64) -> DataFrame:
    """``(stream, shard, bin, piece, pieces, offset, size)`` before the columns ``item`` of each piece of each item.

    ``stream`` names the column of the streams, ``capacity`` that of their bins' capacity (equal within a stream).
    ``bin`` counts from 0 in a stream's shard. Items without a stream, of null or no length, or with a capacity
    below 1 aren't packed. Repeated rows are repeated items. ``item`` may hold any columns, also ones named like
    the new ones (these then get a leading underscore, as in the result). Items are read twice, to be counted and to be packed.
    """
    new = ["shard", "bin", "piece", "pieces", "offset", "size"]
    kept = items.select(F.col(stream).alias("__stream"), F.col(capacity).cast("int").alias("__capacity"), F.col(length).cast("bigint").alias("__length"), *[F.col(c).alias(f"k_{c}") for c in item])
    kept = kept.where("__stream is not null and __length > 0 and __capacity > 0").withColumn("__order", F.xxhash64(*[F.col(f"k_{c}") for c in item]))
    counted = kept.groupBy("__stream").agg(F.ceil(F.count("*") / items_per_shard).alias("__shards")).where("__shards > 1")
    # only streams of more than one shard are looked up
    kept = kept.join(broadcast_if_small(counted, 100_000), "__stream", "left").withColumn("__shard", F.pmod("__order", F.coalesce("__shards", F.lit(1))).cast("int")).drop("__shards")
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"`__stream` {types['__stream']}, __shard int, __bin bigint, __piece int, __pieces int, __offset int, __size int, " + ", ".join(f"`k_{c}` {types[f'k_{c}']}" for c in item)
    ordered = kept.repartition("__stream", "__shard").sortWithinPartitions("__stream", "__shard", "__order", *[f"k_{c}" for c in item])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, packer = None, None
        for b in batches:
            streams, shard_nos = b.column("__stream").to_pylist(), b.column("__shard").to_pylist()
            rows, out = [], []
            for i, (st, sh, n, c) in enumerate(zip(streams, shard_nos, b.column("__length").to_pylist(), b.column("__capacity").to_pylist(), strict=True)):
                if (st, sh) != at:
                    at, packer = (st, sh), BestFit(c, open_bins)
                placed = packer.pieces(n)
                for j, (bin_no, offset, size) in enumerate(placed):
                    rows.append(i)
                    out.append((bin_no, j, len(placed), offset, size))
            if not rows:
                continue
            take = pa.array(rows)
            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()), strict=True)]
            arrays = [b.column("__stream").take(take), b.column("__shard").take(take), *columns, *[b.column(f"k_{c}").take(take) for c in item]]
            yield pa.RecordBatch.from_arrays(arrays, names=["__stream", "__shard", "__bin", "__piece", "__pieces", "__offset", "__size", *[f"k_{c}" for c in item]])

    taken = {stream.lower(), *(c.lower() for c in item)}
    named = {n: n if n not in taken else f"_{n}" for n in new}
    first = [F.col("__stream").alias(stream)] if stream.lower() not in {c.lower() for c in item} else []
    return ordered.mapInArrow(run, schema).select(*first, *[F.col(f"__{n}").alias(named[n]) for n in new], *[F.col(f"k_{c}").alias(c) for c in item])


def fill(packed: DataFrame, stream: str, capacity: DataFrame, open_bins: int = 64) -> DataFrame:
    """How full the bins of each stream are; ``capacity`` has ``(stream, capacity)``.

    ``within_bound``: whether there are no more bins than 1.7 times the least possible (the proven bound of bounded-space best-fit for long streams)
    and the open bins of each shard.
    """
    per = packed.groupBy(stream).agg(
        F.count_distinct("shard", "bin").alias("bins"), F.count_distinct("shard").alias("shards"), F.sum("size").alias("places_used"), F.sum(F.when(F.col("piece") == 0, 1).otherwise(0)).alias("items"), F.sum(F.when((F.col("piece") == 0) & (F.col("pieces") > 1), 1).otherwise(0)).alias("items_cut")
    )
    sized = per.join(capacity, stream).withColumn("fill", F.col("places_used") / (F.col("bins") * F.col("capacity"))).withColumn("least_bins", F.ceil(F.col("places_used") / F.col("capacity")))
    return sized.withColumn("within_bound", F.col("bins") <= 1.7 * F.col("least_bins") + F.col("shards") * open_bins)


_WHOLE, _HEAD, _THROUGH, _TAIL = 0, 1, 2, 3


def row_pieces(ids: np.ndarray, bos: int, eos: int, pad: int) -> list[tuple[int, int]]:
    """``(kind, length)`` of the pieces of items in one packed row, without its padding.

    Whole items run from begin to end token. A row's first piece may go on from the row before (``head`` if it ends
    here, ``through`` if it fills the row), its last may go on in the next (``tail``). A piece that is cut off by
    the next item's begin token goes on nowhere and is left out.
    """
    n = len(ids)
    filled = np.flatnonzero(ids != pad)
    # padding that is also the end token: the first one after the text belongs to the item
    n = 0 if not len(filled) else int(filled[-1]) + 1
    if pad == eos and n < len(ids):
        n += 1
    ids = ids[:n]
    if not n:
        return []
    starts = np.flatnonzero(ids == bos)
    ends = np.flatnonzero(ids == eos)
    out: list[tuple[int, int]] = []
    bounds = [*starts.tolist(), n]
    if bounds[0] > 0:
        e = ends[ends < bounds[0]]
        if len(e):
            out.append((_HEAD, int(e[0]) + 1))
        elif bounds[0] == n:
            out.append((_THROUGH, n))
    for s, nxt in zip(bounds, bounds[1:], strict=False):
        e = ends[(ends > s) & (ends < nxt)]
        if len(e):
            out.append((_WHOLE, int(e[0]) - s + 1))
        elif nxt == n:
            out.append((_TAIL, n - s))
    return out


def packed_pieces(rows: DataFrame, runs: DataFrame, max_broadcast_runs: int = 100_000) -> DataFrame:
    """``(run_id, seq_no, example_id, idx, kind, length, capacity)`` of every piece in the packed rows; repeated rows count once.

    Rows with a null run, place or tokens, or of an unknown run, hold no pieces.
    """
    r = runs.select("run_id", F.col("sequence_length").alias("capacity"), "bos_id", "eos_id", "pad_id").dropna().dropDuplicates(["run_id"])
    joined = rows.select("example_id", "run_id", "seq_no", "input_ids").where("input_ids is not null and seq_no is not null").join(broadcast_if_small(r, max_broadcast_runs), "run_id")
    types = {f.name: f.dataType.simpleString() for f in joined.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("input_ids")
            at, out = [], []
            settings = zip(*(b.column(c).to_pylist() for c in ("bos_id", "eos_id", "pad_id")), strict=True)
            for i, (bos, eos, pad) in enumerate(settings):
                ids = lists[i].values
                ids = ids.drop_null().to_numpy(zero_copy_only=False) if len(ids) else np.empty(0, np.int32)
                for j, (kind, n) in enumerate(row_pieces(ids, bos, eos, pad)):
                    at.append(i)
                    out.append((j, kind, n))
            if at:
                take = pa.array(at)
                columns = [pa.array(x, pa.int32()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(take) for c in ("run_id", "seq_no", "example_id")], *columns, b.column("capacity").take(take)], names=["run_id", "seq_no", "example_id", "idx", "kind", "length", "capacity"])

    schema = f"run_id {types['run_id']}, seq_no {types['seq_no']}, example_id {types['example_id']}, idx int, kind int, length int, capacity {types['capacity']}"
    return joined.mapInArrow(run, schema).distinct()


def packed_items(pieces: DataFrame) -> DataFrame:
    """``(run_id, seq_no, idx, last_seq, length, capacity)`` of every item that is complete in consecutive rows.

    Pieces are put together in blocks of rows, each with as many rows of the next block as an item that fits a
    row can touch; so a run may be of any length, and longer chains are items that don't fit anyway.
    """
    whole = pieces.where(F.col("kind") == _WHOLE).select("run_id", "seq_no", "idx", F.col("seq_no").alias("last_seq"), F.col("length").cast("bigint").alias("length"), "capacity")
    size = (F.col("capacity") * 4 + 4096).cast("bigint")
    own = F.floor(F.col("seq_no") / size)
    reach = F.when(F.col("seq_no") % size < F.col("capacity"), F.array(own, own - 1)).otherwise(F.array(own))
    broken = pieces.where(F.col("kind") != _WHOLE).withColumn("own", own).withColumn("block", F.explode(reach))
    w = Window.partitionBy("run_id", "block").orderBy("seq_no", "idx", "example_id")
    goes_on = F.col("kind").isin(_HEAD, _THROUGH) & F.lag("kind").over(w).isin(_TAIL, _THROUGH) & (F.lag("seq_no").over(w) == F.col("seq_no") - 1)
    chained = broken.withColumn("starts", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("chain", F.sum("starts").over(w))
    items = chained.groupBy("run_id", "block", "chain").agg(
        F.min(F.struct("seq_no", "idx", "kind", "own")).alias("a"), F.max(F.struct("seq_no", "idx", "kind")).alias("z"), F.sum("length").alias("length"), F.first("capacity").alias("capacity")
    )
    spread = items.where((F.col("a.kind") == _TAIL) & (F.col("z.kind") == _HEAD) & (F.col("a.own") == F.col("block")))
    return whole.unionByName(spread.select("run_id", F.col("a.seq_no").alias("seq_no"), F.col("a.idx").alias("idx"), F.col("z.seq_no").alias("last_seq"), "length", "capacity"))


def needless_cuts(rows: DataFrame, runs: DataFrame, items_per_shard: int = 50_000, open_bins: int = 64) -> DataFrame:
    """``(example_id)`` of the packed rows that hold a piece of an item which needn't have been cut.

    The items of each run are taken out of its rows and packed anew by best-fit; those that lie in several rows
    now but in one bin then were cut needlessly. As the packer never cuts what fits a bin, these are the items of at most the capacity, as the
    statement asks, whatever bins they come to lie in. Each row counts once. An item without end is no item.
    """
    items = checkpointed(packed_items(packed_pieces(rows, runs)))
    packed = pack(items, "run_id", ["seq_no", "idx", "last_seq"], "length", "capacity", items_per_shard, open_bins)
    cut = packed.where("last_seq > seq_no and pieces = 1").select("run_id", F.explode(F.sequence("seq_no", "last_seq")).alias("seq_no")).distinct()
    return rows.where("input_ids is not null").select("example_id", "run_id", "seq_no").join(cut, ["run_id", "seq_no"], "left_semi").select("example_id").distinct()
