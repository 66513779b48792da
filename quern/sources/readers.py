"""Readers of corpora, conversations, preference pairs, packed tokens, vocabularies and prompts.

All give lazy DataFrames that can be read again; columns and filters reach the files where the format allows it.
"""

from __future__ import annotations

import json
import time
import warnings
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.order import head


def retried(f: Callable[[], Any], tries: int = 5, wait: float = 2.0, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """``f()``, tried again after ``wait``, 2 ``wait``, 4 ``wait``, … seconds; the last failure is raised. For calls on the driver: tasks are tried again by Spark."""
    for k in range(tries + 1):
        try:
            return f()
        except Exception:
            if k == tries:
                raise
            sleep(min(wait * 2**k, longest))


def retrying(tries: int = 5, wait: float = 2.0, longest: float = 60.0) -> Callable:
    """``retried`` as a decorator."""
    return lambda f: wraps(f)(lambda *a, **k: retried(lambda: f(*a, **k), tries, wait, longest))


def jsonl(spark: SparkSession, path: str | list[str], schema: str, tolerant: bool = False) -> DataFrame:
    """One object a line, gzipped or not. A bad line raises, or is left out if ``tolerant``."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").json(path)


def bad_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """``(line)``: the lines that ``jsonl`` leaves out."""
    parsed = F.from_json("value", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).where(parsed["__bad"].isNotNull()).select(F.col("value").alias("line"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one list of objects."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def open_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(record)``: each line as a VARIANT, for records without a fixed schema."""
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).select(F.try_parse_json("value").alias("record")).where("record is not null")


_REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def source(name: str) -> Callable:
    """Registers a kind of source under a name."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _REGISTRY[name] = f
        return f

    return add


@source("parquet")
def _parquet(spark: SparkSession, path: str, columns: list[str] | None = None, **_: Any) -> DataFrame:
    d = spark.read.parquet(path)
    return d.select(*columns) if columns else d


@source("folders")
def _folders(spark: SparkSession, path: str, subset: str = "default", split: str = "train", columns: list[str] | None = None, **_: Any) -> DataFrame:
    """A dataset kept as Parquet in folders ``subset/split``."""
    return _parquet(spark, f"{path}/{subset}/{split}", columns)


source("jsonl")(lambda spark, path, schema, tolerant=False, **_: jsonl(spark, path, schema, tolerant))
source("json")(lambda spark, path, schema, **_: json_array(spark, path, schema))


def load(spark: SparkSession, kind: str, path: str, order: str | None = None, max_samples: int | None = None, **options: Any) -> DataFrame:
    """A registered source, whole or its first ``max_samples`` rows in ``order``, without which they would be others each time."""
    if kind not in _REGISTRY:
        raise ValueError(f"no source {kind!r}; there are {', '.join(sorted(_REGISTRY))}")
    d = retried(lambda: _REGISTRY[kind](spark, path, **options))
    if max_samples is None:
        return d
    if order is None:
        raise ValueError("the first samples need an order")
    return head(d, [], order, max_samples)


def manifest(spark: SparkSession, directory: str, name: str = "manifest.json") -> dict:
    """A manifest, read through Spark's file system."""
    return json.loads(spark.read.text(f"{directory}/{name}", wholetext=True).first()[0])


def shards(spark: SparkSession, directory: str, schema: str = "text string") -> DataFrame:
    """The shards that the manifest of ``directory`` names, all in ``directory`` or all in its ``shards/``: the first one tells. A missing shard raises when it is read."""
    paths = [s["path"] for s in manifest(spark, directory)["shards"]]
    if not paths:
        return spark.createDataFrame([], schema)
    base = directory if listing(spark, f"{directory}/{paths[0]}") else f"{directory}/shards"
    return jsonl(spark, [f"{base}/{p}" for p in paths], schema)


#: Columns of the formats of fine-tuning shards.
SFT_FORMATS = {
    "1.0": "tokens array<int>",
    "2.0": "text string, prompt string, response string, source_dataset string, template string",
    "3.0": "input_ids array<int>, attention_mask array<int>, labels array<int>",
}


def listing(spark: SparkSession, path: str) -> dict[str, int]:
    """Files and their bytes: of a folder (hidden ones left out), or the one that ``path`` is; none if there is nothing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    return {f.getPath().toString(): f.getLen() for f in fs.listStatus(p) if f.isFile() and not f.getPath().getName().startswith((".", "_"))}


def _sft_files(spark: SparkSession, directory: str, split: str) -> tuple[str, list[str], list[str]]:
    """Schema, files and missing files of a split. Folders are listed once each, files aren't asked for one by one."""
    m = manifest(spark, directory)
    if split not in m.get("splits", {}):
        raise ValueError(f"no split {split!r}; there are {', '.join(sorted(m.get('splits', {})))}")
    files = [f"{directory}/{p}" for p in m["splits"][split]["shards"]]
    there = {folder: {name.rpartition("/")[2] for name in listing(spark, folder)} for folder in {f.rpartition("/")[0] for f in files}}
    missing = [f for f in files if f.rpartition("/")[2] not in there[f.rpartition("/")[0]]]
    return SFT_FORMATS[str(m.get("format_version", "2.0"))], [f for f in files if f not in set(missing)], missing


def sft_split(spark: SparkSession, directory: str, split: str) -> DataFrame:
    """The rows of one split of a fine-tuning corpus, in the columns of its format; missing shards and bad lines are passed over.

    Missing shards raise a warning; ``sft_split_faults`` counts both.
    """
    schema, files, missing = _sft_files(spark, directory, split)
    if missing:
        warnings.warn(f"{len(missing)} shards of {split!r} are missing, the first is {missing[0]}", stacklevel=2)
    return jsonl(spark, files, schema, tolerant=True) if files else spark.createDataFrame([], schema)


def sft_split_faults(spark: SparkSession, directory: str, split: str) -> DataFrame:
    """``(shard, missing, bad_lines)`` of the shards that ``sft_split`` doesn't read whole."""
    schema, files, missing = _sft_files(spark, directory, split)
    lost = spark.createDataFrame([(f, True, 0) for f in missing], "shard string, missing boolean, bad_lines bigint")
    if not files:
        return lost
    lines = spark.read.text(files).select(F.input_file_name().alias("shard"), "value").where(F.length(F.trim("value")) > 0)
    parsed = F.from_json("value", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    return lost.unionAll(lines.where(parsed["__bad"].isNotNull()).groupBy("shard").agg(F.lit(False).alias("missing"), F.count("*").alias("bad_lines")))


def token_shards(spark: SparkSession, directory: str, split: str) -> DataFrame:
    """``(input_ids, labels, attention_mask)`` of the tokenized shards of a split: those that a manifest lists under ``<split>_shards``, or without a manifest ``<split>_*.jsonl``.

    A split that the manifest doesn't list, or that has no shard, raises. The mask is one for every token.
    """
    there = listing(spark, directory)
    if any(p.endswith("/manifest.json") for p in there):
        m = manifest(spark, directory)
        if f"{split}_shards" not in m:
            raise ValueError(f"the manifest lists no shards of {split!r}")
        files = [f"{directory}/{p}" for p in m[f"{split}_shards"]]
    else:
        files = sorted(p for p in there if p.rpartition("/")[2].startswith(f"{split}_") and p.endswith(".jsonl"))
    if not files:
        raise ValueError(f"no shards of {split!r} in {directory}")
    return jsonl(spark, files, "input_ids array<int>, labels array<int>").withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))


def preference_shards(spark: SparkSession, directory: str) -> DataFrame:
    """The preference triplets of a folder with a manifest: of the shards that it names, or of ``shard_*.jsonl`` if it names none."""
    schema = "prompt string, chosen string, rejected string"
    if "shards" in manifest(spark, directory):
        return shards(spark, directory, schema)
    return spark.read.schema(schema).json(f"{directory}/shard_*.jsonl*")


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """``(category, prompt)`` of a file with a list, ``{"prompts": [...]}`` or ``{"categories": {name: [...]}}``."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.from_json(F.when(F.startswith("v", F.lit("[")), F.col("v")).otherwise(F.coalesce(F.get_json_object("v", "$.prompts"), F.lit("[]"))), "array<string>")
    by = F.from_json(F.when(~F.startswith("v", F.lit("[")), F.get_json_object("v", "$.categories")), "map<string,array<string>>")
    flat = text.select(F.lit(None).cast("string").alias("category"), F.explode(listed).alias("prompt"))
    named = text.select(F.explode(by).alias("category", "p")).select("category", F.explode("p").alias("prompt"))
    return flat.unionAll(named)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(id, token, score, length, is_special, is_subword, char_count)`` of ``token<TAB>score`` lines; the id is the line's number, lines without two fields are passed over."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("id", "line"))
    fields = lines.withColumn("f", F.split(F.regexp_replace("line", r"\r$", ""), "\t")).where("size(f) >= 2")
    token = F.col("f")[0]
    piece = "▁"
    return fields.select(
        "id", token.alias("token"), F.col("f")[1].try_cast("double").alias("score"), F.length(token).alias("length"),
        (F.startswith(token, F.lit("<")) & F.endswith(token, F.lit(">"))).alias("is_special"), F.startswith(token, F.lit(piece)).alias("is_subword"), F.length(F.replace(token, F.lit(piece), F.lit(""))).alias("char_count"),
    )


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path in it, in a task as on the driver."""
    if "://" not in path:
        return pafs.LocalFileSystem(), path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def packed_binary(spark: SparkSession, path: str, length: int, rows_per_task: int = 1 << 18) -> DataFrame:
    """``(tokens)`` of rows of ``length`` little-endian 16-bit ids, in one file or a folder of parts.

    Files are cut at row ends into stretches of ``rows_per_task``, which tasks read in whole Arrow batches. A file that isn't a whole number of rows raises.
    """
    files = spark.createDataFrame(sorted(listing(spark, path).items()), "path string, bytes bigint")
    size = 2 * length
    whole = F.when(F.col("bytes") % size == 0, F.expr(f"bytes div {size}")).otherwise(F.raise_error(F.concat(F.lit("not a whole number of rows: "), "path")))
    cut = files.select("path", whole.alias("rows")).where("rows > 0").select("path", "rows", F.explode(F.sequence(F.lit(0), F.col("rows") - 1, F.lit(rows_per_task))).alias("first"))
    cut = cut.select("path", "first", F.least(F.lit(rows_per_task), F.col("rows") - F.col("first")).alias("n")).repartition("path", "first")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, first, n in zip(*(b.column(c).to_pylist() for c in ("path", "first", "n")), strict=True):
                fs, at = file_system(name)
                with fs.open_input_file(at) as f:
                    f.seek(first * size)
                    for done in range(0, n, 8192):
                        k = min(8192, n - done)
                        flat = np.frombuffer(f.read(k * size), "<u2").astype(np.int32)
                        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, k * length + 1, length), pa.int32()), pa.array(flat))], names=["tokens"])

    return cut.mapInArrow(read, "tokens array<int>")
