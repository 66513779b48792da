"""Writers: shards with manifests, caches that know their configuration, packed tokens; and what checks them."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.order import shard_numbers
from quern.sources.readers import file_system, manifest


def config_hash(config: Any) -> str:
    """SHA-256 of the configuration as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def write_json(spark: SparkSession, value: Any, path: str) -> None:
    """One JSON document, through Spark's file system."""
    fs = spark._jvm.org.apache.hadoop.fs
    p = fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=1, default=str).encode()))
    out.close()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def file_hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, bytes, sha256)`` of the files of a pattern, hashed in the tasks."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_shards(df: DataFrame, directory: str, order: str, rows_per_shard: int = 10_000, tokens: str | None = None, config: Any = None, extra: dict | None = None, force: bool = False) -> dict:
    """Gzipped JSON lines, a file for every ``rows_per_shard`` rows in ``order``, and ``manifest.json`` with counts and hashes.

    Shards are formed by number, each written by one task. If a manifest is there it is returned and nothing is done, unless ``force``.
    """
    spark = df.sparkSession
    if not force and exists(spark, f"{directory}/manifest.json"):
        return manifest(spark, directory)
    numbered = shard_numbers(df, [], order, rows_per_shard, "shard")
    numbered.repartition("shard").sortWithinPartitions("shard", order).write.mode("overwrite").partitionBy("shard").option("compression", "gzip").json(f"{directory}/shards")
    return _record(spark, directory, tokens, config, extra)


def write_numbered(df: DataFrame, directory: str, shard: str, order: str, tokens: str | None = None, config: Any = None, extra: dict | None = None) -> dict:
    """``write_shards`` by a shard column that is there already (capped shards)."""
    df.withColumnRenamed(shard, "shard").repartition("shard").sortWithinPartitions("shard", order).write.mode("overwrite").partitionBy("shard").option("compression", "gzip").json(f"{directory}/shards")
    return _record(df.sparkSession, directory, tokens, config, extra)


def _record(spark: SparkSession, directory: str, tokens: str | None, config: Any, extra: dict | None) -> dict:
    # only the counted column is parsed, and no schema is inferred
    written = spark.read.schema(f"`{tokens}` bigint, shard bigint" if tokens else "shard bigint").json(f"{directory}/shards")
    sums = [F.count("*").alias("documents")] + ([F.sum(tokens).alias("tokens")] if tokens else [])
    counts = {r["shard"]: r.asDict() for r in written.groupBy("shard").agg(*sums).collect()}  # one row a shard
    files = []
    for r in file_hashes(spark, f"{directory}/shards/*/*.json.gz").orderBy("path").collect():
        name = r["path"].rpartition("/shards/")[2]
        c = counts.get(int(name.partition("=")[2].partition("/")[0]), {})
        files.append({"path": f"shards/{name}", "num_documents": c.get("documents", 0), "num_tokens": c.get("tokens", 0), "file_size_bytes": r["bytes"], "sha256": r["sha256"]})
    m = {"format_version": "2.0", "config_hash": config_hash(config), "shards": files, "total_documents": sum(f["num_documents"] for f in files), "total_tokens": sum(f["num_tokens"] or 0 for f in files), **(extra or {})}
    write_json(spark, m, f"{directory}/manifest.json")
    return m


def write_split_shards(df: DataFrame, directory: str, split: str, order: str, rows_per_shard: int, format_version: str = "2.0", config: Any = None, packing: dict | None = None, tokenizer: dict | None = None) -> dict:
    """One folder of shards for each value of ``split``, and a manifest that names them. Shard numbers start anew in each split.

    The manifest holds the configuration and its totals: conversations, or for packed rows (``packing`` has their statistics, ``tokenizer`` what made them)
    sequences and tokens.
    """
    spark = df.sparkSession
    numbered = shard_numbers(df, [split], order, rows_per_shard, "shard")
    numbered.repartition(split, "shard").sortWithinPartitions(split, "shard", order).write.mode("overwrite").partitionBy(split, "shard").json(f"{directory}/shards")
    splits: dict[str, dict] = {r[0]: {"shards": [], "rows": r[1]} for r in df.groupBy(split).count().collect()}
    for r in spark.read.format("binaryFile").load(f"{directory}/shards/*/*/*.json").select("path").orderBy("path").collect():
        name = r["path"].rpartition("/shards/")[2]
        splits[name.partition("=")[2].partition("/")[0]]["shards"].append(f"shards/{name}")
    total = sum(x["rows"] for x in splits.values())
    m = {"format_version": format_version, "config": config, "config_hash": config_hash(config), "splits": splits}
    if packing is None:
        m["total_conversations"] = total
    else:
        m |= {"total_sequences": total, "total_tokens": packing.get("real_tokens"), "packing_metadata": packing, "tokenizer_metadata": tokenizer}
    write_json(spark, m, f"{directory}/manifest.json")
    return m


def verify_shards(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, status)`` of each shard of the manifest: ``ok``, ``changed`` or ``missing``."""
    want = [(s["path"], s["sha256"]) for s in manifest(spark, directory)["shards"]]
    expected = spark.createDataFrame(want, "path string, expected string")
    name = F.regexp_extract("path", r"(shards/.*)$", 1)
    there = file_hashes(spark, f"{directory}/shards/*/*").select(name.alias("path"), "sha256")
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") == F.col("expected"), "ok").otherwise("changed")
    return expected.join(there, "path", "left").select("path", status.alias("status"))


def subset(m: dict, target_tokens: int) -> dict:
    """A manifest of the first shards of ``m`` that hold about ``target_tokens``, by the mean tokens a shard; totals are those of the shards taken."""
    files = sorted(m["shards"], key=lambda s: s["path"])
    total = sum(s["num_tokens"] or 0 for s in files)
    per = total / len(files) if files else 0
    n = min(len(files), max(1, int(min(target_tokens, total) / per) + 1)) if per else len(files)
    taken = files[:n]
    return {**m, "shards": taken, "total_documents": sum(s["num_documents"] for s in taken), "total_tokens": sum(s["num_tokens"] or 0 for s in taken)}


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file, or the latest file directly in a folder, was changed, in milliseconds; 0 if there is nothing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return max((f.getModificationTime() for f in fs.listStatus(p)), default=0) if fs.exists(p) else 0


def cached(spark: SparkSession, path: str, config: Any, build: Callable[[], DataFrame], tokens: str | None = None, sources: Sequence[str] = ()) -> DataFrame:
    """``build()`` kept as Parquet: read back if it was written under the same configuration, all its rows are there and none of ``sources`` (files or folders) is newer, else made anew."""
    meta = f"{path}.metadata.json"
    if exists(spark, meta) and exists(spark, path) and all(changed_at(spark, s) <= changed_at(spark, meta) for s in sources):
        known = json.loads(spark.read.text(meta, wholetext=True).first()[0])
        kept = spark.read.parquet(path)
        if known["config_hash"] == config_hash(config) and known["rows"] == kept.count():
            return kept
    build().write.mode("overwrite").option("compression", "snappy").parquet(path)
    kept = spark.read.parquet(path)
    sums = kept.agg(F.count("*").alias("rows"), *([F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens")] if tokens else [])).first().asDict()
    write_json(spark, {"config_hash": config_hash(config), **sums}, meta)
    return kept


def cache_listing(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, config_hash, rows, tokens)`` of every cache in a folder."""
    files = spark.read.format("binaryFile").load(f"{directory}/*.metadata.json")
    body = F.from_json(F.decode("content", "utf-8"), "config_hash string, rows bigint, tokens bigint")
    return files.select(F.regexp_replace("path", r"\.metadata\.json$", "").alias("path"), body.alias("b")).select("path", "b.*")


def clear_cache(spark: SparkSession, path: str) -> None:
    for p in (path, f"{path}.metadata.json"):
        q = spark._jvm.org.apache.hadoop.fs.Path(p)
        q.getFileSystem(spark._jsc.hadoopConfiguration()).delete(q, True)


def latest_valid(listing: DataFrame, path: str, step: str, valid: str) -> DataFrame:
    """The path of the highest step among the valid ones; ``final`` (a null step) comes before all."""
    return listing.where(F.col(valid)).agg(F.max_by(path, F.coalesce(F.col(step), F.lit(2**62))).alias("path"))


def write_packed(df: DataFrame, path: str, order: str, tokens: str, length: int, extra: dict | None = None) -> int:
    """Rows of ``length`` ids below 65,536 as little-endian 16-bit integers: part files in ``order`` in the folder ``path``, and ``path``.idx.

    ``path`` is a folder or URI of any file system that Arrow knows and all executors share. Every task writes a range of the order in Arrow batches, to a name of
    its own that is put in place when whole, so a repeated task overwrites its part. ``extra`` (hashes of the corpus and the tokenizer) goes into the index. The number of
    rows is returned.
    """
    spark = df.sparkSession
    checked = df.select(order, F.when((F.size(tokens) == length) & F.coalesce(F.array_min(tokens) >= 0, F.lit(False)) & (F.array_max(tokens) < 65536), F.col(tokens)).otherwise(F.raise_error(F.lit("a row isn't of the length, or an id doesn't fit 16 bits"))).alias("t"))
    clear_cache(spark, path)
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path))
    ranges = checked.repartitionByRange(order).sortWithinPartitions(order).withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(path)
        n, part, out, held = 0, 0, None, ""
        for b in batches:
            if out is None and b.num_rows:
                part = b.column("part")[0].as_py()
                held = f"{at}/.part-{part:05d}.{uuid.uuid4().hex}"
                out = fs.open_output_stream(held)
            if b.num_rows:
                out.write(b.column("t").flatten().to_numpy(zero_copy_only=False).astype("<u2").tobytes())
                n += b.num_rows
        if out is not None:
            out.close()
            fs.move(held, f"{at}/part-{part:05d}.bin")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    n = ranges.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    write_json(spark, {"shape": [n, length], "dtype": "uint16", "sequence_length": length, "num_sequences": n, **(extra or {})}, f"{path}.idx")
    return n


def metrics_csv(df: DataFrame, path: str) -> None:
    """``metric,value`` lines."""
    df.select("metric", "value").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def packed_manifest(spark: SparkSession, path: str, length: int, statistics: dict, corpus_hash: str, tokenizer_hash: str) -> dict:
    """The manifest of packed tokens, written to ``path``: by its hashes a reader knows from what corpus and tokenizer they come."""
    m = {"data_format": "packed_sequences", "dtype": "uint16", "sequence_length": length, "corpus_manifest_hash": corpus_hash, "tokenizer_config_hash": tokenizer_hash, "statistics": statistics}
    write_json(spark, m, path)
    return m


def incompatible(manifests: dict[str, dict], key: str = "tokenizer_config_hash") -> list[str]:
    """The names of manifests whose hash under ``key`` is missing or another than that of the first which has one."""
    known = next((m[key] for m in manifests.values() if m.get(key)), None)
    return [name for name, m in manifests.items() if m.get(key) is None or m[key] != known]


def finetuning_card(m: dict) -> str:
    """The data card of a fine-tuning corpus from its manifest: totals, splits, and packing if it is packed."""
    totals = {k: m[k] for k in ("format_version", "total_conversations", "total_sequences", "total_tokens", "config_hash") if m.get(k) is not None}
    sections: dict[str, dict[str, Any] | list[str]] = {"Totals": totals, "Splits": {k: f"{v['rows']} rows in {len(v['shards'])} shards" for k, v in m["splits"].items()}}
    if m.get("packing_metadata"):
        sections["Packing"] = m["packing_metadata"]
    if isinstance(m.get("config"), dict):
        sections["Configuration"] = m["config"]
    return markdown_card("Fine-tuning corpus", sections)


def preference_card(m: dict) -> str:
    """The data card of a preference corpus from its manifest: totals, what was left out and why, and the lengths of its fields."""
    totals = {"documents": m["total_documents"], "shards": len(m["shards"]), "config_hash": m["config_hash"]}
    lengths = {f: f"mean {x['mean']:.1f}, median {x['median']:.1f} tokens" for f, x in m.get("lengths", {}).items()}
    return markdown_card("Preference corpus", {"Totals": totals, "Funnel": m.get("funnel", {}), "Lengths": lengths})


def markdown_card(title: str, sections: dict[str, dict[str, Any] | list[str]]) -> str:
    """A data card: a heading for each section, with a table of values or a list."""
    out: list[str] = [f"# {title}", ""]
    for name, body in sections.items():
        out += [f"## {name}", ""]
        out += [f"| {k} | {v} |" for k, v in body.items()] if isinstance(body, dict) else [f"- {x}" for x in body]
        out.append("")
    return "\n".join(out)


