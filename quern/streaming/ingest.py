"""Continuous ingestion: an extension for corpora that grow by files.

A stream of documents is cleaned and filtered record by record; copies are removed in each micro-batch against the table of fingerprints of what was
admitted before. Both tables are written by ``foreachBatch`` under the batch's number, so a batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.functions.text import clean_text, fingerprint
from quern.operators.dedup import exact_first
from quern.operators.filters import length_between
from quern.sources.writers import exists


def cleaned_stream(stream: DataFrame, order: str, text: str) -> DataFrame:
    return stream.select(F.col(order).alias("ord"), clean_text(F.col(text)).alias("text")).where(length_between(F.col("text")))


def admit(spark: SparkSession, directory: str):
    """The writer of micro-batches of ``(ord, text)``: the first of each text that no earlier batch admitted."""

    def write(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        first = exact_first(batch, "text", "ord").withColumn("fp", fingerprint(F.col("text")))
        if exists(spark, f"{directory}/documents"):
            seen = s.read.option("basePath", f"{directory}/documents").parquet(f"{directory}/documents/batch=*").where(F.col("batch") < number).select("fp")
            first = first.join(seen, "fp", "left_anti")
        first.write.mode("overwrite").parquet(f"{directory}/documents/batch={number}")

    return write


def ingest(stream: DataFrame, order: str, text: str, directory: str) -> StreamingQuery:
    """Admits all that is there now of ``stream`` into ``directory``/documents, and ends; a later call goes on from where this one ended."""
    writer = cleaned_stream(stream, order, text).writeStream.foreachBatch(admit(stream.sparkSession, directory))
    return writer.option("checkpointLocation", f"{directory}/checkpoint").trigger(availableNow=True).start()


def event_windows(events: DataFrame, time: str, kind: str, value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by kind in tumbling windows; events later than ``late`` behind the latest are dropped when streaming."""
    stamped = events.withWatermark(time, late) if events.isStreaming else events
    return stamped.groupBy(F.window(time, width).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), "kind", "n", "total")
