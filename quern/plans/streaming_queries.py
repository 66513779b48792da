"""Queries of the streaming extension."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.plans.registry import query
from quern.session import table
from quern.streaming import ingest


@query("stream_event_windows", "SELECT epoch_us(time_bucket(INTERVAL 1 hour, ts)) AS start, event_type AS kind, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_event_windows(spark, sf):
    """The batch form of the windowed aggregation, which the tests compare with its stream."""
    w = ingest.event_windows(table(spark, sf, "events"), "ts", "event_type", "value")
    return w.select(F.unix_micros(F.col("start").cast("timestamp")).alias("start"), "kind", "n", F.round("total", 4).alias("total"))
