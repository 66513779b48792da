"""Session helpers shared by all operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str, heavy: bool = False) -> DataFrame:
    """The Parquet table ``name`` of ``directory``; for ``heavy`` work on each row it is ``spread``."""
    d = spark.read.parquet(f"{directory}/{name}.parquet")
    return spread(d) if heavy else d


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if it comes in fewer partitions than there are cores.

    A file of one row group is one task however many cores wait; only then rows are exchanged. Large inputs have more partitions and stay
    as they are. Filters and column selections pass through to the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, its lineage cut.

    The folder is the one that ``spark.checkpoint.dir`` names. Where that is unset a temporary folder is used if everything runs in one
    machine's process (tests, notebooks); on a cluster, whose executors wouldn't share it, this raises.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quern-"))
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    ``df`` should be cheap to count (a checkpoint or a small table). Beyond the bound the join is
    left to the shuffle, so nothing grows on the driver with the data.
    """
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def fresh(names: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``names`` has that name (case ignored)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` uses it (also inside of conditions)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly column, evaluated once a row: filters on it aren't pushed below it and so don't evaluate it again."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))
