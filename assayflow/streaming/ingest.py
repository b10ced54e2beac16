"""Incremental input: file streams with failure isolation, and a per-key rate limiter with state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..runtime import shared_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data directory as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")


def run_available(stream: DataFrame, label: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Process everything available in micro-batches, append to a Parquet table of the shared folder, read it."""
    import uuid

    out = f"{shared_dir(stream.sparkSession)}/assayflow-stream-{label}-{uuid.uuid4().hex}"
    rows = transform(stream) if transform else stream
    query = rows.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return stream.sparkSession.read.schema(rows.schema).parquet(f"{out}/data")


def windowed(stream: DataFrame, ts: str, size: str, late: str, *keys: str) -> DataFrame:
    """Counts per tumbling event-time window and keys; rows later than ``late`` are dropped from state."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, size), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def limited(stream: DataFrame, key: str, ts: str, per_second: float, burst: float) -> DataFrame:
    """Stateful token bucket per key: one bucket (level, last time) of state each."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level, last = state.get if state.exists else (burst, None)
        for b in batches:
            b = b.sort_values(ts)
            flags = []
            for t in b[ts]:
                at = t.timestamp()
                if last is not None:
                    level = min(burst, level + max(0.0, at - last) * per_second)
                last = at
                flags.append(level >= 1.0)
                level -= flags[-1]
            yield pd.DataFrame({key: k[0], "ts": b[ts].to_numpy(), "allowed": flags})
        state.update((float(level), last))

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, ts timestamp, allowed boolean", "level double, last double", "append", GroupStateTimeout.NoTimeout)
