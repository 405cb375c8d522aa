"""Bounded and continuous runs of streaming queries.

Progress (offsets, state) lives in the query's checkpoint folder: running the
same query on the same folder again only handles what is new.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_STORE = "spark.sql.streaming.stateStore."

#: State in files of each executor's disk; all stores of an executor share the memory. Each batch logs its changes only.
DISK_STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true", f"{_STORE}rocksdb.maxMemoryUsageMB": "300", f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(
    stream: DataFrame, checkpoint: str, path: str | None = None, batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append", timeout: int | None = None, disk_state: bool = False,
) -> StreamingQuery:
    """Handle everything available now, then stop. Output goes to Parquet at
    ``path`` or to ``batch``. ``disk_state`` is for state with a row for each of many keys:
    by default, executors hold all of it on their heaps."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(batch) if batch is not None else writer.format("parquet").option("path", path)
    with _settings(stream.sparkSession, DISK_STATE if disk_state else {}):
        query = writer.start()
    query.awaitTermination(timeout)
    return query


def run_continuously(stream: DataFrame, checkpoint: str, path: str | None = None, batch: Callable[[DataFrame, int], None] | None = None,
                     every: str = "1 minute", mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    writer = writer.foreachBatch(batch) if batch is not None else writer.format("parquet").option("path", path)
    return writer.start()
