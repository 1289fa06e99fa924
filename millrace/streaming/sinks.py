"""Stream sinks: idempotent micro-batch writes with retries, drains, statistics."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

# The batching and retry settings in effect.
BATCH_ROWS = 1000
FLUSH_INTERVAL = "10 seconds"
MAX_RETRIES = 3

BatchWriter = Callable[[DataFrame, int], None]


def retry_write(
    write: BatchWriter, max_retries: int = MAX_RETRIES, sleep: Callable[[float], None] = time.sleep
) -> BatchWriter:
    """Try again after 1, 4, 9, .. seconds. After the last failure the error is
    raised, so the stream stops without committing the batch and a restart
    replays it."""

    def attempt(df: DataFrame, batch_id: int) -> None:
        for tried in range(max_retries + 1):
            if tried:
                sleep(tried * tried)
            try:
                write(df, batch_id)
                return
            except Exception:
                log.warning("batch %s failed on attempt %s", batch_id, tried + 1, exc_info=True)
                if tried == max_retries:
                    raise

    return attempt


def folder_writer(path: str, prepare: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Each micro-batch replaces its own folder, so a replay writes no row twice."""

    def write(df: DataFrame, batch_id: int) -> None:
        rows = prepare(df) if prepare else df
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def split_writer(good: BatchWriter, bad: BatchWriter, reason: str = "error_reason") -> BatchWriter:
    """Good rows and dead letters of one micro-batch, computed once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            good(df.filter(F.col(reason).isNull()).drop(reason), batch_id)
            bad(df.filter(F.col(reason).isNotNull()), batch_id)
        finally:
            df.unpersist()

    return write


def jdbc_writer(url: str, table: str, batch_rows: int = BATCH_ROWS, **options: str) -> BatchWriter:
    """Append each micro-batch to a table of a live store over JDBC."""

    def write(df: DataFrame, batch_id: int) -> None:
        writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
        for name, value in {"batchsize": str(batch_rows), **options}.items():
            writer = writer.option(name, value)
        writer.save()

    return write


def read_folder(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a ``folder_writer`` has written."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def start_sink(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = FLUSH_INTERVAL,
    mode: str = "append",
    max_retries: int = MAX_RETRIES,
) -> StreamingQuery:
    """Start a stream into ``write``. ``interval=None`` drains what is there and
    stops. How much one trigger takes is the source's setting
    (``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``)."""
    writer = (
        df.writeStream.outputMode(mode)
        .foreachBatch(retry_write(write, max_retries))
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def start_topic_sink(
    records: DataFrame, brokers: str, topic: str, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Start a stream of ``key, value`` records into Kafka (needs the connector)."""
    writer = (
        records.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.queryName(name) if name else writer).start()


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over everything available now, into a folder, and stop."""
    query = start_sink(df, folder_writer(path), checkpoint, interval=None, mode=mode)
    query.awaitTermination()
    return query


def progress_frame(spark: SparkSession, progress: Sequence) -> DataFrame:
    """One row per reported micro-batch (a handful of numbers each)."""
    rows = [
        (
            p.name or str(p.id),
            int(p.batchId),
            int(p.numInputRows),
            int(p.durationMs.get("triggerExecution", 0)),
            sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators),
        )
        for p in progress
    ]
    return spark.createDataFrame(
        rows,
        "query string, batch_id bigint, input_rows bigint, duration_ms bigint, late_rows bigint",
    )


def sink_stats(
    batches: DataFrame, written: DataFrame, received: str = "input_rows", retries: int = 0
) -> DataFrame:
    """Totals over micro-batches and the rows actually stored, with true means."""
    stored = written.agg(F.count("*").alias("events_inserted")).withColumn("__one", F.lit(1))
    totals = batches.agg(
        F.coalesce(F.sum(received), F.lit(0)).alias("events_received"),
        F.count_if(F.col(received) > 0).alias("batches_flushed"),
        F.coalesce(F.max("duration_ms"), F.lit(0)).alias("max_flush_ms"),
        F.avg("duration_ms").alias("avg_flush_ms"),
    ).withColumn("__one", F.lit(1))
    both = totals.join(F.broadcast(stored), "__one").drop("__one")
    got, put = F.col("events_received"), F.col("events_inserted")
    return both.select(
        "events_received",
        "events_inserted",
        "batches_flushed",
        F.when(got > 0, put / got * 100).otherwise(F.lit(100.0)).alias("success_rate_percent"),
        F.when(F.col("batches_flushed") > 0, put / F.col("batches_flushed")).alias(
            "avg_batch_size"
        ),
        "avg_flush_ms",
        "max_flush_ms",
        F.lit(retries).cast("bigint").alias("retry_count"),
        (got - put).alias("pending_events"),
    )
