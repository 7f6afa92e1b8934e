"""Streaming line filter (J7: X1-X3, S7, S8, K6).

One stateless filter function serves batch and stream, so both agree by
construction. The stream reads a directory of files (new files are picked
up per micro-batch) or, when asked, a socket; it writes to a fault-tolerant
file sink with a checkpoint (exactly-once), or to the console.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.text import contains
from verdant.session import ensure_checkpoint_dir

EVENT_SCHEMA = ("event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, "
                "value DOUBLE, props STRING")


def error_lines(df: DataFrame, col: str = "value", needle: str = "error") -> DataFrame:
    """Keep rows whose ``col`` contains ``needle`` (case-sensitive)."""
    return df.where(contains(F.col(col), needle))


def file_stream(spark: SparkSession, directory: str, schema: str, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving in ``directory`` as an unbounded table."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def socket_stream(spark: SparkSession, host: str = "localhost", port: int = 7777) -> DataFrame:
    """Text lines from a socket (``value`` column); not fault tolerant,
    for demos only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def start_filter(sdf: DataFrame, out_path: str | None, checkpoint: str | None,
                 col: str = "value", needle: str = "error", interval: str | None = "2 seconds",
                 available_now: bool = False, console: bool = False):
    """X1/X3 + K6: start the filter query. ``available_now`` processes what
    is there and stops (tests, backfills); otherwise a 2-second trigger."""
    w = error_lines(sdf, col, needle).writeStream
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    if console:
        return w.format("console").outputMode("append").start()
    return (w.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").start(out_path))


def run_error_filter_once(spark: SparkSession, directory: str, schema: str, col: str,
                          glob: str | None = None) -> DataFrame:
    """Run the stream over everything available now into shared storage
    (under the checkpoint dir) and return the written rows as a DataFrame."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"{base}/stream-{uuid.uuid4().hex}"
    q = start_filter(file_stream(spark, directory, schema, glob=glob), f"{run}/out", f"{run}/ck",
                     col=col, available_now=True)
    q.awaitTermination()                 # raises what stopped the stream
    # Explicit schema: an empty result still reads back.
    return spark.read.schema(spark.createDataFrame([], schema).schema).parquet(f"{run}/out")


def stopped_after(query, batches: int, limit_s: float = 600.0) -> int:
    """Stops a running query once ``batches`` of its micro-batches are done, or earlier if it ends; returns how many were
    done. A batch that the stop cuts off is run again, under the same number, by the next start."""
    done, began = 0, time.monotonic()
    while done < batches and query.isActive and time.monotonic() - began < limit_s:
        last = query.lastProgress
        done = last["batchId"] + 1 if last and last["numInputRows"] else done
        time.sleep(0.05)
    query.stop()
    query.awaitTermination()                 # raises what else stopped the stream
    return done


def run_error_filter_resumed(spark: SparkSession, directory: str, schema: str, col: str, stop_after: int = 2,
                             files_per_batch: int = 1) -> DataFrame:
    """The filter over the files of ``directory`` in micro-batches of ``files_per_batch`` files, stopped after
    ``stop_after`` batches and started again from its checkpoint. The sink commits files by batch number, so a batch that
    is run again replaces what it left, and the rows are those of one run."""
    run = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    source = lambda: file_stream(spark, directory, schema, max_files_per_trigger=files_per_batch)
    stopped_after(start_filter(source(), f"{run}/out", f"{run}/ck", col=col, interval="0 seconds"), stop_after)
    start_filter(source(), f"{run}/out", f"{run}/ck", col=col, available_now=True).awaitTermination()
    return spark.read.schema(spark.createDataFrame([], schema).schema).parquet(f"{run}/out")
