"""Registered streaming query."""

from __future__ import annotations

from verdant.plans.registry import query
from verdant.session import scratch_path
from verdant.sources.tables import table
from verdant.streaming.error_filter import EVENT_SCHEMA, run_error_filter_once, run_error_filter_resumed


@query("stream_error_filter",
       oracle="SELECT event_id, user_id, event_type FROM events WHERE contains(event_type, 'error')")
def q_stream_error_filter(spark, sf_dir):
    """The events table (one file or a folder of files) as a file stream,
    the shared line filter, an exactly-once file sink; the rows written are the
    result."""
    # A pattern that only this name matches: the source then takes a file as well as a folder.
    out = run_error_filter_once(spark, f"{sf_dir.rstrip('/')}/events.parque[t]", EVENT_SCHEMA, col="event_type")
    return out.select("event_id", "user_id", "event_type")


@query("stream_error_filter_resumed",
       oracle="SELECT event_id, user_id, event_type FROM events WHERE contains(event_type, 'error')")
def q_stream_error_filter_resumed(spark, sf_dir):
    """X1 + K6 over several micro-batches: the events as a folder of files, one file a batch; the stream is stopped
    after two batches and started again from its checkpoint."""
    path = scratch_path(spark, "event-files")
    table(spark, sf_dir, "events").repartition(6, "event_id").write.parquet(path)
    return run_error_filter_resumed(spark, path, EVENT_SCHEMA, col="event_type").select("event_id", "user_id", "event_type")
