"""Streaming queries: the events table landing as a file, ingested by an
available-now stream into a keyed, partitioned target."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.plans._base import query, table
from tablepipe.session import scratch_path
from tablepipe.streaming.incremental import batch_writer, ingest_available, landing_stream, read_ingested, run_available


@query("stream_first_events",
       "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
       "(PARTITION BY user_id, event_type ORDER BY ts) AS rn FROM events) WHERE rn = 1")
def q_stream_first_events(spark, sf):
    """The first event per user and type."""
    events = table(spark, sf, "events")
    target = scratch_path(spark, "stream_events_target")
    ingest_available(spark, sf, events.schema, target, keys=["user_id", "event_type"], checkpoint=scratch_path(spark, "stream_ckpt"),
                     fmt="parquet", order_by=["ts"], partition_col="event_type", pathGlobFilter="events.parquet")
    return read_ingested(spark, target, events.schema)


@query("stream_replayed_batch",
       "SELECT event_id, ts, NULLIF(user_id, 8) AS user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
       "(PARTITION BY user_id, event_type ORDER BY ts) AS rn FROM events) WHERE rn = 1 OR user_id = 8")
def q_stream_replayed_batch(spark, sf):
    """A batch that was written but not committed before a crash is run again by the restarted
    stream: rows without a user, which never conflict, are there once each."""
    events = table(spark, sf, "events")
    target, checkpoint = (scratch_path(spark, f"replayed_{x}") for x in ("target", "ckpt"))
    stream = landing_stream(spark, sf, events.schema, "parquet", pathGlobFilter="events.parquet")
    stream = stream.withColumn("user_id", F.nullif("user_id", F.lit(8)))
    write = batch_writer(spark, target, ["user_id", "event_type"], order_by=["ts"], partition_col="event_type")

    def crash(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("crash after the write")

    try:
        run_available(stream, crash, checkpoint)
    except Exception as e:  # noqa: BLE001 - only the planned crash
        if "crash after the write" not in str(e):
            raise
    run_available(stream, write, checkpoint)
    return read_ingested(spark, target, events.schema)
