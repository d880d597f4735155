"""Daily exports landing in a folder, appended without conflicts.

The daily jobs of the original fetch one export and insert it ignoring
conflicts. Here new files in a landing folder are picked up by a file-source
stream; each micro-batch goes through the same conflict-ignoring append
(``foreachBatch``), so the key rules (first row wins, null keys always
insert) are those of the batch sink - ``dropDuplicates`` in a stream would
merge null keys. ``trigger(availableNow=True)`` processes what has landed and
stops, and the checkpoint in the shared folder makes a re-run skip files it
already took, surviving restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe.operators.sinks import path_exists, pruned_target, rows_to_append


def landing_stream(spark: SparkSession, landing: str, schema, fmt: str = "json",
                   **options) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    return reader.load(landing).select("*", F.col("_metadata.file_path").alias("__file"),
                                       F.col("_metadata.file_block_start").alias("__start"))


def ingest_available(spark: SparkSession, landing: str, schema, target: str, keys,
                     checkpoint: str, prepare=None, fmt: str = "json",
                     max_files_per_trigger: int | None = None, order_by=None,
                     partition_col: str | None = None, **options) -> None:
    """Process every file that has landed, then stop.

    ``prepare(df)`` shapes a micro-batch before the append (it may rely on the
    ``__file`` / ``__start`` / ``__ord`` helper columns, dropped before
    writing). 'First row wins' follows ``order_by`` when given, else arrival
    order (file, split, position). ``target`` is the stream's own folder, read
    with :func:`read_ingested`."""
    if max_files_per_trigger:
        options = {**options, "maxFilesPerTrigger": str(max_files_per_trigger)}
    stream = landing_stream(spark, landing, schema, fmt, **options)
    run_available(stream, batch_writer(spark, target, keys, prepare, order_by, partition_col), checkpoint)


def run_available(stream: DataFrame, each_batch, checkpoint: str) -> None:
    """Run ``each_batch(df, batch_id)`` over what has landed, then stop."""
    query = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


BATCH = "__batch"  # partition column of a stream's target: the micro-batch that wrote the row


def batch_writer(spark: SparkSession, target: str, keys, prepare=None, order_by=None, partition_col: str | None = None):
    """The ``foreachBatch`` function: conflict-ignoring append of one micro-batch, with the
    effect of exactly once.

    foreachBatch is at-least-once: a batch may be run again after a failure. Its rows are
    one folder ``__batch=<id>`` of the target, always written as a whole, and only earlier
    batches count as existing rows; so a replay computes the same rows and replaces them,
    null keys included. There is no marker that could miss its append."""
    target = target.rstrip("/")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        df = batch.withColumn("__ord", F.monotonically_increasing_id())
        if prepare is not None:
            df = prepare(df)
        columns = [f for f in df.schema.fields if not f.name.startswith("__")]
        before = _batches(spark, target, T.StructType(columns)).where(F.col(BATCH) < batch_id)
        if partition_col is not None:
            before = pruned_target(before, df, keys, partition_col)
        add = rows_to_append(df, before, keys, order_by or ["__file", "__start", "__ord"]).select(*[f.name for f in columns])
        writer = add.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(partition_col) if partition_col else writer).parquet(f"{target}/{BATCH}={batch_id}")

    return each_batch


def _batches(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The target's rows with the batch that wrote them; a target that does not exist yet is empty."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, target):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", target).parquet(target)


def read_ingested(spark: SparkSession, target: str, schema) -> DataFrame:
    """The rows of a stream's target. The schema is the one written: partition values are
    read as its types, not guessed from folder names."""
    schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return _batches(spark, target.rstrip("/"), schema).select(*schema.names)
