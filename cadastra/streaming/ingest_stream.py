"""Incremental dump ingest with Structured Streaming's file source.

The stream watches a landing folder for dump files of one base and appends them to a Parquet
table. Its checkpoint records which files were processed, so each file is ingested exactly once
and a restarted or failed run continues where it stopped — the streaming form of "skip sources
whose output exists". ``trigger(availableNow=True)`` processes everything present and stops
(batch-style scheduling); without it the query keeps watching the folder.

The per-row work is the same as the batch reader: fixed schema, bad-row policy, NULL tokens.
It is stateless, so no watermark is needed.

:func:`start_folder_stream` watches a folder that holds dumps of several bases, with and without headers: the
stream carries the names of new files only, and every micro-batch ingests its files under their own
column names into the snapshot layout of :mod:`~cadastra.sources.snapshot`. A batch is published under its
number, so one that is replayed after a failure adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.dumps import (CORRUPT, DELIMITER, ENCODING, QUOTE, apply_bad_row_policy,
                             apply_null_tokens)
from ..sources.schema import COLUMNS
from ..sources.snapshot import ingest_files, source_files


def start_ingest_stream(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, base: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        encoding: str = ENCODING, multiline: bool = True) -> StreamingQuery:
    """Start the ingest stream. ``multiline`` keeps quoted newlines inside fields (each file is
    then parsed by one task); set it off for folders known to hold single-line dumps, which are
    split across tasks."""
    names = COLUMNS[base]
    schema = StructType([StructField(n, StringType(), True) for n in names]
                        + [StructField(CORRUPT, StringType(), True)])
    reader = (spark.readStream.schema(schema).option("sep", DELIMITER).option("quote", QUOTE)
              .option("escape", QUOTE).option("encoding", encoding).option("header", "false")
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("multiLine", str(multiline).lower())
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    rows = apply_null_tokens(apply_bad_row_policy(reader.csv(src_dir), len(names)), names)
    writer = (rows.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).option("compression", "zstd")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_ingest_stream(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, base: str, **kw) -> None:
    """Process every file available now, then return."""
    q = start_ingest_stream(spark, src_dir, out_dir, checkpoint, base, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def start_folder_stream(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, available_now: bool = True,
                        max_files_per_trigger: int | None = None, encoding: str = ENCODING) -> StreamingQuery:
    """Start the stream over a folder of mixed dumps. Files that fail are reported as warnings and not retried by the
    stream; a later :func:`~cadastra.sources.snapshot.ingest_folder` takes them up."""
    import warnings
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    names = reader.load(src_dir).select("path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime")

    def ingest(batch: DataFrame, number: int) -> None:
        errors: list = []
        ingest_files(batch.sparkSession, source_files(batch), out_dir, encoding, f"{checkpoint} batch {number}", errors)
        for base, path, message in errors:
            warnings.warn(f"{path}: {message}")

    writer = names.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_folder_stream(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, **kw) -> None:
    """Process every file available now, then return."""
    q = start_folder_stream(spark, src_dir, out_dir, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
