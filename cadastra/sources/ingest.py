"""Ingest: a folder of raw dumps → one ZSTD Parquet dataset per source file.

1. list the files (no contents read), detect each one's base from its name (or, for Spark-written
   part files, from the folder's name) and drop those the manifest already holds;
2. profile what is pending, one task per file: first record, header test; one splittable scan finds
   the files whose records span lines;
3. read each file with the dump rules (bad rows, NULL tokens) under its own names — dictionary, its
   header, or ``col_NN`` — and write it as its own dataset ``{Base}-{hash of the path}.parquet``;
4. append the ingested sources to the manifest.

A file that fails is reported and stops no other. Writing a source again overwrites its own dataset
and nothing else, so a run after a lost manifest leaves no duplicates. All datasets of a base are read
together with the ``{Base}*.parquet`` glob. Each file is a CSV scan → projection → Parquet write:
parallel over splits, no shuffle; a few files run at a time. Only file metadata reaches the driver,
in batches.
"""

from __future__ import annotations

import hashlib
import itertools
import posixpath
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .catalog import PART_PREFIX
from .dumps import ENCODING, column_plan, file_profiles, list_files, multiline_files, read_dump
from .records import BLOCK_BYTES
from .schema import INGEST_BASE_RULES, detect_base
from .schemas import record_schemas

MANIFEST = "_ingested"
#: files ingested at the same time, and sources handled between two appends to the manifest
AT_ONCE, BATCH = 8, 256


def list_sources(spark: SparkSession, src_root: str, glob: str = "*", skip: str | None = None) -> DataFrame:
    """Dump files under ``src_root``: path, name, length, base. ``skip`` names a suffix to leave out."""
    files = list_files(spark, src_root, glob).where(~F.col("name").startswith("_") & ~F.col("name").startswith("."))
    if skip:
        files = files.where(~F.lower("name").endswith(skip))
    return with_base(files)


def with_base(files: DataFrame) -> DataFrame:
    """``files`` (path, name) with the base of their names, else of their folders' names."""
    own = detect_base(F.col("name"), INGEST_BASE_RULES)
    folder = detect_base(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1), INGEST_BASE_RULES)
    return files.withColumn("base", F.coalesce(F.nullif(own, F.lit("")), folder))


def profile_sources(spark: SparkSession, src_root: str, glob: str = "*") -> DataFrame:
    """Per dump file: path, name, length, base, first record, its fields, header test."""
    return file_profiles(list_sources(spark, src_root, glob))


def pending(sources: DataFrame, done: DataFrame | None, key: str = "path") -> DataFrame:
    """Sources not yet in the done-manifest (anti join on ``key``)."""
    return sources if done is None else sources.join(done.select(key).distinct(), key, "left_anti")


def read_manifest(spark: SparkSession, out_root: str) -> DataFrame | None:
    from .landing import path_exists
    p = f"{out_root}/{MANIFEST}"
    return spark.read.parquet(p) if path_exists(spark, p) else None


def dataset_of(out_root: str, base: str, path: str) -> str:
    """Where the source ``path`` is written: the name depends on nothing but the base and the path."""
    return f"{out_root}/{PART_PREFIX.get(base, base or 'Desconhecido')}-{hashlib.sha1(path.encode()).hexdigest()[:16]}.parquet"


def ingest_file(spark: SparkSession, source: Row, out_root: str, encoding: str = ENCODING) -> tuple[int, list[str]]:
    """Write one profiled source as its own dataset; returns the number of rows dropped as too long, and the columns."""
    if source["failure"]:
        raise OSError(source["failure"])
    if not source["fields"]:
        raise ValueError("the file holds no record")
    names, own_header = column_plan(source["base"], source["fields"], source["has_header"])
    seen = Observation()
    multiline = "split" if source["multiline"] and source["length"] > BLOCK_BYTES else source["multiline"]
    df = read_dump(spark, source["path"], names, header=own_header, encoding=encoding, multiline=multiline, observation=seen)
    df.write.mode("overwrite").option("compression", "zstd").parquet(dataset_of(out_root, source["base"], source["path"]))
    return seen.get["long_rows"] or 0, names


def ingest_directory(spark: SparkSession, src_root: str, out_root: str, glob: str = "*",
                     encoding: str = ENCODING, multiline: bool | None = None,
                     errors: list | None = None, skip: str | None = None) -> dict[str, str]:
    """Ingest every pending dump under ``src_root``; returns {base: glob of its Parquet datasets}.

    ``multiline=None`` decides per file: files whose records never span lines are read in the
    splittable single-line mode (many tasks per file), the others in multi-line mode, large ones of them by
    records (many tasks per file as well). Long rows
    dropped by the bad-row rule are counted in the same pass and reported as a warning. Failures
    are collected in ``errors`` as ``(base, path, message)`` — without that list, the first one is
    raised after the other files are done — and stay out of the manifest, so the next run retries them.
    """
    todo = pending(list_sources(spark, src_root, glob, skip), read_manifest(spark, out_root))
    written: dict[str, str] = {}
    failures: list = []
    waiting = todo.orderBy("path").toLocalIterator()
    while batch := list(itertools.islice(waiting, BATCH)):
        listed = spark.createDataFrame(batch, todo.schema)
        profiled = file_profiles(listed, encoding)
        if multiline is None:
            spans = multiline_files(spark, [r["path"] for r in batch], encoding)
            profiled = profiled.join(spans, "path", "left")
        else:
            profiled = profiled.withColumn("multiline", F.lit(bool(multiline)))
        done, columns = [], {}

        def one(source: Row) -> None:
            base = source["base"]
            try:
                dropped, names = ingest_file(spark, source, out_root, encoding)
            except Exception as e:  # this source stays pending
                failures.append((base, source["path"], f"{type(e).__name__}: {e}"[:500], e))
                return
            if dropped:
                warnings.warn(f"{source['path']}: skipped {dropped} rows with too many fields")
            done.append((source["path"], base))
            columns[posixpath.basename(dataset_of(out_root, base, source["path"]))] = StructType(
                [StructField(n, StringType()) for n in names])

        profiles = profiled.withColumn("multiline", F.coalesce("multiline", F.lit(False))).drop("first_record").collect()
        with ThreadPoolExecutor(AT_ONCE) as pool:  # one row per file of the batch
            list(pool.map(inheritable_thread_target(spark)(one), profiles))
        if done:
            record_schemas(spark, out_root, columns)
            spark.createDataFrame(done, "path string, base string").write.mode("append").parquet(f"{out_root}/{MANIFEST}")
        for _, base in done:
            written[base] = f"{out_root}/{PART_PREFIX.get(base, base or 'Desconhecido')}-*.parquet"
    if errors is not None:
        errors.extend(f[:3] for f in failures)
    elif failures:
        raise failures[0][3]
    return written
