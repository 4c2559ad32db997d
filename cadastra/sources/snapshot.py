"""Ingest of many dump files in few jobs, published at once by versioned snapshots.

Files that are read alike (same base, names, header and line mode) are one *plan*: one scan, one dataset, however many files
it has. Rows carry their source's number, and a dataset is never changed after it is written::

    {out}/{Base}/{version}-{plan}/part-*.parquet       rows of one plan, with the column ``_source``
    {out}/_snapshots/{number}/                          what is live: a row a source (base, dataset, source, names, …)

A snapshot is written to a folder of another name and renamed, so a reader takes the newest finished one and sees either
the state before a run or the state after it, also while the run goes on. A source whose file has changed (length or
time) is ingested again; the next snapshot names its new dataset and no longer the old one, whose rows are then left out
by source number: a dataset that has fewer live sources than it was written with is filtered, others are not. Two runs at a time: the later one builds on the snapshot of the earlier.

Column names come from the snapshot, so planning a read opens no file footers. Datasets with the same names are one scan.

A plan that fails is halved until the failing files stand alone; they are reported and stay pending.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .catalog import PART_PREFIX
from .dumps import ENCODING, column_plan, file_profiles, multiline_files, read_dump
from .ingest import with_base
from .landing import path_exists, publish
from .records import BLOCK_BYTES

SNAPSHOTS = "_snapshots"
SOURCE = "_source"
LIVE = ("base string, dataset string, path string, source long, length long, changed timestamp, names string, "
        "members long, tag string, writer string")
#: files of one batch: what the driver holds is a row a file
BATCH = 100_000


# -- snapshots

def _numbers(spark: SparkSession, out_root: str) -> list[int]:
    """Numbers of the finished snapshots."""
    root = f"{out_root}/{SNAPSHOTS}"
    if not path_exists(spark, root):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{root}/{n}/_SUCCESS"))


def live_sources(spark: SparkSession, out_root: str) -> tuple[int, DataFrame]:
    """Number and rows of the newest snapshot (0 and no rows before the first)."""
    numbers = _numbers(spark, out_root)
    if not numbers:
        return 0, spark.createDataFrame([], LIVE)
    return numbers[-1], spark.read.schema(LIVE).parquet(f"{out_root}/{SNAPSHOTS}/{numbers[-1]}")


def commit(spark: SparkSession, out_root: str, added: DataFrame, attempts: int = 20) -> int:
    """Publish the newest snapshot with ``added`` sources in place of older rows of the same paths; returns its number."""
    writer = uuid.uuid4().hex
    for _ in range(attempts):
        number, live = live_sources(spark, out_root)
        kept = live.join(added.select("path"), "path", "left_anti").select(*live.columns)
        target = f"{out_root}/{SNAPSHOTS}/{number + 1}"
        temporary = f"{out_root}/{SNAPSHOTS}/.{writer}-{number + 1}"
        kept.unionByName(added.withColumn("writer", F.lit(writer)).select(*live.columns)).write.parquet(temporary)
        publish(spark, temporary, target)
        # another run may have taken the number first: its snapshot was kept, ours goes on top of it
        if not spark.read.schema(LIVE).parquet(target).where(F.col("writer") == writer).isEmpty():
            return number + 1
    raise RuntimeError("other runs kept publishing first")


def read_snapshot(spark: SparkSession, out_root: str, base: str, number: int | None = None) -> DataFrame | None:
    """The live rows of ``base`` in the newest (or the given) snapshot, or None if it has none."""
    if number is None:
        number, live = live_sources(spark, out_root)
    else:
        live = spark.read.schema(LIVE).parquet(f"{out_root}/{SNAPSHOTS}/{number}")
    mine = live.where(F.col("base") == base)
    # a dataset that holds rows of sources which a later one replaced has fewer live sources than members
    datasets = (mine.groupBy("names", "dataset").agg((F.count("*") == F.max("members")).alias("whole"))
                .groupBy("names", "whole").agg(F.sort_array(F.collect_list("dataset")).alias("datasets")).collect())
    parts = [_rows(spark, json.loads(r["names"]), r["datasets"], None if r["whole"] else mine) for r in datasets]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _rows(spark: SparkSession, names: list[str], datasets: list[str], live: DataFrame | None) -> DataFrame:
    schema = StructType([*(StructField(n, StringType()) for n in names), StructField(SOURCE, LongType())])
    rows = spark.read.schema(schema).parquet(*datasets)
    if live is not None:  # the planner broadcasts the numbers of live sources if they are few
        wanted = live.where(F.col("dataset").isin(datasets)).select(F.col("source").alias(SOURCE))
        rows = rows.join(wanted, SOURCE, "left_semi")
    return rows.drop(SOURCE)


# -- ingest

def list_folder(spark: SparkSession, src_root: str, glob: str = "*") -> DataFrame:
    """Files under ``src_root``: path, uri (as scans name them), length, modificationTime; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(src_root)
            .select("path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime"))


def source_files(listed: DataFrame) -> DataFrame:
    """The dumps among listed files: path, uri, name, length, changed, base."""
    files = listed.select("path", "uri", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length",
                          F.col("modificationTime").alias("changed"))
    return with_base(files.where(~F.col("name").startswith("_") & ~F.col("name").startswith(".")))


def pending_files(files: DataFrame, live: DataFrame) -> DataFrame:
    """Files that the snapshot does not hold as they are now."""
    return files.join(live.select("path", "length", "changed"), ["path", "length", "changed"], "left_anti").select(*files.columns)


def _source_number(path: str, run: str) -> int:
    return int.from_bytes(hashlib.sha1(f"{run} {path}".encode()).digest()[:8], "big", signed=True)


def _write_plan(spark: SparkSession, out_root: str, run: str, plan: tuple, files: list[Row], encoding: str, failures: list) -> list[tuple]:
    """Write the files of one plan as one dataset; rows for the snapshot. On failure, halves are tried apart."""
    base, names, header, mode = plan
    name = hashlib.sha1(f"{run} {plan} {files[0]['path']}".encode()).hexdigest()[:16]
    dataset = f"{out_root}/{PART_PREFIX.get(base, base or 'Desconhecido')}/{run}-{name}"
    numbers = {f["path"]: _source_number(f["path"], run) for f in files}
    seen = Observation()
    try:
        if mode == "split":  # a large file is a plan of its own
            rows = read_dump(spark, files[0]["path"], names, header=header, encoding=encoding, multiline=mode, observation=seen)
            rows = rows.withColumn(SOURCE, F.lit(numbers[files[0]["path"]]))
        else:
            known = spark.createDataFrame([(f["uri"], numbers[f["path"]]) for f in files], f"_uri string, {SOURCE} long")
            rows = read_dump(spark, [f["path"] for f in files], names, header=header, encoding=encoding, multiline=mode, observation=seen,
                             keep_uri="_uri")
            rows = rows.join(F.broadcast(known), "_uri").drop("_uri")  # at most BATCH rows
        rows.write.option("compression", "zstd").parquet(dataset)
    except Exception as e:
        if len(files) == 1:
            failures.append((base, files[0]["path"], f"{type(e).__name__}: {e}"[:500]))
            return []
        half = len(files) // 2
        return [r for part in (files[:half], files[half:])
                for r in _write_plan(spark, out_root, run, plan, part, encoding, failures)]
    if seen.get["long_rows"]:
        warnings.warn(f"{base or 'unknown'}: skipped {seen.get['long_rows']} rows with too many fields in {len(files)} files")
    return [(base, dataset, f["path"], numbers[f["path"]], f["length"], f["changed"], json.dumps(list(names)), len(files))
            for f in files]


def ingest_files(spark: SparkSession, files: DataFrame, out_root: str, encoding: str = ENCODING, tag: str = "",
                 errors: list | None = None) -> int:
    """Ingest the pending ones of ``files`` (of :func:`source_files`) and publish them at once; returns the number of the
    newest snapshot. ``tag`` names the run: a tag that a snapshot already holds is done and does nothing.

    Failures are collected in ``errors`` as (base, path, message); without that list the first is raised after the
    rest is published.
    """
    number, live = live_sources(spark, out_root)
    if tag and not live.where(F.col("tag") == tag).isEmpty():
        return number
    listed = pending_files(files, live).collect()
    failures: list = []
    for k in range(0, len(listed), BATCH):
        batch = spark.createDataFrame(listed[k:k + BATCH], files.schema)
        spans = multiline_files(spark, [r["path"] for r in listed[k:k + BATCH]], encoding).withColumnRenamed("path", "uri")
        profiles = file_profiles(batch, encoding).drop("first_record").join(spans, "uri", "left").collect()
        plans: dict[tuple, list[Row]] = {}
        for f in sorted(profiles, key=lambda r: r["path"]):
            if f["failure"] or not f["fields"]:
                failures.append((f["base"], f["path"], f["failure"] or "the file holds no record"))
                continue
            names, header = column_plan(f["base"], f["fields"], f["has_header"])
            mode = bool(f["multiline"])
            if mode and f["length"] > BLOCK_BYTES:
                plans[(f["base"], tuple(names), header, "split"), f["path"]] = [f]
            else:
                plans.setdefault(((f["base"], tuple(names), header, mode), ""), []).append(f)
        run = uuid.uuid4().hex[:12]
        done = [r for (plan, _), members in plans.items() for r in _write_plan(spark, out_root, run, plan, members, encoding, failures)]
        if done:
            added = spark.createDataFrame([(*r, tag, None) for r in done], LIVE)
            number = commit(spark, out_root, added)
    if errors is not None:
        errors.extend(failures)
    elif failures:
        raise OSError(f"{failures[0][1]}: {failures[0][2]}")
    return number


def ingest_folder(spark: SparkSession, src_root: str, out_root: str, glob: str = "*", **kw) -> int:
    """:func:`ingest_files` of everything under ``src_root``."""
    return ingest_files(spark, source_files(list_folder(spark, src_root, glob)), out_root, **kw)


def bases_in(spark: SparkSession, out_root: str) -> Iterable[str]:
    """Bases that the newest snapshot holds."""
    return sorted(r[0] for r in live_sources(spark, out_root)[1].select("base").distinct().collect())
