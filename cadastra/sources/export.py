"""Spreadsheet export: ``;``-delimited CSV with a header and a UTF-8 byte-order mark.

* One pass: the row count comes from an ``Observation`` on the written DataFrame, so the list is
  computed once (not once for the count and again for the file).
* The BOM is part of the first header name, so every part file starts with it and no file is
  copied afterwards.
* Multi-part output by default. ``single_file=True`` gives one file without one task that all rows pass:
  range-partitioned, sorted parts without a header and a header of its own are written, then joined by
  ordinal. A file system that concatenates does so in its metadata; on a shared POSIX folder tasks copy
  the parts to their offsets in one file. Elsewhere (object stores) one task writes the file.
* Rows are sorted by ``sort_by``, then by the other columns, so a frequent key spreads over several
  ranges and the bytes do not depend on the partitions. Without ``sort_by`` the order of ``df`` is kept.
* NULL is written as an empty field and ``''`` as ``""``; readers of the export get both back
  as NULL.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .dumps import by_size, parsed
from .records import read_records

BOM = "\ufeff"
DELIMITER = ";"


_OPTIONS = {"sep": DELIMITER, "quote": '"', "escape": '"', "encoding": "UTF-8", "compression": "none",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: bytes that one row of the copy plan stands for, and that a task holds at a time
COPY_RANGE = 64 << 20
COPY_BUFFER = 4 << 20


def export_csv(df: DataFrame, path: str, bom: bool = True, single_file: bool = False,
               sort_by: Sequence[str] | None = None, limit: int | None = None) -> int:
    """Write ``df`` into the folder ``path`` and return the number of rows written.

    A file of ``single_file`` appears by a rename, after all of its bytes are there; what the folder held
    before is removed just before that, so a run that fails while it writes leaves it.
    """
    out = df.limit(int(limit)) if limit else df
    spark = df.sparkSession
    joined = _joiner(spark, path) if single_file else None
    order = [F.col(f"`{c}`").asc_nulls_last() for c in
             [*(sort_by or ()), *(c for c in out.columns if c not in (sort_by or ()))]]
    if joined and sort_by:
        out = out.orderBy(*order)
    elif single_file and not joined:
        out = out.repartition(1).sortWithinPartitions(*order) if sort_by else out.coalesce(1)
    if bom:
        first = out.columns[0]
        out = out.withColumnRenamed(first, BOM + first)
    obs = Observation("export")
    rows = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if not joined:
        rows.write.mode("overwrite").options(**_OPTIONS, header="true").csv(path)
        return int(obs.get["rows"])
    work = f"{path}/_export-{uuid.uuid4().hex[:12]}"  # readers skip names that start with _
    rows.write.options(**_OPTIONS, header="false").csv(f"{work}/rows")
    spark.createDataFrame([], out.schema).coalesce(1).write.options(**_OPTIONS, header="true").csv(f"{work}/header")
    joined(spark, [*_parts(spark, f"{work}/header"), *_parts(spark, f"{work}/rows")], f"{work}/joined")
    _publish(spark, f"{work}/joined", path, work)
    return int(obs.get["rows"] or 0)


def _fs(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _joiner(spark: SparkSession, path: str) -> Callable[[SparkSession, list[tuple[str, int]], str], None] | None:
    """How the file system of ``path`` joins files; None where it cannot."""
    p, fs = _fs(spark, path)
    fs.mkdirs(p)
    if fs.hasPathCapability(p, "fs.capability.paths.concat"):
        return _concatenate
    return _copy_to_offsets if fs.resolvePath(p).toUri().getScheme() == "file" else None


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, length) of the part files of a written folder that hold bytes, by partition and file number."""
    p, fs = _fs(spark, folder)
    found = []
    for f in fs.listStatus(p):
        named = re.match(r"part-(\d+)-.*?(?:-c(\d+))?\.csv$", f.getPath().getName())
        if named and f.getLen():
            found.append((int(named[1]), int(named[2] or 0), f.getPath().toString(), f.getLen()))
    return [(name, length) for _, _, name, length in sorted(found)]


def _concatenate(spark: SparkSession, parts: list[tuple[str, int]], target: str) -> None:
    """Join ``parts`` in the file system's metadata: the first one takes the blocks of the others."""
    _, fs = _fs(spark, target)
    _concat(fs, spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._gateway.new_array, parts, target)


def _concat(fs, hadoop_path, new_array, parts: list[tuple[str, int]], target: str) -> None:
    head, *rest = [hadoop_path(name) for name, _ in parts]
    if rest:
        sources = new_array(hadoop_path, len(rest))
        for i, part in enumerate(rest):
            sources[i] = part
        fs.concat(head, sources)
    if not fs.rename(head, hadoop_path(target)):
        raise OSError(f"could not rename {parts[0][0]} to {target}")


def copy_ranges(parts: list[tuple[str, int]]) -> list[tuple[str, int, int, int]]:
    """(path, start, length, offset) of every range of at most ``COPY_RANGE`` bytes: ``start`` in its part,
    ``offset`` in the joined file."""
    out, offset = [], 0
    for name, length in parts:
        out += [(name, at, min(COPY_RANGE, length - at), offset + at) for at in range(0, length, COPY_RANGE)]
        offset += length
    return out


def _copy_to_offsets(spark: SparkSession, parts: list[tuple[str, int]], target: str) -> None:
    """Join ``parts`` on a POSIX folder that all executors share: tasks copy ranges to their places.

    A range always gets the same bytes, so a task that is retried or runs twice does no harm.
    """
    def local(path: str) -> str:
        p, fs = _fs(spark, path)
        return fs.resolvePath(p).toUri().getPath()

    parent, name = target.rsplit("/", 1)
    into = f"{local(parent)}/{name}"
    folders = {n.rsplit("/", 1)[0] for n, _ in parts}
    at = {f: local(f) for f in folders}
    ranges = copy_ranges([(f"{at[n.rsplit('/', 1)[0]]}/{n.rsplit('/', 1)[1]}", length) for n, length in parts])

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fd = os.open(into, os.O_WRONLY | os.O_CREAT, 0o644)
        try:
            for b in batches:
                done = 0
                for source, start, length, offset in zip(*(c.to_pylist() for c in b.columns)):
                    with open(source, "rb") as f:
                        f.seek(start)
                        while length:
                            data = f.read(min(COPY_BUFFER, length))
                            if not data:
                                raise OSError(f"{source} is shorter than listed")
                            view = memoryview(data)
                            while view:
                                n = os.pwrite(fd, view, offset)
                                view, offset, done = view[n:], offset + n, done + n
                            length -= len(data)
                yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["bytes"])
            os.fsync(fd)
        finally:
            os.close(fd)

    plan = spark.createDataFrame(ranges, "path string, start long, length long, offset long")
    tasks = min(len(ranges), 4 * spark.sparkContext.defaultParallelism)
    copied = plan.repartition(tasks).mapInArrow(copy, "bytes long").agg(F.sum("bytes")).first()[0]
    p, fs = _fs(spark, target)
    total = sum(length for _, length in parts)
    if copied != total or fs.getFileStatus(p).getLen() != total:
        raise OSError(f"{target} holds {fs.getFileStatus(p).getLen()} of {total} bytes")


def _publish(spark: SparkSession, joined: str, path: str, work: str) -> None:
    """Put the joined file in the place of what the folder ``path`` holds."""
    folder, fs = _fs(spark, path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = [f.getPath() for f in fs.listStatus(folder)]
    fs.delete(hadoop_path(f"{path}/_SUCCESS"), False)
    for p in old:
        if not p.getName().startswith("_"):
            fs.delete(p, True)
    if not fs.rename(hadoop_path(joined), hadoop_path(f"{path}/part-00000.csv")):
        raise OSError(f"could not rename {joined}")
    fs.delete(hadoop_path(work), True)
    fs.create(hadoop_path(f"{path}/_SUCCESS")).close()


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Read an export back (header names without the BOM). Large files are read by many tasks each."""
    reader = lambda whole: (spark.read.option("sep", DELIMITER).option("header", "true").option("quote", '"')
                            .option("escape", '"').option("multiLine", whole))
    df = reader("true").csv(path)
    small, lines, spans = by_size(spark, path, "UTF-8")
    if lines or spans:
        parts = [reader(whole).schema(df.schema).csv(files) for files, whole in ((small, "true"), (lines, "false")) if files]
        parts += [parsed(read_records(spark, spans), df.schema, True, "UTF-8")] if spans else []
        df = reduce(DataFrame.unionByName, parts)
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])
