"""Schema records: the columns of landed datasets, kept beside them, so that planning a scan opens no file footers.

``{root}/_schemas`` holds a row a written dataset: name, schema, and the time of its mark of success. A record counts only
while that time is the dataset's own: one that was written again by other means is not described by it, and the scan then
reads footers as before.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

RECORDS = "_schemas"
_COLUMNS = "dataset string, changed long, fields string"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def finished_at(spark: SparkSession, dataset: str) -> int | None:
    """Time of the dataset's mark of success, None without one."""
    p, fs, _ = _file_system(spark, f"{dataset}/_SUCCESS")
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def record_schemas(spark: SparkSession, root: str, schemas: dict[str, StructType]) -> None:
    """Record the schemas of finished datasets (by name below ``root``)."""
    rows = [(name, finished_at(spark, f"{root}/{name}"), schema.json()) for name, schema in schemas.items()]
    spark.createDataFrame(rows, _COLUMNS).coalesce(1).write.mode("append").parquet(f"{root}/{RECORDS}")


def merged(schemas: Iterable[StructType]) -> StructType | None:
    """The columns of all, by name; None if one name has several types."""
    out: dict = {}
    for schema in schemas:
        for f in schema.fields:
            if f.name in out and out[f.name].dataType != f.dataType:
                return None
            out.setdefault(f.name, f)
    return StructType(list(out.values()))


def recorded_schema(spark: SparkSession, root: str, pattern: str) -> StructType | None:
    """The merged schema of the datasets that ``pattern`` names below ``root``, if every one has a valid record."""
    p, fs, jvm = _file_system(spark, f"{root}/{RECORDS}")
    if not fs.exists(p):
        return None
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{pattern}")) or []
    names = [s.getPath().getName() for s in found]
    if not names:
        return None
    records = spark.read.schema(_COLUMNS).parquet(f"{root}/{RECORDS}")
    known = {(r["dataset"], r["changed"]): r["fields"] for r in records.where(records.dataset.isin(names)).collect()}
    fields = [known.get((name, finished_at(spark, f"{root}/{name}"))) for name in names]
    if None in fields:
        return None
    return merged(StructType.fromJson(json.loads(f)) for f in fields)
