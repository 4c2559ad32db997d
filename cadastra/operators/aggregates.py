"""Aggregates: row and distinct-key counts, status breakdowns, export summaries.

All are plain ``groupBy``/``agg`` so Spark aggregates partially before the shuffle. A distinct
count over CNPJ keys shuffles on (group, key) — high cardinality, so even a group that holds a
third of the rows is spread over many tasks — and the final per-group merge is tiny.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C


def rows_and_distinct(df: DataFrame, key: Column, rows: str = "registros",
                      distinct: str = "cnpjs_distintos") -> DataFrame:
    """One row: the number of rows and of distinct non-NULL ``key`` values."""
    return df.agg(F.count(F.lit(1)).alias(rows), F.count_distinct(key).alias(distinct))


def status_breakdown(df: DataFrame, status: str, key: Column) -> DataFrame:
    """Rows and distinct keys per status code and label, largest group first."""
    return (df.groupBy(C.try_int(status).alias("codigo"), C.status_label(status).alias("descricao"))
            .agg(F.count(F.lit(1)).alias("registros"), F.count_distinct(key).alias("cnpjs_distintos"))
            .orderBy(F.desc("registros"), F.asc_nulls_last("codigo"), F.asc_nulls_last("descricao")))


def export_summary(df: DataFrame, limit: int | None) -> DataFrame:
    """Rows matching a list and rows an export with ``limit`` writes: ``min(total, limit)``."""
    total = F.count(F.lit(1))
    exported = F.least(total, F.lit(int(limit)).cast("long")) if limit else total
    return df.agg(total.alias("total"), exported.alias("exportadas"))
