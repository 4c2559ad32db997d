"""Ordering: NULLS LAST sorts and a total-order top-K.

Ascending sorts put NULLs last (SQL-engine convention of the registry reports; Spark's default is
NULLS FIRST). A top-K breaks ties on every output column so the K rows are the same on every run;
``orderBy().limit()`` plans as ``TakeOrderedAndProject`` (per-partition top-K, then a merge of
K·partitions rows), never a full sort.

:func:`ranked` numbers the rows of every key without ever bringing a key's rows into one task, and
:func:`pages` turns them into nested arrays of bounded length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def _asc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def order_nulls_last(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Global ascending sort, NULLs last on every key."""
    return df.orderBy(*[_asc(k) for k in keys])


def total_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Sort keys followed by every other column: an order with no ties between distinct rows."""
    rest = [c for c in df.columns if c not in keys]
    return [_asc(k) for k in keys] + [_asc(c) for c in rest]


def top_k(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``keys`` (NULLS LAST), ties broken by all remaining columns."""
    return df.orderBy(*total_order(df, keys)).limit(int(n))


# bits of ``monotonically_increasing_id`` that count rows inside a partition
_ROW_BITS = 33


def ranked(df: DataFrame, key: str, order: Sequence[str | Column], rank: str = "rank") -> DataFrame:
    """``df`` with each row's place (from 1) among the rows of its ``key``, by ``order`` (NULLs last).

    Rows are range-partitioned by key, order and a hash of the whole row with a random salt, so a key with a third of all
    rows is spread over as many partitions as its size asks for. Inside a partition a place is a running
    count; only keys that cross into further partitions need the counts of the earlier ones: a table of at
    most two rows a partition, so it is broadcast.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = [o for o in order if isinstance(o, str)]
    # rows that are equal in all columns may stand in any order: the salt lets a range end between them
    own = [F.col(key), *[_asc(o) for o in order], *[_asc(c) for c in df.columns if c != key and c not in named], F.col("_salt")]
    dealt = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(n, *own).sortWithinPartitions(*own)
    at = F.monotonically_increasing_id()
    rows, _ = written(dealt.drop("_salt").withColumns({"_part": F.shiftright(at, _ROW_BITS), "_at": at}), "ranked")
    runs = rows.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    of_key = Window.partitionBy(key)
    earlier = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a key is in several partitions only where ranges meet
    before = (runs.withColumns({"_parts": F.count(F.lit(1)).over(of_key), "_before": F.sum("_n").over(earlier)})
              .where("_parts > 1 AND _before > 0").select(F.col(key).alias("_key"), F.col("_part").alias("_p"), "_before"))
    here = F.row_number().over(Window.partitionBy(key, "_part").orderBy("_at"))
    return (rows.withColumn("_here", here)
            .join(F.broadcast(before), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p")), "left")
            .withColumn(rank, F.col("_here") + F.coalesce("_before", F.lit(0)))
            .drop("_part", "_at", "_here", "_key", "_p", "_before"))


def pages(df: DataFrame, key: str, order: Sequence[str | Column], name: str, page_rows: int) -> DataFrame:
    """(key, page, ``name``): the rows of every key as arrays of at most ``page_rows`` structs, in order; pages
    count from 1. No group that is gathered is longer than a page."""
    fields = [c for c in df.columns if c != key]
    numbered = ranked(df, key, order, "_rank").withColumn("page", F.floor((F.col("_rank") - 1) / F.lit(page_rows)) + 1)
    gathered = F.array_sort(F.collect_list(F.struct("_rank", F.struct(*fields).alias("row"))))
    return (numbered.groupBy(key, "page").agg(gathered.alias("_rows"))
            .select(key, F.col("page").cast("int").alias("page"), F.transform("_rows", lambda r: r["row"]).alias(name)))
