"""Helpers shared by the operators: shared-folder tables, order-preserving ids, size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra.session import scratch_path

#: the white space of the word and line contracts: space and U+0009 to U+000D
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage; survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` for helper columns, each lengthened by ``_`` until no column of ``df`` is called so."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered_ids(df: DataFrame, order: list[str], name: str, id_col: str = "gid") -> DataFrame:
    """``df`` with an order-preserving long ``id_col``: range partitions, sorted, numbered, written.

    Ids ascend with ``order`` (they have gaps between partitions). The table is written before it is
    used, so every reader sees the same ids.
    """
    n = shuffle_partitions(df.sparkSession)
    out = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn(id_col, F.monotonically_increasing_id()))
    return materialise(out, name)


#: bits of ``monotonically_increasing_id`` that count rows inside a partition
ROW_BITS = 33


def previous_ids(ids: DataFrame, id_col: str = "gid") -> DataFrame:
    """(``id_col``, ``prev``): the next lower id, null for the first.

    Inside a partition that is id - 1; only the first row of each partition needs the last id of the
    partition before it, from a table of one row per partition.
    """
    part = F.shiftrightunsigned(F.col(id_col), ROW_BITS)
    edges = ids.groupBy(part.alias("part")).agg(F.max(id_col).alias("last"))
    # one row per shuffle partition: a bounded window and a bounded broadcast
    before = edges.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"))
    return (ids.select(id_col, part.alias("part")).join(F.broadcast(before), "part")
            .select(id_col, F.when(F.col(id_col).bitwiseAND((1 << ROW_BITS) - 1) > 0, F.col(id_col) - 1)
                    .otherwise(F.col("before")).alias("prev")))


def md5_long(*cols: Column) -> Column:
    """A non-negative 60-bit number from the md5 of the columns joined by '|' (same in any SQL engine)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("long")


def lowest(rows: DataFrame, mixed: Column, order: list[str], limit: int) -> DataFrame:
    """The ``limit`` distinct ``rows`` of the lowest 64-bit hash ``mixed``, ties by ``order``; all if fewer.

    Only rows under a bound on the hash are sorted, so that tasks hand on some ``2 * limit`` rows
    together, not ``limit`` rows each. The bound follows from the number of rows and is raised until
    ``limit`` distinct ones lie under it, so the result is that of sorting them all.
    """
    n = rows.count()
    share = 2 * limit / max(n, 1)
    near = rows.distinct()
    while share < 1:
        under = rows.where(mixed < int(-(1 << 63) + share * 2.0 ** 64)).distinct()
        if under.count() >= limit:
            near = under
            break
        share *= 4
    return near.orderBy(mixed, *order).limit(limit)
