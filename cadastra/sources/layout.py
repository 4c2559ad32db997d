"""Co-located layout: the company-keyed bases as bucketed tables, so their joins need no shuffle.

Sites, companies, tax regime and partners are bucketed and sorted by company key into the same number of
buckets: a join on that key reads bucket ``k`` of each side in one task. A company that owns a large share of all sites would
fill one bucket and one task, so the rows of *hot* companies are kept in tables of their own, where sites are spread
over as many files as their number asks for and meet the few company rows by a checked broadcast. Sites without a key
match no company and are a third part. The parts are disjoint by key, so a plan over the registry is the union of
the plan over each part (:func:`over_parts`); sorting, top-k and counts come after the union.

Sites are partitioned by state as in :mod:`~cadastra.sources.landing`, so state filters still prune folders.

Bucketing is known from the session's table catalog only: :func:`read_layout` declares the tables again over the same files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import DEFAULT_SKEW, SkewPolicy, is_small
from .catalog import PART_PREFIX, Catalog
from .landing import (CLUSTER_KEY, PARTITION_COLUMN, PARTITION_SOURCE, SITE_ROWS, derived_columns, parquet_options, path_exists,
                      with_filter_columns, write_base)

KEYED = ("estabelecimentos", "empresas", "simples", "socios")
#: what the folder holds besides the tables: one row a table (base, part, buckets, ddl)
DESCRIPTION = "_layout"


@dataclass(frozen=True)
class Layout:
    """The three disjoint parts of the registry by company key, each a catalog."""
    buckets: int
    cold: Catalog
    hot: Catalog
    keyless: Catalog

    @property
    def parts(self) -> list[Catalog]:
        return [self.cold, self.hot, self.keyless]


def _table_name(path: str) -> str:
    return "cadastra_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def _declare(spark: SparkSession, path: str, ddl: str, buckets: int, partition: str | None) -> DataFrame:
    """The bucketed table over the files of ``path``, declared in the session's catalog if it is not yet there."""
    name = _table_name(path)
    partitioned = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {partitioned} "
              f"CLUSTERED BY ({CLUSTER_KEY}) SORTED BY ({CLUSTER_KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _partitioned(df: DataFrame, base: str) -> tuple[DataFrame, str | None]:
    part = PARTITION_COLUMN.get(base)
    return (df.withColumn(part, PARTITION_SOURCE[part](F.col(part.removesuffix("_norm")))) if part else df), part


def write_layout(cat: Catalog, root: str, skew: SkewPolicy = DEFAULT_SKEW, buckets: int | None = None) -> Layout:
    """Write the keyed bases of ``cat`` under the new folder ``root`` and return the layout of the written tables.

    ``buckets``: by default one for every ``SITE_ROWS`` sites. Hot are companies with more than ``skew.hot_rows`` sites
    or partners, rounded to the sites' threshold: dimension rows of one company are few.
    """
    cat.require("estabelecimentos")
    spark = cat.est.sparkSession
    if path_exists(spark, f"{root}/{DESCRIPTION}"):
        raise FileExistsError(f"{root} already holds a layout: give a new folder")
    n = buckets or max(1, -(-cat.rows("estabelecimentos") // SITE_ROWS))
    hot = cat.hot_keys("estabelecimentos", CLUSTER_KEY, skew.hot_rows)
    if cat.has("socios"):
        hot = hot.unionByName(cat.hot_keys("socios", CLUSTER_KEY, skew.hot_rows)).distinct()
    described = []
    for base in KEYED:
        if not cat.has(base):
            continue
        plain = cat.tables[base].drop(*derived_columns(base))
        keyed = plain.where(F.col(CLUSTER_KEY).isNotNull())
        few = F.broadcast(hot) if is_small(hot) else hot
        cold, part = _partitioned(with_filter_columns(keyed.join(few, CLUSTER_KEY, "left_anti"), base), base)
        path = f"{root}/cold/{PART_PREFIX[base]}"
        # one task a bucket: the same hash deals rows to tasks and to buckets
        writer = cold.repartition(n, CLUSTER_KEY).write.format("parquet").options(**parquet_options(base))
        writer = writer.partitionBy(part) if part else writer
        name = _table_name(path)
        writer.bucketBy(n, CLUSTER_KEY).sortBy(CLUSTER_KEY).option("path", path).saveAsTable(name)
        write_base(keyed.join(few, CLUSTER_KEY, "left_semi"), f"{root}/hot/{PART_PREFIX[base]}.parquet", base)
        write_base(plain.where(F.col(CLUSTER_KEY).isNull()), f"{root}/keyless/{PART_PREFIX[base]}.parquet", base)
        described.append((base, n, spark.table(name).schema.toDDL()))
    spark.createDataFrame(described, "base string, buckets int, ddl string").coalesce(1).write.parquet(f"{root}/{DESCRIPTION}")
    return read_layout(spark, root, cat)


def read_layout(spark: SparkSession, root: str, lookups: Catalog) -> Layout:
    """The layout under ``root``; tables without a company key come from ``lookups``."""
    shared = {b: df for b, df in lookups.tables.items() if b not in KEYED}
    cold, hot, keyless, buckets = dict(shared), dict(shared), dict(shared), 1
    for r in spark.read.parquet(f"{root}/{DESCRIPTION}").collect():  # one row a base
        base, buckets = r["base"], r["buckets"]
        cold[base] = _declare(spark, f"{root}/cold/{PART_PREFIX[base]}", r["ddl"], buckets, PARTITION_COLUMN.get(base))
        schema = cold[base].schema
        hot[base], keyless[base] = (spark.read.schema(schema).parquet(f"{root}/{kind}/{PART_PREFIX[base]}.parquet")
                                    for kind in ("hot", "keyless"))
        if base in ("empresas", "simples") and is_small(hot[base]):
            hot[base] = F.broadcast(hot[base])
        if base != "estabelecimentos":  # a row without a key is no company's
            keyless[base] = spark.createDataFrame([], schema)
    return Layout(buckets, Catalog(cold), Catalog(hot), Catalog(keyless))


def over_parts(layout: Layout, plan: Callable[[Catalog], DataFrame]) -> DataFrame:
    """The union of ``plan`` over the parts. ``plan`` joins sites with keyed bases on the company key alone, without
    sorting, limiting or counting across companies; give it a disabled ``SkewPolicy``, as the parts are split already."""
    return reduce(DataFrame.unionByName, [plan(part) for part in layout.parts])


#: for plans over the parts of a layout
SPLIT_ALREADY = SkewPolicy(enabled=False)
