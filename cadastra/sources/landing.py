"""Landing: write registry bases once as Parquet tables, then query the written tables.

Landed layout (under the cluster's shared ``spark.checkpoint.dir`` unless a root is given)::

    {root}/Estabelecimentos.parquet/uf_norm=MG/part-*.zstd.parquet   sites, partitioned by state
    {root}/Empresas.parquet/part-*.zstd.parquet                       every other base
    {root}/_stats/…                                                   hot-key tables, reused by later sessions
    ...

The folder is an ordinary catalog folder: :func:`~cadastra.sources.catalog.load_catalog` and the
command line read it directly. :func:`curate` writes this layout from any catalog (for example
the output of ``sources.ingest``) into a new folder; :func:`landed_registry` writes it from the driver
tables, under a name that follows from the files it read, so changed tables are landed anew.

* Sites carry ``uf_norm = upper(uf)`` as a partition column, so a state filter prunes whole
  directories instead of reading every file (``upper(uf)`` itself cannot be pushed to Parquet), and
  the lenient integer codes that the lists filter on (:data:`CODE_COLUMNS`), the activity division and
  whether they are active (:data:`FILTER_COLUMNS`), so those filters reach the Parquet scan too.
* Before writing, sites are dealt to buckets of their state by a hash of the whole row: a state gets one
  bucket per ``SITE_ROWS`` rows, measured, so a state or a company that holds a third of all sites is spread
  over as many tasks as its size asks for. Each bucket is a task of its own, so what a task sorts does not
  grow with the table nor by chance.
* Every file is sorted by (state and) ``cnpj_basico``, so Parquet row-group statistics let key filters
  (lookups of one company, joins against few keys) skip row groups. Keys that are scattered over the whole
  range are answered by Bloom filters on ``cnpj_basico``, one a row group.
* A base is written once; a ``_SUCCESS`` marker tells later jobs it is complete, so a lost
  executor or a rerun never reads a half-written table. Reading back starts a fresh lineage.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField

from ..functions.codes import cnae_division, is_active, try_int
from ..operators.joins import is_small
from ..session import checkpoint_root, written
from .catalog import PART_PREFIX, Catalog
from .registry import VIEWS, registry_view
from .schema import schema_of

PARTITION_COLUMN = {"estabelecimentos": "uf_norm"}
SITE_ROWS = 500_000      # site rows per file (about 32 MB of Parquet; some 300 MB of a task's memory while they are sorted)
MAX_SMALL_STATES = 1_000 # tasks beyond those that the rows ask for, so that small states have one of their own
CLUSTER_KEY = "cnpj_basico"
PARTITION_SOURCE = {"uf_norm": F.upper}
# Lenient integer forms of code columns, written beside them (null where the text is no integer).
CODE_COLUMNS = {"estabelecimentos": {"situacao_int": "situacao_cadastral", "matriz_int": "identificador_matriz_filial",
                                     "municipio_int": "municipio", "cnae_int": "cnae_fiscal_principal"},
                "empresas": {"porte_int": "porte_empresa"}}
# Other columns derived from a text column, for filters that would not reach the scan: (source, type, function).
FILTER_COLUMNS = {"estabelecimentos": {"divisao_int": ("cnae_fiscal_principal", IntegerType(), lambda c: try_int(cnae_division(c))),
                                       "ativa": ("situacao_cadastral", BooleanType(), is_active),
                                       "secundaria_id": ("cnae_fiscal_secundaria", LongType(), F.xxhash64)}}
# Secondary activities, inverted: a row for each code of a site, in order of the code.
SECONDARY_INDEX = "_index/secondary_activity"
SECONDARY_KEY = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "secundaria_id"]
SECONDARY_SCHEMA = "codigo string, cnpj_basico string, cnpj_ordem string, cnpj_dv string, secundaria_id long"
# Row groups of these files answer "is this company in here?" by a Bloom filter, so scattered keys read few of them.
BLOOM_BASES = ("empresas", "estabelecimentos", "simples", "socios")
LAYOUT_VERSION = 7       # bump when the landed layout changes: older landings are not reused
DEFAULT_BASES = ("empresas", "estabelecimentos", "simples", "municipios", "cnaes", "socios")

_catalogs: dict[tuple[str, str, str], Catalog] = {}
_lock = threading.Lock()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist (Hadoop file system of the session; any URI scheme it knows)?"""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    except Exception:  # no JVM gateway (Spark Connect): ask the file source instead
        from pyspark.errors import AnalysisException
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            return True
        except AnalysisException:
            return False


def derived_columns(base: str) -> list[str]:
    """Columns that landing adds to a base."""
    return [*CODE_COLUMNS.get(base, {}), *FILTER_COLUMNS.get(base, {}), *([PARTITION_COLUMN[base]] if base in PARTITION_COLUMN else [])]


def with_filter_columns(df: DataFrame, base: str) -> DataFrame:
    """``df`` with the columns that landing derives from its own."""
    own = df.columns
    df = df.withColumns({c: try_int(src) for c, src in CODE_COLUMNS.get(base, {}).items() if src in own})
    return df.withColumns({c: fn(src) for c, (src, _, fn) in FILTER_COLUMNS.get(base, {}).items() if src in own})


def parquet_options(base: str) -> dict[str, str]:
    """Writer options of a base: compression, and Bloom filters on the company key, sized by its distinct values."""
    bloom = {f"parquet.bloom.filter.enabled#{CLUSTER_KEY}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    return {"compression": "zstd", **(bloom if base in BLOOM_BASES else {})}


def write_base(df: DataFrame, path: str, base: str, rows_per_file: int = SITE_ROWS) -> None:
    part = PARTITION_COLUMN.get(base)
    own = df.columns
    w = with_filter_columns(df, base)
    order = [CLUSTER_KEY] if CLUSTER_KEY in own else []
    if part:
        w = w.withColumn(part, PARTITION_SOURCE[part](F.col(part.removesuffix("_norm"))))
        # one row per state: buckets by its measured size, numbered through the states
        sizes = (w.groupBy(F.col(part).alias("_state")).agg(F.count("*").alias("_rows"))
                 .withColumn("_buckets", F.ceil(F.col("_rows") / F.lit(rows_per_file)).cast("long"))
                 .withColumn("_first", F.sum("_buckets").over(Window.orderBy("_state")) - F.col("_buckets")))
        buckets, _ = written(sizes, "site-buckets")
        rows, n = buckets.agg(F.sum("_rows"), F.sum("_buckets")).first()
        # a task a bucket, never two of them by chance; very many small states share tasks
        n = max(1, min(n or 0, 2 * (rows or 0) // rows_per_file + MAX_SMALL_STATES))
        w = w.join(F.broadcast(buckets) if is_small(buckets) else buckets, F.col(part).eqNullSafe(F.col("_state")))
        bucket = F.col("_first") + F.pmod(F.xxhash64(*[F.col(c) for c in own]), F.col("_buckets"))
        w = w.repartitionById(n, F.pmod(bucket, F.lit(n)).cast("int")).drop("_state", "_rows", "_buckets", "_first")
        order = [part, *order]  # the partitioned writer keeps this order: it only asks for the state first
    if order:
        w = w.sortWithinPartitions(*order)
    writer = w.write.mode("overwrite").options(**parquet_options(base))
    if part:
        writer = writer.partitionBy(part)
    writer.parquet(path)


def read_base(spark: SparkSession, path: str, base: str, columns) -> DataFrame:
    schema = schema_of(base, columns)
    for c, src in CODE_COLUMNS.get(base, {}).items():
        if src in columns:
            schema = schema.add(StructField(c, IntegerType(), True))
    for c, (src, kind, _) in FILTER_COLUMNS.get(base, {}).items():
        if src in columns:
            schema = schema.add(StructField(c, kind, True))
    part = PARTITION_COLUMN.get(base)
    if part:
        schema = schema.add(StructField(part, StringType(), True))
    return spark.read.schema(schema).parquet(path)


def publish(spark: SparkSession, tmp: str, path: str) -> None:
    """Move a finished folder into place. If another session finished the same folder first, theirs
    is kept; an unfinished folder (no ``_SUCCESS``) is replaced."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:
        raise NotImplementedError
    Path = jvm.org.apache.hadoop.fs.Path
    src, dst = Path(tmp), Path(path)
    fs = dst.getFileSystem(conf)
    done = Path(dst, "_SUCCESS")
    if fs.exists(dst) and not fs.exists(done):
        fs.delete(dst, True)
    if fs.exists(dst) or not fs.rename(src, dst):
        if not fs.exists(done):
            raise OSError(f"cannot publish {tmp} as {path}")
        fs.delete(src, True)              # a concurrent landing won: drop our own copy
    else:
        # renaming onto a folder created in the meantime moves ours inside it: undo that
        nested = Path(dst, src.getName())
        if fs.exists(nested):
            fs.delete(nested, True)


def _write_once(spark: SparkSession, df: DataFrame, path: str, base: str) -> None:
    """Write a base at ``path`` unless it is there already. The data goes to a unique temporary
    folder first and is then renamed into place, so two sessions landing the same folder at the
    same time never interleave their files."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        return
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
    try:
        write_base(df, tmp, base)
        publish(spark, tmp, path)
    except NotImplementedError:           # no JVM gateway: write in place
        write_base(df, path, base)


def secondary_rows(est: DataFrame) -> DataFrame:
    """(codigo, site key, hash of the site's list): every secondary activity of every site once."""
    codes = F.array_distinct(F.split("cnae_fiscal_secundaria", ","))
    return (est.where(F.col("cnae_fiscal_secundaria").isNotNull())
            .select(F.explode(codes).alias("codigo"), *SECONDARY_KEY[:3], F.xxhash64("cnae_fiscal_secundaria").alias("secundaria_id")))


def _write_index(spark: SparkSession, est: DataFrame, path: str) -> None:
    """The inverted table: range-partitioned by code and site, so that a frequent code is many files, and sorted, so
    that row-group statistics answer a code."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        return
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
    order = ["codigo", *SECONDARY_KEY]
    secondary_rows(est).repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(tmp)
    publish(spark, tmp, path)


def land(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> Catalog:
    out = {}
    for base, df in tables.items():
        if df is None:
            continue
        path = f"{root}/{PART_PREFIX[base]}.parquet"
        added = derived_columns(base)
        plain = df.drop(*added)
        _write_once(spark, plain, path, base)
        out[base] = read_base(spark, path, base, plain.columns)
    indexes = {}
    if out.get("estabelecimentos") is not None and "cnae_fiscal_secundaria" in out["estabelecimentos"].columns:
        try:
            _write_index(spark, out["estabelecimentos"], f"{root}/{SECONDARY_INDEX}")
            indexes["secondary_activity"] = spark.read.schema(SECONDARY_SCHEMA).parquet(f"{root}/{SECONDARY_INDEX}")
        except NotImplementedError:  # no JVM gateway: filters read the lists
            pass
    return Catalog(out, stats_root=f"{root}/_stats", indexes=indexes)


def curate(spark: SparkSession, cat: Catalog, root: str) -> Catalog:
    """Write every base of ``cat`` in the curated layout under the new folder ``root`` and return the
    catalog of the written tables. A folder that already holds one of them is refused: its rows may
    be older than the catalog's."""
    taken = [b for b, df in cat.tables.items() if df is not None and path_exists(spark, f"{root}/{PART_PREFIX[b]}.parquet")]
    if taken:
        raise FileExistsError(f"{root} already holds {', '.join(taken)}: give a new folder")
    return land(spark, dict(cat.tables), root)


def source_version(spark: SparkSession, sf_dir: str, bases) -> str:
    """A tag of the files that the bases are read from: paths, lengths and times of change."""
    tables = sorted({VIEWS[b].source for b in bases})
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]).select("path", "length", "modificationTime"))
    row = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return hashlib.sha1(f"{sf_dir.rstrip('/')} {tuple(row)}".encode()).hexdigest()[:12]


def landed_registry(spark: SparkSession, sf_dir: str, bases=DEFAULT_BASES, root: str | None = None) -> Catalog:
    """Registry bases derived from the driver tables in ``sf_dir``, landed once per state of those files."""
    tag = source_version(spark, sf_dir, bases)
    root = f"{root or checkpoint_root(spark) + '/cadastra-registry'}/v{LAYOUT_VERSION}-{tag}"
    key = (spark.sparkContext.applicationId, root, ",".join(bases))
    with _lock:  # queries started from several threads land each base once
        cat = _catalogs.get(key)
        if cat is None:
            cat = land(spark, {b: registry_view(spark, sf_dir, b) for b in bases}, root)
            _catalogs[key] = cat
    return cat
