"""Table catalog: one DataFrame per registry base.

Two ways in:

* :func:`load_catalog` – a directory of landed Parquet parts named by base (``Empresas*.parquet``,
  ``Estabelecimentos*.parquet`` …). Every part of a base is one table (glob scan); columns are
  matched by name. Sites and companies are mandatory; the rest degrade to "absent".
* :func:`registry_catalog` – the registry bases derived from the driver tables.

An absent optional base is ``None``; plans then skip its join and emit NULL/'' columns instead.
"""

from __future__ import annotations

from collections.abc import Iterable
import uuid
import warnings
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .registry import registry_view
from .schemas import recorded_schema

# File-name stem of each base in a landed directory.
PART_PREFIX = {
    "empresas": "Empresas",
    "estabelecimentos": "Estabelecimentos",
    "simples": "Simples",
    "socios": "Socios",
    "municipios": "Municipios",
    "cnaes": "Cnaes",
    "motivos": "Motivos",
    "naturezas": "Naturezas",
    "paises": "Paises",
    "qualificacoes": "Qualificacoes",
}


class MissingTableError(RuntimeError):
    pass


@dataclass
class Catalog:
    tables: dict[str, DataFrame | None] = field(default_factory=dict)
    # per-session memo of table statistics (row counts, hot-key tables), shared by derived catalogs
    stats: dict = field(default_factory=dict)
    # where hot-key tables are kept across sessions (set for curated folders)
    stats_root: str | None = None
    # landed inverted tables by name; only right for the tables that they were written from
    indexes: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, base: str) -> DataFrame | None:
        return self.tables.get(base)

    def has(self, base: str) -> bool:
        return self.tables.get(base) is not None

    def require(self, *bases: str) -> None:
        missing = [b for b in bases if not self.has(b)]
        if missing:
            raise MissingTableError(f"mandatory tables absent: {', '.join(missing)}")

    def without(self, *bases: str) -> Catalog:
        """Same catalog with some bases marked absent (to exercise the degraded plans)."""
        return Catalog({b: (None if b in bases else df) for b, df in self.tables.items()}, self.stats,
                       self.stats_root, self.indexes)

    def rows(self, base: str) -> int:
        """Row count of a base (Parquet answers it from file footers); memoised."""
        k = ("rows", base)
        if k not in self.stats:
            self.stats[k] = self.tables[base].count()
        return self.stats[k]

    def hot_keys(self, base: str, key: str, hot_rows: int) -> DataFrame:
        """Keys of ``base`` with more than ``hot_rows`` rows, computed once per session and kept as a
        small written table. A key hot in any filtered subset is in this set, so plans may use it
        for filtered inputs too."""
        k = ("hot", base, key, hot_rows)
        if k not in self.stats:
            from ..operators.joins import hot_keys
            from ..session import scratch_path
            from .landing import path_exists, publish
            df = self.tables[base]
            spark = df.sparkSession
            if self.stats_root:
                path = f"{self.stats_root}/hot-{base}-{key}-{hot_rows}"
            else:
                path = scratch_path(spark, f"hot-{base}-{key}")
            if not path_exists(spark, f"{path}/_SUCCESS"):
                tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
                hot_keys(df, key, hot_rows).write.parquet(tmp)
                try:
                    publish(spark, tmp, path)
                except NotImplementedError:  # no JVM gateway: keep the written copy where it is
                    path = tmp
            self.stats[k] = spark.read.parquet(path)
        return self.stats[k]

    def skew_inputs(self, base: str, key: str, policy) -> dict:
        """Arguments for ``fact_join`` over (a filtered view of) ``base``: a proven row bound, and
        the base's hot keys when the bound does not already rule hot keys out."""
        if not policy.enabled:
            return {}
        bound = self.rows(base)
        if bound <= policy.hot_rows:
            return {"bound": bound}
        return {"bound": bound, "hot": self.hot_keys(base, key, policy.hot_rows)}

    # short names used throughout the plans
    @property
    def est(self) -> DataFrame | None:
        return self.get("estabelecimentos")

    @property
    def emp(self) -> DataFrame | None:
        return self.get("empresas")

    @property
    def sim(self) -> DataFrame | None:
        return self.get("simples")

    @property
    def mun(self) -> DataFrame | None:
        return self.get("municipios")

    @property
    def cnae(self) -> DataFrame | None:
        return self.get("cnaes")

    @property
    def soc(self) -> DataFrame | None:
        return self.get("socios")


def scan_parts(spark: SparkSession, parquet_dir: str, base: str) -> DataFrame | None:
    """All Parquet parts of ``base`` as one table, or ``None`` when no part exists.

    Columns come from the schema records of the folder where all parts have one (no footers are read), else
    from the parts. Only a missing path counts as absent: an empty or damaged part is an error, because a plan that
    runs without the table would answer another question."""
    root, name = parquet_dir.rstrip("/"), f"{PART_PREFIX[base]}*.parquet"
    schema = recorded_schema(spark, root, name)
    try:
        if schema is not None:
            return spark.read.schema(schema).parquet(f"{root}/{name}")
        # mergeSchema: parts written at different times may differ in column order; match by name.
        return spark.read.option("mergeSchema", "true").parquet(f"{root}/{name}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


OPTIONAL_EFFECTS = {"simples": "tax-regime columns are blank and the MEI filter cannot be applied",
                    "cnaes": "activity names are missing"}


def load_catalog(spark: SparkSession, parquet_dir: str, bases: Iterable[str] | None = None,
                 required: Iterable[str] = ("empresas", "estabelecimentos")) -> Catalog:
    cat = Catalog({b: scan_parts(spark, parquet_dir, b) for b in (bases or PART_PREFIX)})
    cat.require(*required)
    from .landing import SECONDARY_INDEX, SECONDARY_SCHEMA, path_exists
    index = f"{parquet_dir.rstrip('/')}/{SECONDARY_INDEX}"
    if cat.has("estabelecimentos") and "secundaria_id" in cat.est.columns and path_exists(spark, f"{index}/_SUCCESS"):
        cat.indexes["secondary_activity"] = spark.read.schema(SECONDARY_SCHEMA).parquet(index)
    for base, effect in OPTIONAL_EFFECTS.items():
        if base in cat.tables and not cat.has(base):
            warnings.warn(f"no table for {base}: {effect}")
    return cat


def registry_catalog(spark: SparkSession, sf_dir: str,
                     bases: Iterable[str] = ("empresas", "estabelecimentos", "simples", "municipios",
                                             "cnaes", "socios")) -> Catalog:
    return Catalog({b: registry_view(spark, sf_dir, b) for b in bases})


# ---------------------------------------------------------------------------------------------
# describe: schema rows, reads no data
# ---------------------------------------------------------------------------------------------
def sql_type_name(dt: T.DataType) -> str:
    """Spark type → the SQL type name used in the reports (VARCHAR, INTEGER, …)."""
    simple = {
        T.StringType: "VARCHAR", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
        T.ShortType: "SMALLINT", T.ByteType: "TINYINT", T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP",
        T.BinaryType: "BLOB",
    }
    for cls, name in simple.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return dt.simpleString().upper()


DESCRIBE_SCHEMA = T.StructType([
    T.StructField("base", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("column_type", T.StringType(), False),
])


def describe(spark: SparkSession, tables: dict[str, DataFrame], bases: str) -> DataFrame:
    """Column list of each base in ``bases`` (``'|'``-separated). Only schemas are touched."""
    rows = []
    for raw in bases.split("|"):
        base = raw.strip()
        if not base:
            continue
        df = tables.get(base)
        if df is None:
            raise MissingTableError(f"no table for base {base!r}")
        for i, f in enumerate(df.schema.fields, start=1):
            rows.append((base, i, f.name, sql_type_name(f.dataType)))
    return spark.createDataFrame(rows, DESCRIBE_SCHEMA)

