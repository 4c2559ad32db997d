"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder.

On a cluster the session comes from the platform; this module only reads its settings. Scratch
data (round trips, landed files, stream checkpoints) goes under ``spark.checkpoint.dir``, the
shared folder the cluster names. Where that setting is absent, a session on ``local[...]`` gets a
private folder, removed when the process ends; any other session is refused, because a folder of
the driver's machine is invisible to its executors.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCALE_CONFS = {
    # runtime re-planning: coalesce small shuffle partitions, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when a side proves small at runtime
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def default_driver_memory() -> str:
    """Half of the machine's memory, at most 8 GiB (local mode runs everything in the driver JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, int(total / 2 / 2**30)))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cadastra",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("CADASTRA_DRIVER_MEMORY", default_driver_memory()))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONFS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_private_root: list[str] = []


def _local_folder() -> str:
    """A folder of this process, for local sessions without a configured one."""
    if not _private_root:
        _private_root.append(tempfile.mkdtemp(prefix="cadastra-ckpt-"))
        atexit.register(shutil.rmtree, _private_root[0], ignore_errors=True)
    return _private_root[0]


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; on ``local[...]`` a private one when none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_folder()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/cadastra-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` as a table in the shared scratch folder (lineage cut, safe from lost executors) and its number
    of rows, counted in the pass that writes."""
    spark, seen = df.sparkSession, Observation()
    path = scratch_path(spark, name)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"] or 0
