"""Session settings and durable scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. UTC fixes hour and date arithmetic; adaptive
# execution picks join strategies from measured sizes and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes; wide projections fall
    # back to split methods, which it does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# A row group goes to one task whole. Rows of texts take far longer to read than
# their stored bytes tell, so groups are small enough to spread over all cores.
ROW_GROUP_BYTES = 8 << 20

# Used by local sessions that name no folder.
_local_root: str | None = None


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "weirwatch", shuffle: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own; on a cluster a machine-local folder would
    vanish with its executor, so a missing setting is an error there.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        _local_root = _local_root or tempfile.mkdtemp(prefix="weirwatch-")
        return _local_root
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return os.path.join(scratch_root(spark), "weirwatch", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    Used where a result feeds several later jobs and must be the same in each
    of them. The table lies in shared storage, so losing executors costs no
    recomputation and cannot change what a later job sees. It stays columnar,
    so later reads still prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
