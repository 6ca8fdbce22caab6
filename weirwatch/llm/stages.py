"""Written intermediate tables, and input columns with fixed names."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: Shuffle files of a finished write are of no more use, as its result is in the shared folder.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local session without one gets a folder of its own, as in tests."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{SETTING} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="weirwatch-llm-")
        spark.conf.set(SETTING, root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(folder(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: lineage ends here, and a lost executor costs no more than its own task."""
    path = new_path(df.sparkSession, name)
    df.sparkSession.conf.set(CLEAN, "true")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows that one Arrow batch carries to Python, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long, ``text`` as string, and further named columns; all else is left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(x) for x in more]
    )


def free_names(docs: DataFrame, *stems: str) -> list[str]:
    """Names for columns of our own beside those of a user's table, whatever these are called."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in stems:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def own_columns(docs: DataFrame) -> list[Column]:
    """All columns of a user's table as they are, names with dots or ticks too."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def same_row(doc_id: str, text_hash: str, own_hash: str) -> Column:
    """Whether a user's row, with its text's hash in ``own_hash``, is the row of a result."""
    return F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.col(own_hash) == F.col(text_hash))


def crc_mod(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor
