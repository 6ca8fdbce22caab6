"""Which partitions of a table hold a key: an index beside the data, bucketed by key hash.

An entry is a key's 64-bit hash and the partition value of a row that has the
key. Entries are only ever added, so they are a superset of what holds now,
and keys of equal hash share their entries: the index never hides a row, and
the real keys decide in the partitions that it names. Every write adds one run
of new entries; after ``MOST_RUNS`` the runs are merged into one.

A lookup opens the buckets that hold the wanted hashes and no other, and no
data file at all. Choose ``buckets`` such that a bucket has about a million keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.sources import snapshots

KIND = "index"
BUCKETS = 64
MOST_RUNS = 16
SCHEMA = "key_hash long, part string, bucket int"


def entries(rows: DataFrame, keys: list[str], partition_by: str, buckets: int = BUCKETS) -> DataFrame:
    """Distinct entries of the rows that have all their keys."""
    keyed = rows.where(F.concat(*[F.lit("")] + [F.when(F.col(k).isNotNull(), "") for k in keys]).isNotNull())
    key_hash = F.xxhash64(*keys)
    return keyed.select(
        key_hash.alias("key_hash"), F.col(partition_by).cast("string").alias("part"), F.pmod(key_hash, F.lit(buckets)).cast("int").alias("bucket")
    ).distinct()


def lookup(spark: SparkSession, snapshot: snapshots.Snapshot, wanted: DataFrame) -> DataFrame:
    """Entries whose hash is among those of ``wanted``, itself entries of incoming rows."""
    # At most one value per bucket.
    touched = [r.bucket for r in wanted.select("bucket").distinct().collect()]
    stored = snapshots.read_side(spark, snapshot, KIND, SCHEMA).where(F.col("bucket").isin(touched))
    return stored.join(wanted.select("bucket", "key_hash").distinct(), ["bucket", "key_hash"], "left_semi").distinct()


def _write(found: DataFrame, path: str) -> str:
    ordered = found.repartition("bucket").sortWithinPartitions("bucket", "key_hash")
    return snapshots.write_side(ordered.select("key_hash", "part", "bucket"), path, KIND, partition_by="bucket")


def extended(spark: SparkSession, snapshot: snapshots.Snapshot, new: DataFrame, known: DataFrame) -> tuple[str, ...]:
    """The index's folders with the entries of ``new`` that are not ``known`` yet."""
    runs = snapshot.sides.get(KIND, ())
    fresh = new.join(known.select("bucket", "key_hash", "part"), ["bucket", "key_hash", "part"], "left_anti")
    if len(runs) >= MOST_RUNS:
        whole = snapshots.read_side(spark, snapshot, KIND, SCHEMA).unionByName(fresh).distinct()
        return (_write(whole, snapshot.path),)
    return (*runs, _write(fresh, snapshot.path))


def built(rows: DataFrame, keys: list[str], partition_by: str, path: str, buckets: int = BUCKETS) -> tuple[str, ...]:
    """A new index of all rows of a table."""
    return (_write(entries(rows, keys, partition_by, buckets), path),)
