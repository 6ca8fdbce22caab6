"""Parquet tables with keyed upserts.

Every table is a chain of snapshots (``snapshots``): a load writes new folders
and publishes them in one step. Log tables are partitioned by day and keep an
index of key hashes to days (``key_index``): an upsert asks it for the days
that hold incoming keys, rewrites those days and adds the rows of new keys to
theirs, and neither reads nor touches the others. Where the partition follows from the
key, as in derived tables, no index is needed.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.functions.identity import event_hash
from weirwatch.operators.dedupe import first_write_wins, last_write_wins, merge_rows
from weirwatch.session import materialize
from weirwatch.sources import key_index, snapshots

DAY = "log_date"
REQUEST_KEYS = ["request_hash"]
APP_KEYS = ["event_hash"]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a snapshot was published at the path."""
    return snapshots.latest(spark, path) is not None


def read_table(spark: SparkSession, path: str, parts: list | None = None, commit: int | None = None) -> DataFrame:
    """A stored table with the columns and types it was written with; a missing one is an error.

    With ``parts`` only folders of these partition values are opened;
    ``commit`` picks an earlier snapshot.
    """
    snapshot = snapshots.latest(spark, path, commit)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {path}")
    return snapshots.read(spark, snapshot, None if parts is None else set(parts))


def with_day(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn(DAY, F.to_date(ts))


def overwrite(df: DataFrame, path: str, partition_by: str | None = None, index_keys: list[str] | None = None, sides: dict | None = None) -> None:
    """Truncate and reload; the old snapshot is in force until the new one is published.

    ``index_keys`` builds a key index; ``sides`` are further side folders to name.
    """
    spark = df.sparkSession
    old = snapshots.latest(spark, path)
    data = snapshots.write_data(df, path, partition_by)
    sides = dict(sides or {})
    if index_keys:
        written = snapshots.read(spark, snapshots.Snapshot(path.rstrip("/"), 0, df.schema, partition_by, data))
        sides[key_index.KIND] = key_index.built(written, index_keys, partition_by, path)
    snapshots.publish(spark, old, snapshots.Snapshot(path, 0, df.schema, partition_by, data, sides))


def _conformed(incoming: DataFrame, snapshot: snapshots.Snapshot) -> DataFrame:
    """Incoming rows with the table's columns, in its order and types; a value that does not fit is an error."""
    missing = [f.name for f in snapshot.schema if f.name not in incoming.columns]
    extra = [c for c in incoming.columns if c not in snapshot.schema.names]
    if missing or extra:
        raise ValueError(f"{snapshot.path} lacks columns {extra}, the incoming rows {missing}")
    return incoming.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in snapshot.schema])


def upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str],
    keep: str = "last",
    order: str | None = None,
    partition_by: str | None = None,
    rebuild: bool = False,
    part_of_key: bool = False,
    ledger: DataFrame | None = None,
) -> int:
    """Merge rows into a table by key; returns the distinct incoming rows.

    ``order`` is a column that tells which of several incoming rows of a key
    is the later one; it is not stored. ``keep='first'`` never changes stored
    rows. ``rebuild`` replaces the table, dropping keys the input lacks.
    ``part_of_key`` says that equal keys have equal partition values, as they
    have where the partition column is a key; other partitioned tables have a
    key index. ``ledger`` rows are published in the same step as the data.

    A failed task, a lost executor or a load that is cut off leaves the table
    as it was.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"unknown keep: {keep}")
    if order:
        pick = last_write_wins if keep == "last" else first_write_wins
        incoming = pick(incoming, keys, order).drop(order)
    incoming = materialize(incoming, "incoming")
    count = incoming.count()
    part_of_key = part_of_key or partition_by in keys
    indexed = partition_by is not None and not part_of_key
    old = snapshots.latest(spark, path)
    sides = {} if ledger is None else {LEDGER: (*(old.sides.get(LEDGER, ()) if old else ()), snapshots.write_side(ledger, path, LEDGER))}
    if rebuild or old is None:
        overwrite(incoming, path, partition_by, keys if indexed else None, sides)
        return count
    if count == 0:
        if sides:
            snapshots.publish(spark, old, replace(old, sides={**old.sides, **sides}))
        return 0
    incoming = _conformed(incoming, old)
    if not partition_by:
        merged = merge_rows(snapshots.read(spark, old), incoming, keys, keep)
        data = snapshots.write_data(merged, path)
        snapshots.publish(spark, old, replace(old, data=data, sides={**old.sides, **sides}))
        return count

    # One value per partition that may hold incoming keys: a short list.
    if indexed:
        wanted = key_index.entries(incoming, keys, partition_by)
        known = materialize(key_index.lookup(spark, old, wanted), "index-hits")
        holding = {r.part for r in known.select("part").distinct().collect()}
        sides[key_index.KIND] = key_index.extended(spark, old, wanted, known)
    else:
        text = F.col(partition_by).cast("string").alias("part")
        holding = {r.part for r in incoming.select(text).distinct().collect()}
    sides = {**old.sides, **sides}
    if keep == "first":
        # Stored rows never change: only add what is new. Real keys decide, in the partitions that may hold them.
        stored = snapshots.read(spark, old, holding).select(*keys)
        new = snapshots.write_data(incoming.join(stored, keys, "left_anti").select(*old.schema.names), path, partition_by)
        snapshots.publish(spark, old, replace(old, data=(*old.data, *new), sides=sides))
        return count
    # Only partitions that may hold an incoming key are rewritten; to others, rows of new keys are added.
    holding &= old.parts()
    merged = merge_rows(snapshots.read(spark, old, holding), incoming, keys, keep) if holding else incoming
    new = snapshots.write_data(merged, path, partition_by)
    stay = tuple((folder, part) for folder, part in old.data if part not in holding)
    snapshots.publish(spark, old, replace(old, data=(*stay, *new), sides=sides))
    return count


def replace_parts(spark: SparkSession, path: str, rows: DataFrame, partition_by: str, parts: set) -> None:
    """Put rows in the place of whole partitions; one of ``parts`` that no row has is empty then.

    All rows must have a partition value of ``parts``, given as text.
    """
    old = snapshots.latest(spark, path)
    data = snapshots.write_data(rows, path, partition_by)
    beyond = {part for _, part in data} - parts
    if beyond:
        raise ValueError(f"rows of other partitions than were to be replaced: {sorted(map(str, beyond))[:5]}")
    if old is None:
        snapshots.publish(spark, None, snapshots.Snapshot(path, 0, rows.schema, partition_by, data))
        return
    stay = tuple((folder, part) for folder, part in old.data if part not in parts)
    snapshots.publish(spark, old, replace(old, data=(*stay, *data)))


def changed_since(spark: SparkSession, path: str, commit: int | None) -> tuple[int, set]:
    """The number of the snapshot in force, and the partitions that differ from an earlier one.

    All partitions where no earlier one is named or it was expired. Read from the manifests alone.
    """
    now = snapshots.latest(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    then = None if commit is None else snapshots.latest(spark, path, commit)
    return now.number, snapshots.changed_parts(then, now)


def stored_matches(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows that have a key of the incoming ones; only partitions that the index names are opened."""
    snapshot = snapshots.latest(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {path}")
    parts = None
    if key_index.KIND in snapshot.sides:
        wanted = key_index.entries(incoming.withColumn("part", F.lit(None).cast("string")), keys, "part")
        parts = {r.part for r in key_index.lookup(spark, snapshot, wanted).select("part").distinct().collect()}
    return snapshots.read(spark, snapshot, parts).join(incoming.select(*keys).distinct(), keys, "left_semi")


LEDGER = "ledger"
LEDGER_SCHEMA = "file_path string, modified timestamp, batch long"


def loaded_files(spark: SparkSession, path: str) -> DataFrame:
    """Files whose rows a table has, with the batch that brought them; none for a missing table."""
    snapshot = snapshots.latest(spark, path)
    return spark.createDataFrame([], LEDGER_SCHEMA) if snapshot is None else snapshots.read_side(spark, snapshot, LEDGER, LEDGER_SCHEMA)


def compact(spark: SparkSession, path: str, most: int = 8) -> int:
    """Rewrite partitions that lie in more than ``most`` folders as one, and the ledger's runs; returns how many partitions."""
    old = snapshots.latest(spark, path)
    if old is None:
        raise FileNotFoundError(f"no table at {path}")
    counts: dict[str | None, int] = {}
    for _, part in old.data:
        counts[part] = counts.get(part, 0) + 1
    many = {part for part, n in counts.items() if n > most}
    sides = dict(old.sides)
    if len(sides.get(LEDGER, ())) > most:
        sides[LEDGER] = (snapshots.write_side(snapshots.read_side(spark, old, LEDGER, LEDGER_SCHEMA), path, LEDGER),)
    if many or sides != old.sides:
        data = tuple((f, p) for f, p in old.data if p not in many)
        if many:
            data += snapshots.write_data(snapshots.read(spark, old, many), path, old.partition_by)
        snapshots.publish(spark, old, replace(old, data=data, sides=sides))
    return len(many)


def _refuse_missing_timestamps(rows: DataFrame) -> DataFrame:
    """Fail the writing job on a row without a timestamp, in the same pass."""
    ts = F.col("timestamp")
    checked = F.when(ts.isNotNull(), ts).otherwise(
        F.raise_error(F.lit("a log row has no timestamp; load refused")).cast("timestamp")
    )
    return rows.withColumn("timestamp", checked)


def load_request_logs(spark: SparkSession, rows: DataFrame, path: str, ledger: DataFrame | None = None) -> int:
    """Upsert request rows by request hash; the last write wins.

    ``rows`` has a ``load_order`` column. Rows without a hash are appended.
    ``ledger`` names the files the rows come from.
    """
    rows = with_day(_refuse_missing_timestamps(rows))
    return upsert(
        spark, path, rows, REQUEST_KEYS, "last", order="load_order", partition_by=DAY, ledger=ledger
    )


def load_app_logs(spark: SparkSession, rows: DataFrame, path: str, reload: bool = False) -> int:
    """Add application rows whose whole-event hash is new; the first wins.

    ``reload`` clears the table first.
    """
    content = [c for c in rows.columns if c not in ("load_order", "raw_record")]
    rows = rows.withColumn("event_hash", event_hash(rows, content))
    rows = with_day(_refuse_missing_timestamps(rows))
    return upsert(
        spark, path, rows, APP_KEYS, "first", order="load_order", partition_by=DAY, rebuild=reload
    )


def load_quality_metrics(spark: SparkSession, metrics: DataFrame, path: str) -> int:
    """Upsert ``dataset, metric, value`` rows."""
    return upsert(spark, path, metrics, ["dataset", "metric"])
