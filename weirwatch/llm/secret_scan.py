"""Operator 7: secret scan over an incremental ledger of blobs.

Every text is content-addressed by its SHA-256. Three Parquet tables make the
ledger, all of them only appended to:

``versions``  path (doc_id), blob and run of every version ever seen; runs are
              numbered from 1 on, a version counts in the run that saw it first
``scanned``   blob and rule version of every scan that is complete
``findings``  blob, rule, rule version, start and end of every span

A run adds its versions, scans each blob and rule version that is not in
``scanned`` once, however many paths or versions have it, appends findings
before it marks the scans, and joins findings back to paths: to the paths of
today (:func:`secrets`) and to those of every version (:func:`history`), so that
a secret which a later version took out is still reported. A run that broke
off is repeated; the findings that it left are equal and count once.

Places of matches come from two built-in functions: the matches of a pattern,
and the pieces between them. Running sums of their lengths are the places, in
code points, end exclusive.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwatch.llm import stages


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its ``group`` has ``least`` characters at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The base kinds in their order.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@", 0, 12),
)

#: A faster test that a text may have a match that counts; each pattern's matches that count pass it.
_MAY = {
    "assign": r"(?i)(?:word|passwd|secret|token|key)[\"']?\x20*[:=]",
    "hex": r"[0-9a-f]{24}",
}
_BLOB, _SCAN, _FIND = "path long, blob string, run int", "blob string, kind string, version int", "blob string, kind string, version int, start long, end long"


def _matches(text, rule: Rule, order: int):
    """Array of (kind order, gap before, length, counts) of a rule's matches in a text."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(F.transform(found, F.length).alias("m"), F.transform(value, F.length).alias("v"), F.slice(F.transform(gaps, F.length), 1, F.size(found)).alias("g"))
    rows = F.transform(zipped, lambda x, i: F.struct(F.lit(order).alias("kind"), i.alias("nr"), x["m"].alias("size"), x["g"].alias("gap"), (x["v"] >= rule.least).alias("counts")))
    empty = F.array().cast("array<struct<kind:int,nr:int,size:int,gap:int,counts:boolean>>")
    may = text.rlike(_MAY[rule.kind]) if rule.kind in _MAY else text.rlike(rule.pattern)
    return F.when(may, rows).otherwise(empty)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, kind, version, start, end of every span that counts, from (blob, text, todo).

    ``todo`` lists the kinds to scan. Matches of one rule are leftmost and don't
    overlap; those that are too short use up their place all the same. Repeated
    rows of a blob count once.
    """
    found = F.concat(*[F.when(F.array_contains("todo", r.kind), _matches(F.col("text"), r, i)).otherwise(F.array()) for i, r in enumerate(rules)])
    # One exchange for both: a blob that several equal rows bring counts once, and places are running sums.
    rows = blobs.select("blob", F.explode(found).alias("m")).select("blob", "m.*").repartition("blob", "kind").distinct()
    until = Window.partitionBy("blob", "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(until)).where("counts")
    kinds = F.array(*[F.struct(F.lit(r.kind).alias("k"), F.lit(r.version).alias("v")) for r in rules])
    rule = F.element_at(kinds, F.col("kind") + 1)
    return rows.select("blob", rule["k"].alias("kind"), rule["v"].alias("version"), (F.col("end") - F.col("size")).alias("start"), "end")


def _read(spark: SparkSession, ledger: str, table: str, schema: str) -> DataFrame:
    path = os.path.join(ledger, table)
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def update(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``docs``; returns their (path, blob) rows, repeated rows included.

    Null text is the empty blob. A version that comes back is no new version. One
    run at a time may write a ledger.
    """
    spark = docs.sparkSession
    rows = stages.texts(docs).select(F.col("doc_id").alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    now = stages.stage(rows.select("path", "blob"), "versions")
    known = _read(spark, ledger, "versions", _BLOB)
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    new = now.distinct().join(known, now["path"].eqNullSafe(known["path"]) & (now["blob"] == known["blob"]), "left_anti")
    new.withColumn("run", F.lit(run)).write.mode("append").parquet(os.path.join(ledger, "versions"))
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    done = _read(spark, ledger, "scanned", _SCAN).join(F.broadcast(wanted), ["kind", "version"])
    done = done.groupBy("blob").agg(F.collect_set("kind").alias("done"))
    # One path stands for all that have the blob.
    first = now.groupBy("blob").agg(F.min("path").alias("first")).join(done, "blob", "left")
    todo = F.array_except(F.array(*[F.lit(r.kind) for r in rules]), F.coalesce("done", F.array().cast("array<string>")))
    fresh = stages.stage(first.select(F.col("blob").alias("b"), "first", todo.alias("todo")).where(F.size("todo") > 0), "unseen")
    unseen = rows.join(fresh, F.expr("blob = b and path <=> first")).select("blob", "text", "todo")
    scan(unseen, rules).write.mode("append").parquet(os.path.join(ledger, "findings"))
    marks = fresh.select(F.col("b").alias("blob"), F.explode("todo").alias("kind")).join(F.broadcast(wanted), "kind")
    marks.select("blob", "kind", "version").write.mode("append").parquet(os.path.join(ledger, "scanned"))
    return now


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def findings_of(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``paths`` (path, blob, further columns kept): its counts by base kind, the digest of its base spans and the list of all spans."""
    spark = paths.sparkSession
    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    spans = _read(spark, ledger, "findings", _FIND).join(F.broadcast(wanted), ["kind", "version"])
    spans = spans.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", order.alias("nr"), "end", "kind"))).alias("spans"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["nr"] <= len(BASE_RULES))
    spans = spans.select(
        F.col("blob").alias("of"),
        *[F.size(F.filter("spans", _of_kind(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES],
        joined(base).alias("base"), joined(F.col("spans")).alias("spans"),
    )
    out = paths.join(spans, paths["blob"] == spans["of"], "left")
    return out.select(
        *paths.columns, *[F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def history(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, run, current, blob, n_assign, n_access, n_hex, base_sha256, spans of every version of every path in a ledger.

    ``run`` is the run that saw the version first. ``current`` marks a path's
    latest new version: where a text went back to an earlier one, it is the newer
    of the two. Versions without a span are listed too; a version is listed once,
    however often its row was repeated. A ledger that was never written is empty.
    """
    versions = _read(spark, ledger, "versions", _BLOB).groupBy("path", "blob").agg(F.min("run").alias("run"))
    # A run may have seen rows of one path with several texts: all of its latest run are current.
    latest = versions.groupBy("path").agg(F.max("run").alias("latest")).withColumnRenamed("path", "of_path")
    versions = versions.join(latest, versions["path"].eqNullSafe(latest["of_path"])).select("path", "blob", "run", (F.col("run") == F.col("latest")).alias("current"))
    return findings_of(versions, ledger, rules).withColumnRenamed("path", "doc_id")


def secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``.

    Null and empty texts have no span. Repeated rows are reported each. Further
    columns of ``docs`` are left out. Without ``ledger`` a new one is begun.
    """
    ledger = ledger or stages.new_path(docs.sparkSession, "ledger")
    now = update(docs, ledger, rules)
    return findings_of(now, ledger, rules).withColumnRenamed("path", "doc_id").drop("blob")
