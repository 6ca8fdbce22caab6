"""Salted hashes of entities and whole-event identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.functions.casts import none_if_empty


def hash_entity(value: Column, salt: str) -> Column:
    """First 16 hex digits of the salted SHA-256; null and empty stay null."""
    text = none_if_empty(value.cast("string"))
    return F.substring(F.sha2(F.concat(F.lit(salt), text), 256), 1, 16)


def event_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Identity of a whole row: equal rows, and only those, share it."""
    names = sorted(columns or df.columns)
    body = F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)
