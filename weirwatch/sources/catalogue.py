"""Dataset catalogue: names, paths and types of the stored datasets."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from weirwatch.sources.jsonl import read_app_log, read_request_log

READERS = {"request_log": read_request_log, "structured_app_log": read_app_log}


@dataclass(frozen=True)
class Dataset:
    path: str
    type: str
    description: str = ""


def load_catalogue(spark: SparkSession, path: str) -> dict[str, Dataset]:
    """Read ``{name: {path, type, description}}``; no datasets is an error."""
    text = spark.read.text(path, wholetext=True).first()
    entries = json.loads(text.value) if text and text.value.strip() else {}
    if not entries:
        raise ValueError(f"no datasets in {path}")
    return {name: Dataset(**entry) for name, entry in entries.items()}


def read_dataset(spark: SparkSession, dataset: Dataset, mode: str = "failfast") -> DataFrame:
    if dataset.type not in READERS:
        raise ValueError(f"unknown dataset type: {dataset.type}")
    return READERS[dataset.type](spark, dataset.path, mode)
