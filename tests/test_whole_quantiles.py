"""Whole-column quantiles against sorting, with ties, NaN, infinities and few values left to the last step."""

import contextlib
import io
import math
import random

import pytest
from pyspark.sql import functions as F

from weirwatch.operators import whole_quantiles as wq


def plain(values, p, method):
    values = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    if not values:
        return None
    at = p * (len(values) - 1)
    if method == "nearest":
        return values[min(round(at), len(values) - 1)]
    a, b = values[math.floor(at)], values[math.ceil(at)]
    return a if a == b else a + (b - a) * (at - math.floor(at))


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.fixture(scope="module")
def columns():
    draw = random.Random(4)
    n = 3000
    return {
        "spread": [draw.gauss(0, 1e6) for _ in range(n)],
        "ties": [float(draw.choice([1, 1, 1, 2, 50])) for _ in range(n)],
        "one": [7.0] * n,
        "gaps": [None if i % 3 else float(i) for i in range(n)],
        "odd": [draw.choice([math.nan, math.inf, -math.inf, 0.0, -0.0, 1.5, None]) for _ in range(n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("few,accuracy", [(4096, 10_000), (4, 100), (0, 10), (1, 10_000)])
def test_against_sorting(spark, columns, monkeypatch, few, accuracy):
    monkeypatch.setattr(wq, "FEW", few)
    monkeypatch.setattr(wq, "ACCURACY", accuracy)
    monkeypatch.setattr(wq, "_SLACK", 2.0 / accuracy)
    rows = list(zip(*columns.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in columns)).repartition(3).cache()
    for p in (0.0, 0.05, 0.5, 0.95, 1.0):
        wanted = {f"{c}-{m}": (c, p, m) for c in columns for m in ("interpolated", "nearest")}
        got = wq.whole_quantiles(df, wanted)
        for name, (c, _, m) in wanted.items():
            assert same(got[name], plain(columns[c], p, m)), (name, p)
    df.unpersist()


def test_a_wrong_sketch_is_found_out(spark, columns, monkeypatch):
    """The counts decide: values that do not enclose the rank only cost another round."""
    monkeypatch.setattr(wq, "FEW", 0)
    real = wq._enclosed
    calls = []

    def wrong(values, open_):
        calls.append(len(open_))
        return [(min(a, b) - 10.0, min(a, b) - 5.0) for a, b in real(values, open_)] if len(calls) == 1 else real(values, open_)

    monkeypatch.setattr(wq, "_enclosed", wrong)
    df = spark.createDataFrame([(v,) for v in columns["spread"]], "spread DOUBLE")
    assert wq.whole_quantiles(df, {"q": ("spread", 0.5, "nearest")})["q"] == plain(columns["spread"], 0.5, "nearest")
    assert len(calls) > 1


def test_no_value_is_shuffled(spark):
    """What the passes exchange is one row a task: sketches and counts."""
    df = spark.range(200_000, numPartitions=4).select((F.col("id") * 1.5).alias("v"))
    search = [wq._Search("v", 100_000, None, None, 0, 200_000)]
    a, b = wq._enclosed(df, search)[0]
    assert a < 150_000.0 < b
    narrowed = wq._narrowed(df, search, [(a, b)])[0]
    assert narrowed.between < 200_000 * 10 * wq._SLACK
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.agg(F.percentile_approx("v", [0.4, 0.6], wq.ACCURACY)).explain()
    assert "SinglePartition" in out.getvalue() and "hashpartitioning" not in out.getvalue()
    assert wq.whole_quantiles(df, {"m": ("v", 0.5, "interpolated")})["m"] == 149_999.25


def test_bad_arguments(spark):
    df = spark.range(3).toDF("v")
    with pytest.raises(ValueError):
        wq.whole_quantiles(df, {"x": ("v", 1.5, "nearest")})
    with pytest.raises(ValueError):
        wq.whole_quantiles(df, {"x": ("v", 0.5, "middle")})
    assert wq.whole_quantiles(df, {}) == {} and wq.whole_quantiles(df.limit(0), {"x": ("v", 0.5, "nearest")}) == {"x": None}
