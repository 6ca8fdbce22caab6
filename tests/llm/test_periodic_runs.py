"""Periodic runs against plain search, small tiles included."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from weirwatch.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of all runs, by trying each period at each place."""
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            size, root = j - i + p, words[i : i + p]
            if size >= max(12, 2 * p) and not any(p % q == 0 and root == root[:q] * (p // q) for q in range(1, p)):
                found.append((i, size, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, words):
    runs = plain_runs(words)
    keep = [True] * len(words)
    for s, size, p in runs:
        keep[s + p : s + size] = [False] * (size - p)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    return (doc_id, len(runs), *figures, sha(lines), sha(" ".join(w for w, k in zip(words, keep) if k)))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    out = [None, "", " \n\t", "a " * 11, "a " * 12, " ".join("ab" * 6), " ".join("abc" * 4), "x y\tx y\nx  y x\ry x y x y", "é ß " * 20]
    for _ in range(120):
        alphabet, words = "abcdefgh"[: draw.choice([1, 2, 3, 8])], []
        while len(words) < draw.choice([13, 60, 300]):
            unit = [draw.choice(alphabet) for _ in range(draw.randint(1, draw.choice([4, 30, 90])))]
            words += unit * draw.randint(1, 5) + unit[: draw.randint(0, len(unit))]
        out.append(" ".join(words))
    return out + [out[-1], "a b " * 30]


@pytest.mark.parametrize("core_words", [1, 16, 8192])
def test_runs(spark, texts, core_words):
    rows = [(i, t, 1, 2, "x", 0.5) for i, t in enumerate(texts)] + [(None, "a b " * 9, 1, 2, "x", 0.5), (5, texts[5], 1, 2, "x", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, row INT, octave INT, words STRING, period DOUBLE").repartition(3)
    found = periodic_runs.collapsed_documents(docs, core_words=core_words)
    got = sorted(map(tuple, periodic_runs.describe(found).collect()), key=str)
    want = sorted((plain_row(r[0], WORD.findall(r[1] or "")) for r in rows), key=str)
    assert got == want
    kept = {r.doc_id: r for r in found.collect()}
    assert all(sha(r.text) == r.collapsed_sha256 for r in kept.values())
    assert kept[4].text == "a" and kept[0].text == ""


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = plain_planted(d.doc_id, WORD.findall(d.text or ""))
        if len(words) <= 1200:
            assert got[d.doc_id] == plain_row(d.doc_id, words)
            planted += words != WORD.findall(d.text or "")
    assert planted > 5


def test_long_text(spark):
    """Three megabytes: a long period, a short one across many tiles, and words that never recur."""
    draw = random.Random(8)
    unit = [f"w{draw.randrange(10**6)}" for _ in range(60_000)]
    words = [f"u{i}" for i in range(50_000)] + unit * 2 + unit[:777] + ["v"] + ["p", "q", "r"] * 30_000 + ["z"]
    found = periodic_runs.collapsed_documents(spark.createDataFrame([(1, " ".join(words))], "doc_id LONG, text STRING")).collect()[0]
    assert [tuple(r) for r in found.runs] == [(50_000, 120_777, 60_000), (170_778, 90_000, 3)]
    assert found.text.split() == words[:50_000] + unit + ["v", "p", "q", "r", "z"]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert periodic_runs.describe(periodic_runs.collapsed_documents(periodic_runs.planted(docs))).count() == 0


def test_planted(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(300)] + [(None, "a b"), (7, None)]
    got = periodic_runs.planted(spark.createDataFrame(rows, "doc_id LONG, text STRING")).where(F.col("doc_id").isNotNull()).collect()
    want = {i: plain_planted(i, (t or "").split()) for i, t in rows if i is not None and t is not None}
    assert all(r.text is None or r.text.split() == want[r.doc_id] for r in got)
