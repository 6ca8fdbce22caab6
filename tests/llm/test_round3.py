"""Stages keep user columns of any name; counts beyond 2^32; a large group of near copies and its near misses."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weirwatch.llm import decontaminate, language_model, mixing, near_dup, toxicity

TAKEN = [p + x for p in ("x_", "l_", "d_", "m_", "X_", "M_") for x in ("id", "hash", "text")]
TAKEN = list({c.lower(): c for c in [*TAKEN, "m_source", "m_copy", "m_size", "m_whole", "m_part", "m_mixed", "d_again", "node", "class", "place", "row", "size", "predicted", "a.b", "ti`ck"]}.values())


@pytest.fixture(scope="module")
def clashing(spark):
    base = "doc_id LONG, text STRING, source STRING"
    texts = [f"plain words number {i} go on and on with some more of them {i * 7}" for i in range(30)] + ["", None]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, base)
    return docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in TAKEN])


def untouched(out, docs):
    assert out.columns == docs.columns
    want = {r.doc_id: r for r in docs.collect()}
    for r in out.collect():
        assert all(r[c] == want[r.doc_id][c] for c in docs.columns if c != "text")
    return out.count()


def test_stages_keep_user_columns(spark, clashing):
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(30)], "doc_id LONG, quality INT, toxic INT")
    bench = spark.createDataFrame([(1, clashing.where("doc_id = 3").first().text)], "item_id LONG, text STRING")
    untouched(toxicity.clean_documents(clashing, labels), clashing)
    assert untouched(near_dup.deduplicated(clashing), clashing) >= 30
    assert untouched(decontaminate.clean_documents(clashing, bench), clashing) == 31
    untouched(mixing.mixed_documents(clashing), clashing)


def test_counts_above_32_bits():
    squeeze = language_model._squeeze
    keys, zero = np.array([5, 9], np.uint64), np.zeros(2, np.uint8)
    row = {"keys": squeeze(language_model._differences(keys)), "counts": squeeze(np.array([3_000_000_000, 1], np.uint32)), "context": squeeze(zero), "word": squeeze(zero)}
    table = pa.table({"bucket": [0, 0], "chunk": [1, 2], **{k: pa.array([v, v], pa.binary()) for k, v in row.items()}})
    out = language_model._add_up(table, False, 0).to_pylist()
    totals = language_model._joined([r for r in out if r["totals"]])
    assert totals.tolist() == [6_000_000_000, 2] * 2
    assert [r["y"] for r in out if r["chunk"] is None] == [6_000_000_002]


def test_large_group_and_near_misses(spark, monkeypatch):
    """Few links leave a task, and components are those of all pairs."""
    draw = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    base = [draw.choice(words) for _ in range(220)]

    def copy(changes):
        out = list(base)
        for at in draw.sample(range(len(out)), changes):
            out[at] = draw.choice(words)
        return " ".join(out)

    texts = [copy(draw.randint(0, 4)) for _ in range(240)] + [copy(draw.randint(9, 16)) for _ in range(120)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(216)} for t in texts]
    part = list(range(len(sets)))

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = top(i), top(j)
                part[max(x, y)] = min(x, y)
    rows = []
    real = near_dup._next_links
    monkeypatch.setattr(near_dup, "PIVOTS", 32)

    def counted(*args):
        out = real(*args)
        rows.append(out[0].count())
        return out

    monkeypatch.setattr(near_dup, "_next_links", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {i: top(i) for i in range(len(texts))}
    assert len(set(got.values())) > 20 and len(rows) > 1
    assert sum(rows) <= 2 * len(texts)
