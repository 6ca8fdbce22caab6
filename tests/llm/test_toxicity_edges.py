"""Toxicity: odd texts and tables, no evidence, all candidates, white space as the lexicon has it."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from weirwatch.llm import toxicity

DOCS = "doc_id LONG, text STRING, score DOUBLE, text_hash STRING, of INT, toxic STRING"
LABELS = "doc_id LONG, quality INT, toxic INT, text STRING"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, "h", 1, "z") for i, t in rows], DOCS)


def marks(spark, rows):
    return spark.createDataFrame([(i, 1, t, "other") for i, t in rows], LABELS)


def used(n):
    """Ids that are learned from."""
    return [i for i in range(6 * n) if zlib.crc32(str(i).encode()) % 5][:n]


@pytest.mark.parametrize("kinds", [[1, 0], [1, 1], [0, 0], []])
def test_without_evidence_all_are_kept(spark, kinds):
    docs = table(spark, [(i, f"some plain words of text {i}") for i in range(40)])
    labels = marks(spark, list(zip(used(2), kinds)))
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 40 and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in got)
    assert toxicity.clean_documents(docs, labels).count() == 40


def corpus(insults, n=900):
    draw = random.Random(8)
    plain = ["".join(draw.choice("bcdfglmnprst") + draw.choice("aeiou") for _ in range(draw.randint(2, 4))) for _ in range(500)]
    rows, labels = [], []
    for k, i in enumerate(used(n)):
        words = [draw.choice(plain) for _ in range(25)]
        if k % 3 == 0:
            words.insert(draw.randint(2, 20), insults[k // 3 % len(insults)])
        rows.append((i, " ".join(words)))
        labels.append((i, int(k % 3 == 0)))
    return rows, labels


def test_odd_texts_and_repeated_rows(spark):
    rows, labels = corpus(["zwurmix", "krontolo", "x" * 60])
    odd = [(90_001, None), (90_002, ""), (90_003, " \t\n"), (None, "you zwurmix krontolo zwurmix"), (90_004, "plain " * 300_000 + "end"), (90_005, "you are a zwurmix really, a krontolo"), (90_006, "you zwurmix and zwurmix"), (90_006, "you zwurmix and zwurmix"), (90_007, "you are a " + "x" * 60)]
    docs = table(spark, rows + odd)
    labels = marks(spark, labels + [(None, 1), (90_900, 1)])
    got = toxicity.toxicity(docs, labels).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    empty = {by[i][0].score for i in (90_001, 90_002, 90_003, 90_004)}
    assert len(empty) == 1 and max(empty) < 0.5
    assert len(by[90_006]) == 2 and by[90_006][0] == by[90_006][1] and by[90_006][0].predicted == 1
    # Words of any length are learned, and a wide space is no border of words, as in the lexicon.
    assert by[90_007][0].predicted == 1 and by[None][0].predicted == 1 and not by[None][0].held_out
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.where(F.col("doc_id") > 90_000).collect()} >= {90_001, 90_002, 90_003, 90_004}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.clean_documents(docs.limit(0), labels).count() == 0


def test_training_leaves_held_out_labels_alone(spark):
    """Turning the labels of all held-out rows round changes no score."""
    rows, labels = corpus(["zwurmix", "krontolo"])
    extra = [i for i in range(5_000, 5_400) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = table(spark, rows + [(i, "a plain text with zwurmix" if i % 2 else "a plain text") for i in extra])
    one, two = (
        {r.doc_id: r.score for r in toxicity.toxicity(docs, marks(spark, labels + [(i, (i + turn) % 2) for i in extra])).collect()} for turn in (0, 1)
    )
    assert one == two
