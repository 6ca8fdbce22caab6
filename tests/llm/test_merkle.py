"""The manifest and its proofs against plain hashing, tree by tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from weirwatch.llm import merkle, queries, stages

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, tree INT, place INT, hash STRING, rank INT, salt INT, leaf STRING"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_hash(d, more=0):
    values = (d.doc_id, d.source, d.lang, None if d.n_chars is None else d.n_chars + more, d.text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grow(level):
    """The top, and for each node the siblings on its way: hash or None, and whether it lies to the left."""
    proofs, places = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for proof, i in zip(proofs, places):
            proof.append((level[i ^ 1], i % 2 == 1) if i ^ 1 < len(level) else (None, False))
        places = [i // 2 for i in places]
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], proofs


def plain(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d.lang, []).append(d)
    trees = []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        rows = sorted(groups[lang], key=lambda d: (d.doc_id is not None, d.doc_id or 0, row_hash(d)))
        trees.append((rows, *grow([row_hash(d) for d in rows])))
    if not trees:
        return []
    root, upper = grow([t[1] for t in trees])
    out = []
    for (rows, subroot, proofs), rest in zip(trees, upper):
        for d, proof in zip(rows, proofs):
            way = proof + rest
            folded = row_hash(d, d.doc_id is not None and zlib.crc32(str(d.doc_id).encode()) % 7 == 0)
            for sibling, left in way:
                folded = h(folded) if sibling is None else h(sibling, folded) if left else h(folded, sibling)
            out.append((d.doc_id, row_hash(d), subroot, root, h(*(s for s, _ in way if s)), folded, folded == root))
    return sorted(out, key=str)


def audited(docs):
    return sorted(map(tuple, merkle.audit(docs, stages.crc_mod("doc_id", 7) == 0).collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    rows = []
    for lang, n in (("de", 1), ("en", 200), (None, 65), ("é", 2), ("", 3), ("fr", 64), ("z", 129), ("\U0001f600", 5)):
        rows += [(1000 * len(rows) + 7 * i, None if i % 9 == 4 else "tö" * (i % 5), lang, [None, "s", ""][i % 3], None if i % 11 == 0 else i, 1, 2, "x", 3, 4, "y") for i in range(n)]
    rows += [(None, "no id", "en", None, 5, 1, 2, "x", 3, 4, "y")] * 2 + [rows[5]] * 3
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_odd_rows(odd):
    assert audited(odd) == plain(odd.collect())


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(odd, n):
    docs = odd.where("lang = 'en'").orderBy("doc_id").limit(n)
    assert audited(docs) == plain(docs.collect())


def test_many_languages(spark):
    """More subroots than a block holds, and a lone leaf in each."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    assert audited(docs) == plain(docs.collect())


def test_empty(odd):
    assert audited(odd.limit(0)) == []


def test_long_text(spark):
    docs = spark.createDataFrame([(i, "long " * 600_000, "en", "s", 3_000_000) for i in range(3)], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    assert audited(docs) == plain(docs.collect())


def test_query(spark):
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, SF).collect()), key=str)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert got == plain(docs) and {r[-1] for r in got} == {True, False}
