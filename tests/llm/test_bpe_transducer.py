"""The transducer against the library of rank files, and decoding against UTF-8."""

import hashlib
import random

import pytest

from weirwatch.llm import bpe_transducer as bpe
from weirwatch.llm import queries

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def odd_texts():
    draw = random.Random(4)
    odd = "aZ9 \t\n\r\x0b\x1c\x85  é漢\U0001f600é'sS\x00<|endoftext|>"
    return [None, "", " ", "\n\n", "it's don't WE'LL", "x" * 5000, " " * 3000 + "y", *("".join(draw.choice(odd) for _ in range(draw.randint(1, 80))) for _ in range(300))]


def test_pieces(ranks, library):
    machine, draw, tokens = bpe.Transducer(ranks, most=2000), random.Random(6), list(ranks)
    for _ in range(1500):  # any bytes, also such that are no text; the machine starts anew several times
        piece = b"".join(draw.choice(tokens) for _ in range(draw.randint(1, 8))) if draw.random() < 0.6 else bytes(draw.choice(b"abcdeinst \xc3\xa9") for _ in range(draw.randint(1, 60)))
        assert machine.encode_piece(piece) == library._core_bpe.encode_single_piece(piece)


def test_output_is_settled_early(ranks):
    """A long piece leaves as it is read: what a state holds does not grow with the piece."""
    machine, out = bpe.Transducer(ranks), []
    state, longest = 0, max(map(len, ranks))
    for i in range(4000):
        state = machine.feed(state, b"etaoin"[i % 6 :][:1], out)
        assert len(machine.states[state][1]) <= 2 * longest
    assert len(out) > 500


def test_small_vocabulary():
    """Ranks for which an entry is no result of its own merges are reached as whole pieces only."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259}
    machine = bpe.Transducer(ranks)
    assert machine.encode_piece(b"abcabc") == [258, 258]
    assert machine.encode_piece(b"xyz") == [259]
    assert machine.encode_piece(b"xyzx") == [120, 121, 122, 120]
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0})


def test_documents(spark, library):
    texts = odd_texts()
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, "x"), (4, texts[4], 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_tokens INT, ids STRING").repartition(3)
    got = sorted(map(tuple, bpe.round_trips(docs, PATH, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    ids = {r.doc_id: r.ids for r in bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert ids[5] == library.encode_ordinary(texts[5]) and ids[0] == []
    assert bpe.round_trips(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_bpe_transducer(spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(docs[r.doc_id].encode())


def test_long_text(spark, library):
    draw = random.Random(9)
    text = " ".join("".join(draw.choice("aeioustrn") for _ in range(draw.randint(1, 9))) for _ in range(550_000))
    assert len(text) > 3_000_000
    got = bpe.round_trips(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING"), PATH, public_tokenizers.PATTERN).collect()[0]
    ids = library.encode_ordinary(text)
    assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode()))


def test_streaming_decode(ranks, library):
    vocabulary, draw = bpe.Vocabulary(ranks), random.Random(2)
    for _ in range(60):
        text = "".join(draw.choice("aé漢\U0001f600߿ࠀ￿\U0010ffff z") for _ in range(40))
        ids = [ranks[bytes([b])] for b in text.encode()] if draw.random() < 0.5 else library.encode_ordinary(text)
        parts = list(bpe.decode(vocabulary, ids, chunk=draw.randint(1, 5)))
        assert b"".join(parts) == text.encode()
        assert all(part.decode() is not None for part in parts)  # each part ends with a character
    for broken in (b"\x80", b"\xc0\x80", b"\xe0\x80\x80", b"\xed\xa0\x80", b"\xf5", b"\xf4\x90\x80\x80", b"\xc3a", b"\xf0\x9f"):
        with pytest.raises(ValueError):
            list(bpe.decode(vocabulary, [ranks[bytes([b])] for b in broken], chunk=1))
