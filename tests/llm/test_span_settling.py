"""Dealing out and settling of segments."""

import random

import numpy as np
import pyarrow as pa
import pytest

from weirwatch.llm import repeated_spans


def _block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


def test_chance_phrases_share_no_anchor():
    """Texts with common phrases of 24 bytes have no window in common, so nothing of them is looked at again."""
    draw = random.Random(1)
    phrases = ["".join(draw.choice("abcdef ") for _ in range(24)) for _ in range(4)]
    texts = ["".join(draw.choice(phrases) + "".join(draw.choice("ghijklm") for _ in range(40)) for _ in range(60)) for _ in range(20)]
    anchor, row, *_ = repeated_spans.segments(*_block(texts))
    assert len(np.unique(anchor)) == len(anchor) > 1000
    same = repeated_spans.segments(*_block([texts[0], "x" * 37 + texts[0] + "y" * 37]))[0]
    assert len(np.unique(same)) < 0.6 * len(same)


def test_segments_hold_every_window_once():
    draw = random.Random(2)
    texts = ["".join(draw.choice("ab") for _ in range(n)) for n in (0, 99, 100, 101, 3000, 5)] + ["a" * 700, "", "é" * 150]
    data, offsets = _block(texts)
    anchor, row, start, size, content, _ = repeated_spans.segments(data, offsets)
    held = sorted((int(r), int(s) + k) for r, s, n in zip(row, start, size) for k in range(n))
    assert held == [(i, j) for i, t in enumerate(texts) for j in range(len(t.encode()) - 99)]
    anchors = {}
    for a, r, s, n in zip(anchor, row, start, size):
        for k in range(n):
            at = offsets[r] + s + k
            assert anchors.setdefault(data[at : at + 100].tobytes(), a) == a


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_settling_in_pieces(monkeypatch, rows):
    monkeypatch.setattr(repeated_spans, "SETTLED_ROWS", rows)
    draw = random.Random(3)
    found = []
    for anchor in (-5, -4, 0, 3, 9, 12):
        for _ in range(draw.choice([1, 2, 40])):
            key = draw.randint(0, 30)
            # A text's first row and, at times, a copy of it with a later place.
            found.append((anchor, draw.randint(0, 5), key // 2 + draw.choice([0, 0, 100]), key, draw.randint(0, 20) << 17 | 40 << 1 | (anchor == 12)))
    found = sorted({(a, p, k, s): c for a, c, p, k, s in found}.items())
    found = [(a, c, p, k, s) for (a, p, k, s), c in found]
    first, contents = {}, {}
    for a, c, p, k, s in found:
        first.setdefault((a, c), (p, k, s >> 17))
        contents.setdefault(a, set()).add(c)
    want = sorted((a, p, k, s >> 17, 139, 0) for a, c, p, k, s in found if first[a, c][1:] != (k, s >> 17))
    want = sorted(want + [(a, *first[a, c], 139, len(contents[a])) for a, c in first if len(contents[a]) > 1 or a == 12])
    names = ["anchor", "content", "place", "text_key", "span"]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found[i : i + 5])], names=names) for i in range(0, len(found), 5)]
    got = [tuple(r.values()) for b in repeated_spans._settle(100)(iter(batches)) for r in b.to_pylist()]
    assert sorted(got) == want
    assert not list(repeated_spans._settle(100)(iter([])))


def test_suffix_order_against_plain_sort():
    draw = np.random.default_rng(4)
    symbols = np.concatenate([draw.integers(1, 4, 900), np.full(300, 2), draw.integers(1, 3, 200)]).astype(np.uint8)
    raw = symbols.tobytes()
    for depth in (8, 16, 50, 100):
        order = repeated_spans.suffix_order(symbols, depth)
        assert sorted(order.tolist()) == list(range(len(raw)))
        prefixes = [raw[i : i + depth] for i in order]
        assert prefixes == sorted(prefixes)


def test_one_line_in_many_contexts(spark):
    """Anchors with more different segments than ``hot``: each window is settled by its hash, repeated rows and null ids too."""
    draw = random.Random(6)
    line = "".join(draw.choice("abcdefgh ") for _ in range(180))
    texts = ["".join(draw.choice("ijklmnop ") for _ in range(90)) + chr(33 + i) + line + chr(33 + i) + "".join(draw.choice("qrstuvw ") for _ in range(90)) for i in range(40)]
    rows = [(i if i < 38 else None, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows + rows[3:6], "doc_id LONG, text STRING")
    for hot in (repeated_spans.HOT, 5):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed, r.n_spans) for r in repeated_spans.remove_repeats(table, hot=hot).collect())
        want = [(r[0] is None, r[0] or 0, 180 * (i > 0), int(i > 0)) for i, r in enumerate(rows)]
        assert got == sorted(want + want[3:6])
