"""The mix as a sequence of slots, against its own sums and targets."""

import random
from collections import defaultdict

import pytest

from weirwatch.llm import mixing

BASE = "doc_id LONG, text STRING, source STRING"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    sizes = {"a": 300, "b": 120, None: 60}
    out = [(100 * j + i, "w " * draw.randint(0, 700), s) for j, (s, n) in enumerate(sizes.items()) for i in range(n)]
    out += [(9_000, "one two three " * 50, "a")] * 40 + [(9_001, None, "b"), (9_002, "", "a"), (None, "no id " * 30, "b")]
    return out + [(9_003, "long " * 50_000, "b")]


def test_sequence_is_the_mix(spark, rows):
    docs = spark.createDataFrame(rows, BASE).repartition(5)
    pieces = mixing.sequence(docs).collect()
    mixed = mixing.mix(docs).collect()
    n_words = {(r.doc_id, r.source): r.size for r in mixed}
    taken, first = defaultdict(int), {}
    for p in pieces:
        assert 0 <= p.from_word < p.to_word <= n_words[p.doc_id, p.source]
        taken[p.doc_id, p.source] += p.to_word - p.from_word
        first[p.doc_id, p.source] = min(p.slot, first.get((p.doc_id, p.source), p.slot))
    copies = defaultdict(int)
    for r in mixed:
        copies[r.doc_id, r.source] += 1
    for r in mixed:
        key = r.doc_id, r.source
        assert r.taken == taken[key] // copies[key] and r.first_slot == first.get(key)
    # Every word of the source comes once before any comes again.
    seen = defaultdict(int)
    for p in pieces:
        for w in range(p.from_word, p.to_word):
            seen[p.doc_id, p.source, p.copy, w] += 1
    for source in ("a", "b", None):
        times = {n for k, n in seen.items() if k[1] == source}
        assert max(times) - min(times) <= 1 or max(times) == 2


def test_prefixes_are_near_the_targets(spark, rows):
    docs = spark.createDataFrame(rows, BASE)
    targets = {r.source: r.target for r in mixing.mix(docs).collect()}
    pieces = mixing.sequence(docs).collect()
    slots = defaultdict(set)
    for p in pieces:
        slots[p.slot].add(p.source)
    assert all(len(s) == 1 for s in slots.values()) and sorted(slots) == list(range(len(slots)))
    total = sum(targets.values())
    for share in (0.1, 0.3, 0.5, 0.8):
        got = defaultdict(int)
        for p in pieces:
            if p.slot < share * len(slots):
                got[p.source] += p.to_word - p.from_word
        for source, target in targets.items():
            assert abs(got[source] - share * target) <= 0.02 * total


def test_the_schedule_decides(spark, rows, monkeypatch):
    """Another turn gives another order and, by source, the same words."""
    docs = spark.createDataFrame(rows, BASE)
    one = {r.doc_id: (r.taken, r.first_slot) for r in mixing.mix(docs).collect() if r.doc_id}
    monkeypatch.setattr(mixing, "TURN", mixing.CIRCLE // 4)
    two = {r.doc_id: (r.taken, r.first_slot) for r in mixing.mix(docs).collect() if r.doc_id}
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in two.items()}
    assert one != two


def test_points_far_on_are_exact():
    place = lambda i: i % mixing.CIRCLE * mixing.TURN % mixing.CIRCLE
    start = 10**15
    assert len({place(start + i) for i in range(10_000)}) == 10_000
    assert (mixing.CIRCLE - 1) * mixing.TURN < 2**63


def test_empty_table(spark):
    docs = spark.createDataFrame([], BASE)
    assert mixing.sequence(docs).count() == 0 and mixing.mix(docs).count() == 0
