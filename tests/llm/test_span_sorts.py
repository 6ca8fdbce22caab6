"""The expansion's sorts."""

import numpy as np
import pytest

from weirwatch.llm import repeated_spans


@pytest.mark.parametrize("bits", [1, 20, 42, 60])
def test_packed_sort_is_the_stable_order(bits):
    key = np.random.default_rng(bits).integers(0, min(1 << bits, 500), 3000)
    assert (repeated_spans._stable_order(key, bits) == np.argsort(key, kind="stable")).all()
    assert (repeated_spans._stable_order(key[:1], bits) == [0]).all() and not len(repeated_spans._stable_order(key[:0], bits))


def test_repeated_windows_against_plain_search():
    rng = np.random.default_rng(5)
    pieces = [bytes(rng.integers(97, 99, int(n), dtype=np.uint8)) for n in rng.integers(100, 160, 30)]
    pieces += [pieces[3][:110] + b"x" * 5, b"ab" * 80, pieces[7]]
    seen, wanted = set(), set()
    for i, p in enumerate(pieces):
        for j in range(len(p) - 99):
            if p[j : j + 100] in seen:
                wanted.add((i, j))
            seen.add(p[j : j + 100])
    found = {(i, at + k) for i, at, n in repeated_spans.repeated_windows(pieces) for k in range(n)}
    assert found == wanted
