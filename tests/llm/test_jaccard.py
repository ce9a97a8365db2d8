"""What the near-copy join compares before it counts."""

from __future__ import annotations

import numpy as np
import pytest

from tidegate.llm import jaccard


@pytest.mark.parametrize(("size", "apart"), [(395, 139), (800, 282), (1500, 530)])
def test_cells_tell_sets_that_do_not_link(size, apart):
    """Sets with a similarity of 0.7 do not pass the bound of 0.8, and no bound exceeds the n-grams that differ."""
    draw = np.random.default_rng(size)
    scheme = int(np.searchsorted(jaccard.LOWS, size, side="right")) - 1
    differ = 2 * size - 2 * -(-80 * 2 * size // 180)
    passed = 0
    for _ in range(40):
        common = draw.integers(0, 2**64, size - apart // 2, dtype=np.uint64)
        both = [np.sort(np.concatenate([common, draw.integers(0, 2**64, apart // 2, dtype=np.uint64)])) for _ in range(2)]
        found = jaccard.cells(np.concatenate(both), np.array([0, size, 2 * size]), np.array([scheme, scheme]))
        x, y = (np.frombuffer(c, np.uint64).reshape(1, -1) for c in found)
        unlike = int(jaccard.unlike_cells(x, y)[0])
        assert unlike <= 2 * (apart // 2)
        assert jaccard.unlike_cells(x, x)[0] == 0
        passed += unlike <= differ
    assert passed <= 8


def test_groups_without_higher_ranks_are_not_named(spark):
    """A pair of several groups comes once; only a group whose pairs go beyond the ranks is named for later."""
    one, far = b"\x00" * 64, b"\x11" * 64
    rows = [(9, s, 0, 0, 0, i, 30, one, i) for s in (1, 2) for i in (1, 2)]
    rows += [(9, 3, 0, 0, 0, i, 30, one, i) for i in (1, 2, 4, 5)]
    rows += [(9, 4, 0, 0, 0, i, 30, c, i) for i, c in ((6, one), (7, far))]
    members = spark.createDataFrame(
        rows, "scheme int, signature long, low int, high int, block int, id long, n long, cells binary, label long"
    ).coalesce(1)
    found = jaccard.within(members, 80, (1, 1)).collect()
    pairs = [(r.a, r.b) for r in found if r.a is not None]
    assert len(pairs) == len(set(pairs)) and (1, 2) in pairs and (6, 7) not in pairs
    assert [r.later for r in found if r.a is None] == [3]
    higher = jaccard.within(members, 80, (2, 2000)).collect()
    everything = {(1, 2), (1, 4), (1, 5), (2, 4), (2, 5), (4, 5)}
    assert {(r.a, r.b) for r in higher if r.a is not None} | set(pairs) == everything
    assert all(r.later is None for r in higher)
