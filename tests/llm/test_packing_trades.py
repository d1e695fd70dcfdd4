"""Operator 7: two-for-one trades and the search's end do not depend on how many pieces a bin has."""

from collections import Counter

import numpy as np

from wattline.llm import packing


def test_two_for_one_with_many_pieces():
    assert packing._trade((996, 25), (14,) * 70, 1024) == ((996, 14, 14), (25,) + (14,) * 68)
    assert packing._trade((14,) * 72 + (12,), (31,), 1024) == ((31,) + (14,) * 70 + (12,), (14, 14))


def test_search_goes_on_until_no_trade_helps():
    assert packing.local_search(Counter({(300,): 1, (2,) * 100: 1}), 1024) == {(300,) + (2,) * 100: 1}


def test_no_trade_is_left():
    rng = np.random.default_rng(3)
    counts = Counter(rng.integers(200, 345, 3000).tolist())
    under = [p for p, n in packing.pack(counts).items() if sum(p) < 1024]
    assert all(packing._trade(a, b, 1024) is None for a in under for b in under if a != b and sum(a) >= sum(b))
