"""The configuration program of packing: what it places, its bound, and exact packing of small histograms."""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
from hypothesis import given, settings, strategies as st

from starloom.llm import packing


def held(plan) -> Counter:
    back = Counter()
    for times, config in plan:
        for n, a in config:
            back[n] += a * times
    return back


@lru_cache(maxsize=None)
def fewest(items: tuple[int, ...], capacity: int) -> int:
    """Exact packing: the first item's sequence in every way."""
    if not items:
        return 0

    def fill(room: int, start: int, rest: tuple[int, ...]):
        yield rest
        for i in range(start, len(rest)):
            if rest[i] <= room and (i == start or rest[i] != rest[i - 1]):
                yield from fill(room - rest[i], i, rest[:i] + rest[i + 1 :])

    return 1 + min(fewest(rest, capacity) for rest in fill(capacity - items[0], 0, items[1:]))


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_against_exact_packing(items):
    histogram = Counter(items)
    solution = packing.solve_program(dict(histogram), 12)
    plan = packing.solve(dict(histogram), 12)
    exact = fewest(tuple(sorted(items, reverse=True)), 12)
    assert held(plan) == histogram
    assert held(solution.plan) + Counter(solution.left) == histogram
    assert exact <= sum(t for t, _ in plan) <= exact + 1
    assert math.ceil(solution.bound - 1e-6) <= exact


def test_the_program_places_nearly_all():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2048, np.exp(rng.normal(5.5, 1.3, 12_000)).astype(int) + 1)
    for times in (1, 20, 10**9):
        histogram = {n: c * times for n, c in Counter(lengths.tolist()).items()}
        solution = packing.solve_program(histogram)
        total, rest = sum(histogram.values()), sum(solution.left.values())
        used = sum(t for t, _ in packing.solve(histogram))
        assert rest <= 0.1 * total
        assert solution.bound >= sum(n * c for n, c in histogram.items()) / 2048 * (1 - 1e-9)
        assert used <= solution.bound * 1.01 + 1


def test_weights_find_what_volume_hides():
    """Lengths of which two or three fit: with prices by volume alone the short ones go first and the long ones stay alone."""
    rng = np.random.default_rng(1)
    histogram = {n: int(c) for n, c in zip(range(600, 1100), rng.integers(1, 50, 500))}
    first, weighted = (sum(t for t, _ in packing.solve(histogram, steps=s)) for s in (1, 12))
    assert weighted < 0.95 * first
    assert weighted < sum(t for t, _ in packing.best_fit(dict(histogram), 2048))


def test_many_pieces_of_one_token():
    plan = packing.solve({1: 5000, 2000: 3, 2048: 2})
    assert held(plan) == Counter({1: 5000, 2000: 3, 2048: 2})
    assert sum(t for t, _ in plan) == 8
    assert packing.solve({}) == []
