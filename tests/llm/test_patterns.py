from __future__ import annotations

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from panelforge.llm import packing


def histogram(sizes) -> dict[int, int]:
    return {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True), strict=True)}


def checked(hist: dict[int, int], capacity: int):
    """(sequences, share of the pieces that patterns placed) of a plan that is whole and overlaps nowhere."""
    entries, by_pattern = packing.plan_parts(hist, capacity)
    used, at = Counter(), {}
    for length, rank, number, seq, offset in entries:
        assert rank == used[length]
        used[length] += number
        for s in range(seq, seq + number):
            at.setdefault(s, []).append((offset, length))
    assert used == Counter({k: n for k, n in hist.items() if n})
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at), sum(e[2] for e in entries[:by_pattern]) / max(1, sum(hist.values()))


@pytest.mark.parametrize("mean", [5.0, 5.8, 6.4, 7.2])
def test_patterns_place_most_pieces_and_fill_sequences(mean):
    sizes = np.minimum(4096, np.random.default_rng(int(mean * 10)).lognormal(mean, 0.9, 12000).astype(int) + 1)
    n_seq, share = checked(histogram(sizes), 4096)
    assert share >= 0.5
    assert n_seq <= math.ceil(sizes.sum() / 4096 * 1.003) + 1


@pytest.mark.parametrize("hist", [{}, {4096: 7}, {1: 5}, {3000: 11}, {2048: 9}, {1365: 10}, {4095: 3, 1: 2}, {700: 1, 701: 1, 2695: 1}, {63: 1000}])
def test_plans_of_few_lengths(hist):
    n_seq, _ = checked(hist, 4096)
    best = {(3000, 11): 11}.get(next(iter(hist.items()), None)) or max(
        -(-sum(k * n for k, n in hist.items()) // 4096), *([-(-n // (4096 // k)) for k, n in hist.items()] or [0]))
    assert n_seq == best


def test_sections_and_patterns_keep_their_limits():
    hist = histogram(np.random.default_rng(1).integers(1, 4097, 5000))
    groups = packing.sections(hist, 4096)
    covered = sorted(n for own in groups.values() for n in own)
    assert covered == sorted(n for n in hist if n >= 4096 // packing.CRUMBS)
    assert all(g == own[0] and own[0] - own[-1] <= 4096 // packing.WIDTHS and own == sorted(own, reverse=True) for g, own in groups.items())
    pats = packing.patterns(list(groups), 4096)
    assert len(set(pats)) == len(pats)
    for p in pats:
        assert packing.FILL * 4096 <= sum(g * m for g, m in p) <= 4096
        assert [g for g, _ in p] == sorted({g for g, _ in p}, reverse=True) and all(m in packing.REPEATS for _, m in p)


def test_nnls_is_the_least_over_all_supports():
    rng = np.random.default_rng(7)
    for _ in range(20):
        a = rng.integers(0, 3, (3, 6)) * (rng.random((3, 6)) < 0.7)
        b = rng.integers(0, 20, 3).astype(float)
        index = np.tile(np.arange(3), (6, 1))
        got = packing.nnls(index, a.T, b, np.ones(3))
        x = np.array([got.get(j, 0.0) for j in range(6)])
        best = min([float(b @ b)] + [float(np.square(a[:, s] @ z - b).sum()) for k in (1, 2, 3) for s in map(list, combinations(range(6), k))
                                     for z in [np.linalg.lstsq(a[:, s], b, rcond=None)[0]] if (z >= -1e-9).all()])
        assert (x >= 0).all() and np.square(a @ x - b).sum() <= best + 1e-6
