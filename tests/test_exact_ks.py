"""Exact two-sample KS p-values against counted orders of the samples."""

from itertools import combinations
from math import comb, gcd

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.operators import drift as DR


def counted(m, n, gap):
    """Share of the orders of m + n values whose largest gap is >= gap."""
    hit = 0
    for firsts in combinations(range(m + n), m):
        i = j = worst = 0
        for t in range(m + n):
            i, j = (i + 1, j) if t in firsts else (i, j + 1)
            worst = max(worst, abs(i * n - j * m))
        hit += worst >= gap
    return hit / comb(m + n, m)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(0, 40))
def test_matches_counted_orders(m, n, gap):
    assert DR.exact_ks_p(m, n, gap) == pytest.approx(counted(m, n, gap), abs=1e-12)


def paths(m, n, gap):
    """Whole-number path counts, for sizes that orders cannot be listed at."""
    row = [0] * (n + 1)
    for i in range(m + 1):
        for j in range(n + 1):
            here = 1 if i == j == 0 else (row[j] if i else 0) + (row[j - 1] if j else 0)
            row[j] = here if abs(i * n - j * m) < gap else 0
    return 1 - row[n] / comb(m + n, n)


@pytest.mark.parametrize("m, n, gap", [(5, 500, 1450), (5, 500, 1500), (30, 47, 600), (200, 200, 5400), (1, 9000, 8999)])
def test_matches_path_counts(m, n, gap):
    assert DR.exact_ks_p(m, n, gap) == pytest.approx(paths(m, n, gap), abs=1e-9)
    assert DR.exact_ks_p(n, m, gap) == DR.exact_ks_p(m, n, gap)


def test_known_decisions():
    """Five new texts against 500: D = 0.58 and 0.60 are drift, though the
    asymptotic series says they are not."""
    assert round(DR.exact_ks_p(5, 500, 1450), 3) == 0.042
    assert round(DR.exact_ks_p(5, 500, 1500), 3) == 0.032


def test_small_p_keeps_digits():
    assert DR.exact_ks_p(40, 40, 1600) == pytest.approx(2 / comb(80, 40), rel=1e-9)


def test_operator(spark):
    a, b = [float(x * x % 37) for x in range(30)], [float(x % 23) + 5 for x in range(21)]
    rows = [("g", "reference", v) for v in a] + [("g", "current", v) for v in b] + [("empty", "current", 1.0)]
    df = spark.createDataFrame(rows, "k string, sample string, value double")
    got = {r.k: r for r in DR.ks_two_sample(df, by=["k"]).collect()}
    worst = max(abs(sum(x <= v for x in a) * 21 - sum(x <= v for x in b) * 30) for v in a + b)
    assert got["g"].ks_stat == pytest.approx(worst / 630) and got["g"].p_value == pytest.approx(paths(30, 21, worst))
    assert got["empty"].ks_stat is None and got["empty"].p_value is None
    far = {r.k: r for r in DR.ks_two_sample(df, by=["k"], exact_max=20).collect()}["g"]
    assert far.p_value != got["g"].p_value and abs(far.p_value - got["g"].p_value) < 0.1
    assert gcd(30, 21) > 1  # ties between sample sizes need no common unit
