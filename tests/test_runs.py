import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from arrayloom.model import ArrayFileError
from arrayloom.operators.runs import normal_runs, run_of, segments


def plain_starts(bounds, rows):
    out = []
    for r in range(rows):
        before = [i for i, b in enumerate(bounds) if b <= r]
        out.append(before[-1] if before else -1)
    return out


def plain_ends(bounds, rows):
    return [next((i for i, b in enumerate(bounds) if r <= b), -1) for r in range(rows)]


@given(st.lists(st.integers(0, 30), max_size=8).map(sorted), st.integers(0, 25))
def test_starts_agree_with_a_plain_lookup(bounds, rows):
    starts, end = normal_runs(np.array(bounds, np.uint64), rows, False)
    got = run_of(np.arange(rows), starts, end)
    assert got.tolist() == plain_starts(bounds, rows)


@given(st.lists(st.integers(0, 30), max_size=8).map(sorted), st.integers(0, 25))
def test_ends_agree_with_a_plain_lookup(bounds, rows):
    starts, end = normal_runs(np.array(bounds, np.uint64), rows, True)
    got = run_of(np.arange(rows), starts, end)
    assert got.tolist() == plain_ends(bounds, rows)


def test_greatest_end_does_not_overflow():
    starts, end = normal_runs(np.array([0, 2**64 - 1], np.uint64), 5, True)
    assert run_of(np.arange(5), starts, end).tolist() == [0, 1, 1, 1, 1]


def test_decreasing_boundaries_are_an_error():
    with pytest.raises(ArrayFileError):
        normal_runs(np.array([3, 1], np.uint64), 5, False)


@given(st.lists(st.lists(st.integers(0, 30), max_size=6).map(sorted), max_size=3), st.integers(0, 40), st.integers(1, 12))
def test_segments_cover_the_rows_and_are_constant(columns, rows, most):
    normal = [normal_runs(np.array(c, np.uint64), rows, i % 2 == 1) for i, c in enumerate(columns)]
    begin, end, which = segments(rows, normal, most)
    assert [r for a, b in zip(begin, end) for r in range(a, b)] == list(range(rows))
    assert all(0 < b - a <= most for a, b in zip(begin, end))
    for (starts, stop), runs in zip(normal, which):
        for a, b, run in zip(begin, end, runs):
            assert set(run_of(np.arange(a, b), starts, stop).tolist()) == {run}
