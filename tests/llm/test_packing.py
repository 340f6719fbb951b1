import numpy as np
from hypothesis import given, strategies as st

from hourgrid.llm import packing as P

NUMBERS = st.lists(st.integers(0, 2**40))


@given(NUMBERS)
def test_numbers(values):
    values = np.array(values, np.int64)
    assert P.widened(P.narrow(values)).tolist() == values.tolist()
    assert P.unsmall(P.small(values)).tolist() == values.tolist()


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1))
def test_keys(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert P.ungapped(P.gaps(keys)).tolist() == keys.tolist()


@given(st.sets(st.integers(0, 5000)), st.integers(5001, 10**6))
def test_cells(values, size):
    values = np.array(sorted(values), np.int64)
    assert P.unpacked(P.packed(values, size)).tolist() == values.tolist()
