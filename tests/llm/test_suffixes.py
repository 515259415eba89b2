import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm.suffixes import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 4).flatmap(lambda a: st.lists(st.integers(1, a), max_size=60)))
def test_equals_sorted_suffixes(symbols):
    assert suffix_array(np.array(symbols, int)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_long_runs_and_periods():
    for text in ([1] * 500, [1, 2] * 300, [3, 1, 2] * 200 + [1] * 100, list(range(1, 300)), list(range(300, 0, -1))):
        assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])
