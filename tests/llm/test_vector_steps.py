"""The adders of the bit-sliced index, by how much Python they run and what they give."""

import sys

import numpy as np

from stratalog.llm.vector_search import BlockIndex


def test_adders_take_all_bitmaps_of_a_digit_at_once():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-130, 130, (500, 64))
    index, lines = BlockIndex(np.arange(500), vectors), [0]

    def count(frame, event, arg):
        lines[0] += event == "line"
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        score = index.scores(vectors[3])
    finally:
        sys.settrace(before)
    assert lines[0] < 6000  # one by one, the bitmaps took 18,834
    digits = np.array([np.unpackbits(s.view(np.uint8), bitorder="little")[:500] for s in score], np.int64)
    weights = [1 << b for b in range(len(score))]
    weights[-1] *= -1
    assert (np.array(weights) @ digits == vectors @ vectors[3]).all()
