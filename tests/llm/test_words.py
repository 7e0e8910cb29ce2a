import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from newsloom.llm.words import common, shingle_set, shingle_sets, shingles, winnow, winnowed_words, word_hashes, word_lists


def test_batches_equal_singles():
    r = random.Random(1)
    texts = [" ".join(r.choice("abcdefg") for _ in range(r.randint(0, 60))) for _ in range(200)] + [None, ""]
    rows, begin, h = shingle_sets(texts, 3, 5)
    assert len(rows)
    for j, i in enumerate(rows):
        assert (shingle_set(texts[i], 3)[1] == h[begin[j] : begin[j + 1]]).all()
    rows, words = word_lists(texts, 12)
    begin, f = winnowed_words(words, 12, 8)
    for j, i in enumerate(rows):
        assert (np.unique(winnow(shingles(word_hashes(texts[i]), 12), 8)) == f[begin[j] : begin[j + 1]]).all()


@given(st.sets(st.integers(0, 200)), st.sets(st.integers(0, 200)))
def test_common(a, b):
    assert common(np.array(sorted(a), np.uint64), np.array(sorted(b), np.uint64)) == len(a & b)


def test_equal_runs_leave_equal_fingerprints():
    r = random.Random(2)
    run = [f"w{r.randint(0, 9999)}" for _ in range(19)]
    for _ in range(20):
        a = " ".join([f"x{r.random()}" for _ in range(9)] + run + [f"y{r.random()}" for _ in range(9)])
        b = " ".join([f"z{r.random()}" for _ in range(5)] + run)
        fa, fb = (set(winnow(shingles(word_hashes(t), 12), 8).tolist()) for t in (a, b))
        assert fa & fb
