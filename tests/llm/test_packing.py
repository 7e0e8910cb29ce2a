import itertools
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.llm import packing as P
from newsloom.llm import tokens as T


@given(st.lists(st.integers(1, 50), min_size=1, max_size=40), st.integers(1, 8))
@settings(deadline=None)
def test_difference_partitions(sizes, k):
    w = P.difference(np.array(sizes), k)
    assert sorted(i for x in w for i in x) == list(range(len(sizes))) and len(w) <= k


def test_two_way_differencing_by_hand():
    w = P.difference(np.array([8, 7, 6, 5, 4]), 2)  # the known result of the method: 16 and 14
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in x) for x in w) == [14, 16]


@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
@settings(deadline=None)
def test_no_window_exceeds_the_capacity(sizes):
    a = np.array(sizes)
    w = P.pack(a, 100)
    assert sorted(i for x in w for i in x) == list(range(len(a))) and all(a[x].sum() <= 100 for x in w)


def test_close_to_the_least_number_of_windows():
    r = random.Random(1)
    for _ in range(30):
        sizes = [r.randint(1, 10) for _ in range(7)]
        best = next(k for k in range(1, 8) if any(max(sum(s for s, g in zip(sizes, p) if g == j) for j in range(k)) <= 10 for p in itertools.product(range(k), repeat=7)))
        assert len(P.pack(np.array(sizes), 10)) <= best + 1


def test_frame(spark):
    r = random.Random(2)
    rows = [(i, "a" if i % 3 else "b", r.randint(1, 900), "w") for i in range(3000)] + [(5000, None, 0, "w"), (5001, None, 10_007, "w"), (5002, "a", None, "w")]
    items = spark.createDataFrame(rows, "id long, source string, tokens long, window string")
    spec = spark.createDataFrame([(1, 512, None), (2, 1000, "b"), (3, 100, "none"), (None, 5, None)], "spec_id int, capacity int, source string")
    w = P.packed(items, spec).cache()
    assert w.groupBy("spec_id", "window").agg(F.sum("tokens").alias("t")).join(spec, "spec_id").where("t > capacity").count() == 0
    got = {x.spec_id: x.t for x in w.groupBy("spec_id").agg(F.sum("tokens").alias("t")).collect()}
    assert got == {1: sum(x[2] or 0 for x in rows), 2: sum(x[2] for x in rows if x[1] == "b")}
    assert w.where("piece = 0").groupBy("spec_id", "id").count().where("count > 1").count() == 0
    assert w.where("id = 5001 and spec_id = 1").count() == 20
    assert min(x.fill for x in P.fill_report(w, spec).collect()) > 0.93
    assert P.packed(items.limit(0), spec).count() == 0


def test_tokens(spark):
    assert T.count("") == 0 and T.count("hello world") > 1
    long = "word and number 12 " * 9000
    whole = len(T.encoding(T.VOCABULARY).encode_ordinary(long))
    assert T.count(long) == whole
    mixed = "Das  ist' ein\n\n Text, 12 34 — \u00e4\u00f6 " * 6000
    assert T.count(mixed) == len(T.encoding(T.VOCABULARY).encode_ordinary(mixed))
    df = spark.createDataFrame([(1, "s", "a b", 7), (2, None, "", 7), (3, "s", None, 7)], "id long, source string, text string, tokens int")
    assert {x.id: x.tokens for x in T.sized(df).collect()} == {1: T.count("a b"), 2: 0}
