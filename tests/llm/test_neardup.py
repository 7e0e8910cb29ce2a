import random
import re

import pytest

from newsloom.llm import neardup as N


def brute(rows, k, t, least):
    sets = {}
    for i, x in rows:
        w = re.findall(r"[^\W_]+", (x or "").lower())
        if i is not None and len(w) >= max(least, k):
            sets.setdefault(i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)})
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


def corpus(seed, n=120):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows, texts = [], []
    for i in range(n):
        if texts and r.random() < 0.5:
            w = r.choice(texts).split()
            for _ in range(r.randint(0, 12)):
                op, at = r.random(), r.randrange(len(w))
                if op < 0.4:
                    w[at] = r.choice(vocab)
                elif op < 0.7:
                    w.insert(at, r.choice(vocab))
                elif len(w) > 5:
                    del w[at]
            x = " ".join(w)
        else:
            x = " ".join(r.choice(vocab) for _ in range(r.randint(3, 150)))
        texts.append(x)
        rows.append((i, x))
    return rows


@pytest.mark.parametrize("seed,k,t,least", [(1, 3, 0.5, 30), (2, 5, 0.8, 1), (3, 2, 0.3, 5)])
def test_against_brute_force(spark, seed, k, t, least):
    rows = corpus(seed) + [(900, None), (901, ""), (0, corpus(seed)[0][1])]
    df = spark.createDataFrame([(i, x, "n") for i, x in rows], "id long, text string, cls string").repartition(3)
    members, links = N.similar(df, k, t, least, f"t{seed}")
    got = {tuple(r) for r in N.pairs(members, links).collect()}
    assert got == brute(rows, k, t, least)


def test_hot_shingles_are_salted_without_loss(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT", 5)  # the workers of local mode import their own copy: the driver's tile must agree with any split
    rows = [(i, f"same words at the start of all texts {i} {i + 1} {i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string")
    members, links = N.similar(df, 3, 0.5, 1, "hot")
    assert {tuple(r) for r in N.pairs(members, links).collect()} == brute(rows, 3, 0.5, 1)


def test_long_text_empty_table_and_copies(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    df = spark.createDataFrame([(1, long), (2, long + " tail end here"), (3, "x y z"), (4, "x y z")], "id long, text string")
    members, links = N.similar(df, 5, 0.8, 1, "long")
    assert {tuple(r) for r in N.pairs(members, links).collect()} == {(1, 2)}
    members, links = N.similar(df, 3, 0.8, 1, "long")
    got = N.classes(members, links)
    assert {r.id: (r.class_id, r.copies, r.links) for r in got.collect()} == {1: (1, 1, 1), 2: (2, 1, 1), 3: (3, 2, 0), 4: (3, 2, 0)}
    members, links = N.similar(df.limit(0), 3, 0.5, 1, "none")
    assert N.pairs(members, links).count() == 0


def test_sets_of_very_different_sizes(spark):
    """7 words of 17 shared are 0.41, two size bands apart."""
    w = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(1, " ".join(w[:7])), (2, " ".join(w[:17])), (3, " ".join(w[100:140])), (4, " ".join(w[100:199]))], "id long, text string")
    assert {tuple(r) for r in N.pairs(*N.similar(df, 1, 0.4, 1, "low")).collect()} == {(1, 2), (3, 4)}


def test_groups(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (20, 21), (4, 9)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.id: r.group_id for r in N.groups(spark.createDataFrame(edges, "first_id long, second_id long"), "g").collect()}
    assert all(got[i] == 1 for i in (1, 2, 3, 4, 9)) and all(got[i] == 10 for i in (10, 11, 12)) and got[21] == 20
    assert {got[i] for i in range(100, 141)} == {100}


def test_few_postings_are_compared(spark, monkeypatch):
    """Texts made of common phrases share keys with many others; sizes and places in the prefix leave few to compare, and lose none."""
    r = random.Random(6)
    phrases = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(60)]
    texts = [" ".join([*r.sample(phrases, r.randint(3, 12)), *(f"u{r.randint(0, 10**6)}" for _ in range(r.randint(5, 60)))]) for _ in range(120)]
    texts += [f"{x} some words more {i}" for i, x in enumerate(texts[:30])]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    order = spark.sparkContext.broadcast(N.rarity(N.sign(df, 3, 30)))
    post = N.postings(df, 3, 0.5, 30, order, 1).toArrow()
    compared, count = [], N.np.bitwise_count
    monkeypatch.setattr(N.np, "bitwise_count", lambda m: compared.append(len(m)) or count(m))
    got = {(a, b) for a, b in zip(*(N.tile(post, 0.5).column(c).to_pylist() for c in "ab"))}
    cls = {r.id: r.cls for r in N.sign(df, 3, 30).where("id is not null").collect()}
    want = {(min(cls[a], cls[b]), max(cls[a], cls[b])) for a, b in brute(list(enumerate(texts)), 3, 0.5, 30)}
    assert want <= got and len(want) >= 30
    assert sum(compared) < 3500  # 4890 without the places


@pytest.mark.parametrize("t", [0.3, 0.5, 0.8])
def test_limits_lose_no_pair(t):
    """Sets as similar as asked, to the element: the place of the first that they share always allows the other's size."""
    r, of = random.Random(7), N.np.array
    for _ in range(300):
        x, y = r.randint(5, 1500), r.randint(5, 1500)
        both = N.math.ceil(t * (x + y) / (1 + t) - 1e-9)
        if both > min(x, y):
            continue
        for m, other in ((x, y), (y, x)):  # those that they share come last
            prefix = min(m, m - N.math.ceil(t * m - 1e-9) + 1)
            assert m - both < prefix and N.limits(of([m]), of([(m - both) * 256 // prefix], N.np.uint8), t)[0] >= other
