import random

from newsloom.llm import incremental as I
from newsloom.llm.incremental import History
from newsloom.llm.weburl import page_key
from newsloom.llm.words import jaccard_at_least, shingle_set


def brute(texts, urls, items, k=3, t=0.5, least=30):
    known, sets, out = {}, {}, {}

    def add(i, u, x):
        if (key := page_key(u)) is not None:
            known[key] = min(i, known.get(key, i))
        if x is not None:
            n, s = shingle_set(x, k)
            if n >= least:
                sets[i] = s

    for i, x in texts:
        add(i, None, x)
    for i, u in urls:
        add(i, u, None)
    for i, u, x in sorted(items):
        hit = [known[page_key(u)]] if page_key(u) in known else []
        if x is not None:
            n, s = shingle_set(x, k)
            if n >= least:
                hit += [j for j, y in sets.items() if jaccard_at_least(s, y, t)]
        if hit:
            out[i] = min(hit)
        else:
            add(i, u, x)
    return out


def edited(r, x):
    w = x.split()
    for _ in range(len(w) // 25):
        w[r.randrange(len(w))] = f"q{r.randint(0, 99)}"
    return " ".join(w)


def test_batches_against_brute_force(spark):
    r = random.Random(4)
    fresh = lambda: " ".join(f"w{r.randint(0, 5000)}" for _ in range(r.randint(40, 120)))
    texts = [(i, fresh()) for i in range(1, 40)] + [(40, None), (41, "short text")]
    texts.append(texts[0])
    urls = [(i, f"http://site.example/a/{i}?utm_source=x") for i in range(1, 42)] + [(7, "http://lnk.example/z"), (8, None)]
    items, pool = [], [x for _, x in texts if x]
    for i in range(100, 160):
        kind = r.random()
        x = edited(r, r.choice(pool)) if kind < 0.4 else fresh() if kind < 0.9 else None
        u = f"https://www.site.example:443/a/{r.randint(1, 60)}/#c" if r.random() < 0.4 else f"http://new.example/{i}" if r.random() < 0.8 else None
        items.append((i, u, x))
        if x:
            pool.append(x)
    t = spark.createDataFrame([(i, x, "n") for i, x in texts], "id long, text string, n string")
    h = History.create(spark, I.scratch_store(spark, "hist"), 3, 0.5, 30).build(t, spark.createDataFrame(urls, "id long, url string"))
    got = {}
    for lo in range(100, 160, 20):
        batch = [x for x in items if lo <= x[0] < lo + 20]
        got |= {x.item: x.first_id for x in h.check(spark.createDataFrame(batch + batch[:1], "id long, url string, text string")).collect()}
    want = brute(texts, urls, items)
    assert {i: f for i, f in got.items() if f is not None} == want and set(got) == {x[0] for x in items} and len(want) > 15


def test_case_of_a_case_is_no_case(spark):
    """An item that repeats only an item which itself was not accepted is accepted."""
    words = [f"w{i}" for i in range(300)]
    a, b, c = " ".join(words[:200]), " ".join(words[50:250]), " ".join(words[100:300])
    df = lambda rows: spark.createDataFrame(rows, "id long, url string, text string")
    t = spark.createDataFrame([(1, a)], "id long, text string")
    h = History.create(spark, I.scratch_store(spark, "chain"), 3, 0.5, 30).build(t, spark.createDataFrame([(1, None)], "id long, url string"))
    got = {r.item: r.first_id for r in h.check(df([(2, None, b), (3, None, c), (4, None, c)])).collect()}
    assert got == {2: 1, 3: None, 4: 3}
    assert h.check(df([]).limit(0)).count() == 0
    assert {r.item: r.first_id for r in h.check(df([(5, None, c), (6, None, None)])).collect()} == {5: 3, 6: None}


def test_dense_edits_and_short_texts(spark):
    """A word changed every 10 leaves no equal run of 12; 30 words with one changed in the middle share few long runs."""
    r = random.Random(8)
    new = lambda n: [f"w{r.randint(0, 9999)}" for _ in range(n)]
    old = [new(n) for n in [30] * 20 + [60, 120, 250, 700]]
    items = []
    for i, w in enumerate(old):
        x = list(w)
        for j in [14] if len(w) == 30 else range(5, len(w), 10):
            x[j] = f"q{i}x{j}"
        items += [(100 + 2 * i, None, " ".join(x)), (101 + 2 * i, None, " ".join(new(len(w))))]
    items.append((200, None, " ".join(["z0", *items[-1][2].split()[:650]])))  # a copy within the batch, of another size
    t = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(old)], "id long, text string")
    h = History.create(spark, I.scratch_store(spark, "dense"), 3, 0.5, 30).build(t, spark.createDataFrame([(1, None)], "id long, url string"))
    got = {x.item: x.first_id for x in h.check(spark.createDataFrame(items, "id long, url string, text string")).collect()}
    assert {i: f for i, f in got.items() if f is not None} == brute([(i, " ".join(w)) for i, w in enumerate(old)], [], items) and sum(f is not None for f in got.values()) == len(old) + 1


def test_few_postings_are_compared(spark, monkeypatch):
    """Texts made of common phrases share keys with most of the history; sizes and places in the prefix leave few to compare, and lose none."""
    r = random.Random(6)
    phrases = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(60)]
    new = lambda: " ".join([*r.sample(phrases, r.randint(3, 12)), *(f"u{r.randint(0, 10**6)}" for _ in range(r.randint(5, 60)))])
    old = [(i, new()) for i in range(400)]
    items = [(1000 + i, edited(r, old[i][1]) if i % 4 == 0 else new()) for i in range(100)]
    of = lambda rows: I.sets(spark.createDataFrame(rows, "id long, text string").coalesce(1), 3, 30)
    rare = spark.sparkContext.broadcast(I.rarity(of(old), 0))
    post = lambda rows, was: I.posted(I.keyed(of(rows), 0.5, rare), 1, was).toArrow()
    left = post(items, False)
    right = I.pa.concat_tables([post(old, True), left])
    compared, rows = [], I._Postings.rows
    monkeypatch.setattr(I._Postings, "rows", lambda self, d, *a: compared.append(len(d)) or rows(self, d, *a))
    got = {(a, b) for a, b in zip(*(I.met(left, right, 0.5).column(c).to_pylist() for c in ("item", "rec")))}
    sets = {i: shingle_set(x, 3)[1] for i, x in old + items}
    want = {(a, b) for a, _ in items for b in sets if b < a and jaccard_at_least(sets[a], sets[b], 0.5)}
    assert want <= got and len(want) >= 20
    assert sum(compared) / 2 < 0.04 * len(items) * len(sets)


def test_the_order_comes_from_all_texts(spark):
    """Each shingle is counted in every text that has it, and the prefixes begin with the rarest by these counts."""
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[: 31 + i % 9])) for i in range(1, 90)] + [(90, None), (91, "short")]
    h = History.create(spark, I.scratch_store(spark, "order"), 3, 0.5, 30).build(spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(1, None)], "id long, url string"))
    have = [shingle_set(x, 3)[1] >> I.np.uint64(24) for _, x in rows[:89]]
    want = I.np.bincount(I.np.concatenate(have).astype(int) & (len(h.order.value) - 1), minlength=len(h.order.value))
    assert (h.order.value == want).all() and want.max() == 89
    for r in h.reps.collect():
        n = want[I.unpack40(bytes(r.fps) + bytes(r.rest)).astype(int) & (len(want) - 1)]
        assert len(n) == r.n and (I.np.diff(n) >= 0).all()


def test_page_keys():
    same = ["http://a.example/x/y?b=2&a=1", "HTTPS://www.A.example:443/x/%79/?a=1&b=2&utm_source=q#top", "http://click.t.example/r?u=http%3A%2F%2Fm.a.example%2Fx%2Fy%3Fa%3D1%26amp%3Bb%3D2", " http://amp.a.example/x/y?b=2&amp;a=1&print=1 "]
    assert len({page_key(u) for u in same}) == 1
    assert page_key("http://a.example/x?page=2") != page_key("http://a.example/x") != page_key("http://a.example/y")
    assert page_key(None) is None and page_key("  ") is None and page_key("http://[bad") and page_key("not a url")


def test_the_store_outlives_its_object(spark):
    """Opened again it knows what was accepted; a batch that broke off before the manifest was written isn't part of it; filters grow with the history."""
    r = random.Random(5)
    new = lambda: " ".join(f"w{r.randint(0, 9999)}" for _ in range(60))
    df = lambda rows: spark.createDataFrame(rows, "id long, url string, text string")
    folder = I.scratch_store(spark, "again")
    t = spark.createDataFrame([(1, new())], "id long, text string")
    h = History.create(spark, folder, 3, 0.5, 30).build(t, spark.createDataFrame([(1, "http://a.example/1")], "id long, url string"))
    first = [(i, f"http://a.example/{i}", new()) for i in range(2, 30)]
    assert all(x.first_id is None for x in h.check(df(first)).collect())
    assert h.s["keys_filtered"] > 500 and len(h.s["filters"]) == 1  # doubled, so made anew
    h.close()
    h = History.open(spark, folder)
    h._save = lambda: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        h.check(df([(50, None, new()), (51, None, first[3][2])]))
    except RuntimeError:
        pass
    h = History.open(spark, folder)
    got = {x.item: x.first_id for x in h.check(df([(60, None, first[3][2]), (61, "http://a.example/9?utm_source=x", None), (62, None, new())])).collect()}
    assert got == {60: 5, 61: 9, 62: None} and len(h.s["layers"]) == 3 and len(h.s["filters"]) == 2


def test_low_thresholds_and_sizes(spark):
    """At t = 0.4 pairs may lie two size bands apart."""
    words = [f"w{i}" for i in range(200)]
    t = spark.createDataFrame([(1, " ".join(words[:35])), (2, " ".join(words[100:190]))], "id long, text string")
    h = History.create(spark, I.scratch_store(spark, "low"), 1, 0.4, 5).build(t, spark.createDataFrame([(1, None)], "id long, url string"))
    got = {x.item: x.first_id for x in h.check(spark.createDataFrame([(5, None, " ".join(words[:85])), (6, None, " ".join(words[:14]))], "id long, url string, text string")).collect()}
    assert got == {5: 1, 6: 1}


def test_rounds_decide_as_one_task(spark):
    """The two ways to decide a batch agree, on chains, hubs and ties."""
    r = random.Random(11)
    rows = []
    for item in range(300):
        hubs = r.sample(range(120), r.randint(0, 3))
        rows += [(item, h, r.random() < 0.7, r.choice([None, None, None, -5, -9])) for h in hubs] or [(item, None, True, None)]
    sees = spark.createDataFrame(rows, "item long, hub long, own boolean, rec long")
    h = History.create(spark, I.scratch_store(spark, "rounds"), 3, 0.5, 30)
    one = sorted(I.decided(sees).collect())
    assert one == sorted(h._in_rounds(sees).collect()) and len(one) == 300 and sum(x.first_id is None for x in one) > 30
