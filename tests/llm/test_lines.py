import random

import numpy as np

from newsloom.llm import lines as L


def test_equal_stretches_have_equal_chunks():
    """Cuts depend on content alone: a text that stands within another has its inner chunks there."""
    a = b"the quick brown fox jumps over the lazy dog and runs away from all of it, " * 4
    h1, _, at, many = L.chunks([a])
    h2 = L.chunks([b"other text before\n" + a + b"x"])[0]
    assert len(at) > 3 and (at + many)[-1] == len(a) and np.isin(h1[1:-1], h2).all()
    assert len(L.chunks([])[0]) == 0 and L.chunks([b"", b"ab", b""])[1].tolist() == [1]


def test_chunks_realign_after_an_edit():
    r = random.Random(1)
    text = bytes(r.randrange(97, 123) for _ in range(4000))
    a, b = L.chunks([text])[0], L.chunks([text[:100] + b"zz" + text[100:]])[0]
    assert len(np.intersect1d(a, b)) > 0.9 * len(a)


def test_normal():
    assert L.normal("  Last\tUpdated 12.3.2024  ") == "last updated #.#.#"


def test_excessive_chunks_are_cut(spark, monkeypatch):
    """Against a count of each text's chunks, through the broadcast and through the join."""
    r = random.Random(6)
    note = "This notice stands on every page of the site, with 12 more words than anybody has ever read in one go."
    rows = [(i, 1 if i < 60 else 2, "\n".join(["".join(r.choice("abcdefgh ") for _ in range(200)), note if i % 3 else "", "tail"])) for i in range(90)] + [(900, 1, ""), (901, 1, "\n\n")]
    docs = spark.createDataFrame(rows, "id long, site long, text string").select("site", "id", "text").repartition(3)
    total, count, own = {}, {}, {}
    for i, s, x in rows:
        h, _, at, many = L.chunks([L.normal_text(x).encode() + b"\n"])
        own[i] = (L.normal_text(x).encode() + b"\n", h.tolist(), at.tolist(), many.tolist())
        total[s] = total.get(s, 0) + 1
        for k in set(h.tolist()):
            count[s, k] = count.get((s, k), 0) + 1
    want = {}
    for i, s, _ in rows:
        raw, h, at, many = own[i]
        bad = [count[s, k] >= 5 and count[s, k] >= 0.1 * total[s] for k in h]
        want[i] = (b"".join(raw[a : a + n] for a, n, k in zip(at, many, bad) if not k).decode().removesuffix("\n"), len(h), sum(bad))
    for most in (L.MOST_KEYS, 0):
        monkeypatch.setattr(L, "MOST_KEYS", most)
        got = {x.id: (x.content, x.chunks, x.cut) for x in L.without_chunks(docs, "lc").collect()}
        assert got == want and any(v[2] > 1 for v in want.values())
    lines = spark.createDataFrame([(1, L.normal(note)), (2, "tail")], "site long, line string")
    by_join = sorted(L.without_lines(docs, lines, "lc").collect())
    monkeypatch.setattr(L, "MOST_KEYS", 1000)
    assert by_join == sorted(L.without_lines(docs, lines, "lc").collect())


def test_against_brute_force(spark):
    r = random.Random(2)
    notes = ["Print this page", "12 comments", "FOLLOW us daily", "x"]
    rows, sites = [], []
    for i in range(120):
        body = ["body " + "".join(r.choice("abcdefgh") for _ in range(30)) for _ in range(3)] + [n for n in notes if r.random() < 0.3] + [""]
        rows.append((i, "\n".join(body)))
        sites.append((i, 1 if i < 80 else 2 + i % 30))
    rows += [rows[3], (500, None), (None, "Print this page"), (501, ""), (502, "Print this page\n" * 20_000)]
    sites += [(501, 1), (502, 1), (500, 1)]
    docs = spark.createDataFrame([(i, x, 0) for i, x in rows], "id long, text string, site int")
    d = L.with_sites(docs, spark.createDataFrame(sites, "id long, site long"), "lines")
    hot = L.repeated_lines(d, 'lt')
    got = {(x.site, x.line) for x in hot.collect()}
    of, count, total = dict(sites), {}, {}
    for i, x in {i: x for i, x in rows if i is not None and x is not None}.items():
        total[of[i]] = total.get(of[i], 0) + 1
        for line in {L.normal(y) for y in x.split("\n")} - {""}:
            count[of[i], line] = count.get((of[i], line), 0) + 1
    assert got == {k for k, n in count.items() if n >= 5 and n >= 0.1 * total[k[0]]} and got
    clean = {x.id: x.content for x in L.without_lines(d, hot, 'lt').collect()}
    assert "Print this page" not in clean[502] and "body " in clean[3] and len(clean) == 122
    assert L.repeated_lines(d.limit(0), 'lt').count() == 0
