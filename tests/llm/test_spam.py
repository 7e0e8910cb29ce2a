import random

import pytest

from newsloom.llm import spam as S


@pytest.fixture(scope="module")
def world(spark):
    r = random.Random(1)
    sub, verb, obj, adv = ["the council", "a bakery", "the museum", "local farmers", "the port"], ["opened", "rejected", "praised", "bought", "delayed"], ["a new bridge", "the old tram", "two ferries", "the budget", "the roof"], ["on monday", "near the river", "after the vote", "without comment"]
    sent = lambda: f"{r.choice(sub)} {r.choice(verb)} {r.choice(obj)} {r.choice(adv)} in town{r.randint(0, 400)}.".capitalize()
    good = [" ".join(sent() for _ in range(r.randint(3, 15))) for _ in range(400)]
    key = ["dog bed", "rain boots", "car lease"]
    bad = []
    for i in range(40):
        k = r.choice(key)
        bad.append([
            ", ".join(f"{k} town{r.randint(0, 400)}" for _ in range(30)),
            " ".join(r.choice(["cheap", "best", *key]) for _ in range(80)),
            "\n".join(f'<a href="http://s{r.randint(0, 99)}.test/{j}">{k}</a>' for j in range(20)),
            f"Looking for {k}? Our {k} shop has every {k} you need. Order {k} today: {k}, more {k} and {k} reviews. Why {k}? {k} saves money and {k} lasts.",
            " ".join(f"#{k.title().replace(' ', '')}{j}" for j in range(20)),
        ][i % 5])
    hard = ["\n".join(f"0{h}:{r.randint(10, 59)} {sent()[:-1]}" for h in range(9)), "\n".join(f"Town{r.randint(0, 400)} (A): {r.randint(100, 999)}, {r.randint(1, 99)}.5%" for _ in range(20)), " ".join(sent() + f" http://t{j}.example/{j}" for j in range(5)), " ".join(sent() for _ in range(6)) + " #news #town"]
    docs = [(i, x) for i, x in enumerate(good + bad + hard)]
    df = spark.createDataFrame([(i, x, "s") for i, x in docs], "id long, text string, spam string")
    return df, S.corpus_counts(df), len(good), len(bad)


def test_spam_is_found_and_news_is_not(world):
    df, counts, good, bad = world
    got = {r.id for r in S.scored(df, counts).where("spam > 0.5").collect()}
    assert got == set(range(good, good + bad))


def test_quick_look_misses_nothing(world):
    df, counts, _, _ = world
    texts = [r.text for r in df.collect()]
    full = [S.spam_share(x, counts)[0] > 0.5 for x in texts]
    words = [S.word_hashes(x) for x in texts]
    _, salad, terms = S.quick_look(words, counts)
    most = [S.most_covered(x, w, terms[k], 0.5) if k in terms else 0.0 for k, (x, w) in enumerate(zip(texts, words))]
    assert not [x for x, f, o, m in zip(texts, full, salad, most) if f and not o and m <= 0.5 and "#" not in x and not S._MAY_LINK.search(x)]
    assert {r.id for r in S.scored(df, counts, 0.5).where("spam > 0.5").collect()} == {k for k, f in enumerate(full) if f}


def test_spans_by_table_are_those_of_the_pattern():
    """Over every character there is, alone and mixed; the bound counts visible characters as the rule does."""
    r = random.Random(2)
    every = "".join(map(chr, range(0x110000)))
    texts = [every[:0x30000], every, "", "_", "a", " a_b\u00a0\u3000c\u0301\u00b2 "] + ["".join(r.choice(every[: r.choice([0x80, 0x800, 0x30000, 0x110000])]) for _ in range(200)) for _ in range(100)]
    for x in texts:
        assert [tuple(s) for s in S.word_spans(x).tolist()] == [m.span() for m in S.WORD.finditer(x)]
        assert S.visible(x)[-1] == len("".join(x.split()))
        a, z = sorted(r.randint(0, len(x)) for _ in range(2))
        assert S.visible(x)[z] - S.visible(x)[a] == len("".join(x[a:z].split()))


def test_words_read_side_by_side_are_those_of_the_pattern(monkeypatch):
    """Whatever the texts are cut at: their words, places and visible characters; a word has one hash, and no other word has it."""
    r = random.Random(4)
    texts = [None, "", "  ", "!?", "x" * 5000, "\u0130stanbul \u0130zmir", "\u0391\u03a3:\u0392 \u0391\u03a3", "a\U00030000b \U0010ffff c", "ab ba aab aba baa \u00b2"]
    texts += [" ".join(r.choice(["ab", "ba", "\u00e9t\u00e9", "Stra\u00dfe", "\u65e5\u672c", "1,5", "\u00a0", "_", "e\u0301"]) + str(r.randint(0, 99)) for _ in range(r.randint(1, 60))) for _ in range(200)]
    named = {}
    for at_once in (1, 500, 1 << 20):
        monkeypatch.setattr(S, "AT_ONCE", at_once)
        seen = []
        for rows, words, spans, chars in S.read(texts):
            spans = iter(spans.tolist())
            for i, w, n in zip(rows.tolist(), words, chars.tolist()):
                low = texts[i].lower()
                assert [next(spans) for _ in w] == [list(m.span()) for m in S.WORD.finditer(low)]
                assert all(named.setdefault(x, h) == h for x, h in zip(S.WORD.findall(low), w.tolist())) and S.word_hashes(texts[i]).tolist() == w.tolist()
                assert n == (len("".join(texts[i].split())) if len(low) == len(texts[i]) else 0)
                seen.append(i)
            assert next(spans, None) is None
        assert seen == [i for i, x in enumerate(texts) if x and S.WORD.search(x)]
    assert len(set(named.values())) == len(named) > 500


def test_shares_by_arrays_are_those_of_the_rule(spark, monkeypatch):
    """Keywords in sentences, lists and across their ends, with links, tags, digits, and capitals whose lower case is longer."""
    r = random.Random(5)
    term = ["dog bed", "loan", "Rain  Boots", "loan\nloan", "car. lease", "5 loans", "x loan", "\u0130zmir villa", "2024 2024"]
    other = [f"word{k}" for k in range(300)] + ["http://a.test/b", "www.shop.test", "#LoanNow", "<a href='u'>dog bed</a>", "[loan](http://b.test)", "e.g.x", "\u65e5\u672c", "\u00b2"]
    ends = [" ", " ", " ", ", ", ". ", "!\u201d ", "\n", "\n\n", " | ", " - ", "\u2026", "; ", "\u00a0", "?!"]
    texts = []
    for _ in range(400):
        own, often = r.sample(term, 3), r.random() ** 2
        texts.append("".join((r.choice(own) if r.random() < often else r.choice(other)) + r.choice(ends[: r.randint(1, len(ends))]) for _ in range(r.randint(1, 90))))
    texts += [" ".join(f"word{r.randint(0, 299)}" for _ in range(60)) for _ in range(300)]
    assert all(S.may_link(x) == bool(S._MAY_LINK.search(x)) for x in [*texts, "a.\u017f\u0131", "a.\u0130s", "WWW.", "<A b", "[URL", "x://", "a.b", "a. bc", "\u00e9.bc", "1.23"])
    counts = S.corpus_counts(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))
    words = [S.word_hashes(x) for x in texts]
    for method in (False, True):
        mean, _, terms = S.quick_look(words, counts, not method)
        want = [S.spam_share(x, counts, True, method, False) for x in texts]
        with monkeypatch.context() as m:
            m.setattr(S, "keywords", None)  # the pattern's way is not needed, save where lower case is longer
            got = [S.share_by_arrays(x, words[k], terms.get(k), counts, method, float(mean[k])) if len(x.lower()) == len(x) else None for k, x in enumerate(texts)]
        got = [S.share_by_arrays(x, words[k], terms.get(k), counts, method, float(mean[k])) if g is None else g for k, (x, g) in enumerate(zip(texts, got))]
        assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want))
        assert 20 < sum(w[0] > 0.5 for w in want) < 400 and len({w[0] for w in want}) > 50


def test_scored_is_the_rule_on_every_row(spark):
    """A stuffed keyword in a third of the corpus, one that comes only twice, and salad among words of high PMI."""
    r = random.Random(3)
    fill = lambda n: " ".join(f"name{r.randint(0, 3000)}" for _ in range(n))
    texts = [f"The council of {fill(12)} met. Nobody from {fill(9)} came." for _ in range(200)]
    texts += [". ".join(f"Loan {fill(1)} loans{i % 2} loan {fill(1)}" for _ in range(12)) for i in range(120)]
    vocabulary = [f"word{k}" for k in range(40)]
    texts += [" ".join(f"{a} {b}" for a, b in zip(vocabulary, vocabulary[1:])) for _ in range(600)]
    texts += [" ".join(r.choice(vocabulary) for _ in range(12)) + ". " + " ".join(f"only{i}x{k}" for k in range(60)) for i in range(8)]
    texts += [f"Cheap loan or loan {fill(2)}.", "", "word", "\u0391\u03a3:\u0392 \u0391\u03a3:\u0392"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    counts = S.corpus_counts(df)
    got = {x.id: x.spam for x in S.scored(df, counts).collect()}
    want = {i: S.spam_share(x, counts)[0] for i, x in enumerate(texts)}
    assert got == want and min(sum(want[i] > 0 for i in part) for part in (range(200, 320), range(920, 928), range(928, 929))) > 0


def test_edges(spark, world):
    _, counts, _, _ = world
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (4, "dog bed " * 30_000), (None, "x"), (5, "  \n\n ")], "id long, text string")
    got = {r.id: r.spam for r in S.scored(df, counts).collect()}
    assert set(got) == {2, 3, 4, 5} and got[4] > 0.9 and got[2] == got[3] == got[5] == 0
    assert S.scored(df.limit(0), counts).count() == 0 and S.corpus_counts(df.limit(0)).flat.sum() == 0


def test_counts_are_exact_and_terms_may_be_joined(spark, world, monkeypatch):
    """Stuffed terms against a count of every word and pair; with no room to broadcast them the result is the same."""
    df, counts, _, _ = world
    n, d = {}, {}
    for r in df.collect():
        h, times = S.term_runs([S.word_hashes(r.text)])
        for k, t in zip(h.tolist(), times.tolist()):
            n[k], d[k] = n.get(k, 0) + t, d.get(k, 0) + 1
    assert counts.known == {k: n[k] for k in n if n[k] >= S.BURST * d[k]} and len(counts.known) > 5
    rounded = lambda x: sorted((r.id, r.spam, r.links, round(r.pmi, 9)) for r in x.collect())
    want = rounded(S.scored(df, counts))
    monkeypatch.setattr(S, "MOST_TERMS", 0)
    joined = S.corpus_counts(df, "joined")
    assert joined.table is not None and rounded(S.scored(df, joined)) == want


def test_the_method_alone(world):
    """Repeated collocations are flagged without single words, links or tags; word salad by its mean PMI; news by neither."""
    df, counts, good, bad = world
    got = {r.id: r for r in S.measured(df, counts).collect()}
    assert {i for i, r in got.items() if r.stuffed > 0.5} == {r.id for r in S.measured(df, counts, 0.5).where("stuffed > 0.5").collect()}
    kinds = [sum(got[good + i].stuffed > 0.5 for i in range(k, bad, 5)) for k in range(5)]
    assert kinds[0] == kinds[3] == 8 and kinds[4] == 0 and not any(got[i].stuffed > 0.5 for i in range(good))
    assert sum(got[i].pmi for i in range(good)) / good > 1
