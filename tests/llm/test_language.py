import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import language as X
from tests.conftest import DATA


@pytest.fixture(scope="module")
def samples(spark):
    return sorted((r.lang_iso, r.text) for r in spark.read.parquet(f"{DATA}/lang_sample.parquet").collect())


@pytest.fixture(scope="module")
def tagger(samples):
    return X.train([s for i, s in enumerate(samples) if i % 4])


def test_held_out_sentences(samples, tagger):
    out = [s for i, s in enumerate(samples) if i % 4 == 0]
    split = [X.words_of(t) for _, t in out]
    post = tagger.posteriors(split)
    ok = sum(tagger.langs[p.mean(axis=0).argmax()] == lang for (lang, _), p in zip(out, post))
    assert ok / len(out) >= 0.9


def test_code_switched_words(samples, tagger):
    r = random.Random(3)
    out = [s for i, s in enumerate(samples) if i % 4 == 0]
    right = total = 0
    for _ in range(40):
        (la, a), (lb, b) = r.sample(out, 2)
        words, gaps = X.words_of(a + "\n" + b)
        cut = len(X.words_of(a)[0])
        best = tagger.posteriors([(words, gaps)])[0].argmax(axis=1)
        right += sum(tagger.langs[k] == (la if i < cut else lb) for i, k in enumerate(best))
        total += len(words)
    assert right / total >= 0.9


def test_posteriors_do_not_depend_on_the_batch(samples, tagger):
    split = [X.words_of(t) for _, t in samples[:12]] + [([], []), X.words_of("x " * 3000)]
    for s, p in zip(split, tagger.posteriors(split)):
        alone = tagger.posteriors([s])[0]
        assert p.shape == alone.shape and np.allclose(p, alone, atol=1e-4) and (not len(p) or np.allclose(p.sum(axis=1), 1, atol=1e-4))


def test_frame(spark, samples, tagger):
    eng, rus = (next(t for lang, t in samples if lang == x) for x in ("eng", "rus"))
    rows = [(1, eng, "a"), (2, eng + "\n" + rus + "\n" + rus, "b"), (3, None, "c"), (4, "", "d"), (5, "123 !!", "e"), (None, eng, "f"), (6, eng * 500, "g")]
    df = spark.createDataFrame(rows, "id long, text string, letters string")
    got = {r.id: [x.lang for x in r.langs] for r in X.shares(X.tagged(df, tagger)).collect()}
    assert got == {1: ["eng"], 2: ["eng", "rus"], 4: [], 5: [], 6: ["eng"]}
    assert X.tagged(df.limit(0), tagger).count() == 0


def test_labels(spark):
    rows = [("en", "eng"), ("EN-us", "eng"), ("ger", "deu"), ("DEU", "deu"), ("sl_SI", "slv"), ("und", None), ("", None), ("xx", None), ("n/a", None), ("default", None), (None, None), ("ita", "ita"), (" fr ", "fra"), ("uz", "uzb"), ("ta", "tam"), ("az-AZ", "aze"), ("nan", "nan")]
    got = X.with_named(spark.createDataFrame([(a,) for a, _ in rows], "label string"), "label", "out")
    assert {r.label: r.out for r in got.collect()} == dict(rows)
    assert X.with_named(spark.createDataFrame([("en", 1)], "label string, n int").select("label"), "label", "out").select(F.col("out")).first().out == "eng"


def test_no_language_is_lost_at_the_bound(monkeypatch, samples):
    many = [(lang, f"{text} {i}") for lang, text in samples for i in range(5)]
    got = X.balanced(many, 70)
    assert {x for x, _ in got} == {x for x, _ in samples} and len(got) <= 70 and X.balanced(samples, 20_000) == sorted(samples)


def test_lexicon(samples):
    lex = X.lexicon_of(samples * 3)
    assert lex.get("und") in (None, "deu") and sum(v == "rus" for v in lex.values()) > 20 and X.in_lexicon("zzzz", lex) == []
    tagger = X.train(samples, rounds=5)
    assert tagger.lexicon == X.lexicon_of(samples)
