"""Languages of documents and of their stretches: a linear-chain conditional random field over words.

Each word emits a score for each language: the sum of the learned weights of its features (the word
itself, prefixes and suffixes, letter n-grams, script, and the languages in whose lexicon it is), looked up by hash. The
lexicon of a language holds the words of its training texts that come there again and again and hardly elsewhere. Learned transitions join
neighbours, with one matrix inside a sentence, one at a sentence's end and one at a line's end, so
code-switched text is cut where the evidence says. Forward-backward gives each word's posterior.

Training: labelled sentences, at most ``MOST_SAMPLES`` of which are taken, as many of each language, by hash; strung together
at random so that languages switch at sentence and line ends; maximum likelihood by AdaGrad on
mini-batches, fixed seed. Labelling: texts of a batch are sorted by length and run side by side
through the recursions; texts of any length are labelled whole.

Texts are read through ``mojibake`` first, so garbled text counts for the language it was written in.
Cases: null, empty and letterless texts have no language; ties go to the language first in the
alphabet; unknown languages are given the nearest known one, with a low confidence.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.iso639 import language
from newsloom.llm import mojibake
from newsloom.runtime import ship

MOST_SAMPLES = 20_000
LEXICON_TIMES, LEXICON_SHARE = 3, 0.9
SIZE = 1 << 17
TOKEN = re.compile(r"[^\W\d_]+|[.!?…]+|\n")
SENTENCE, LINE = 1, 2


@lru_cache(maxsize=200_000)
def features(word: str) -> list[int]:
    """Hashed features of a word; the first is the word itself. Callers don't change the list."""
    w = word.lower()
    p = "<" + w + ">"
    out = ["w" + w, "s" + script(w)]
    out += ["p" + w[:k] for k in (1, 2, 3)] + ["e" + w[-k:] for k in (1, 2, 3, 4)]
    out += [p[i : i + k] for k in (2, 3) for i in range(len(p) - k + 1)]
    out += [c for c in set(w) if c > "\x7f"]
    return [zlib.crc32(x.encode()) % SIZE for x in out]


def in_lexicon(word: str, lexicon: dict[str, str]) -> list[int]:
    """The feature of the language in whose lexicon a word is, if any."""
    lang = lexicon.get(word.lower())
    return [zlib.crc32(f"lexicon {lang}".encode()) % SIZE] if lang else []


def script(w: str) -> str:
    c = w[0]
    return "cyr" if "Ѐ" <= c <= "ӿ" else "lat" if c < "ɐ" else "grk" if "Ͱ" <= c <= "Ͽ" else "oth"


def words_of(text: str) -> tuple[list[str], list[int]]:
    """Words, and what lies before each: 0 the same sentence, 1 a sentence's end, 2 a line's end."""
    words, gaps, gap = [], [], LINE
    for x in TOKEN.findall(text):
        if x == "\n":
            gap = LINE
        elif x[0] in ".!?…":
            gap = max(gap, SENTENCE)
        else:
            words.append(x), gaps.append(gap)
            gap = 0
    return words, gaps


def lexicon_of(samples: list[tuple[str, str]]) -> dict[str, str]:
    """word -> language, of words that come LEXICON_TIMES or more in the samples, nearly always in one language."""
    n: dict[str, dict[str, int]] = {}
    for lang, text in samples:
        for w in words_of(text)[0]:
            by = n.setdefault(w.lower(), {})
            by[lang] = by.get(lang, 0) + 1
    out = {}
    for w, by in n.items():
        lang = max(sorted(by), key=by.__getitem__)
        if by[lang] >= LEXICON_TIMES and by[lang] >= LEXICON_SHARE * sum(by.values()):
            out[w] = lang
    return out


def balanced(samples: list[tuple[str, str]], most: int) -> list[tuple[str, str]]:
    """At most ``most`` samples, as many of each language as that leaves room for, chosen by hash: no language is lost."""
    langs = sorted({x for x, _ in samples})
    each = max(1, most // max(1, len(langs)))
    out = []
    for lang in langs:
        own = sorted({x for x in samples if x[0] == lang}, key=lambda x: (zlib.crc32(x[1].encode("utf_8", "surrogatepass")), x[1]))
        many = [x for x in samples if x[0] == lang]
        out += many if len(many) <= each else own[:each]
    return sorted(out)


class Tagger:
    """Weights of the emissions (SIZE x languages) and of the three transition matrices, and the lexicon."""

    def __init__(self, langs: list[str], weights: np.ndarray, trans: np.ndarray, lexicon: dict[str, str] | None = None):
        self.langs, self.weights, self.trans, self.lexicon = langs, weights, trans, lexicon or {}
        self.memo: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row for each word; rows of words met before come from a bounded memo."""
        if len(self.memo) > 150_000:
            self.memo, self.rows = {}, []
        memo = self.memo
        new = [w for w in words if w not in memo]
        for w in dict.fromkeys(new):
            memo[w] = len(self.rows)
            f = features(w) + in_lexicon(w, self.lexicon)
            self.rows.append(self.weights[f].sum(axis=0) / np.sqrt(len(f)))
        if new or not hasattr(self, "_m"):
            self._m = np.array(self.rows, np.float32).reshape(-1, len(self.langs))
        return self._m[np.fromiter(map(memo.__getitem__, words), np.int64, len(words))]

    def posteriors(self, texts: list[tuple[list[str], list[int]]]) -> list[np.ndarray]:
        """(words x languages) of each text, by forward-backward over many texts at once."""
        k = len(self.langs)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i][0]))
        out: list[np.ndarray] = [np.empty((0, k), np.float32)] * len(texts)
        every = [w for i in order for w in texts[i][0]]
        e = self.emissions(every) if every else np.empty((0, k), np.float32)
        e = np.exp(e - e.max(axis=1, keepdims=True)) + 1e-12 if len(e) else e
        t = np.exp(self.trans - self.trans.max()).astype(np.float32)
        at, lo = 0, 0
        while lo < len(order):
            # a block holds at most some 400,000 cells, or one text
            hi, longest = lo, 0
            while hi < len(order):
                n = len(texts[order[hi]][0])
                if hi > lo and max(longest, n) * (hi - lo + 1) > 400_000:
                    break
                longest, hi = max(longest, n), hi + 1
            some = order[lo:hi]
            lo = hi
            if not longest:
                continue
            b = len(some)
            em, gap = np.ones((longest, b, k), np.float32), np.zeros((longest, b), np.int8)
            size = np.array([len(texts[i][0]) for i in some])
            for j, i in enumerate(some):
                n = size[j]
                em[:n, j] = e[at : at + n]
                gap[:n, j] = texts[i][1]
                at += n
            alpha, beta = np.ones_like(em), np.ones_like(em)
            a = em[0] / em[0].sum(axis=1, keepdims=True)
            alpha[0] = a
            live = [np.flatnonzero(size > s)[0] if (size > s).any() else b for s in range(longest)]
            for s in range(1, longest):
                f = live[s]
                x = alpha[s - 1, f:]
                g = gap[s, f:]
                m = np.where((g == 0)[:, None], x @ t[0], np.where((g == 1)[:, None], x @ t[1], x @ t[2])) * em[s, f:]
                alpha[s, f:] = m / m.sum(axis=1, keepdims=True)
            for s in range(longest - 2, -1, -1):
                f = live[s + 1]
                x = beta[s + 1, f:] * em[s + 1, f:]
                g = gap[s + 1, f:]
                m = np.where((g == 0)[:, None], x @ t[0].T, np.where((g == 1)[:, None], x @ t[1].T, x @ t[2].T))
                beta[s, f:] = m / m.sum(axis=1, keepdims=True)
            post = alpha.astype(np.float64) * beta + 1e-30
            post /= post.sum(axis=2, keepdims=True)
            for j, i in enumerate(some):
                out[i] = post[: size[j], j]
        return out


def more_samples(tagger: Tagger, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Lines of labelled documents that bear their label out: a document must read at least 0.8 as
    labelled, and a line that reads surely as another language is left out."""
    out = []
    for lang, text in rows:
        lines = [x for x in text.split("\n") if x.strip()]
        posts = tagger.posteriors([words_of(x) for x in lines])
        at = tagger.langs.index(lang) if lang in tagger.langs else -1
        n = sum(len(p) for p in posts)
        if at < 0 or not n or sum(p[:, at].sum() for p in posts) < 0.8 * n:
            continue
        for x, p in zip(lines, posts):
            if len(p) and (p[:, at].mean() > 0.5 or p.mean(axis=0).max() < 0.9):
                out.append((lang, x))
    return out


def train(samples: list[tuple[str, str]], seed: int = 5, rounds: int = 60, rate: float = 0.35, start: Tagger | None = None) -> Tagger:
    """Fit to (language, text) sentences; from ``start``'s weights if given."""
    samples = balanced(samples, MOST_SAMPLES)
    langs = start.langs if start else sorted({x for x, _ in samples})
    lexicon = lexicon_of(samples)
    k = len(langs)
    rng = np.random.default_rng(seed)
    prepared = []
    for lang, text in samples:
        words, gaps = words_of(text)
        if words:
            prepared.append((langs.index(lang), [np.array(features(w)) for w in words], [np.array(in_lexicon(w, lexicon), np.int64) for w in words], np.array(gaps)))
    weights, trans = (start.weights.astype(np.float64), start.trans.copy()) if start else (np.zeros((SIZE, k)), np.zeros((3, k, k)))
    gw, gt = np.full((SIZE, k), 1e-2), np.full((3, k, k), 1.0)
    for _ in range(rounds):
        order = rng.permutation(len(prepared))
        at = 0
        while at < len(order):
            some = [prepared[i] for i in order[at : at + int(rng.integers(3, 9))]]
            at += len(some)
            some.sort(key=lambda x: x[0] + rng.random() * k)  # some neighbours share a language
            f: list[np.ndarray] = []
            y, g = [], []
            for lang, fs, lex, gaps in some:
                drop = rng.random(len(fs))
                for x, m, dr in zip(fs, lex, drop):  # unknown words: the word itself withheld, and with it the lexicon
                    f.append(x[1:] if dr < 0.3 else np.concatenate([x, m]) if len(m) and dr < 0.8 else x)
                y.append(np.full(len(fs), lang))
                gaps = gaps.copy()
                gaps[0] = rng.choice([SENTENCE, LINE])
                g.append(gaps)
            y, g = np.concatenate(y), np.concatenate(g)
            n = len(f)
            many = np.fromiter(map(len, f), np.int64, n)
            rows, begin, root = np.concatenate(f), np.cumsum(many) - many, np.sqrt(many)
            em = np.add.reduceat(weights[rows], begin, axis=0) / root[:, None]
            e = np.exp(em - em.max(axis=1, keepdims=True))
            t = np.exp(trans)
            steps = t[g]
            a, b = np.empty((n, k)), np.ones((n, k))
            v = e[0]
            a[0] = v / v.sum()
            for s in range(1, n):
                v = a[s - 1] @ steps[s] * e[s]
                a[s] = v / v.sum()
            for s in range(n - 2, -1, -1):
                v = steps[s + 1] @ (e[s + 1] * b[s + 1])
                b[s] = v / v.sum()
            post = a * b
            post /= post.sum(axis=1, keepdims=True)
            grad = -post
            grad[np.arange(n), y] += 1
            pair = a[:-1, :, None] * steps[1:] * (e[1:] * b[1:])[:, None, :]
            pair = -pair / pair.sum(axis=(1, 2), keepdims=True)
            pair[np.arange(n - 1), y[:-1], y[1:]] += 1
            dt = np.stack([pair[g[1:] == j].sum(axis=0) for j in range(3)])
            u, inv = np.unique(rows, return_inverse=True)
            sums = np.zeros((len(u), k))
            np.add.at(sums, inv, np.repeat(grad / root[:, None], many, axis=0))
            sums -= 2e-4 * weights[u]
            gw[u] += sums**2
            weights[u] += rate * sums / np.sqrt(gw[u])
            gt += dt**2
            trans += rate * dt / np.sqrt(gt)
    return Tagger(langs, weights.astype(np.float32), trans, lexicon)


def stretches(text: str, post: np.ndarray, words: list[str], langs: list[str]) -> list[tuple[int, str, int, float]]:
    """(position, language, letters, confidence) of the maximal stretches of one language."""
    out: list[tuple[int, str, int, float]] = []
    if not len(words):
        return out
    best = post.argmax(axis=1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    edge = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1], [True]]))
    for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
        n = int(size[a:z].sum())
        out.append((len(out) + 1, langs[best[a]], n, float((post[a:z, best[a]] * size[a:z]).sum() / n)))
    return out


def tagged(docs: DataFrame, tagger: Tagger, corpus: mojibake.Corpus | None = None) -> DataFrame:
    """(id, letters, stretches) of each text: array of (pos, lang, letters, confidence) in reading order."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((tagger.langs, tagger.weights, tagger.trans, tagger.lexicon))
    tables = None if corpus is None else spark.sparkContext.broadcast((corpus.w, corpus.t))
    item = pa.struct([("pos", pa.int32()), ("lang", pa.string()), ("letters", pa.int64()), ("confidence", pa.float64())])

    def run(batches):
        own = Tagger(*model.value)
        langs = own.langs
        known = mojibake.known(tables) if tables else None
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                b = whole.slice(lo, 2000)
                texts = b.column(1).to_pylist()
                if known is not None:
                    texts = [x if x.isascii() and "&" not in x else mojibake.restore(x, known) for x in texts]
                split = [words_of(x) for x in texts]
                post = own.posteriors(split)
                got = [stretches(x, p, s[0], langs) for x, p, s in zip(texts, post, split)]
                rows = [[{"pos": a, "lang": l, "letters": n, "confidence": c} for a, l, n, c in g] for g in got]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sum(x[2] for x in g) for g in got], pa.int64()), pa.array(rows, pa.list_(item))], ["id", "letters", "stretches"])

    src = docs.where(F.col("text").isNotNull() & F.col("id").isNotNull()).select("id", "text")
    return src.mapInArrow(run, "id long, letters long, stretches array<struct<pos:int,lang:string,letters:long,confidence:double>>")


def fitted(samples: DataFrame, docs: DataFrame, labels: DataFrame, each: int = 80) -> Tagger:
    """Fit to clean sentences (lang, text), then to at most ``each`` labelled documents of each language
    (a bounded sample, chosen by hash of the id; ``labels`` has id and lang)."""
    langs = samples.where("lang is not null").select("lang").distinct().count()
    first_of = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    few = samples.select("lang", "text").where("lang is not null and text is not null").withColumn("k", F.row_number().over(first_of)).where(F.col("k") <= max(1, MOST_SAMPLES // max(1, langs)))
    clean = sorted((r.lang, r.text) for r in few.select("lang", "text").collect())
    if not clean:
        raise ValueError("no labelled sentence to learn from")
    first = train(clean)
    by = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    some = labels.where(F.col("lang").isin(*first.langs)).distinct().withColumn("k", F.row_number().over(by)).where(F.col("k") <= each).select("id", "lang")
    rows = docs.where("text is not null").join(F.broadcast(some), "id").select("lang", "id", "text").distinct().collect()  # at most ``each`` of a language
    return train(clean * 3 + more_samples(first, sorted((r.lang, r.text) for r in rows)), rounds=2, start=first)


def shares(tags: DataFrame, least: float = 0.2) -> DataFrame:
    """(id, letters, langs): the languages that at least ``least`` of a text's letters belong to, each
    with its share and mean confidence; worked out inside the row, without a shuffle."""
    names = F.array_distinct(F.transform("stretches", lambda s: s["lang"]))

    def total(lang: Column, field) -> Column:
        return F.aggregate(F.filter("stretches", lambda s: s["lang"] == lang), F.lit(0.0), lambda acc, s: acc + field(s))

    each = F.transform(names, lambda n: F.struct(n.alias("lang"), total(n, lambda s: s["letters"].cast("double")).alias("letters"), total(n, lambda s: s["letters"] * s["confidence"]).alias("weight")))
    each = F.transform(each, lambda x: F.struct(x["lang"].alias("lang"), (x["letters"] / F.col("letters")).alias("share"), (x["weight"] / x["letters"]).alias("confidence")))
    return tags.select("id", "letters", F.sort_array(F.filter(each, lambda x: x["share"] >= least - 1e-12)).alias("langs"))


def with_named(df: DataFrame, label: str, out: str) -> DataFrame:
    """df with the ISO 639-3 code that a label names as ``out``, else null."""
    return df.withColumn(out, language(F.col(label)))
