"""Keyword-stuffed and link-list documents, by corpus statistics of neighbouring words.

*Terms.* A word or a pair of neighbours is counted exactly: occurrences, and documents that have it. One pass emits the
terms that come twice or more in a document, summed in each task; only of those that come BURST times or more wherever
they recur, a second pass counts the documents that have them once. A stuffed term comes BURST times or more in every
document that has it, on average over the whole corpus; their number is that of what spammers sell, and is counted
before they are broadcast.

*Neighbours.* Beside them, count-min tables of fixed size hold all words and pairs. They give the pointwise mutual
information (PMI) of neighbours, log p(ab) / p(a)p(b): the mean over a document, and over each unit. With more kinds of
pairs than cells the tables overestimate pairs, so PMI: units of word salad may then be missed, stuffed terms never are.

*Keywords* of a document: stuffed terms that recur there within one sentence or over many short entries, are RATE times
as frequent there as in the corpus, and, for a pair, are a collocation (PMI above COLLOCATION).

*Units.* A document is cut into sentences and lines. A unit is spam if keywords, links and tags cover COVER of its
characters, or if it is word salad: many known words whose mean PMI is below SALAD. A document is spam if spam units,
links and tags make up more than half of its characters. ``measured`` is the method alone: repeated collocations and salad,
without single words, links and tags, which are a rule beside it.

Cases: null or empty text -> no spam; tables, schedules, recipes and lists have no keyword that
recurs; repeated rows give equal results; very long texts are read whole; an empty corpus has no stuffed term.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import sketch
from newsloom.llm.words import WORD, mix
from newsloom.runtime import ship, written

SINGLE, PAIR, ROWS, PIECES = 1 << 19, 1 << 20, 2, 16
AT_ONCE = 1 << 20  # characters whose words are read side by side (a longer text alone)
MOST_TERMS = 1_000_000  # stuffed terms (24 bytes each) that are broadcast
BURST, COLLOCATION, COVER, SALAD, RATE = 4.0, 1.0, 0.22, -1.0, 2.5
KNOWN, SALAD_PAIRS = 5, 6
LINK = re.compile(
    r"<a\s[^>]*>.*?</a\s*>|\[url[^\]]*\].*?\[/url\]|\[[^\]\n]*\]\(\s*https?://[^)\s]*\)|(?:https?://|www\.)\S+|\b(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/\S*)?(?=[\s,;|)]|$)",
    re.I | re.S,
)
_MAY_LINK = re.compile(r"://|www\.|<a\s|\[url|[a-z0-9]\.[a-z]{2}", re.I)
_DOT = re.compile(r"\.[^\W\d_]")
TAG = re.compile(r"(?<!\w)#[^\W\d_]\w*")
UNIT = re.compile(r"[^\n.!?…]+[.!?…]*(?:[»”\"’“)\]]*(?=\s|$))?|[.!?…]+")
ENTRY = re.compile(r"[,;|·•\n:!?–—>*/\t]+|\s-\s")
_SENT = re.compile(r"(?<=[.!?…])[»”\"’“]*\s+|\n+")


def pair_hashes(w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(w[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (w[1:] >> np.uint64(3)))


def among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among sorted ones; a table of their low bits lets most others go before the search."""
    out = np.zeros(len(h), bool)
    if not len(known):
        return out
    may = np.arange(len(h))
    if len(h) > len(known):
        low = (1 << min(22, (16 * len(known)).bit_length())) - 1
        table = np.zeros(low + 1, bool)
        table[known.view(np.int64) & low] = True
        may = np.flatnonzero(table.take(h.view(np.int64) & low))
    at = np.searchsorted(known, h[may])
    at[at == len(known)] = 0
    out[may] = known[at] == h[may]
    return out


_TABLED = 0x40000  # characters whose kinds are looked up in a table; no letter, digit or space lies beyond
_KINDS: list[np.ndarray] = []
_BASE, _SHORT = np.uint64(0xD1342543DE82EF95), 1 << 12


def _kinds() -> list[np.ndarray]:
    """Whether a character belongs to words, whether it is a space, its hash, and the powers of _BASE for words up to _SHORT;
    made once in a worker."""
    if not _KINDS:
        some = [chr(i) for i in range(_TABLED)]
        _KINDS.extend(np.fromiter(map(f, some), bool, _TABLED) for f in (str.isalnum, str.isspace))
        _KINDS.append(mix(np.arange(1, _TABLED + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        _KINDS.append(np.cumprod(np.full(_SHORT, _BASE)))
    return _KINDS


def _codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(c, _TABLED - 1) if c.max(initial=0) >= _TABLED else c


def _spans(c: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(c) + 2, bool)
    inside[1:-1] = _kinds()[0][c]
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def _hashes(c: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Hashes of words: the characters' hashes times powers by their place, summed."""
    if not len(spans):
        return np.empty(0, np.uint64)
    size = spans[:, 1] - spans[:, 0]
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
    inside, _, own, powers = _kinds()
    longest = int(size.max())
    with np.errstate(over="ignore"):
        powers = powers if longest <= _SHORT else np.cumprod(np.full(longest, _BASE))
        return mix(np.add.reduceat(own[c[inside[c]]] * powers[place], first))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words in order."""
    c = _codes(text.lower())
    return _hashes(c, _spans(c))


def read(texts: list):
    """AT_ONCE characters at a time: (rows of the texts that have words, word hashes of each, spans of all their words in the
    lower-cased text, visible characters of each, 0 where the lower case has another length)."""
    some: list[int] = []
    chars = 0
    for i, x in enumerate(texts):
        if x:
            some.append(i)
            chars += len(x)
        if some and (chars >= AT_ONCE or i == len(texts) - 1):
            yield _read(texts, some)
            some, chars = [], 0
    if some:
        yield _read(texts, some)


def _read(texts: list, some: list[int]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    lows = [texts[i].lower() for i in some]
    c = _codes("\n".join(lows))
    start = np.cumsum([0] + [len(x) + 1 for x in lows])
    spans = _spans(c)
    h = _hashes(c, spans)
    at = np.searchsorted(spans[:, 0], start)
    size = np.diff(at)
    same = [len(x) == len(texts[i]) for i, x in zip(some, lows)]
    seen = np.add.reduceat(~_kinds()[1][c], start[:-1], dtype=np.int64) * same  # the line end between two texts is a space
    has = np.flatnonzero(size)
    rows = np.array(some, np.int64)[has]
    return rows, [h[a:z] for a, z in zip(at[has].tolist(), at[has + 1].tolist())], spans - np.repeat(start[:-1], size)[:, None], seen[has]


def word_lists(texts: list) -> list[np.ndarray]:
    """Word hashes of the texts that have words."""
    return [w for _, words, _, _ in read(texts) for w in words]


class Counts:
    """Count-min tables of words (occurrences, documents) and pairs (occurrences), and the stuffed terms with their exact counts."""

    def __init__(self, flat: np.ndarray, docs: int, words: int, terms: np.ndarray | None = None, n: np.ndarray | None = None):
        self.flat, self.docs, self.words = flat, max(1, docs), max(1, words)
        a = ROWS * SINGLE
        self.n1, self.d1, self.n2 = flat[:a].reshape(ROWS, -1), flat[a : 2 * a].reshape(ROWS, -1), flat[2 * a :].reshape(ROWS, -1)
        self.terms = np.empty(0, np.uint64) if terms is None else terms  # sorted
        self.n = np.empty(0, np.int64) if n is None else n
        self.known = dict(zip(self.terms.tolist(), self.n.tolist()))
        self.table: DataFrame | None = None

    @staticmethod
    def _cells(h: np.ndarray, size: int) -> list[np.ndarray]:
        return [((h >> np.uint64(24 * r)) & np.uint64(size - 1)).astype(np.int64) for r in range(ROWS)]

    def single(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self._cells(mix(w), SINGLE)
        return tuple(np.minimum(t[0][at[0]], t[1][at[1]]).astype(np.float64) for t in (self.n1, self.d1))

    def pair(self, p: np.ndarray) -> np.ndarray:
        at = self._cells(p, PAIR)
        return np.minimum(self.n2[0][at[0]], self.n2[1][at[1]]).astype(np.float64)

    def pmi(self, w: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
        """PMI of each word and its right neighbour; ``n``: exact occurrences of the pairs, else estimated."""
        return self.pmi_of(self.single(w)[0], self.pair(pair_hashes(w)) if n is None else n)

    def pmi_of(self, one: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.log((n + 0.1) * self.words / ((one[:-1] + 1) * (one[1:] + 1)))

    def held(self, h: np.ndarray) -> np.ndarray:
        """Which hashes are stuffed terms."""
        return among(h, self.terms)


def runs_of(rows: list[np.ndarray], wanted: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, times) of every word, and of every pair, of each of many texts that have words, one entry for each text that
    has it; ``wanted``: of these (sorted) only."""
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    w = np.concatenate(rows)
    inside = np.ones(max(0, len(w) - 1), bool)
    inside[np.cumsum(size)[:-1] - 1] = False  # a pair never spans two texts
    out = []
    for h, n in ((mix(w), size), (pair_hashes(w)[inside] if len(w) > 1 else w[:0], np.maximum(size - 1, 0))):
        if wanted is not None:
            own = among(h, wanted)
            h, n = h[own], np.bincount(np.repeat(np.arange(len(n)), n)[own], minlength=len(n))
        n = n[n > 0]
        at = np.cumsum(n) - n
        for a, z in zip(at.tolist(), (at + n).tolist()):
            h[a:z].sort()
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        head[at] = True
        first = np.flatnonzero(head)
        out.append((h[first], np.diff(np.append(first, len(h)))))
    return out


def term_runs(rows: list[np.ndarray], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``runs_of``, words and pairs together."""
    return tuple(np.concatenate(x) for x in zip(*runs_of(rows, wanted)))


def _summed_by(h: np.ndarray, *cols: np.ndarray) -> tuple[np.ndarray, ...]:
    o = np.argsort(h, kind="stable")
    h = h[o]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    return (h[first], *(np.add.reduceat(c[o], first) if len(h) else c for c in cols))


_ONE = f"h long, n long, d long, docs long, words long, {sketch.SCHEMA}"


def corpus_counts(docs: DataFrame, owner: str = "spam") -> Counts:
    """Counts over all texts (id, text) in two scans; tables of fixed size and the counted stuffed terms reach the driver."""
    spark = docs.sparkSession
    ship(spark)
    cells = ROWS * (2 * SINGLE + PAIR)
    texts = docs.where(F.col("text").isNotNull()).select("text")

    def first(batches):
        flat = np.zeros(cells, np.uint64)
        n = words = 0
        for b in batches:
            rows = word_lists(b.column(0).to_pylist())
            if not rows:
                continue
            n += len(rows)
            words += sum(map(len, rows))
            one, two = runs_of(rows)
            lo = 0
            for mask, h, times in ((SINGLE, *one), (SINGLE, one[0], None), (PAIR, *two)):
                for cell in Counts._cells(h, mask):
                    flat[lo : lo + mask] += np.bincount(cell, times, mask).astype(np.uint64)  # exact: far below 2^53
                    lo += mask
            h, times = (np.concatenate(x) for x in zip(one, two))
            often = times > 1
            h, total, has = _summed_by(h[often], times[often], np.ones(int(often.sum()), np.int64))
            m = len(h)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(total.astype(np.int64)), pa.array(has), *(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["h", "n", "d", "docs", "words", "task", "chunk", "blob"])
        if n:
            own = sketch.blobs(flat, PIECES)
            first_row = [x + [None] * (PIECES - 1) for x in ([n], [words])]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(PIECES, pa.int64()) for _ in range(3)), *(pa.array(x, pa.int64()) for x in first_row), *own.columns], ["h", "n", "d", "docs", "words", "task", "chunk", "blob"])

    seen = written(texts.mapInArrow(first, _ONE), owner)
    total = seen.agg(F.sum("docs"), F.sum("words")).first()
    flat = sketch.summed(seen.where("chunk is not null").select("task", "chunk", "blob"), PIECES, cells)
    recur = seen.where("h is not null").groupBy("h").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).where(F.col("n") >= BURST * F.col("d"))
    recur = written(recur, owner)
    once = _had_once(texts, recur, spark)
    stuffed = recur.join(once, "h", "left").where(F.col("n") >= BURST * F.col("d") + (BURST - 1) * F.coalesce("s", F.lit(0))).select("h", (F.col("n") + F.coalesce("s", F.lit(0))).alias("n"))
    stuffed = written(stuffed, owner)
    out = Counts(np.minimum(flat, np.iinfo(np.uint32).max).astype(np.uint32), total[0] or 0, total[1] or 0)
    if stuffed.count() > MOST_TERMS:
        out.table = stuffed  # each document's own terms go to it by a join
        return out
    got = stuffed.toArrow()
    h, n = got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy()
    o = np.argsort(h)
    return Counts(out.flat, out.docs, out.words, h[o], n[o])


def _had_once(texts: DataFrame, terms: DataFrame, spark) -> DataFrame:
    """(h, s): documents that have a term of ``terms`` just once. The terms are broadcast if they were counted and are few,
    else every term that comes once goes to them by a shuffle."""
    few = terms.count() <= MOST_TERMS
    wanted = spark.sparkContext.broadcast(np.sort(terms.select("h").toArrow().column("h").to_numpy().view(np.uint64))) if few else None

    def run(batches):
        for b in batches:
            rows = word_lists(b.column(0).to_pylist())
            if not rows:
                continue
            h, times = term_runs(rows, None if wanted is None else wanted.value)
            h = h[times == 1]
            h, s = _summed_by(h, np.ones(len(h), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(s)], ["h", "s"])

    got = texts.mapInArrow(run, "h long, s long")
    return (got if few else got.join(terms.select("h"), "h", "left_semi")).groupBy("h").agg(F.sum("s").alias("s"))


def may_link(text: str) -> bool:
    """Whether ``_MAY_LINK`` finds anything; what each of its forms needs is looked for first."""
    return ("://" in text or "w." in text or "W." in text or "<" in text or "[" in text or _DOT.search(text) is not None) and _MAY_LINK.search(text) is not None


def keywords(text: str, counts: Counts) -> set[tuple[str, ...]]:
    """The stuffed words and pairs of one text."""
    repeats: dict[tuple, int] = {}
    every: dict[tuple, int] = {}
    size = len(word_hashes(text))
    entries: dict[tuple, int] = {}
    for part in _SENT.split(text):
        words = WORD.findall(part.lower())
        if len(words) < 2:
            continue
        here: dict[tuple, int] = {}
        for k, w in enumerate(words):
            if len(w) >= 4 and not w.isdigit():
                here[(w,)] = here.get((w,), 0) + 1
            if k and len(w) > 1 and len(words[k - 1]) > 1 and not (w.isdigit() or words[k - 1].isdigit()):
                t = (words[k - 1], w)
                here[t] = here.get(t, 0) + 1
        for t, n in here.items():
            every[t] = every.get(t, 0) + n
            if n > 1:
                repeats[t] = repeats.get(t, 0) + n
    for part in ENTRY.split(text):
        words = WORD.findall(part.lower())
        if 1 <= len(words) <= 5:
            terms = {(w,) for w in words if len(w) >= 4 and not w.isdigit()} | {(a, b) for a, b in zip(words, words[1:]) if len(a) > 1 and len(b) > 1 and not (a.isdigit() or b.isdigit())}
            for t in terms:
                entries[t] = entries.get(t, 0) + 1
    cand = {t for t, n in repeats.items() if n >= 2} | {t for t, n in entries.items() if n >= 4}
    out = set()
    for t in cand:
        w = word_hashes(" ".join(t))
        if len(w) != len(t):
            continue
        h = mix(w) if len(t) == 1 else pair_hashes(w)
        n = counts.known.get(int(h[0]))
        if n is None:
            continue
        here = max(every.get(t, 0), entries.get(t, 0)) / max(1, size)
        if here >= RATE * n / counts.words and (len(t) == 1 or counts.pmi(w, np.array([n]))[0] > COLLOCATION):
            out.add(t)
    return out


def spam_share(text: str, counts: Counts, often: bool = True, method: bool = False, salad: bool = True) -> tuple[float, float, float]:
    """(share of spam characters, share of links and tags, mean PMI of neighbouring words); ``often``, ``salad``: False where it is
    known that no keyword, no salad is possible. With ``method`` only repeated collocations and salad count as spam, and
    the second share is that of salad."""
    upto = visible(text)
    size = int(upto[-1])
    w = word_hashes(text)
    if not size:
        return 0.0, 0.0, 0.0
    links = [(m.start(), m.end()) for m in LINK.finditer(text)] if not method and may_link(text) else []
    tags = [(m.start(), m.end()) for m in TAG.finditer(text)] if not method and "#" in text else []
    mean = float(counts.pmi(w).mean()) if len(w) > 1 else 0.0
    mark = bytearray(len(text))
    for a, z in links + tags:
        mark[a:z] = b"\x01" * (z - a)
    second = sum(mark)
    keys = keywords(text, counts) if often else set()
    if method:
        keys = {t for t in keys if len(t) == 2}
    spam = bytearray(mark)
    low = text.lower()
    if len(low) != len(text):
        low = text
    for m in UNIT.finditer(text):
        a, z = m.start(), m.end()
        chars = int(upto[z] - upto[a])
        if not chars:
            continue
        covered = sum(mark[a:z])
        if covered < z - a and (keys or salad and len(w) >= 8):
            found = [(x.group(), x.start(), x.end()) for x in WORD.finditer(low, a, z)]
            hit = bytearray(mark[a:z])
            for k, (x, s, e) in enumerate(found):
                if (x,) in keys:
                    hit[s - a : e - a] = b"\x01" * (e - s)
                if k and (found[k - 1][0], x) in keys:
                    hit[found[k - 1][1] - a : e - a] = b"\x01" * (e - found[k - 1][1])
            covered = sum(hit)
            if salad and covered < COVER * chars and len(found) >= 8:
                h = word_hashes(" ".join(x for x, _, _ in found))
                known = counts.single(h)[1] >= KNOWN
                both = known[:-1] & known[1:]
                if both.sum() >= SALAD_PAIRS and counts.pmi(h)[both].mean() < SALAD:
                    covered = chars
                    second += chars if method else 0
        if covered >= COVER * chars:
            spam[a:z] = b"\x01" * (z - a)
    total_spam = int(np.diff(upto)[np.frombuffer(spam, bool)].sum())
    return total_spam / size, second / max(1, size if method else len(text)), mean


def quick_look(words: list[np.ndarray], counts: Counts, singles: bool = True, spans: np.ndarray | None = None, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """(mean PMI, whether a salad unit is possible, the terms that may be keywords by text) of many texts at once; weaker than the rule, so no
    text it lets go has either. A keyword comes twice or more, and RATE times as often as in the corpus. The known pairs of a
    salad unit are SALAD_PAIRS or more in a row among the text's; if so many have a mean below SALAD, fewer than
    twice as many in a row have. With ``spans`` of all words and the ``least`` characters of each text, those texts are let go
    whose terms cover fewer."""
    if not words:
        return np.empty(0), np.empty(0, bool), {}
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.cumsum(size) - size
    w = np.concatenate(words)
    one, docs = counts.single(w)
    pairs = pair_hashes(w)
    p = np.append(counts.pmi_of(one, counts.pair(pairs)), 0.0)
    p[at + size - 1] = 0.0  # the pair that spans two texts
    mean = np.add.reduceat(p, at) / np.maximum(size - 1, 1)
    often = np.zeros(len(words), bool)
    text = np.repeat(np.arange(len(words)), size)
    inside = np.ones(len(w), bool)
    inside[at + size - 1] = False

    room = np.zeros(len(words), np.int64)

    def recurs(h: np.ndarray, k: int) -> None:
        """Keep the stuffed terms, of ``k`` words, that come twice in a text and RATE times as often as in the corpus."""
        at = np.flatnonzero(inside[: len(h)] & counts.held(h)) if k > 1 else np.flatnonzero(counts.held(h))
        if not len(at):
            return
        h, own = h[at], text[at]
        o = np.argsort(h, kind="stable")  # texts stay in order within equal hashes
        h, own, at = h[o], own[o], at[o]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])]))
        if spans is not None:
            long = np.add.reduceat(spans[at + k - 1, 1] - spans[at, 0], first)
        times, h, own = np.diff(np.append(first, len(h))), h[first], own[first]
        n = counts.n[np.searchsorted(counts.terms, h)]
        ok = (times > 1) & (times * float(counts.words) >= RATE * n * size[own] - 1e-6)
        found.append((own[ok], h[ok]))
        if spans is not None:
            np.add.at(room, own[ok], long[ok])

    found: list[tuple[np.ndarray, np.ndarray]] = []
    if singles:
        recurs(mix(w), 1)
    if len(w) > 1:
        recurs(pairs, 2)
        known = docs >= KNOWN
        both = np.flatnonzero(inside[:-1] & known[:-1] & known[1:])
        own, upto = text[both], np.concatenate([[0.0], np.cumsum(p[both] - SALAD)])
        for k in range(SALAD_PAIRS, min(2 * SALAD_PAIRS, len(both) + 1)):
            low = upto[k:] - upto[:-k] < 1e-6
            often[own[k - 1 :][low & (own[k - 1 :] == own[: len(own) - k + 1])]] = True
    terms: dict[int, np.ndarray] = {}
    if found:
        own, h = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        if least is not None:
            ok = room[own] >= least[own]
            own, h = own[ok], h[ok]
        o = np.argsort(own, kind="stable")
        own, h = own[o], h[o]
        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else []
        terms = dict(zip(own[at].tolist(), np.split(h, at[1:]))) if len(own) else {}
    return mean, often, terms


def word_spans(low: str) -> np.ndarray:
    """Where the words of a lower-cased text begin and end, as ``WORD`` finds them."""
    return _spans(_codes(low))


def visible(text: str) -> np.ndarray:
    """How many characters before each place (and before the end) are no spaces."""
    out = np.zeros(len(text) + 1, np.int64)
    np.cumsum(~_kinds()[1][_codes(text)], out=out[1:])
    return out


def most_covered(text: str, w: np.ndarray, terms: np.ndarray, least: float) -> float:
    """An upper bound of the share of a text's characters in units that keywords among ``terms`` cover enough; ``w``: its
    words' hashes. First over the whole text (such units of more than ``least`` need keywords on COVER of that), then by unit."""
    low = text.lower()
    spans = word_spans(low)
    if len(spans) != len(w) or len(low) != len(text):
        return 1.0
    known = np.sort(terms)
    size = len("".join(text.split()))
    one = np.flatnonzero(among(mix(w), known))
    two = np.flatnonzero(among(pair_hashes(w), known)) if len(w) > 1 else one[:0]
    begin, end = np.concatenate([spans[one, 0], spans[two, 0]]), np.concatenate([spans[one, 1], spans[two + 1, 1]])
    if (end - begin).sum() < COVER * least * size:
        return 0.0
    upto, cut = visible(text), [m.span() for m in UNIT.finditer(text)]
    starts = np.array([a for a, _ in cut], np.int64)
    unit = np.searchsorted(starts, begin, side="right") - 1
    covered = np.bincount(unit, end - begin, len(cut))
    share = 0
    for k in np.flatnonzero(covered).tolist():
        chars = int(upto[cut[k][1]] - upto[cut[k][0]])
        share += chars if covered[k] >= COVER * chars else 0
    return share / max(1, size)


def _marked(spans, size: int) -> np.ndarray:
    """Which of so many places lie in any of the spans."""
    at = np.array(spans, np.int64).reshape(-1, 2)
    return np.cumsum(np.bincount(at[:, 0], minlength=size + 1) - np.bincount(at[:, 1], minlength=size + 1))[:-1] > 0


def share_by_arrays(text: str, w: np.ndarray, terms: np.ndarray | None, counts: Counts, method: bool, mean: float) -> tuple[float, float, float]:
    """``spam_share`` of a text in which no salad is possible, all of whose keywords are among ``terms`` (None: there are none),
    with places in arrays; ``w``: its words' hashes, ``mean``: their PMI."""
    low = text.lower()
    spans = word_spans(low)
    if len(low) != len(text) or len(spans) != len(w):
        return spam_share(text, counts, terms is not None, method, False)
    begin, end = spans[:, 0], spans[:, 1]
    upto = visible(text)
    mark = np.zeros(len(text), bool)
    if not method:
        links = LINK.finditer(text) if may_link(text) else ()
        for m in (*links, *(TAG.finditer(text) if "#" in text else ())):
            mark[m.start() : m.end()] = True
    cut = np.array([m.span() for m in UNIT.finditer(text)], np.int64).reshape(-1, 2)
    hits: list[tuple[int, int]] = []
    if terms is not None and len(w) > 1:
        known = np.sort(terms)
        sent, entry = (np.searchsorted(np.array([m.end() for m in r.finditer(text)], np.int64), begin, side="right") for r in (_SENT, ENTRY))
        in_sent, in_entry = np.bincount(sent), np.bincount(entry)
        unit = np.searchsorted(cut[:, 0], begin, side="right") - 1
        for k, h in ((1, mix(w)), (2, pair_hashes(w)))[method:]:
            at = np.flatnonzero(among(h, known))
            last = at + k - 1
            sents = np.where((sent[at] == sent[last]) & (in_sent[sent[at]] > 1), sent[at], -1)
            entries = np.where((entry[at] == entry[last]) & (in_entry[entry[at]] <= 5), entry[at], -1)
            begins = np.where(unit[at] == unit[last], begin[at], end[last])  # else no place at all
            places: dict[int, list[tuple]] = {}
            for t, *place in zip(h[at].tolist(), sents.tolist(), entries.tolist(), begins.tolist(), end[last].tolist(), at.tolist()):
                places.setdefault(t, []).append(place)
            for t, own in places.items():
                i = own[0][4]
                if any(len(x) < (4, 2)[k - 1] or x.isdigit() for x in (low[begin[j] : end[j]] for j in range(i, i + k))):
                    continue
                here, short = Counter(x[0] for x in own if x[0] >= 0), len({x[1] for x in own} - {-1})
                if short < 4 and max(here.values(), default=0) < 2 or (n := counts.known.get(t)) is None:
                    continue
                if max(here.total(), short) / len(w) >= RATE * n / counts.words and (k == 1 or counts.pmi(w[i : i + 2], np.array([n]))[0] > COLLOCATION):
                    hits.extend(x[2:4] for x in own)
    hit = mark | _marked(hits, len(text))
    covered, chars = (x[cut[:, 1]] - x[cut[:, 0]] for x in (np.concatenate([[0], np.cumsum(hit)]), upto))
    spam = mark | _marked(cut[(chars > 0) & (covered >= COVER * chars)], len(text))
    return int(np.diff(upto)[spam].sum()) / int(upto[-1]), int(mark.sum()) / len(text), mean


_OWN: dict[str, Counts] = {}


def known_counts(parts) -> Counts:
    """The counts of a broadcast; made once in a worker."""
    key = str(getattr(parts, "_path", None) or id(parts))
    if key not in _OWN:
        _OWN.clear()
        _OWN[key] = Counts(*parts.value)
    return _OWN[key]


def _each(docs: DataFrame, counts: Counts, method: bool, names: tuple[str, str, str], least: float = 0.0) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    parts = spark.sparkContext.broadcast((counts.flat, counts.docs, counts.words, counts.terms, counts.n))

    def run(batches):
        from newsloom.llm import spam as S

        own = S.known_counts(parts)
        for b in batches:
            texts = b.column(1).to_pylist()
            joined = b.column(2).to_pylist() if b.num_columns > 2 else None
            out = [(0.0, 0.0, 0.0)] * len(texts)
            for rows, words, spans, chars in S.read(texts):
                linked = [not method and ("#" in texts[i] or may_link(texts[i])) for i in rows.tolist()]
                room = np.where(linked, 0.0, COVER * least * chars)
                mean, salad, may = S.quick_look(words, own, not method, spans, room)  # the method knows no single words
                for k, (i, m, mixed) in enumerate(zip(rows.tolist(), mean.tolist(), salad.tolist())):
                    x, terms = texts[i], may.get(k)
                    if joined is not None:
                        own.known = {t["h"] % (1 << 64): t["n"] for t in joined[i] or ()}
                        terms = np.fromiter(own.known, np.uint64, len(own.known)) if own.known else None
                    if terms is not None and least > 0.0 and not linked[k] and S.most_covered(x, words[k], terms, least) <= least:
                        terms = None
                    if mixed or "\u03a3" in x:  # its lower case depends on what follows, so on where a text is cut
                        out[i] = S.spam_share(x, own, True, method, True)
                    else:
                        out[i] = S.share_by_arrays(x, words[k], terms, own, method, m) if terms is not None or linked[k] else (0.0, 0.0, m)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([g[k] for g in out], pa.float64()) for k in range(3))], ["id", *names])

    def recurring(batches):
        for b in batches:
            for rows, words, _, _ in read(b.column(1).to_pylist()):
                for i, w in zip(rows.tolist(), words):
                    h, times = term_runs([w])
                    h = h[times > 1]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i] * len(h), pa.int64())), pa.array(h.view(np.int64))], ["id", "h"])

    src = docs.where(F.col("id").isNotNull() & F.col("text").isNotNull()).select("id", "text")
    if counts.table is not None:  # as many terms as a document has
        own_terms = src.mapInArrow(recurring, "id long, h long").distinct().join(counts.table, "h").groupBy("id").agg(F.collect_list(F.struct("h", "n")).alias("terms"))
        src = src.join(own_terms, "id", "left").select("id", "text", "terms")
    return src.mapInArrow(run, "id long, " + ", ".join(f"{n} double" for n in names))


def scored(docs: DataFrame, counts: Counts, least: float = 0.0) -> DataFrame:
    """(id, spam, links, pmi) of each text. Who only asks which texts have more spam than ``least`` gets 0 for those that
    provably have not, by a bound that is cheaper than the units."""
    return _each(docs, counts, False, ("spam", "links", "pmi"), least)


def measured(docs: DataFrame, counts: Counts, least: float = 0.0) -> DataFrame:
    """(id, stuffed, salad, pmi) of each text by the method alone: share of its characters in units that repeated collocations
    cover or that are salad, share of salad, mean PMI; ``least`` as in ``scored``, for the first two."""
    return _each(docs, counts, True, ("stuffed", "salad", "pmi"), least)
