"""Text decoded in the wrong charset: found and restored by noisy-channel decoding.

*Source model.* One pass counts the words and letter trigrams of all texts (tokens with a character outside ASCII;
character references are read first) in count-min tables; since most text is sound, true forms outnumber garbled ones.

*Channel.* A stretch was written in charset T, its bytes were read in charset R, and bytes that R can't read are lost
(U+FFFD). For each (R, T) a token becomes a lattice of bytes: a character of R's gives its byte, a mark gives a
wildcard. Arcs of the lattice are the characters of T whose bytes fit (in UTF-8 an arc spans several bytes); a
wildcard fits every byte, so its arcs carry the letters that the corpus commonly has in T. A lattice without
wildcards has one path. The best paths come from a Viterbi search under the letter trigrams, and the frequencies of
the words on them decide between those.

*Decision.* gain = log P(best path) - log P(as it stands). A text is garbled if one channel's gains over its
tokens add up to EVIDENCE or more (a channel whose R the page's header names starts DECLARED ahead), or if bytes
were lost. Tokens that gain under the text's channels are replaced, those with lost bytes only where the best path is
known to the corpus and stands MARGIN above the next.

A sound word stands against a word that is spelled otherwise unless the other one is surely more frequent; "surely"
is a lower bound of the Poisson count, the same rule at every size of the corpus.

Cases: null and pure ASCII texts without references are sound; bytes that are no UTF-8 count as lost; a text may hold
several stretches of different channels, each must show its own evidence; long texts are read whole; of a token all of
whose letters are lost nothing survives, so it stays.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import sketch
from newsloom.runtime import ship

WORDS, TRIGRAMS, ROWS, CHUNKS = 1 << 19, 1 << 18, 2, 12
EVIDENCE, EACH, DECLARED, MARGIN, BEAM = 6.0, 2.0, 1.0, 1.0, 16
MARK = "�"
TOKEN = re.compile("[^ \t\r\n<>\"=/]*[^\x00-\x7f][^ \t\r\n<>\"=/]*")
REFERENCE = re.compile(r"&(?:#\d{2,7}|#[xX][0-9a-fA-F]{2,6}|[A-Za-z]{2,8}[0-9]{0,2});")
#: As TOKEN, where a reference stands for its character.
SPOT = re.compile("[^ \t\r\n<>\"=/&]*(?:&(?!#?[A-Za-z0-9]{1,8};)[^ \t\r\n<>\"=/&]*)*(?:[^\x00-\x7f]|&#?[A-Za-z0-9]{1,8};)[^ \t\r\n<>\"=/]*")
HIGH = re.compile("[^\x00-\x7f]")
#: Punctuation that sound text has too.
PLAIN = frozenset(" ­  “”‘’«»„–—·…©№")
_PLAIN_ONLY = re.compile("[\x00-\x7f" + "".join(PLAIN) + "]*")
LETTERS = re.compile(r"[^\W\d_]+")
ONE_BYTE = ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8_r", "iso8859_2", "iso8859_5", "mac_cyrillic", "cp852")


def _table(name: str) -> dict[str, int]:
    """Character -> byte; bytes that the charset leaves undefined are read as C1 controls."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(name)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    if name == "cp1252":
        for b in range(0x80, 0xA0):  # read as Latin-1
            out.setdefault(chr(b), b)
    return out


READ = {n: _table(n) for n in ONE_BYTE}
WRITE = {n: {v: k for k, v in t.items()} for n, t in READ.items()}
CHANNELS = [(r, "utf_8") for r in ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8_r", "iso8859_2", "cp852")]
CHANNELS += [(r, t) for r in ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8_r", "iso8859_2", "iso8859_5") for t in ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8_r", "iso8859_2", "iso8859_5", "mac_cyrillic", "cp852") if r != t]
#: Channels that lose every byte they can't read: a one-byte charset read as UTF-8, UTF-8 read as ASCII.
LOSING = [("utf_8", t) for t in ONE_BYTE] + [("ascii", "utf_8")]
ANY = "any"


def h(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass"))


def surely(n: float) -> float:
    """A lower bound of the expected count of something seen n times."""
    return n - 2.0 * math.sqrt(n)


class Corpus:
    """Count-min tables of words and of letter trigrams, with the scores that follow from them."""

    def __init__(self, words: np.ndarray, trigrams: np.ndarray):
        self.w, self.t = words.reshape(ROWS, WORDS), trigrams.reshape(ROWS, TRIGRAMS)
        self.nw, self.nt = float(max(1.0, self.w[0].sum())), float(max(1.0, self.t[0].sum()))
        self.memo: dict[str, tuple] = {}
        self.three: dict[str, float] = {}
        self.one: dict[str, float] = {}
        self.words: dict[str, float] = {}
        self.alphabets: dict[str, list[tuple]] = {}
        self.channels: dict[frozenset, tuple] = {}
        #: for each channel, the characters it may have left
        self.turns = []
        for read, true in CHANNELS:
            if true == "utf_8":
                self.turns.append(frozenset(READ[read]))
                continue
            back = WRITE[true]
            self.turns.append(frozenset(c for c, b in READ[read].items() if b in back and (back[b] in PLAIN or not self.rare(back[b].lower()))))

    @staticmethod
    def _least(table: np.ndarray, key: str) -> float:
        x = h(key)
        m = table.shape[1] - 1
        return float(min(table[0, x & m], table[1, (x >> 24) & m]))

    def count(self, word: str) -> float:
        w = word.lower()
        v = self.words.get(w)
        if v is None:
            if len(self.words) > 500_000:
                self.words.clear()
            v = self.words[w] = self._least(self.w, w)
        return v

    def letter(self, c: str) -> float:
        v = self.one.get(c)
        if v is None:
            v = self.one[c] = self._least(self.t, "1" + c)
        return v

    def trigram(self, s: str) -> float:
        v = self.three.get(s)
        if v is None:
            if len(self.three) > 500_000:
                self.three.clear()
            n2, n3 = self._least(self.t, "2" + s[:2]), self._least(self.t, "3" + s)
            p = 0.7 * n3 / (n2 + 1) + 0.3 * (self.letter(s[2]) + 0.02) / self.nt
            v = self.three[s] = math.log(min(1.0, p) + 1e-9)
        return v

    def rare(self, c: str) -> bool:
        """A letter that sound text of the corpus hardly has."""
        return self.letter(c) < 2e-5 * self.nt

    def score(self, token: str) -> float:
        total, s = 0.0, "^" + shape(token) + "$"
        for m in LETTERS.finditer(token):
            w = m[0]
            spelled = sum(self.trigram(s[i : i + 3]) for i in range(m.start(), m.end())) - 3.0
            n = self.count(w)
            known = math.log((n - 0.5) / self.nw) if n > 1 else -1e9
            odd = 4.0 * sum(1 for i in range(1, len(w)) if w[i].isupper() and w[i - 1].islower())
            strange = 4.0 * sum(1 for c in set(w.lower()) if c > "\x7f" and self.rare(c))
            total += max(known, spelled) - odd - strange
        for c in LETTERS.sub("", token):
            total += -1.0 if c < "\x80" else -5.0 if c in PLAIN else -7.0
        return total

    def alphabet(self, true: str) -> list[tuple[str, str, bytes, str]]:
        """The characters that a wildcard may stand for in a charset (ANY: in some one-byte charset): letters that the
        corpus commonly has, in both cases, and punctuation; each with its small form, bytes and kind."""
        got = self.alphabets.get(true)
        if got is None:
            chars = set(READ[true]) if true in READ else {c for t in READ.values() for c in t}
            ok = sorted(c for c in chars if c in PLAIN or c.isalpha() and not self.rare(c.lower()))
            got = self.alphabets[true] = [(c, c.lower(), c.encode("utf_8") if true == "utf_8" else bytes([READ[true][c]]) if true in READ else b"?", kind(c)) for c in ok]
        return got


def kind(c: str) -> str:
    """'c' a Cyrillic letter, 'l' another letter, '' no letter."""
    return "" if not c.isalpha() else "c" if "\u0400" <= c <= "\u04ff" else "l"


def shape(token: str) -> str:
    return re.sub(r"[\d_]", "0", token.lower())


_TO_BYTE = {n: {ord(c): b for c, b in t.items()} for n, t in READ.items()}
_MIXED = re.compile("[A-Za-zÀ-ɏ][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-zÀ-ɏ]")
_ODD = re.compile("[a-zß-öø-ÿа-џ][A-ZÀ-ÖØ-ÞА-Я]")
#: Of each one-byte channel: character read -> character written.
ACROSS = [{} if t == "utf_8" else {ord(c): WRITE[t][b] for c, b in READ[r].items() if b in WRITE[t]} for r, t in CHANNELS]


def through(token: str, read: str, true: str) -> str | None:
    """The one path of a lattice without wildcards; None if the channel can't have made the token."""
    try:
        raw = token.translate(_TO_BYTE[read]).encode("latin_1")
    except UnicodeEncodeError:
        return None
    if any(c > "\x7f" and c not in READ[read] for c in token):
        return None
    if true == "utf_8":
        try:
            out = raw.decode("utf_8")
        except UnicodeDecodeError:
            return None
        if len(out) == len(token):
            return None
        again = through(out, read, "utf_8") if HIGH.search(out) else None  # garbled twice
        return again or out
    back = WRITE[true]
    if any(b > 127 and b not in back for b in raw):
        return None
    out = "".join(chr(b) if b < 128 else back[b] for b in raw)
    return None if out == token else out


def lattice(token: str, read: str) -> list[int] | None:
    """The bytes a token was read from, -1 for a lost one; None if the charset can't have given its characters."""
    out: list[int] = []
    for c in token:
        if c == MARK:
            out.append(-1)
        elif c < "\x80":
            out.append(ord(c))
        elif read == "utf_8":
            out += c.encode("utf_8", "surrogatepass")
        elif c in READ.get(read, ()):
            out.append(READ[read][c])
        else:
            return None
    return out


def paths(byte: list[int], true: str, corpus: Corpus, beam: int = BEAM) -> list[tuple[float, str]]:
    """The best readings of a byte lattice in a charset, by a Viterbi search over (byte, last letters) with a beam. No
    arc puts letters of two scripts beside each other, or a capital after a small letter."""
    one = None if true == "utf_8" else WRITE.get(true, {})
    n = len(byte)
    at: list[list[tuple[float, str]]] = [[] for _ in range(n + 1)]
    at[0] = [(0.0, "^")]
    for i in range(n):
        if not at[i]:
            continue
        b = byte[i]
        if 0 <= b < 128:
            arcs = [(chr(b), chr(b).lower(), 1, kind(chr(b)))]
        elif one is not None and b >= 128:
            arcs = [(one[b], one[b].lower(), 1, kind(one[b]))] if b in one else []
        else:
            arcs = [(c, low, len(e), q) for c, low, e, q in corpus.alphabet(true) if one is not None or i + len(e) <= n and all(y in (-1, x) for x, y in zip(e, byte[i : i + len(e)]))]
            if one is None and not arcs:  # known bytes of a letter that the corpus hardly has
                arcs = [(c, c.lower(), k, kind(c)) for k in (2, 3, 4) if i + k <= n and min(byte[i : i + k]) >= 0 and (c := bytes(byte[i : i + k]).decode("utf_8", "ignore"))]
        for p, s in sorted(at[i], reverse=True)[: beam if len(arcs) > 1 else 10 * beam]:  # a known byte tells a wildcard's readings apart
            last, end = s[-2:].lower(), s[-1]
            before, small = kind(end), end.islower()
            for c, low, k, q in arcs:
                if before and q and before != q or small and c.isupper():
                    continue
                at[i + k].append((p + (corpus.trigram(last + low) if len(last) == 2 else math.log((corpus.letter(low) + 0.02) / corpus.nt)), s + c))
    ends = [(p + corpus.trigram(s[-2:].lower() + "$"), s[1:]) for p, s in at[n] if len(s) > 1]
    return sorted(ends, reverse=True)[:beam]


def _fit(s: str, corpus: Corpus) -> float:
    """What word counts leave open: how well punctuation outside ASCII sits, and capitals."""
    low, total = "^^" + shape(s) + "$", 0.0
    for i, c in enumerate(low):
        if c > "\x7f" and not c.isalpha():
            total += 5.0 + 0.5 * sum(corpus.trigram(low[j - 2 : j + 1]) for j in range(i, min(i + 3, len(low))))
    for w in LETTERS.findall(s):
        if w[0] > "\x7f":
            capital = min(1.0, (corpus.count("^" + w) + 0.5) / (corpus.count(w) + 1.0))
            total += math.log(capital if w[0].isupper() else 1.0 - capital + 1e-3)
    if not s.isupper():
        total -= 4.0 * sum(1 for a, b in zip(s, s[1:]) if b > "\x7f" and b.isupper() and a.isalpha())
    return total


def filled(token: str, corpus: Corpus) -> tuple[str | None, str]:
    """(reading of a token with lost bytes, its channel): the best path over the lattices of all channels, if the
    corpus has its words and it stands MARGIN above the next best; else (None, '')."""
    seen = [c for c in token if c > "\x7f" and c != MARK]
    if not any(c.isalnum() for c in token if c != MARK):
        return None, ""  # nothing survives that a search could hold on to
    found: list[tuple[str, str]] = []
    if seen:
        tries = [(r, t) for r, t in CHANNELS if t == "utf_8"] + LOSING
    else:  # no byte tells the charset: one search over the letters of all, of which a path must fit one
        tries = LOSING[-1:] if MARK * 2 in token else []
        for _, s in paths(lattice(token, "utf_8") or [], ANY, corpus):
            new = {x for x, y in zip(s, token) if y == MARK}
            if t := next((t for t in ONE_BYTE if new <= READ[t].keys()), None):
                found.append((s, f"{t}>utf_8"))
    done: set[tuple] = set()
    for read, true in tries:
        byte = lattice(token, read)
        if byte is None or (same := (tuple(byte), tuple(c for c, *_ in corpus.alphabet(true)))) in done:
            continue
        done.add(same)
        found += [(s, f"{true}>{read}") for _, s in paths(byte, true, corpus)]
    ranked: dict[str, tuple[float, str]] = {}
    for s, channel in found:
        if not _MIXED.search(s) and MARK not in s and s not in ranked:
            ranked[s] = (corpus.score(s) + _fit(s, corpus), channel)
    if not ranked:
        return None, ""
    order = sorted(((v, s, c) for s, (v, c) in ranked.items()), reverse=True)
    top, s, channel = order[0]
    known = all(surely(corpus.count(w)) > 0.0 for w in LETTERS.findall(s) if HIGH.search(w))
    near = len(order) > 1 and order[1][0] > top - MARGIN
    return (s, channel) if known and not near else (None, "")


def readings(token: str, corpus: Corpus) -> tuple:
    """((channel number, gain, reading), ...) of the channels under which a token gains; of one with lost bytes
    ((-1, 0, reading or the token itself),). () for a sound token.

    A one-byte channel is tried only if it turns every character outside ASCII into one that the corpus commonly has;
    the UTF-8 channels only where the bytes are valid UTF-8."""
    got = corpus.memo.get(token)
    if got is not None:
        return got
    if len(corpus.memo) > 300_000:
        corpus.memo.clear()
    if MARK in token:
        got = corpus.memo[token] = ((-1, 0.0, filled(token, corpus)[0] or token),)
        return got
    got = corpus.memo[token] = () if _PLAIN_ONLY.fullmatch(token) else _readings(token, corpus)
    return got


_TWO = re.compile("[^\x00-\x7f]{2}")


def _fitting(high: frozenset, corpus: Corpus) -> tuple[list[int], list[tuple[dict, list[int]]]]:
    """(UTF-8 channels, one-byte channels grouped by what they make of the characters) that may have left these characters."""
    several, groups = [], {}
    for k, turns in enumerate(corpus.turns):
        if high <= turns:
            if CHANNELS[k][1] == "utf_8":
                several.append(k)
            else:
                groups.setdefault(tuple(ACROSS[k][ord(c)] for c in sorted(high)), (ACROSS[k], []))[1].append(k)
    return several, list(groups.values())


def _readings(token: str, corpus: Corpus) -> tuple:
    high = frozenset(HIGH.findall(token))
    fit = corpus.channels.get(high)
    if fit is None:
        if len(corpus.channels) > 100_000:
            corpus.channels.clear()
        fit = corpus.channels[high] = _fitting(high, corpus)
    word = LETTERS.search(token) is not None and not any(x < "\x80" for x in token)
    tried: dict[str, list[int]] = {}
    several, across = fit
    for k in several if _TWO.search(token) else ():  # a letter of UTF-8 is two bytes or more
        if (r := through(token, *CHANNELS[k])) is not None:
            tried.setdefault(r, []).append(k)
    for table, ks in across:
        tried.setdefault(token.translate(table), []).extend(ks)
    tried.pop(token, None)
    if word:  # a word never stands for bare punctuation
        tried = {r: ks for r, ks in tried.items() if LETTERS.search(r)}
    if not tried:
        return ()
    own = LETTERS.findall(token)
    stands = max((surely(corpus.count(w)) for w in own if HIGH.search(w)), default=0.0)
    one_word = len(own) == 1 and all(c in own[0] for c in high)
    base, most = None, max(map(corpus.count, own), default=0.0)
    sound = all(c.isalpha() and not corpus.rare(c.lower()) for c in high) and not _ODD.search(token)
    out = []
    for r, ks in tried.items():
        if _MIXED.search(r) or sound and _ODD.search(r):
            continue  # no word mixes scripts, and none gains capitals inside
        new = LETTERS.findall(r)
        if one_word and (not new or max(map(corpus.count, new)) <= 2.0 * stands):
            continue  # a word that stands gives way only to one that is more frequent by far
        if sound and (sum(map(str.isalpha, r)) < sum(map(str.isalpha, token)) or any(surely(corpus.count(w)) <= 0.5 * most for w in new if HIGH.search(w))):
            ks = [k for k in ks if CHANNELS[k][1] == "utf_8"]  # of two soundly spelled words the other must surely be the commoner
            if not ks:
                continue
        if base is None:
            base = corpus.score(token)
        gain = corpus.score(r) - base
        for k in ks:
            g = gain - (1.0 if CHANNELS[k][1] == "utf_8" else 2.0)
            if g > 0:
                out.append((k, g, r))
    return tuple(out)


def _reference(m: re.Match) -> str:
    c = html.unescape(m[0])
    return c if len(c) == 1 and c > "\x7f" else m[0]


def plain(text: str) -> str:
    """The text with character references outside ASCII read; others belong to the markup and stay."""
    return REFERENCE.sub(_reference, text) if "&" in text else text


def examine(text: str, corpus: Corpus, declared: str = "") -> tuple[list[int], int, dict[str, str]]:
    """(channels with evidence, marks of lost bytes, {token: its reading}) of one text whose references are read."""
    memo = corpus.memo
    tally: dict[str, int] = {}
    for tok in TOKEN.findall(text):
        got = memo.get(tok)
        if got is None:
            got = readings(tok, corpus)
        if got:
            tally[tok] = tally.get(tok, 0) + 1
    if not tally:
        return [], 0, {}
    gains: dict[int, float] = {}
    found = {tok: readings(tok, corpus) for tok in tally}
    for tok, n in tally.items():
        for k, g, _ in found[tok]:
            if k >= 0 and g > EACH:  # less is no evidence, but enough where the channel has shown itself
                gains[k] = gains.get(k, 0.0) + n * min(g, 12.0)
    for k in gains:
        if declared and CHANNELS[k][0] == declared:
            gains[k] += DECLARED
    good = {k for k, g in gains.items() if g >= EVIDENCE}
    fixes, lost = {}, 0
    for tok, got in found.items():
        if got[0][0] < 0:
            fixes[tok] = got[0][2]
            lost += tally[tok] * tok.count(MARK)
        elif own := [(gains[k], g, r) for k, g, r in got if k in good]:
            fixes[tok] = max(own)[2]
    return sorted(good), lost, fixes


def restore(text: str, corpus: Corpus) -> str:
    """The text as written, as far as it survives; references of tokens that change are read, others stay."""
    return replaced(text, examine(plain(text), corpus)[2])


def replaced(text: str, fixes: dict[str, str]) -> str:
    if not fixes:
        return text
    if "&" not in text:
        return TOKEN.sub(lambda m: fixes.get(m[0], m[0]), text)
    return SPOT.sub(lambda m: fixes.get(plain(m[0]), m[0]), text)


def _text(x) -> str:
    return x if isinstance(x, str) else bytes(x).decode("utf_8", "replace")


def corpus_of(texts: DataFrame) -> Corpus:
    """Counts over all rows of the one column (string or binary); tables of fixed size reach the driver."""
    ship(texts.sparkSession)
    cells = ROWS * (WORDS + TRIGRAMS)

    def run(batches):
        from newsloom.llm import mojibake as M

        flat, tally = np.zeros(cells, np.float64), Counter()
        some = False
        for b in batches:
            for x in b.column(0).to_pylist():
                if x is not None:
                    tally.update(M.TOKEN.findall(M.plain(M._text(x))))
                    if len(tally) > 100_000:
                        M._pour(tally, flat)
                        some = True
        if tally or some:
            M._pour(tally, flat)
            yield sketch.blobs(flat.astype(np.uint64), CHUNKS)

    flat = sketch.summed(texts.mapInArrow(run, sketch.SCHEMA), CHUNKS, cells).astype(np.float32)
    return Corpus(flat[: ROWS * WORDS], flat[ROWS * WORDS :])


def _pour(tally: Counter, flat: np.ndarray) -> None:
    """Add the counts of tokens to the tables and forget them."""
    words: dict[str, int] = {}
    grams: dict[str, int] = {}
    for tok, n in tally.items():
        if MARK in tok:
            continue
        for w in LETTERS.findall(tok):
            low = w.lower()
            words[low] = words.get(low, 0) + n
            if w[0].isupper():  # how often it is written with a capital
                words["^" + low] = words.get("^" + low, 0) + n
        s = "^" + shape(tok) + "$"
        for i, c in enumerate(s):
            for g in ("1" + c, "2" + s[i : i + 2], "3" + s[i : i + 3])[: len(s) - i]:
                grams[g] = grams.get(g, 0) + n
    tally.clear()
    at = 0
    for table, size in ((words, WORDS), (grams, TRIGRAMS)):
        x = np.fromiter(map(h, table), np.uint64, len(table))
        n = np.fromiter(table.values(), np.float64, len(table))
        for r in range(ROWS):
            flat[at : at + size] += np.bincount(((x >> np.uint64(24 * r)) & np.uint64(size - 1)).astype(np.int64), n, size)
            at += size


_OWN: dict[str, Corpus] = {}


def known(parts) -> Corpus:
    """The corpus of a broadcast; one for all tasks of a worker, so that its memos last."""
    key = str(getattr(parts, "_path", None) or id(parts))
    if key not in _OWN:
        _OWN.clear()
        _OWN[key] = Corpus(*parts.value)
    return _OWN[key]


_DECLARED = r"(?i)charset\s*=\s*[\"']?([\w.:-]+)"
#: Names that headers use, as Python's codecs are named here. Fixed values.
NAMES = {"windows-1252": "cp1252", "iso-8859-1": "cp1252", "latin1": "cp1252", "windows-1250": "cp1250", "windows-1251": "cp1251", "iso-8859-2": "iso8859_2", "iso8859-2": "iso8859_2", "iso-8859-5": "iso8859_5", "koi8-r": "koi8_r", "macintosh": "mac_roman", "mac_roman": "mac_roman", "cp437": "cp437", "cp850": "cp850", "cp866": "cp866", "cp852": "cp852"}


def garbled(texts: DataFrame, corpus: Corpus) -> DataFrame:
    """(id, channels, lost, restored) of the garbled texts; ``texts`` has id, text (string or binary) and perhaps
    headers, whose charset is weighed as a hint. ``lost``: marks of lost bytes, restored or not."""
    spark = texts.sparkSession
    ship(spark)
    parts = spark.sparkContext.broadcast((corpus.w, corpus.t))

    def run(batches):
        from newsloom.llm import mojibake as M

        own = M.known(parts)
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for i, x, declared in zip(*(c.to_pylist() for c in b.columns)):
                raw = M._text(x)
                text = M.plain(raw)
                if text.isascii():
                    continue
                good, lost, fixes = M.examine(text, own, M.NAMES.get((declared or "").lower(), ""))
                if not good and not fixes:
                    continue
                for c, v in zip(cols, (i, ",".join(f"{M.CHANNELS[k][1]}>{M.CHANNELS[k][0]}" for k in good), lost, M.replaced(raw, fixes))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())], ["id", "channels", "lost", "restored"])

    named = F.regexp_extract("headers", _DECLARED, 1) if "headers" in texts.columns else F.lit("")
    src = texts.where(F.col("text").isNotNull() & F.col("id").isNotNull()).select("id", "text", named.alias("declared"))
    return src.mapInArrow(run, "id long, channels string, lost int, restored string")
