"""New batches checked against everything accepted before, without reading the history's texts again.

*Store* (a folder, kept between sessions: ``create``, ``open``, ``append`` by each ``check``). For each class of equal
texts among the accepted records: the least id, the prefix keys in order, a parity bitmap and the other shingles; for each
hub (a canonical page, or a class) the least id; Bloom filters partitioned by hash; the order of the keys. A manifest
names the layers that belong to the store, and is written last: a batch that breaks off leaves the store as it was.

*Fingerprints.* In any fixed order of the shingles, two sets of similarity t share one of their
|x| - ceil(t|x|) + 1 first. If the first they share is number i of x, they have |x| - i in common at most, so
|y| <= (|x| - i) (1+t)/t - |x|, and as much holds for y: a posting meets only those whose sizes keep both limits. The order is rare
first by counts of all texts of the first history, in a table whose cells grow with its shingles, and stays fixed (any
order is complete). Keys are cut to 40 bits, which may let more through, never less.

*Check of a batch.* All its keys - fingerprints, pages, classes - meet the Bloom filters of their partition; what no
filter holds is new and ends there. Positives, as a bitmap sized by their number, screen the scan of the store's keys;
what is left meets the batch's fingerprints by part of the key space, in packed arrays. Pairs whose bitmaps allow
similarity t are verified on the stored shingle sets. Items of one batch meet each other by the same keys.

*Decision.* In order of id: an item that repeats an accepted record is a case and isn't accepted. A batch with at most
MOST_ROWS links to hubs (counted) is decided by one task in that order; a larger one in rounds of joins over hubs, never
pair by pair within a hub; the least undecided id can always be decided, so the rounds end.

*Update.* Keys of the accepted items are appended as a layer, with filters of their own size; nothing is rewritten.
When the history has doubled since the filters were made, or they have LAYERS layers, they are made anew from the keys, with more parts.

Cases: null or short content (fewer than ``least_words``) is compared by URL alone, a null URL by
content alone, both null: accepted; repeated rows count once; an empty batch changes nothing.
"""

from __future__ import annotations

import gc
import itertools
import json
import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import neardup as N
from newsloom.llm import sketch
from newsloom.llm.weburl import page_key
from newsloom.llm.words import common, mix, shingle_sets
from newsloom.runtime import fresh, get_text, put_text, shared_dir, ship, written

CELLS, MOST_CELLS, PER_CELL, CHUNKS = 1 << 21, 1 << 23, 8, 16  # of the counts of shingles: as many as keep shingles to PER_CELL a cell, within these
PER_FILTER, PARTS, LAYERS = 1 << 22, 6, 16
AT_ONCE = 4_000_000  # pairs of postings looked at together
LOOKED_UP = 500_000  # postings of a batch looked up together
MOST_ROWS = 500_000  # ids or hubs (16 bytes each) that are broadcast; more are joined by a shuffle
_POST = "part int, keys binary, at binary, place binary, ids binary, n binary, bits binary, old boolean"
_KEYED = "id long, cls long, n int, fps binary, bits binary, rest binary"
_SETS = "id long, cls long, n int, keys binary, bits binary"
_NEW = f"page long, {_KEYED}"


def page_hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest("page " + key) >> 1


def pack40(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack40(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view(np.uint64)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys * np.uint64(parts)) >> np.uint64(40)).astype(np.int64)


def _words64(n: np.ndarray) -> np.ndarray:
    """Length of a stored bitmap in words of 64 bits: half of what ``neardup`` stores, at least 256 bits."""
    return np.array([max(4, N.width(b) // 128) for b in range(40)])[N._band(n)]


def _folded(bits: bytes) -> bytes:
    m = np.frombuffer(bits, np.uint64)
    return (m[: len(m) // 2] ^ m[len(m) // 2 :]).tobytes() if len(m) > 4 else bits


def _sets_of(texts: list, k: int, least_words: int) -> tuple[np.ndarray, list[pa.Array]]:
    """(rows kept, columns cls, n, keys, bits) of the texts of ``least_words`` or more: class of the shingle set, its size,
    its keys in order of their value, parity bitmap."""
    rows, begin, h = shingle_sets(texts, k, least_words)
    ends = list(zip(begin[:-1].tolist(), begin[1:].tolist()))
    cls, keys = [N.class_hash(h[lo:hi]) for lo, hi in ends], h >> np.uint64(24)
    return rows, [pa.array(cls, pa.int64()), pa.array(np.diff(begin).astype(np.int32)), *(pa.array(x, pa.binary()) for x in ([pack40(keys[lo:hi]) for lo, hi in ends], [_folded(x) for x in N.bitmaps(h, begin)]))]


def _cut(keys: list[bytes], t: float, rare: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(fps, rest) of packed sets: the prefix keys, rare first, and the other keys."""
    fps, rest = [], []
    for blob in keys:
        x = unpack40(blob)
        n = len(x)
        p = min(n, n - math.ceil(t * n - 1e-9) + 1)
        order = x[np.argsort(rare[_cell(x, len(rare))], kind="stable")]
        fps.append(pack40(order[:p])), rest.append(pack40(order[p:]))
    return pa.array(fps, pa.binary()), pa.array(rest, pa.binary())


def _cell(keys: np.ndarray, cells: int) -> np.ndarray:
    return (keys & np.uint64(cells - 1)).astype(np.int64)


def _keys_of(texts: list, k: int, least_words: int, t: float, rare: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """(rows kept, columns cls, n, fps, bits, rest) of the texts of ``least_words`` or more."""
    rows, (cls, n, keys, bits) = _sets_of(texts, k, least_words)
    fps, rest = _cut(keys.to_pylist(), t, rare)
    return rows, [cls, n, fps, bits, rest]


_NAMES = ["cls", "n", "fps", "bits", "rest"]


def sets(texts: DataFrame, k: int, least_words: int) -> DataFrame:
    """(id, and the columns of ``_sets_of``) of each text (id, text) of ``least_words`` or more."""

    def run(batches):
        for b in (x.slice(lo, 4096) for x in batches for lo in range(0, x.num_rows, 4096)):
            rows, cols = _sets_of(b.column(1).to_pylist(), k, least_words)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), *cols], ["id", "cls", "n", "keys", "bits"])

    src = texts.where(F.col("id").isNotNull() & F.col("text").isNotNull()).select("id", "text")
    return src.mapInArrow(run, _SETS)


def rarity(every: DataFrame, shingles: int) -> np.ndarray:
    """How many of the sets have each shingle, by cell: counts of all of them."""
    cells = CELLS
    while cells < MOST_CELLS and cells * PER_CELL < shingles:
        cells <<= 1

    def run(batches):
        counts = np.zeros(cells, np.uint64)
        for b in batches:
            if b.num_rows:
                counts += np.bincount(_cell(unpack40(b"".join(b.column(0).to_pylist())), cells), minlength=cells).astype(np.uint64)
        if counts.any():
            yield sketch.blobs(counts, CHUNKS)

    total = sketch.summed(every.select("keys").mapInArrow(run, sketch.SCHEMA), CHUNKS, cells)
    return np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)


def keyed(every: DataFrame, t: float, order) -> DataFrame:
    """``_KEYED`` of the rows of ``sets``, by the broadcast counts ``order``."""

    def run(batches):
        for b in batches:
            fps, rest = _cut(b.column(3).to_pylist(), t, order.value)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], fps, b.column(4), rest], ["id", *_NAMES])

    return every.select("id", "cls", "n", "keys", "bits").mapInArrow(run, _KEYED)


def newcomers(items: DataFrame, k: int, least_words: int, t: float, order) -> DataFrame:
    """(page, id, and the columns of ``_keys_of``) of every item (id, url, text), in one scan; null where it has none."""

    def run(batches):
        for b in (x.slice(lo, 4096) for x in batches for lo in range(0, x.num_rows, 4096)):
            rows, cols = _keys_of(b.column(2).to_pylist(), k, least_words, t, order.value)
            at = np.full(b.num_rows, -1, np.int64)
            at[rows] = np.arange(len(rows))
            where = pa.array(at, mask=at < 0)
            pages = [page_hash(x) if (x := page_key(u)) else None for u in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), b.column(0), *(c.take(where) for c in cols)], ["page", "id", *_NAMES])

    return items.where(F.col("id").isNotNull()).select("id", "url", "text").mapInArrow(run, _NEW)


def leads(every: DataFrame) -> DataFrame:
    """The text of the least id of each class, from a written table: only rows of repeated classes are shuffled."""
    names = ["n", "keys", "bits"]
    more = every.groupBy("cls").agg(F.count("*").alias("c")).where("c > 1").select("cls")
    first = every.join(more, "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("id", *names)).alias("r"))
    return every.join(more, "cls", "left_anti").select("id", "cls", *names).unionByName(first.select("cls", "r.*").select("id", "cls", *names))


def posted(rows: DataFrame, parts: int, old: bool, screen=None, bits: int = 0) -> DataFrame:
    """Packed postings of (id, n, fps, bits), one row for each part of the key space and batch; ``place``: where in its
    prefix a key comes, in 256ths; ``screen``: a broadcast bitmap (of so many bits) of the keys that count."""

    def run(batches):
        for b in (x.slice(k0, 16_384) for x in batches for k0 in range(0, x.num_rows, 16_384)):
            ids, n = (b.column(c).to_numpy() for c in range(2))
            raw, maps = b.column(2).to_pylist(), b.column(3).to_pylist()
            size = np.fromiter((len(x) // 5 for x in raw), np.int64, len(raw))
            key, doc = unpack40(b"".join(raw)), np.repeat(np.arange(len(raw)), size)
            place = ((np.arange(len(key)) - (np.cumsum(size) - size)[doc]) * 256 // size[doc]).astype(np.uint8)
            if screen is not None:
                ok = np.flatnonzero(sketch.held(screen.value, (key & np.uint64(bits - 1)).astype(np.int64)))
                key, doc, place = key[ok], doc[ok], place[ok]
            part = _part(key, parts)
            o = np.argsort(part, kind="stable")
            edge = np.searchsorted(part[o], np.arange(parts + 1))
            cols: list[list] = [[], [], [], [], [], [], []]
            for q in range(parts):
                some = o[edge[q] : edge[q + 1]]
                if not len(some):
                    continue
                used, local = np.unique(doc[some], return_inverse=True)
                for col, v in zip(cols, (q, pack40(key[some]), local.astype(np.uint16).tobytes(), place[some].tobytes(), ids[used].tobytes(), n[used].tobytes(), b"".join(maps[u] for u in used))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(x, pa.binary()) for x in cols[1:]), pa.array([old] * len(cols[0]), pa.bool_())], ["part", "keys", "at", "place", "ids", "n", "bits", "old"])

    return rows.select("id", "n", "fps", "bits").mapInArrow(run, _POST)


def _limits(n: np.ndarray, place: np.ndarray, t: float) -> np.ndarray:
    """The largest size of a set similar to one of size n if the first key they share comes at this place (256ths of the prefix, rounded down) or later."""
    p = np.minimum(n, n - np.ceil(t * n - 1e-9).astype(np.int64) + 1)
    i = -(-place.astype(np.int64) * p // 256)
    return np.floor((n - i) * ((1 + t) / t) - n + 1e-6).astype(np.int64)


def _quarter(n: np.ndarray) -> np.ndarray:
    """Size bands, four to a factor of 2."""
    m, e = np.frexp(np.maximum(n, 1).astype(np.float64))
    return (4 * e + ((m - 0.5) * 8).astype(np.int64)).astype(np.uint64)


class _Postings:
    """Postings of one part, sorted by (key, size band, largest partner) in ``code``."""

    def __init__(self, table: pa.Table, t: float):
        keys, doc, place, ids, ns, bits, old = [], [], [], [], [], [], []
        base = 0
        for kb, ab, pb, ib, nb, bb, o in zip(*(table.column(c).to_pylist() for c in ("keys", "at", "place", "ids", "n", "bits", "old"))):
            i = np.frombuffer(ib, np.int64)
            keys.append(unpack40(kb)), doc.append(np.frombuffer(ab, np.uint16).astype(np.int64) + base), place.append(np.frombuffer(pb, np.uint8))
            ids.append(i), ns.append(np.frombuffer(nb, np.int32)), bits.append(np.frombuffer(bb, np.uint64)), old.append(np.full(len(i), o))
            base += len(i)
        key, doc = np.concatenate(keys), np.concatenate(doc)
        self.ids, self.n, self.flat, self.old = np.concatenate(ids), np.concatenate(ns).astype(np.int64), np.concatenate(bits), np.concatenate(old)
        size = _words64(self.n)
        self.start, self.band = np.cumsum(size) - size, N._band(self.n)
        most = _limits(self.n[doc], np.concatenate(place), t)
        code = key << np.uint64(24) | _quarter(self.n)[doc] << np.uint64(16) | np.minimum(most, 0xFFFF).astype(np.uint64)
        o = np.argsort(code)
        self.code, self.key, self.doc, self.most = code[o], key[o], doc[o], most[o]

    def rows(self, d: np.ndarray, words: int, to: int) -> np.ndarray:
        m = self.flat[self.start[d][:, None] + np.arange(words)]
        while m.shape[1] > to:
            half = m.shape[1] // 2
            m = m[:, :half] ^ m[:, half:]
        return m


def met(left: pa.Table, right: pa.Table, t: float) -> pa.Table:
    """(item, rec) of one part: postings that share a key and whose sizes and bitmaps allow similarity t; of the batch itself only earlier ids."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"item": pa.array([], pa.int64()), "rec": pa.array([], pa.int64())})
    x, y = _Postings(left, t), _Postings(right, t)
    ratio, total = (1 - t) / (1 + t), np.int64(len(y.ids))
    reach = math.ceil(math.log2(1 / t))  # size bands that similar sets may lie apart
    found: list[np.ndarray] = []

    def allowed(p, q):
        ok = np.zeros(len(p), bool)
        bp, bq = x.band[p], y.band[q]
        for b, c in {(int(b), int(c)) for b in np.unique(bp) for c in range(b - reach, b + reach + 1)}:
            at = np.flatnonzero((bp == b) & (bq == c))
            if len(at):
                wb, wc = (int(_words64(np.array([1 << e]))[0]) for e in (b, c))
                to = min(wb, wc)
                for lo in range(0, len(at), 200_000):
                    some = at[lo : lo + 200_000]
                    diff = np.bitwise_count(x.rows(p[some], wb, to) ^ y.rows(q[some], wc, to)).sum(axis=1, dtype=np.int64)
                    ok[some] = diff <= ratio * (x.n[p[some]] + y.n[q[some]]) + 1e-9
        return ok

    least = _quarter(np.ceil(t * x.n - 1e-6))
    low, all_ones = np.minimum(x.n, 0xFFFF).astype(np.uint64), np.uint64(0xFFFF)
    for first in range(0, len(x.key), LOOKED_UP):
        key, doc, most = (c[first : first + LOOKED_UP] for c in (x.key, x.doc, x.most))
        lo = np.searchsorted(y.code, key << np.uint64(24))
        hi = np.searchsorted(y.code, key << np.uint64(24) | np.uint64(0xFFFFFF), side="right")
        alone = (hi - lo == 1) & (y.ids[y.doc[np.minimum(lo, len(y.doc) - 1)]] == x.ids[doc])  # only the item itself has it
        some = np.flatnonzero((hi > lo) & ~alone & (_quarter(most) >= least[doc]))
        # each of these in each size band that it allows: there, the records whose own limit allows the item come last
        bands = (_quarter(most[some]) - least[doc[some]]).astype(np.int64) + 1
        at = np.repeat(some, bands)
        band = least[doc[at]] + (np.arange(len(at)) - np.repeat(np.cumsum(bands) - bands, bands)).astype(np.uint64)
        cell = key[at] << np.uint64(24) | band << np.uint64(16)
        lo, hi = np.searchsorted(y.code, cell | low[doc[at]]), np.searchsorted(y.code, cell | all_ones, side="right")
        some = np.flatnonzero(hi > lo)
        at, lo, hi = at[some], lo[some], hi[some]
        upto = np.cumsum(hi - lo)
        a = 0
        while a < len(at):
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + AT_ONCE, side="right")))
            for r in range(0, int((hi[a:z] - lo[a:z]).max()), AT_ONCE):  # a single key with more records than that
                f = np.minimum(lo[a:z] + r, hi[a:z])
                c = np.minimum(hi[a:z] - f, AT_ONCE)
                from_x = np.repeat(at[a:z], c)
                to_y = np.arange(len(from_x)) + np.repeat(f - (np.cumsum(c) - c), c)
                p, q = doc[from_x], y.doc[to_y]
                ok = (y.n[q] <= most[from_x]) & (x.n[p] <= y.most[to_y]) & (y.old[q] | (y.ids[q] < x.ids[p]))
                code = np.unique(p[ok] * total + q[ok])
                found.append(code[allowed(code // total, code % total)])
            a = z
    code = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return pa.table({"item": pa.array(x.ids[code // total]), "rec": pa.array(y.ids[code % total])})


def paged(urls: DataFrame) -> DataFrame:
    """(id, page): hash of the canonical page of each URL."""

    def run(batches):
        for b in batches:
            ids, pages = [], []
            for i, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key := page_key(u):
                    ids.append(i), pages.append(page_hash(key))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pages, pa.int64())], ["id", "page"])

    return urls.where(F.col("id").isNotNull() & F.col("url").isNotNull()).select("id", "url").mapInArrow(run, "id long, page long")


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    """Four bit positions for each key."""
    a, b = mix(h), mix(h ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(a + np.uint64(j) * b) & np.uint64(bits - 1) for j in range(4)]).astype(np.int64)


def hub_key(hub: np.ndarray) -> np.ndarray:
    """The 40-bit key of pages and classes, beside those of the fingerprints."""
    return mix(hub.view(np.uint64)) >> np.uint64(24)


def by_part(rows: DataFrame, parts: int, hubs: bool) -> DataFrame:
    """(part, keys) of the one column of ``rows``: packed fingerprints, or hubs."""

    def run(batches):
        for b in batches:
            h = hub_key(b.column(0).to_numpy().astype(np.int64)) if hubs else unpack40(b"".join(b.column(0).to_pylist()))
            h = np.unique(h)
            p = _part(h, parts)
            edge = np.searchsorted(p, np.arange(parts + 1))  # keys are sorted, so parts are
            some = np.flatnonzero(np.diff(edge))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([h[edge[q] : edge[q + 1]].tobytes() for q in some], pa.binary())], ["part", "keys"])

    return rows.mapInArrow(run, "part int, keys binary")


def decided(sees: DataFrame) -> DataFrame:
    """(item, first_id) of a bounded number of rows (item, hub, own, rec), taken by one task in order of item."""

    def run(table: pa.Table) -> pa.Table:
        accepted: dict[int, int] = {}
        items, firsts = [], []
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("item", "hub", "own", "rec"))), key=lambda x: x[0])
        for item, own in itertools.groupby(rows, key=lambda x: x[0]):
            own = list(own)
            found = [r for _, _, _, r in own if r is not None] + [accepted[h] for _, h, _, _ in own if h in accepted]
            if not found:
                accepted |= {h: item for _, h, mine, _ in own if mine and h is not None}
            items.append(item), firsts.append(min(found, default=None))
        return pa.table({"item": pa.array(items, pa.int64()), "first_id": pa.array(firsts, pa.int64())})

    return sees.groupBy(F.lit(0).alias("all")).applyInArrow(run, "item long, first_id long")


def counted(df: DataFrame, owner: str, *sums) -> tuple[DataFrame, list[int]]:
    """``written``, and sums over its rows taken on the way."""
    seen = Observation()
    out = written(df.observe(seen, *(s.alias(f"s{i}") for i, s in enumerate(sums))), owner)
    return out, [int(seen.get[f"s{i}"] or 0) for i in range(len(sums))]


def near(small: DataFrame, rows: int) -> DataFrame:
    """A side of a join that is broadcast if it was counted and is small."""
    return F.broadcast(small) if rows <= MOST_ROWS else small


class History:
    """The store of accepted records. Tables: reps (_KEYED), hubs (hub, id), filters (part, bits, bloom)."""

    def __init__(self, spark: SparkSession, folder: str, state: dict):
        ship(spark)
        self.spark, self.folder, self.s = spark, folder, state
        self.k, self.t, self.least = state["k"], state["t"], state["least_words"]
        self.order = None
        if "order" in state:
            raise ValueError(f"the store in {folder} was made by an earlier version, whose keys stand in another order; build it anew")
        if "counts" in state:
            self.order = spark.sparkContext.broadcast(np.frombuffer(bytes(spark.read.parquet(f"{folder}/{state['counts']}").first()[0]), np.uint32))
        self.owner = f"batch-{uuid.uuid4().hex[:8]}"

    @classmethod
    def create(cls, spark: SparkSession, folder: str, k: int, t: float, least_words: int) -> "History":
        """An empty store in a folder all executors share."""
        own = cls(spark, folder, {"k": k, "t": t, "least_words": least_words, "layers": [], "filters": [], "parts": PARTS, "keys": 0, "keys_filtered": 0})
        own._save()
        return own

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> "History":
        return cls(spark, folder, json.loads(get_text(spark, f"{folder}/manifest.json")))

    def close(self) -> None:
        """Give back what the store holds in memory; the folder stays and can be opened again."""
        if self.order is not None:
            self.order.destroy()
            self.order = None

    def _save(self) -> None:
        put_text(self.spark, f"{self.folder}/manifest.json", json.dumps(self.s))

    def _put(self, df: DataFrame, name: str) -> str:
        name = f"{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.folder}/{name}")
        return name

    def _all(self, kind: str, schema: str) -> DataFrame:
        """The layers of one kind as one scan: appending never deepens a plan."""
        names = self.s["filters"] if kind == "filters" else [x[kind] for x in self.s["layers"]]
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{n}" for n in names))

    reps = property(lambda self: self._all("reps", _KEYED))
    hubs = property(lambda self: self._all("hubs", "hub long, id long"))
    filters = property(lambda self: self._all("filters", "part int, bits int, bloom binary"))

    def build(self, texts: DataFrame, urls: DataFrame) -> "History":
        """The initial history: one scan of the texts, one of the URLs; the sets of the texts are counted, then ordered by the counts."""
        every, (shingles,) = counted(sets(texts, self.k, self.least), self.owner, F.sum("n"))
        order = rarity(every, shingles)
        self.s["counts"] = self._put(self.spark.createDataFrame([(order.tobytes(),)], "counts binary"), "counts")
        self.order = self.spark.sparkContext.broadcast(order)
        reps = self._put(keyed(leads(every), self.t, self.order), "reps")
        fresh(self.owner)
        pages = paged(urls).groupBy("page").agg(F.min("id").alias("id")).select(F.col("page").alias("hub"), "id")
        classes = self.spark.read.schema(_KEYED).parquet(f"{self.folder}/{reps}").select(F.col("cls").alias("hub"), "id")
        self.s["layers"].append({"reps": reps, "hubs": self._put(pages.unionByName(classes), "hubs")})
        self._filter_anew()
        return self

    def _filter_anew(self) -> None:
        """Filters of the whole history from its keys, with parts of at most PER_FILTER keys."""
        reps, hubs = self.reps, self.hubs
        keys = (reps.agg(F.sum(F.octet_length("fps") / 5)).first()[0] or 0) + hubs.count()
        self.s["parts"] = max(PARTS, math.ceil(keys / PER_FILTER))
        self.s["keys"] = self.s["keys_filtered"] = int(keys)
        self.s["filters"] = [self._put(self._filters(reps, hubs, int(keys)), "filters")]
        self._save()

    def _filters(self, reps: DataFrame, hubs: DataFrame, keys: int) -> DataFrame:
        parts = self.s["parts"]
        bits = 1 << max(10, math.ceil(math.log2(8 * (keys + 1) / parts)))

        def fill(table):
            m = np.zeros(bits, bool)
            for x in table.column("keys").to_pylist():
                m[_slots(np.frombuffer(x, np.uint64), bits).ravel()] = True
            return pa.table({"part": pa.array(table.column("part").to_pylist()[:1], pa.int32()), "bits": pa.array([bits], pa.int32()), "bloom": pa.array([np.packbits(m, bitorder="little").tobytes()], pa.binary())})

        both = by_part(reps.select("fps"), parts, False).unionByName(by_part(hubs.select("hub"), parts, True))
        return both.groupBy("part").applyInArrow(fill, "part int, bits int, bloom binary")

    def prescreen(self, keys: DataFrame, bits: int) -> np.ndarray:
        """The keys (part, keys) that a filter of their part may hold, as a bitmap of so many bits."""

        def test(left, right):
            h = np.unique(np.frombuffer(b"".join(left.column("keys").to_pylist()), np.uint64))
            ok = np.zeros(len(h), bool)
            for n, bloom in zip(right.column("bits").to_pylist(), right.column("bloom").to_pylist()):
                ok |= sketch.held(np.frombuffer(bloom, np.uint8), _slots(h, n)).all(axis=0)
            return pa.table({"at": pa.array((h[ok] & np.uint64(bits - 1)).astype(np.int64))})

        return sketch.bitmap(keys.groupBy("part").cogroup(self.filters.groupBy("part")).applyInArrow(test, "at long"), bits)

    def check(self, items: DataFrame) -> DataFrame:
        """(item, first_id) for the items (id, url, text) of a batch: first_id null where accepted. Updates the store."""
        owner, t, parts = self.owner, self.t, self.s["parts"]
        new, sums = counted(newcomers(items, self.k, self.least, t, self.order), owner, F.count("page"), F.count("cls"), F.sum(F.octet_length("fps")))
        first = F.min(F.struct("id", *_NAMES[1:])).alias("r")
        lead = written(new.where("cls is not null").groupBy("cls").agg(first).select("cls", "r.*").select("id", *_NAMES), owner)
        member = new.select(F.col("id").alias("item"), F.explode(F.array_compact(F.array("page", "cls"))).alias("hub"))
        n_hubs, n_keys = sums[0] + sums[1], sums[2] // 5
        # all keys meet the filters
        bits = sketch.bits_for(n_keys + n_hubs) or sketch.MOST_BITS
        keys = by_part(lead.select("fps"), parts, False).unionByName(by_part(member.select("hub"), parts, True))
        screen = self.spark.sparkContext.broadcast(self.prescreen(keys, bits))
        posts = posted(lead, parts, False)
        stored = posted(self.reps, parts, True, screen, bits).unionByName(posts)
        cand, (n,) = counted(posts.groupBy("part").cogroup(stored.groupBy("part")).applyInArrow(lambda x, y: met(x, y, t), "item long, rec long").distinct(), owner, F.count("rec"))
        pairs = written(self._verified(cand, n, lead), owner)

        def positive(batches):
            for b in batches:
                yield b.filter(pa.array(sketch.held(screen.value, (hub_key(b.column(1).to_numpy().astype(np.int64)) & np.uint64(bits - 1)).astype(np.int64))))

        # hubs that an item sees: its own, those of similar classes of the batch, and what the history holds of them (rec)
        maybe = member.mapInArrow(positive, "item long, hub long")
        by_hub = self.hubs.withColumnRenamed("id", "rec").join(near(maybe, n_hubs), "hub").select("item", "hub", F.lit(False).alias("own"), "rec")
        cls = new.where("cls is not null").select(F.col("id").alias("item"), "cls")
        link = pairs.select("a", "b", "rec", "old").unionByName(pairs.where("not old").select(F.col("b").alias("a"), F.col("a").alias("b"), "rec", "old"))
        by_text = cls.join(link, F.col("cls") == F.col("a")).select("item", F.when(~F.col("old"), F.col("b")).alias("hub"), F.lit(False).alias("own"), F.when(F.col("old"), F.col("rec")).alias("rec"))
        plain = new.select(F.col("id").alias("item"), F.explode_outer(F.array_compact(F.array("page", "cls"))).alias("hub"), F.lit(True).alias("own"), F.lit(None).cast("long").alias("rec"))
        sees, (n,) = counted(plain.unionByName(by_hub).unionByName(by_text).groupBy("item", "hub").agg(F.max("own").alias("own"), F.min("rec").alias("rec")), owner, F.count("item"))
        screen.destroy()
        out = written(decided(sees) if n <= MOST_ROWS else self._in_rounds(sees), owner)
        self._admit(new, out.where("first_id is null").select(F.col("item").alias("id")), n_keys + n_hubs)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()  # else the batch's plans and shuffle files stay until the driver happens to collect its garbage
        return out

    def _in_rounds(self, sees: DataFrame) -> DataFrame:
        """``decided`` by joins, for batches of any size."""
        status = sees.groupBy("item").agg(F.min("rec").alias("rec")).withColumn("state", F.when(F.col("rec").isNotNull(), "case").otherwise("open"))
        sees = sees.where("hub is not null")
        while True:
            live = sees.where("own").join(status.where("state <> 'case'").select("item", "state"), "item")
            hubs = live.groupBy("hub").agg(F.min(F.when(F.col("state") == "accepted", F.col("item"))).alias("acc"), F.min(F.when(F.col("state") == "open", F.col("item"))).alias("und"))
            seen = sees.join(hubs, "hub").groupBy("item").agg(F.min("acc").alias("acc"), F.min("und").alias("und"))
            now = F.when(F.col("state") != "open", F.col("state")).when(F.col("acc") < F.col("item"), "case").when(F.col("und") < F.col("item"), "open").otherwise("accepted")
            status = written(status.join(seen, "item", "left").select("item", "rec", now.alias("state")), self.owner)
            if status.where("state = 'open'").isEmpty():
                break
        acc = sees.where("own").join(status.where("state = 'accepted'").select("item"), "item").groupBy("hub").agg(F.min("item").alias("acc"))
        inside = sees.join(acc, "hub").where("acc < item").groupBy("item").agg(F.min("acc").alias("acc"))
        return status.join(inside, "item", "left").select("item", F.when(F.col("state") == "case", F.least("rec", "acc")).alias("first_id"))

    def _verified(self, cand: DataFrame, n: int, lead: DataFrame) -> DataFrame:
        """(a, b, rec, old) of the ``n`` candidates whose stored sets have similarity t or more: the item's class, the other's
        class and id, and whether that is of the history."""
        t = self.t

        def run(batches):
            for b in batches:
                ok = []
                for p, q, r, u in zip(*(b.column(c).to_pylist() for c in range(4, 8))):
                    x, y = np.sort(unpack40(p + q)), np.sort(unpack40(r + u))
                    both = common(x, y)
                    ok.append(both > 0 and both >= t * (len(x) + len(y) - both) - 1e-9)
                yield pa.RecordBatch.from_arrays(b.columns[:4], ["a", "b", "rec", "old"]).filter(pa.array(ok, pa.bool_()))

        recs = near(cand.select(F.col("rec").alias("id")).distinct(), n)
        other = lambda df, old: df.select(F.col("id").alias("rec"), F.col("cls").alias("b"), F.col("fps").alias("r"), F.col("rest").alias("u"), F.lit(old).alias("old"))
        every = other(self.reps.join(recs, "id", "left_semi"), True).unionByName(other(lead, False))
        both = cand.join(lead.select(F.col("id").alias("item"), F.col("cls").alias("a"), F.col("fps").alias("p"), F.col("rest").alias("q")), "item").join(every, "rec")
        return both.select("a", "b", "rec", "old", "p", "q", "r", "u").mapInArrow(run, "a long, b long, rec long, old boolean")

    def _admit(self, new: DataFrame, ids: DataFrame, keys: int) -> None:
        """Append the accepted items' keys as a layer, with filters of their own. Of equal texts one at most is accepted."""
        got = new.join(near(ids, keys), "id", "left_semi")
        more = got.where("cls is not null").dropDuplicates(["cls"]).select("id", *_NAMES)
        hubs = got.select("id", F.explode(F.array_compact(F.array("page", "cls"))).alias("hub")).groupBy("hub").agg(F.min("id").alias("id"))
        layer = {"reps": self._put(more, "reps"), "hubs": self._put(hubs, "hubs")}
        own = self.spark.read.schema(_KEYED).parquet(f"{self.folder}/{layer['reps']}")
        own_hubs = self.spark.read.schema("hub long, id long").parquet(f"{self.folder}/{layer['hubs']}")
        self.s["layers"].append(layer)
        self.s["keys"] += keys
        if self.s["keys"] > 2 * max(1, self.s["keys_filtered"]) or len(self.s["filters"]) >= LAYERS:
            self._filter_anew()
            return
        self.s["filters"].append(self._put(self._filters(own, own_hubs, keys), "filters"))
        self._save()


def scratch_store(spark: SparkSession, name: str) -> str:
    """A folder for a store of this session only."""
    return f"{shared_dir(spark)}/newsloom-{name}-{uuid.uuid4().hex}"
