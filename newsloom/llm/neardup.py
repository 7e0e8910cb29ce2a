"""Near-duplicate texts: an exact set-similarity self-join over word shingles.

1. *Sign.* Each text becomes a set of hashed shingles. Texts with equal sets fall into one class.
   A sketch of fixed size counts all shingles of the corpus by hashed bucket; rare comes first.
2. *Tile.* By the prefix principle two sets of similarity t share one of the |x| - ceil(t|x|) + 1
   first shingles in any fixed order, so each class is posted under these alone, with its place: if the
   first shingle two sets share comes i-th of x, they share |x| - i + 1 at most, which limits |y|. The
   postings of one shingle form a tile, sorted by size; two meet only if each one's place allows the
   other's size. Those compare hashed bitmap signatures (each shingle flips one bit; width grows with
   the size band, a factor 2): the number of differing bits bounds the symmetric difference from below,
   hence the overlap from above.
3. *Verify.* Pairs that pass are checked by exact intersection of the sorted arrays.

No step drops a pair of similarity t or more. Shingles counted more than ``HOT`` times are salted
into bounded sub-tiles. Cases: null or short texts (fewer words than ``least_words``) have no pairs;
repeated (id, text) rows count once; equal texts are pairs with each other; order never matters.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import sketch
from newsloom.llm.words import common, mix, shingle_sets, shingles, word_hashes
from newsloom.runtime import ship, written

BUCKETS, CHUNKS = 1 << 21, 16
HOT = 20_000
PER_PART = 1_000_000
AT_ONCE = 1_000_000  # pairs of postings looked at together
WORDS = 1 << 20  # words of the bitmaps compared together


def _band(n: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1


def width(band: int) -> int:
    """Bits of a stored signature in a size band: four to eight for each shingle; within a band half of them are compared."""
    return max(256, 1 << (band + 3))


def bitmaps(h: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Parity bitmaps of many sets, each as wide as its band asks."""
    n = np.diff(begin)
    band = _band(n)
    out: list = [None] * len(n)
    for b in np.unique(band):
        bits = width(int(b))
        docs = np.flatnonzero(band == b)
        for lo in range(0, len(docs), 2048):
            some = docs[lo : lo + 2048]
            at = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in some])
            row = np.repeat(np.arange(len(some)), n[some])
            bit = row * bits + ((h[at] >> np.uint64(8)) & np.uint64(bits - 1)).astype(np.int64)
            packed = np.packbits((np.bincount(bit, minlength=len(some) * bits) & 1).astype(np.uint8), bitorder="little").reshape(len(some), -1)
            for d, x in zip(some, packed):
                out[d] = x.tobytes()
    return out


def class_hash(s: np.ndarray) -> int:
    v = xxhash.xxh3_64_intdigest(s.tobytes())
    return v - (1 << 64) if v >> 63 else v


_SIGNED = f"id long, cls long, n int, {sketch.SCHEMA}"


def sign(docs: DataFrame, k: int, least_words: int) -> DataFrame:
    """Rows (id, cls, n) for each text, and rows (task, chunk, blob) of the shingle counts of each task."""

    def run(batches):
        counts = np.zeros(BUCKETS, np.uint64)
        for b in batches:
            rows, begin, h = shingle_sets(b.column(1).to_pylist(), k, least_words)
            ids = b.column(0).take(pa.array(rows))
            cls = [class_hash(h[a:z]) for a, z in zip(begin[:-1].tolist(), begin[1:].tolist())]
            counts += np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS).astype(np.uint64)
            m = len(ids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cls, pa.int64()), pa.array(np.diff(begin).astype(np.int32)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], ["id", "cls", "n", "task", "chunk", "blob"])
        if counts.any():
            own = sketch.blobs(counts, CHUNKS)
            yield pa.RecordBatch.from_arrays([pa.nulls(CHUNKS, pa.int64()), pa.nulls(CHUNKS, pa.int64()), pa.nulls(CHUNKS, pa.int32()), *own.columns], ["id", "cls", "n", "task", "chunk", "blob"])

    return docs.where(F.col("text").isNotNull()).select("id", "text").mapInArrow(run, _SIGNED)


def rarity(signed: DataFrame) -> np.ndarray:
    """Corpus counts by bucket: BUCKETS integers, a size that doesn't grow with the data. Only an order is made of them."""
    total = sketch.summed(signed.where("chunk is not null").select("task", "chunk", "blob"), CHUNKS, BUCKETS)
    return np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted 40-bit keys: differences, by byte planes, compressed."""
    d = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :5]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.T).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    d = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(5, -1)
    out = np.zeros((d.shape[1], 8), np.uint8)
    out[:, :5] = d.T
    return np.cumsum(out.reshape(-1).view(np.uint64))


_POST = "part int, keys binary, at binary, place binary, cls binary, n binary, bits binary"


def postings(docs: DataFrame, k: int, t: float, least_words: int, order, parts: int) -> DataFrame:
    """Packed postings of the texts of each batch, one row for each part of the key space."""

    def run(batches):
        rare = order.value
        for b in (x.slice(k0, 16_384) for x in batches for k0 in range(0, x.num_rows, 16_384)):
            _, begin, h = shingle_sets(b.column(0).to_pylist(), k, least_words)
            f = rare[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
            rank = f.astype(np.uint64) << np.uint64(32) | (h >> np.uint64(32))
            seen: dict[int, int] = {}
            keys, doc, at_place = [], [], []
            for d, (lo, hi) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
                c = class_hash(h[lo:hi])
                if c in seen:
                    continue
                seen[c] = d
                n = hi - lo
                p = min(n, n - math.ceil(t * n - 1e-9) + 1)
                first = lo + np.argsort(rank[lo:hi], kind="stable")[:p]  # equal ranks stay in the order of the hashes, the same in every text
                place = np.arange(p) * 256 // p
                key, often = h[first], f[first]
                if often[-1] > HOT:
                    plain = often <= HOT
                    own, places = [key[plain]], [place[plain]]
                    for x, m, i in zip(key[~plain], often[~plain], place[~plain]):
                        salts = -(-int(m) // HOT)
                        mine = c % salts
                        tiles = [(min(mine, y) * salts + max(mine, y)) for y in range(salts)]
                        own.append(mix(np.array(tiles, np.uint64) ^ x)), places.append(np.full(salts, i))
                    key, place = np.concatenate(own), np.concatenate(places)
                keys.append(key), doc.append(np.full(len(key), len(seen) - 1, np.uint16)), at_place.append(place.astype(np.uint8))
            if not seen:
                continue
            mine = np.array(list(seen.values()))
            every = bitmaps(h, begin)
            bits = [every[d] for d in mine]
            key, idx, place = np.concatenate(keys) >> np.uint64(24), np.concatenate(doc), np.concatenate(at_place)
            o = np.argsort(key, kind="stable")
            key, idx, place = key[o], idx[o], place[o]
            part = ((key * np.uint64(parts)) >> np.uint64(40)).astype(np.int64)
            cls = np.fromiter(seen, np.int64, len(seen))
            n = np.diff(begin)[mine].astype(np.int32)
            edge = np.searchsorted(part, np.arange(parts + 1))
            cols: list[list] = [[], [], [], [], [], [], []]
            for q in range(parts):
                lo, hi = edge[q], edge[q + 1]
                if lo == hi:
                    continue
                used, local = np.unique(idx[lo:hi], return_inverse=True)
                for col, v in zip(cols, (q, _pack(key[lo:hi]), local.astype(np.uint16).tobytes(), place[lo:hi].tobytes(), cls[used].tobytes(), n[used].tobytes(), b"".join(bits[u] for u in used))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(x, pa.binary()) for x in cols[1:])], ["part", "keys", "at", "place", "cls", "n", "bits"])

    return docs.where(F.col("text").isNotNull()).select("text").mapInArrow(run, _POST)


def limits(n: np.ndarray, place: np.ndarray, t: float) -> np.ndarray:
    """The largest size of a set similar to one of size n if the first shingle they share comes at this place (256ths of the prefix, rounded down) or later."""
    p = np.minimum(n, n - np.ceil(t * n - 1e-9).astype(np.int64) + 1)
    i = -(-place.astype(np.int64) * p // 256)
    return np.floor((n - i) * ((1 + t) / t) - n + 1e-6).astype(np.int64)


def tile(table: pa.Table, t: float) -> pa.Table:
    """Pairs of classes in one part whose places and bitmaps allow similarity t."""
    keys, cls, ns, words, doc, place = [], [], [], [], [], []
    base = 0
    for kb, ab, pb, cb, nb, bb in zip(*(table.column(c).to_pylist() for c in ("keys", "at", "place", "cls", "n", "bits"))):
        c, n = np.frombuffer(cb, np.int64), np.frombuffer(nb, np.int32)
        keys.append(_unpack(kb)), doc.append(np.frombuffer(ab, np.uint16).astype(np.int64) + base), place.append(np.frombuffer(pb, np.uint8))
        cls.append(c), ns.append(n), words.append(np.frombuffer(bb, np.uint64))
        base += len(c)
    key, doc, n = np.concatenate(keys), np.concatenate(doc), np.concatenate(ns).astype(np.int64)
    size = np.array([width(x) // 64 for x in range(40)])[_band(n)]
    start = np.cumsum(size) - size
    flat = np.concatenate(words)
    # one row for a class, from whichever batch, numbered by size
    cls, first, same = np.unique(np.concatenate(cls), return_index=True, return_inverse=True)
    by_size = np.argsort(n[first], kind="stable")
    cls, first, number = cls[by_size], first[by_size], np.empty(len(by_size), np.int64)
    number[by_size] = np.arange(len(by_size))
    n, start, doc = n[first], start[first], number[same[doc]]
    band = _band(n).astype(np.int8)
    upto = np.cumsum(np.bincount(n))[np.minimum(limits(n[doc], np.concatenate(place), t), n[-1])]  # the classes of a size that the place allows come before this
    bits = np.uint64(len(cls).bit_length())
    code = (key - key.min()) << bits | doc.astype(np.uint64)  # a part spans a twelfth of the 40-bit keys at most
    o = np.argsort(code)
    code = code[o]
    head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    code, upto = code[head], np.maximum.reduceat(upto[o], head)
    key, doc = code >> bits, (code & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found: list[np.ndarray] = []
    total = np.int64(len(cls))
    ratio = (1 - t) / (1 + t)  # |x ^ y| <= ratio * (|x| + |y|) for similar pairs
    folded: dict[tuple[int, int], np.ndarray] = {}

    def bitrows(b: int, to: int) -> np.ndarray:
        """The bitmaps of a band's classes, folded to so many words."""
        if (b, to) not in folded:
            m = flat[start[band == b][:, None] + np.arange(width(b) // 64)]
            while m.shape[1] > to:
                h = m.shape[1] // 2
                m = m[:, :h] ^ m[:, h:]
            folded[b, to] = m
        return folded[b, to]

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Codes of the pairs, x the smaller, whose bitmaps allow similarity t."""
        out = [np.empty(0, np.int64)]
        kind = band[x].astype(np.int16) << 8 | band[y]
        for b, c in zip(*divmod(np.flatnonzero(np.bincount(kind)), 256)):
            at = np.flatnonzero(kind == (b << 8 | c))
            to = max(4, width(int(b)) // 128) if b == c else width(int(b)) // 64
            mx, my, bx, by = bitrows(int(b), to), bitrows(int(c), to), np.searchsorted(band, b), np.searchsorted(band, c)
            step = max(1, WORDS // to)
            for lo in range(0, len(at), step):
                p, q = x[at[lo : lo + step]], y[at[lo : lo + step]]
                diff = np.bitwise_count(mx[p - bx] ^ my[q - by]).sum(axis=1, dtype=np.int64)
                ok = diff <= ratio * (n[p] + n[q]) + 1e-9
                out.append(p[ok] * total + q[ok])
        return np.concatenate(out)

    # a posting meets the later ones of its key up to the size that its own place allows, if theirs allow it too
    some = np.flatnonzero((key[1:] == key[:-1]) & (upto[:-1] > doc[1:]))
    many = np.searchsorted(code, (key[some] << bits) + upto[some].astype(np.uint64)) - some - 1
    ends = np.cumsum(many)
    a = 0
    while a < len(some):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + AT_ONCE, side="right")))
        c = many[a:z]
        x = np.repeat(some[a:z], c)
        y = np.arange(len(x)) + np.repeat(some[a:z] + 1 - (np.cumsum(c) - c), c)
        ok = np.flatnonzero(upto[y] > doc[x])
        found.append(near(doc[x[ok]], doc[y[ok]]))
        a = z
    codes = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    a, z = cls[codes // total], cls[codes % total]
    return pa.table({"a": pa.array(np.minimum(a, z)), "b": pa.array(np.maximum(a, z))})


def _places(ids: pa.Array, bits: int) -> np.ndarray:
    return (mix(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(id, hashes) of the texts whose id is in ``wanted``. A bitmap sized by their number screens the scan, so that only
    their texts are made into sets; a join on the rest is exact. With more ids than a bitmap is made for, the texts are
    joined to them instead."""
    spark = docs.sparkSession
    ids = wanted.select("id").distinct()
    bits = sketch.bits_for(wanted.count(), 8)
    have = docs.where(F.col("text").isNotNull() & F.col("id").isNotNull()).select("id", "text")
    if not bits:
        have, screen = have.join(ids, "id", "left_semi"), None
    else:

        def place(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(_places(b.column(0), bits))], ["at"])

        screen = spark.sparkContext.broadcast(sketch.bitmap(wanted.select("id").mapInArrow(place, "at long"), bits))

    def run(batches):
        for b in batches:
            got = b if screen is None else b.take(pa.array(np.flatnonzero(sketch.held(screen.value, _places(b.column(0), bits)))))
            blobs = [np.unique(shingles(word_hashes(x), k)).tobytes() for x in got.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([got.column(0), pa.array(blobs, pa.binary())], ["id", "hashes"])

    found = have.mapInArrow(run, "id long, hashes binary")
    return found if screen is None else found.join(ids, "id", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame, left: str, right: str, t: float) -> DataFrame:
    """The pairs (left, right) of ids whose exact similarity is t or more."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = common(x, y)
                ok.append(both > 0 and both >= t * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], [left, right]).filter(pa.array(ok, pa.bool_()))

    x = sets.select(F.col("id").alias(left), F.col("hashes").alias("hx"))
    y = sets.select(F.col("id").alias(right), F.col("hashes").alias("hy"))
    return pairs.join(x, left).join(y, right).select(left, right, "hx", "hy").mapInArrow(run, f"{left} long, {right} long")


def similar(docs: DataFrame, k: int = 5, t: float = 0.8, least_words: int = 1, owner: str = "neardup") -> tuple[DataFrame, DataFrame]:
    """(members: id, cls, n) and (links: a, b between different classes of similarity t or more)."""
    spark = docs.sparkSession
    ship(spark)
    signed = written(sign(docs, k, least_words), owner)
    members = signed.where("id is not null").select("id", "cls", "n").distinct()
    total = members.agg(F.sum("n")).first()[0] or 0
    order = spark.sparkContext.broadcast(rarity(signed))
    parts = max(12, math.ceil(total * (1 - t) / PER_PART))
    post = postings(docs, k, t, least_words, order, parts)
    cand = post.groupBy("part").applyInArrow(lambda x: tile(x, t), "a long, b long").distinct()
    cand = written(cand, owner)
    reps = members.groupBy("cls").agg(F.min("id").alias("id"))
    both = cand.select(F.col("a").alias("cls")).union(cand.select(F.col("b").alias("cls"))).distinct()
    wanted = written(reps.join(both, "cls"), owner)
    sets = sets_of(docs, wanted, k).dropDuplicates(["id"]).join(wanted, "id").select(F.col("cls").alias("id"), "hashes")
    return members, verified(cand, sets, "a", "b", t)


def pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """All similar pairs of ids, the smaller first: links between classes and copies within a class."""
    a = members.select(F.col("id").alias("x"), F.col("cls").alias("a"))
    b = members.select(F.col("id").alias("y"), F.col("cls").alias("b"))
    across = links.join(a, "a").join(b, "b").select("x", "y")
    within = a.join(b, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    return across.union(within).where("x <> y").select(F.least("x", "y").alias("first_id"), F.greatest("x", "y").alias("second_id")).distinct()


def classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """One row for each text: its class (least id with an equal set), copies in the class, links of the class."""
    c = members.groupBy("cls").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    n = links.select(F.col("a").alias("cls")).unionAll(links.select(F.col("b").alias("cls"))).groupBy("cls").agg(F.count("*").alias("links"))
    return members.join(c, "cls").join(n, "cls", "left").select("id", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))


def groups(edges: DataFrame, owner: str, a: str = "first_id", b: str = "second_id") -> DataFrame:
    """Connected groups (id, group_id = least id) by alternating star contractions; each round is a
    written table, so the number of rounds (logarithmic) never lengthens a lineage."""
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), owner)
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = written(large.join(small, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")).select("p.*").where("u <> v").distinct(), owner)
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return e.select(F.col("u").alias("id"), F.col("v").alias("group_id")).union(e.select(F.col("v").alias("id"), F.col("v").alias("group_id"))).distinct()
