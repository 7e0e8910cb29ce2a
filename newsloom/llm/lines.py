"""Text repeated over the documents of one source, found by content-defined chunks.

The normalised text (lower case, blanks collapsed, digit runs as '#') is cut where a rolling hash of the last WINDOW
bytes has its low bits zero, wherever lines end, so equal stretches give equal chunks wherever they lie. Chunks are
counted by distinct documents of each source; those repeated excessively are cut from the documents
(``without_chunks``).

*Lines.* Where whole lines are asked for (``repeated_lines``), the chunks that lie inside a line, cut by bytes of that
line alone, are the same wherever the line stands, so a line can only be repeated excessively if all of those are. A
bitmap of the excessive chunks, sized by their number, screens the lines; lines left, and those too short to hold a
chunk, are counted exactly. Chunks alone can't give the lines: one at a line's end also depends on the neighbour.

Counts are summed in each task before they are shuffled, so a source with a third of all documents is no hot key.
Cases: null text or source -> no lines; an empty line never counts; a line or chunk counts once for a document;
repeated documents count once; very long texts are cut whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import sketch
from newsloom.llm.words import mix
from newsloom.runtime import once, ship, written

WINDOW, AVERAGE = 8, 32
SLICE = 500  # texts taken at once: bounds a task's memory
MOST_KEYS = 2_000_000  # hashes (16 MB) that are broadcast; more are joined by a shuffle
_rng = np.random.Generator(np.random.PCG64(7))
GEAR = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
with np.errstate(over="ignore"):
    POWER = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))
_BLANKS, _DIGITS = re.compile("[ \t ]+"), re.compile("[0-9]+")
_EDGES = re.compile(" ?\n ?")


def normal(line: str) -> str:
    """A line as it is compared."""
    return _DIGITS.sub("#", _BLANKS.sub(" ", line.lower()).strip(" "))


def normal_text(text: str) -> str:
    """The text as it is compared, line for line."""
    return _EDGES.sub("\n", _DIGITS.sub("#", _BLANKS.sub(" ", text.lower())).strip(" "))


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of the text, first byte, bytes) of each chunk of many texts; first bytes count over all texts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    if not len(raw):
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    begin = (np.cumsum(size) - size)[size > 0]
    into = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        g = GEAR[raw]
        roll = g.copy()
        for j in range(1, WINDOW):
            roll[j:] += np.where(into[j:] >= j, g[:-j], np.uint64(0)) << np.uint64(j)
        starts = np.zeros(len(raw), bool)
        starts[1:] = ((roll[:-1] >> np.uint64(20)) & np.uint64(AVERAGE - 1)) == 0
        starts[begin] = True
        at = np.flatnonzero(starts)
        many = np.diff(np.append(at, len(raw)))
        inside = np.arange(len(raw)) - np.repeat(at, many)
        h = np.add.reduceat(VALUE[raw] * POWER[inside & (len(POWER) - 1)] + (inside >> 12).astype(np.uint64), at)
        return mix(h + many.astype(np.uint64)), np.repeat(np.arange(len(texts)), size)[at], at, many


def _sourced(site: np.ndarray, h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h ^ (site.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def _slices(batches):
    return (x.slice(lo, SLICE) for x in batches for lo in range(0, x.num_rows, SLICE))


def _ended(texts: list[str]) -> list[bytes]:
    return [normal_text(x).encode("utf_8", "surrogatepass") + b"\n" for x in texts]


def excessive_chunks(docs: DataFrame, least: int, share: float) -> DataFrame:
    """(site, chunk) of the chunks in at least ``least`` documents and ``share`` of a source's; ``docs`` has site and text."""

    def run(batches):
        for b in _slices(batches):
            site = b.column(0).to_numpy()
            h, doc, _, _ = chunks(_ended(b.column(1).to_pylist()))
            if not len(h):
                continue
            o = np.lexsort((h, doc))
            h, doc = h[o], doc[o]
            keep = np.ones(len(h), bool)
            keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            s, h = site[doc[keep]], h[keep]
            o = np.lexsort((h, s))
            s, h = s[o], h[o]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(s[at], pa.int64()), pa.array(h[at].view(np.int64)), pa.array(np.diff(np.append(at, len(h))).astype(np.int32))], ["site", "chunk", "n"])

    n = docs.select("site", "text").mapInArrow(run, "site long, chunk long, n int").groupBy("site", "chunk").agg(F.sum("n").alias("n"))
    # few of the counts reach ``least``, so those of the sources meet few rows
    return n.where(F.col("n") >= least).join(sizes(docs), "site").where(F.col("n") >= share * F.col("docs")).select("site", "chunk")


def sizes(docs: DataFrame) -> DataFrame:
    return docs.groupBy("site").agg(F.count("*").alias("docs"))


def with_sites(docs: DataFrame, sites: DataFrame, owner: str) -> DataFrame:
    """Documents (id, text) once each, with their source (id, site), as a written table."""
    one = once(docs.where(F.col("id").isNotNull() & F.col("text").isNotNull()).select("id", "text"), "id")
    return written(one.join(sites.where(F.col("site").isNotNull()).select("id", "site").distinct(), "id").select("site", "id", "text"), owner)


def repeated_lines(docs: DataFrame, owner: str, least: int = 5, share: float = 0.1) -> DataFrame:
    """(site, line, docs_with, docs) of the lines repeated excessively; ``docs`` has site, id, text."""
    spark = docs.sparkSession
    ship(spark)
    hot = written(excessive_chunks(docs, least, share), owner)
    bits = sketch.bits_for(hot.count())  # 0: more than a bitmap is made for, then all lines are counted

    def place(batches):
        for b in batches:
            h = _sourced(b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array((h & np.uint64(bits - 1)).astype(np.int64))], ["at"])

    screen = spark.sparkContext.broadcast(sketch.bitmap(hot.mapInArrow(place, "at long"), bits)) if bits else None

    def run(batches):
        for b in _slices(batches):
            site = b.column(0).to_numpy()
            texts = _ended(b.column(1).to_pylist())
            raw = np.frombuffer(b"".join(texts), np.uint8)
            ends = np.flatnonzero(raw == 10)
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            own = np.repeat(np.arange(len(texts)), size)[ends]
            good = np.ones(len(ends), bool)
            if screen is not None:
                h, doc, at, many = chunks(texts)
                line = np.searchsorted(ends, at)
                first = np.concatenate([[0], ends[:-1] + 1])
                inside = (at + many <= ends[line]) & (at - first[line] >= WINDOW)
                at = (_sourced(site[doc[inside]], h[inside]) & np.uint64(bits - 1)).astype(np.int64)
                good[line[inside][~sketch.held(screen.value, at)]] = False
            lines = b"".join(texts).split(b"\n")
            rows = {(int(own[i]), lines[i]) for i in np.flatnonzero(good).tolist() if lines[i]}
            t = pa.table({"site": pa.array(site[[d for d, _ in rows]] if rows else [], pa.int64()), "line": pa.array([x.decode("utf_8", "replace") for _, x in rows], pa.string()), "n": pa.array(np.ones(len(rows), np.int32))})
            t = t.group_by(["site", "line"]).aggregate([("n", "sum")])
            yield from pa.table({"site": t["site"], "line": t["line"], "n": pc.cast(t["n_sum"], pa.int32())}).combine_chunks().to_batches()

    n = docs.select("site", "text").mapInArrow(run, "site long, line string, n int").groupBy("site", "line").agg(F.sum("n").alias("docs_with"))
    return n.where(F.col("docs_with") >= least).join(sizes(docs), "site").where(F.col("docs_with") >= share * F.col("docs")).select("site", "line", "docs_with", "docs")


def _known(keys: DataFrame, spark) -> object | None:
    """A counted, sorted broadcast of hashes, or None where they are too many."""
    if keys.count() > MOST_KEYS:
        return None
    return spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in keys.collect()], np.int64)))


def _in(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    return known[at] == h


def without_chunks(docs: DataFrame, owner: str, least: int = 5, share: float = 0.1) -> DataFrame:
    """(id, content, chunks, cut, cut_bytes): each normalised text without its source's excessive chunks."""
    spark = docs.sparkSession
    ship(spark)

    def fold(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_sourced(b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)).view(np.int64))], ["key"])

    hot = written(excessive_chunks(docs, least, share).mapInArrow(fold, "key long"), owner)
    known = _known(hot, spark)

    def run(batches):
        for b in _slices(batches):
            site, raw = b.column(0).to_numpy(), _ended(b.column(2).to_pylist())
            h, doc, at, many = chunks(raw)
            key = _sourced(site[doc], h).view(np.int64)
            if known is not None:
                bad = _in(key, known.value)
            else:
                own = [frozenset(x or ()) for x in b.column(3).to_pylist()]
                bad = np.fromiter((k in own[d] for k, d in zip(key.tolist(), doc.tolist())), bool, len(key))
            whole, n = np.frombuffer(b"".join(raw), np.uint8), len(raw)
            size = np.fromiter(map(len, raw), np.int64, n)
            keep = np.repeat(~bad, many)
            text_of = np.repeat(np.arange(n), size)
            left = np.bincount(text_of[keep], minlength=n)
            parts = np.split(whole[keep], np.cumsum(left)[:-1]) if n else []
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([p.tobytes().decode("utf_8", "replace").removesuffix("\n") for p in parts], pa.string()), pa.array(np.bincount(doc, minlength=n).astype(np.int32)), pa.array(np.bincount(doc[bad], minlength=n).astype(np.int32)), pa.array((size - left).astype(np.int64))],
                ["id", "content", "chunks", "cut", "cut_bytes"],
            )

    src = docs.select("site", "id", "text")
    if known is None:  # each document's own excessive chunks, at most as many as it has chunks, come by a shuffle

        def own(batches):
            for b in _slices(batches):
                h, doc, _, _ = chunks(_ended(b.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(1).take(pa.array(doc)), pa.array(_sourced(b.column(0).to_numpy()[doc], h).view(np.int64))], ["id", "key"])

        mine = src.mapInArrow(own, "id long, key long").distinct().join(hot, "key", "left_semi").groupBy("id").agg(F.collect_set("key").alias("keys"))
        src = src.join(mine, "id", "left").select("site", "id", "text", "keys")
    return src.mapInArrow(run, "id long, content string, chunks int, cut int, cut_bytes long")


def line_key(site: int, line: str) -> int:
    v = xxhash.xxh3_64_intdigest(f"{site}\n{line}".encode("utf_8", "surrogatepass"))
    return v - (1 << 64) if v >> 63 else v


def without_lines(docs: DataFrame, lines: DataFrame, owner: str) -> DataFrame:
    """(id, content, cut): each text without its source's repeated lines, and how many were cut. The lines travel as
    hashes of (source, line): broadcast where their number was counted and is small, else joined line by line."""
    spark = docs.sparkSession
    ship(spark)

    def keys(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([line_key(s, x) for s, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], pa.int64())], ["key"])

    hot = written(lines.select("site", "line").mapInArrow(keys, "key long").distinct(), owner)
    known = _known(hot, spark)

    def cut(batches):
        for b in _slices(batches):
            out, n = [], []
            for s, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                own = text.split("\n")
                bad = _in(np.array([line_key(s, normal(x)) for x in own], np.int64), known.value)
                out.append("\n".join(x for x, k in zip(own, bad.tolist()) if not k)), n.append(int(bad.sum()))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(out, pa.string()), pa.array(n, pa.int32())], ["id", "content", "cut"])

    if known is not None:
        return docs.select("site", "id", "text").mapInArrow(cut, "id long, content string, cut int")

    def each(batches):
        for b in _slices(batches):
            for s, i, text in zip(*(c.to_pylist() for c in b.columns)):
                own = text.split("\n")
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(own), pa.int64()), pa.array(range(len(own)), pa.int32()), pa.array([line_key(s, normal(x)) for x in own], pa.int64()), pa.array(own, pa.string())], ["id", "no", "key", "own"])

    every = docs.select("site", "id", "text").mapInArrow(each, "id long, no int, key long, own string")
    marked = every.join(hot.withColumn("hot", F.lit(True)), "key", "left")
    # a text's own lines come together again: as many as it has
    got = marked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("no", "own", F.coalesce("hot", F.lit(False)).alias("hot")))).alias("rows"))
    return got.select("id", F.array_join(F.transform(F.filter("rows", lambda x: ~x["hot"]), lambda x: x["own"]), "\n").alias("content"), F.size(F.filter("rows", lambda x: x["hot"])).alias("cut"))
