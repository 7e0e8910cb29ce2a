"""Main content of pages by consensus of their host.

Each page's text blocks carry generalised tag-class paths (numbers replaced). A page scores every path
by the letters of its sentence-like text outside links and votes for the best. Votes are summed by
host in Spark, each task's first, so a host with a third of all pages is no hot key. A host's winning
paths are those that a fifth of its pages vote for, and long-text paths in the same container. Pages
are then read again by the winning paths; a line of an extract is kept if its block lies on one.
A page without a block on a winning path (a layout that few of the host's pages have) is read by its own
best path, and sentence paths in the same container, apart from what most of the host's pages have.

Lines are found in the page exactly, then by their letters, then by their ASCII letters (so a line
garbled on one side is still found), then by their first or last letters; a line found nowhere is
body. Cases: null page -> its lines are judged by the host's lines of known path, else body; null
text -> no lines; a title (first line, or the page's heading) is kept; empty lines are not rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.pagetext import blocks, squeeze
from newsloom.runtime import ship, written

SHARE, LONG, MOST = 0.2, 120, 0.5
_LETTERS, _ASCII = re.compile(r"[\W\d_]+"), re.compile("[^a-z]+")
_END = frozenset(".!?…»”“\"’")
_TITLE = ("title", "h1")


def is_title(path: str) -> bool:
    return path.rpartition(">")[2].split(".")[0] in _TITLE


def scores(bs: list[tuple[str, str, int]]) -> dict[str, list[int]]:
    """path -> [blocks, characters, characters of sentences outside links, sentences]."""
    out: dict[str, list[int]] = {}
    for path, text, linked in bs:
        s = out.setdefault(path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        if not is_title(path) and text[-1] in _END and linked * 2 < len(text) and len(text) >= 40:
            s[2] += len(text)
            s[3] += 1
    return out


def letters(s: str) -> str:
    return _LETTERS.sub("", s.lower())


class Page:
    """Blocks of one page, to look lines up in."""

    def __init__(self, bs: list[tuple[str, str, int]]):
        self.exact: dict[str, list[str]] = {}
        self.bs = bs
        for path, text, _ in bs:
            self.exact.setdefault(text, []).append(path)
        self._near = None

    def near(self):
        if self._near is None:
            found = []
            for form in (letters, lambda x: _ASCII.sub("", x.lower())):
                by: dict[str, list[str]] = {}
                joined, at, paths = [], [], []
                n = 0
                for path, text, _ in self.bs:
                    f = form(text)
                    if f:
                        by.setdefault(f, []).append(path)
                        joined.append(f), at.append(n), paths.append(path)
                        n += len(f)
                found.append((form, by, "".join(joined), at, paths))
            self._near = found
        return self._near

    def paths(self, line: str) -> list[str]:
        """The paths a line may come from, best first; empty if it isn't in the page."""
        if got := self.exact.get(line):
            return got
        for least, (form, by, joined, at, paths) in zip((1, 4), self.near()):
            f = form(line)
            if len(f) < least:
                continue
            if got := by.get(f):
                return got
            if len(f) >= 8:
                k = joined.find(f)
                if k >= 0:
                    return [paths[bisect_right(at, k) - 1]]
            if len(f) >= 40:
                for piece, shift in ((f[:24], 0), (f[-24:], 24), (f[len(f) // 2 - 12 : len(f) // 2 + 12], 0)):
                    k = joined.find(piece)
                    if k >= 0:
                        return [paths[bisect_right(at, k) - 1]]
        return []


def read(page) -> list[tuple[str, str, int]]:
    return blocks(page if isinstance(page, str) else bytes(page).decode("utf_8", "replace"))


def surveyed(docs: DataFrame, owner: str) -> DataFrame:
    """One scan of (site, id, page, text): rows of path scores by site (id null), rows of
    lines, and rows of pages (line_no null): their paths, and ``own``, those with sentences, best first."""
    ship(docs.sparkSession)
    schema = "site long, path string, pages long, votes long, blocks long, chars long, good long, id long, line_no int, paths array<string>, line long, own array<string>"

    def run(batches):
        for b in batches:
            total: dict[tuple, list[int]] = {}
            c: list[list] = [[] for _ in range(6)]
            for site, i, page, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                bs = read(page) if page is not None else []
                sc = scores(bs)
                best = max(sc, key=lambda p: (sc[p][2], p), default=None)
                for path, s in sc.items():
                    t = total.setdefault((site, path), [0] * 5)
                    for k, v in enumerate((1, int(path == best and s[2] > 0), s[0], s[1], s[2])):
                        t[k] += v
                if i is not None and bs:
                    good = sorted((x for x in sc if sc[x][2] > 0), key=lambda x: (sc[x][2], x), reverse=True)
                    for col, v in zip(c, (site, i, None, list(sc), None, good)):
                        col.append(v)
                if text is None or i is None:
                    continue
                look = Page(bs)
                for k, line in enumerate(text.split("\n")):
                    if k and (x := squeeze(line)):
                        got = look.paths(x) if bs else []
                        for col, v in zip(c, (site, i, k, got or None, xxhash.xxh3_64_intdigest(letters(x)) >> 1, None)):
                            col.append(v)
            n, m = len(total), len(c[0])
            keys, vals = list(total), list(total.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys] + c[0], pa.int64()),
                    pa.array([k[1] for k in keys] + [None] * m, pa.string()),
                    *(pa.array([v[j] for v in vals] + [None] * m, pa.int64()) for j in range(5)),
                    pa.array([None] * n + c[1], pa.int64()),
                    pa.array([None] * n + c[2], pa.int32()),
                    pa.array([None] * n + c[3], pa.list_(pa.string())),
                    pa.array([None] * n + c[4], pa.int64()),
                    pa.array([None] * n + c[5], pa.list_(pa.string())),
                ],
                ["site", "path", "pages", "votes", "blocks", "chars", "good", "id", "line_no", "paths", "line", "own"],
            )

    return written(docs.select("site", "id", "page", "text").mapInArrow(run, schema), owner)


def winners(survey: DataFrame) -> DataFrame:
    """(site, win, usual): each host's winning paths (null if it has none), and the others that most of its pages have."""
    p = survey.where("id is null").groupBy("site", "path").agg(*(F.sum(c).alias(c) for c in ("pages", "votes", "blocks", "chars", "good")))
    n = p.groupBy("site").agg(F.sum("votes").alias("cast"), F.max_by("path", F.struct("votes", "good", "path")).alias("best"), F.max("pages").alias("top"))
    p = p.join(n, "site").where("cast > 0")
    inside = F.regexp_replace("best", ">[^>]*$", "")
    voted = F.col("votes") >= SHARE * F.col("cast")
    beside = F.startswith("path", F.concat(inside, F.lit(">"))) & (F.col("blocks") >= 5) & (F.col("chars") >= LONG * F.col("blocks")) & (F.col("good") >= 0.6 * F.col("chars"))
    usual = ~(voted | beside) & (F.col("pages") > MOST * F.col("top"))
    w = p.groupBy("site").agg(F.sort_array(F.collect_set(F.when(voted | beside, F.col("path")))).alias("win"), F.collect_set(F.when(usual, F.col("path"))).alias("usual"))
    return w.withColumn("win", F.when(F.size("win") > 0, F.col("win")))


def alone(survey: DataFrame, win: DataFrame) -> DataFrame:
    """(site, id, mine): the paths of the pages that have no block on a winning path of their host."""
    p = survey.where("id is not null and line_no is null").select("site", "id", "paths", "own").join(win, "site")
    p = p.where(F.col("win").isNull() | ~F.arrays_overlap("paths", "win"))
    p = p.withColumn("own", F.filter("own", lambda x: ~F.array_contains("usual", x))).where(F.size("own") > 0)
    inside = F.concat(F.regexp_replace(F.col("own")[0], ">[^>]*$", ""), F.lit(">"))
    p = p.withColumn("inside", inside).groupBy("site", "id").agg(F.min_by(F.struct("own", "inside"), "own").alias("r")).select("site", "id", "r.*")
    return p.select("site", "id", F.filter("own", lambda x: F.startswith(x, F.col("inside"))).alias("mine"))


def unwanted_lines(survey: DataFrame) -> DataFrame:
    """(id, line_no) of the lines that are neither title nor body."""
    win = winners(survey)
    lines = survey.where("line_no is not null").select("site", "id", "line_no", "paths", "line").join(win, "site", "left")
    lines = lines.join(alone(survey, win), ["site", "id"], "left").withColumn("win", F.coalesce("mine", "win"))
    title = F.exists("paths", lambda p: F.regexp_extract(p, r"([a-z0-9]+)[^>]*$", 1).isin(*_TITLE))
    body = F.col("win").isNull() | F.arrays_overlap("paths", "win") | title
    dropped = lines.where("paths is not null").where(~body).select("site", "id", "line_no", "line")
    # lines found in no page: by the same host's lines that were, letter for letter
    adrift = lines.where("paths is null").select("site", "id", "line_no", "line")
    same = adrift.join(dropped.select("site", "line").distinct(), ["site", "line"], "left_semi")
    return dropped.select("id", "line_no").unionByName(same.select("id", "line_no")).distinct()


def bodies(docs: DataFrame, survey: DataFrame) -> DataFrame:
    """(id, title, body, blocks) of each page of (site, id, page), read by the host's winning paths or else its own."""

    def run(batches):
        for b in batches:
            titles, texts, n = [], [], []
            for page, win in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = set(win or ())
                bs = read(page)
                heads = [t for p, t, _ in bs if p.rpartition(">")[2].split(".")[0] == "h1"] or [t for p, t, _ in bs if is_title(p)]
                kept = [t for p, t, _ in bs if p in own]
                titles.append(heads[0] if heads else None), texts.append("\n".join(kept)), n.append(len(kept))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(titles, pa.string()), pa.array(texts, pa.string()), pa.array(n, pa.int32())], ["id", "title", "body", "blocks"])

    win = winners(survey)
    src = docs.where(F.col("page").isNotNull()).join(win, "site", "left").join(alone(survey, win), ["site", "id"], "left").select("id", "page", F.coalesce("mine", "win").alias("win"))
    return src.mapInArrow(run, "id long, title string, body string, blocks int")
