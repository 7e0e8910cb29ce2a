"""Records as XML and JSON, archive files by size and age, look-up, access lists and search."""

from __future__ import annotations

import gzip
import os
import re
import uuid
from urllib.parse import quote, unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions.text import mark_paras, xml_escape
from newsloom.functions.times import iso_utc
from newsloom.runtime import ship, shuffle_parts

LIMIT, AGE_S = 10 * 1024 * 1024, 1800
HEADER, FOOTER = '<?xml version="1.0" encoding="UTF-8"?>\n<article-set format-version="4.0">', "</article-set>"


def element(name: str, c: Column) -> Column:
    """<name>value</name>, or null (left out by concat_ws) where there is no value."""
    return F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>")))


def article_xml(r: DataFrame) -> Column:
    """The record of columns id, hostname, name, feed_title, feed_url, url, published, retrieved, lang, title, cleartext as XML."""
    x = lambda n: xml_escape(F.col(n))
    return F.concat_ws(
        "\n", F.concat(F.lit('<article id="'), F.col("id").cast("string"), F.lit('">')),
        F.concat(F.lit("<source>"), F.coalesce(element("name", x("name")), F.lit("")), F.coalesce(element("hostname", x("hostname")), F.lit("")), F.lit("</source>")),
        F.concat(F.lit("<feed>"), F.coalesce(element("title", x("feed_title")), F.lit("")), F.coalesce(element("uri", x("feed_url")), F.lit("")), F.lit("</feed>")),
        element("uri", x("url")), element("publish-date", iso_utc(F.col("published"))), element("retrieved-date", iso_utc(F.col("retrieved"))), element("lang", x("lang")),
        element("title", x("title")), element("body-cleartext", mark_paras(F.col("cleartext"))), F.lit("</article>"),
    )


def rotated(records: DataFrame, limit: int = LIMIT, age_s: int = AGE_S) -> DataFrame:
    """Records (acl, id, at, bytes) with the archive file each goes to: files are cut by age, and within an
    age window by size. Windows bound what one task sorts, whatever a tag's volume."""
    slot = F.floor(F.unix_timestamp("at") / age_s)
    w = Window.partitionBy("acl", "slot").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(w), F.lit(0))
    return records.withColumn("slot", slot).withColumn("part", F.floor(before / limit))


def _folder(spark: SparkSession, path: str) -> tuple:
    """A path's file system, the path as that system writes it, and its name in the file tree (null where it is in none)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    p = fs.makeQualified(p)
    return fs, p, p.toUri().getPath() if p.toUri().getScheme() == "file" else None


def _put(folder: str, acl: bytes | None, slot: int | None, part: int | None, lines: list) -> None:
    """One archive file, whole or not at all. 48 windows (of half an hour: a day) share a folder."""
    folder = f"{folder}/{'acl' if acl is None else 'acl=' + quote(acl, safe='')}/{'null' if slot is None else slot // 48}"
    os.makedirs(folder, exist_ok=True)
    new = f"{folder}/.{uuid.uuid4().hex}"
    with open(new, "wb") as f:
        f.write(gzip.compress(b"\n".join([HEADER.encode(), *lines, FOOTER.encode(), b""]), 6, mtime=0))
    os.replace(new, f"{folder}/{'null' if slot is None else slot}_{'null' if part is None else part}.xml.gz")


def write_archive(records: DataFrame, path: str) -> None:
    """One compressed file for each access tag, window and part of records (acl, slot, part, id, xml), in order of id within
    HEADER and FOOTER. The files of one part meet in one task, which the size limit of a part bounds; written anew each time.
    In a file tree the tasks write the files themselves, beside the old archive, whose place they take when all are there:
    Spark's writer starts several processes for each file there (permissions). Elsewhere Spark's writer is used."""
    keys, spark = ["acl", "slot", "part"], records.sparkSession
    fs, at, folder = _folder(spark, path)
    if folder is None:
        rows = records.select(*keys, F.lit(1).alias("o"), "id", F.col("xml").alias("value"))
        ends = records.select(*keys).distinct().select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("o"), F.lit(HEADER).alias("value")), F.struct(F.lit(2).alias("o"), F.lit(FOOTER).alias("value")))).alias("e"))
        every = rows.unionByName(ends.select(*keys, "e.o", F.lit(None).cast("long").alias("id"), "e.value"))
        every.repartition(*keys).sortWithinPartitions(*keys, "o", "id").select(*keys, "value").write.mode("overwrite").partitionBy(*keys).option("compression", "gzip").text(path)
        return
    ship(spark)
    new = at.suffix(".new")
    folder = new.toUri().getPath()
    fs.delete(new, True)
    fs.mkdirs(new)

    def run(batches):
        files, key, lines = 0, None, []
        for b in batches:
            for *now, xml in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != key:
                    if key is not None:
                        _put(folder, *key, lines)
                    files, key, lines = files + 1, now, []
                lines.append(xml or b"")
        if key is not None:
            _put(folder, *key, lines)
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])

    rows = records.repartition(shuffle_parts(spark), *keys).sortWithinPartitions(*keys, "id")
    rows.select(F.col("acl").cast("binary"), F.col("slot").cast("long"), F.col("part").cast("long"), F.col("xml").cast("binary")).mapInArrow(run, "files long").agg(F.sum("files")).collect()
    fs.delete(at, True)
    fs.rename(new, at)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(acl, slot, part, value): the lines of the files that ``write_archive`` left. In a file tree the tasks list the folders
    of days and read them, so the driver knows no files."""
    folder = _folder(spark, path)[2]
    if folder is None:
        return spark.read.text(path).select("acl", F.col("slot").cast("long").alias("slot"), F.col("part").cast("long").alias("part"), "value")
    ship(spark)
    days = [(f"{acl.name}/{day}",) for acl in os.scandir(folder) for day in os.listdir(acl.path)]

    def run(batches):
        number = lambda x: None if x == "null" else int(x)
        for b in batches:
            for day in b.column(0).to_pylist():
                tag = day.split("/")[0]
                acl, out, size = unquote_to_bytes(tag[4:]) if tag != "acl" else None, [], 0
                for file in os.listdir(f"{folder}/{day}"):
                    if not file.endswith(".xml.gz"):
                        continue
                    with open(f"{folder}/{day}/{file}", "rb") as f:
                        text = gzip.decompress(f.read())
                    lines = re.split(rb"\r\n|\n|\r", text) if b"\r" in text else text.split(b"\n")
                    slot, part = map(number, file[:-7].split("_"))
                    out += [(acl, slot, part, x) for x in lines[: len(lines) - (not lines[-1])]]
                    size += len(text)
                    if size > 2**22:
                        yield table(out)
                        out, size = [], 0
                yield table(out)

    def table(out):
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out) if out else [[]] * 4, kinds, strict=True)], ["acl", "slot", "part", "value"])

    got = spark.createDataFrame(days, "day string").repartition(shuffle_parts(spark)).mapInArrow(run, "acl binary, slot long, part long, value binary")
    return got.select(F.col("acl").cast("string").alias("acl"), "slot", "part", F.col("value").cast("string").alias("value"))


def next_file(files: DataFrame, after: str | None) -> DataFrame:
    """The oldest file (acl, file) strictly newer than ``after``, or the newest, of each tag."""
    if after is None:
        return files.groupBy("acl").agg(F.max("file").alias("file"))
    return files.where(F.col("file") > after).groupBy("acl").agg(F.min("file").alias("file"))


def grants(lines: DataFrame) -> DataFrame:
    """(user, acl) of password-file lines (line_no, line): a '#acl' line grants its tags to the user above; all have 'public'."""
    w = Window.orderBy("line_no")  # one password file: bounded configuration
    n = lines.withColumn("after", F.lead("line").over(w)).where(F.col("line").rlike(r"^[^#:\s]+:"))
    tags = F.when(F.startswith("after", F.lit("#acl")), F.split(F.trim(F.regexp_replace("after", "^#acl", "")), r"[\s,]+")).otherwise(F.array().cast("array<string>"))
    return n.select(F.split_part("line", F.lit(":"), F.lit(1)).alias("user"), F.explode(F.array_distinct(F.concat(tags, F.array(F.lit("public"))))).alias("acl")).where("acl <> ''")


def tokens(c: Column) -> Column:
    return F.split(F.lower(c), r"[^\p{L}\p{Nd}]+")


def search(articles: DataFrame, q: str = "", title: str = "", body: str = "", lang: str | None = None, host: str | None = None, day: str | None = None, url: str | None = None, classes: list[str] | None = None, offset: int = 0, page: int = 100) -> DataFrame:
    """Articles that hold all words of q in title or body, of ``title`` in the title, of ``body`` in the body, whose ``url`` has a part
    and that are of one of the access ``classes`` (columns url and acl are needed only then); newest first."""
    out = articles.withColumn("tw", tokens(F.coalesce("title", F.lit("")))).withColumn("bw", tokens(F.coalesce("cleartext", F.lit(""))))
    for w in q.lower().split():
        out = out.where(F.array_contains("tw", w) | F.array_contains("bw", w))
    for w in title.lower().split():
        out = out.where(F.array_contains("tw", w))
    for w in body.lower().split():
        out = out.where(F.array_contains("bw", w))
    for name, v in (("lang", lang), ("hostname", host)):
        if v is not None:
            out = out.where(F.col(name) == v)
    if url is not None:
        out = out.where(F.contains(F.lower("url"), F.lit(url.lower())))
    if classes is not None:
        out = out.where(F.arrays_overlap("acl", F.array(*map(F.lit, classes))))
    if day is not None:
        out = out.where(F.to_date("found") == F.lit(day).cast("date"))
    return out.drop("tw", "bw").orderBy(F.desc("found"), F.desc("id")).offset(offset).limit(page)


def json_search(articles: DataFrame, query: dict) -> DataFrame:
    """A search given as a dictionary: keys Title, Body, Lang, Host, Date, each optional."""
    return search(articles, title=query.get("Title", ""), body=query.get("Body", ""), lang=query.get("Lang"), host=query.get("Host"), day=query.get("Date"))
