"""Readers of plain files: address lists, trigram tables, script ranges, stop n-grams; declared table schemas and JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Schemas of the relational tables, for readers that don't carry one (CSV, JSON, JDBC casts).
SCHEMAS = {
    "site": "id long, hostname string, name string, tld string, tags array<string>, disabled boolean, locked boolean, next_request timestamp",
    "feed": "id long, siteid long, url string, regex string, disabled boolean, parse_unquote boolean, trust_level int, failures int, unchanged_iter int, effective_ttl int, next_scan timestamp, pruning_ts_last timestamp, pruning_mode string, found_total long, found_new long",
    "feed_ps": "feedid long, feedsiteid long, title string, description string, language string, copyright string, manual_title string, pub_date timestamp, published_ttl int, updated timestamp",
    "feed_article": "id long, siteid long, feedsiteid long, feedid long, publisher_siteid long, enqueued boolean, acl_tagset array<string>, found timestamp, next_attempt timestamp",
    "feed_article_urls": "seq int, fa_id long, fa_feed_id long, url string, ts timestamp",
    "feed_article_meta": "id long, title string, pub_date timestamp, tags array<string>, geo string, img string, is_utf8 string, is_cleartext string, lang_iso string, lang_altcode string, lang_is_cld boolean",
    "article": "feed_articleid long, http_code int, headers string, content binary, mimetype string, retrieved timestamp",
    "processed_article": "feed_articleid long, mode string, content string",
}


def typed(df: DataFrame, name: str) -> DataFrame:
    """A table's columns cast to its declared schema, in its order; missing ones are null, others are left out."""
    want = df.sparkSession.createDataFrame([], SCHEMAS[name]).schema
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in want))


def relational(spark: SparkSession, url: str, name: str, key: str = "id", parts: int = 32, bounds: tuple[int, int] | None = None, **options: str) -> DataFrame:
    """A table of a relational store over JDBC, read in ranges of its key where its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return typed(reader.load(), name) if name in SCHEMAS else reader.load()


def address_list(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """(line_no, url) of the lines of a text file from line ``skip`` on; blank lines and comments are passed over. A list is one
    file read in order, a bounded piece of configuration."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()).coalesce(1)
    n = F.row_number().over(Window.orderBy("line_no")) - 1
    out = lines.select(n.alias("line_no"), F.trim("value").alias("url"))
    return out.where((F.col("line_no") >= skip) & (F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def trigram_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(lang, gram, n) of files '<code>-3grams.txt' of lines 'count trigram', with the codes named by 'table.txt' (tab-separated:
    code, three-letter code, name). Blanks at a trigram's ends count; malformed lines are left out."""
    names = spark.read.csv(f"{folder}/table.txt", sep="\t", schema="code string, lang string, name string")
    rows = spark.read.text(f"{folder}/*-3grams.txt").withColumn("code", F.regexp_extract(F.input_file_name(), r"([^/]+)-3grams\.txt$", 1))
    cut = rows.select("code", F.regexp_extract("value", r"^\s*(\d+) ", 1).alias("n"), F.regexp_replace("value", r"^\s*\d+ ", "").alias("gram"))
    return cut.where("n <> '' and length(gram) = 3").join(F.broadcast(names), "code").select("lang", "gram", F.col("n").cast("long").alias("n"))  # one small file


def script_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(script, first, last) of lines 'XXXX..YYYY ; Script # ...'; neighbouring ranges of one script become one (gaps and islands)."""
    m = spark.read.text(path).select(F.regexp_extract("value", r"^([0-9A-Fa-f]{4,6})(?:\.\.([0-9A-Fa-f]{4,6}))?\s*;\s*(\w+)", 0).alias("m"), "value").where("m <> ''")
    part = lambda k: F.regexp_extract("m", r"^([0-9A-Fa-f]{4,6})(?:\.\.([0-9A-Fa-f]{4,6}))?\s*;\s*(\w+)", k)
    number = lambda c: F.conv(c, 16, 10).cast("int")
    r = m.select(part(3).alias("script"), number(part(1)).alias("first"), number(F.when(part(2) == "", part(1)).otherwise(part(2))).alias("last"))
    w = Window.partitionBy("script").orderBy("first", "last")
    before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("first") <= before + 1, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = r.withColumn("before", before)
    return r.withColumn("island", island).groupBy("script", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def script_of(chars: DataFrame, ranges: DataFrame, char: str = "char") -> DataFrame:
    """``chars`` with the script of each character, '#unknown#' outside all ranges. Ranges are split by their first byte, so
    the look-up is an equi-join with a residual condition, never a join of everything with everything."""
    blocks = ranges.withColumn("block", F.explode(F.sequence(F.shiftright("first", 8), F.shiftright("last", 8))))
    c = chars.withColumn("_code", F.ascii(F.col(char)))
    hit = (F.shiftright(c["_code"], 8) == blocks["block"]) & c["_code"].between(blocks["first"], blocks["last"])
    return c.join(blocks, hit, "left").select(*chars.columns, F.coalesce("script", F.lit("#unknown#")).alias("script"))


def stop_ngrams(spark: SparkSession, path: str) -> DataFrame:
    """(h) hashes of the stop n-grams of a text file, one to a line; blank lines are passed over."""
    return spark.read.text(path).where("trim(value) <> ''").select(ngram_hash(F.trim("value")).alias("h")).distinct()


def ngram_hash(c: Column) -> Column:
    return F.xxhash64(c)
