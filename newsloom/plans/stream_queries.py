"""Streaming stages driven over the test tables until their input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import arrays
from newsloom.plans.archive_queries import _FILES
from newsloom.plans.relational_queries import SQL_NOW, now
from newsloom.runtime import table
from newsloom.streaming import stages as S


def _stream(spark, d, name) -> DataFrame:
    path = f"{d}/{name}.parquet"
    return S.source(spark, path, spark.read.parquet(path).schema)


def stream_cutoff(spark, d) -> DataFrame:
    e = _stream(spark, d, "feed_article").select("feedid", "id", F.col("found").alias("at"))
    return S.run_once(S.after_cutoff(e), "cutoff").select("feedid", "id")


def stream_dedup(spark, d) -> DataFrame:
    """URLs as first met, within three months of event time."""
    u = _stream(spark, d, "feed_article_urls").select("url", F.col("ts").alias("at")).where("url is not null")
    return S.run_once(S.first_seen(u, "92 days"), "dedup").select("url").distinct()


def stream_unknown(spark, d) -> DataFrame:
    """Items' URLs that neither the stream nor the history has met."""
    u = _stream(spark, d, "batch_item").select("url", F.col("arrived").alias("at")).where("url is not null")
    return S.run_once(S.unknown(u, table(spark, d, "feed_article_urls").select("url")), "unknown").select("url").distinct()


def stream_fresh(spark, d) -> DataFrame:
    """Articles found within the week before now."""
    e = _stream(spark, d, "feed_article").select("id", F.col("found").alias("at"))
    return S.run_once(S.fresh_enough(e, now()), "fresh").select("id")


def stream_cleaned(spark, d) -> DataFrame:
    """Pages through the cleaning stage: text's size and language."""
    from newsloom.plans.text_queries import charset_of

    a = charset_of(_stream(spark, d, "article").where("content is not null"))
    return S.run_once(S.cleaned(a), "cleaned").select("id", F.length("text").alias("chars"), "lang").distinct()


def stream_rotated(spark, d) -> DataFrame:
    """Records of a stream with the archive file each goes to, by age and size within its batch; each batch writes its own parts."""
    from newsloom.operators import archive as A

    t = _stream(spark, d, "processed_article").where("mode = 'cleartext' and content is not null").select(F.col("feed_articleid").alias("id"), F.octet_length("content").alias("bytes"))
    fa = table(spark, d, "feed_article").select("id", F.col("found").alias("at"), F.explode(arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string"))).alias("acl"))
    out = S.run_once(S.with_static(t, fa, "id"), "rotated", each=lambda b: A.rotated(b.groupBy("acl", "id", "at").agg(F.min("bytes").alias("bytes")), limit=2000).select("acl", "id", "slot", "part", "bytes"))
    return out


def stream_polite(spark, d) -> DataFrame:
    """When each request may start, four seconds apart within a site."""
    e = _stream(spark, d, "feed_article").select("siteid", "id", F.col("found").alias("at"))
    return S.run_once(S.polite(e), "polite")


def stream_lookup(spark, d) -> DataFrame:
    """Ids whose cleartext is ready, with the record looked up; empty texts are passed over."""
    ids = _stream(spark, d, "processed_article").where("mode = 'cleartext' and length(content) > 0").select(F.col("feed_articleid").alias("id"))
    full = table(spark, d, "feed_article").select("id", "siteid", "feedid")
    return S.run_once(S.with_static(ids, full, "id"), "lookup").distinct()


def stream_windows(spark, d) -> DataFrame:
    """Records of each access tag by day, closed once the watermark has passed; the newest days are still open."""
    e = _stream(spark, d, "feed_article").select(F.explode(arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string"))).alias("acl"), F.col("found").alias("at"), F.lit(1).cast("long").alias("bytes"))
    out = S.run_once(S.windows(e, "1 day", "1 hour"), "windows", "append")
    return out.select("acl", F.unix_timestamp("start").alias("start_s"), "records")


def stream_throttle(spark, d) -> DataFrame:
    """Events of each tag at least an hour after the last shown of that tag, unless they are rich."""
    tags = F.explode(arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string")))
    e = _stream(spark, d, "feed_article").select(tags.alias("acl"), "id", F.col("found").alias("at"), F.array_contains(F.coalesce("acl_tagset", F.array().cast("array<string>")), "render").alias("rich"))
    return S.run_once(S.throttled(e, 3_600_000), "throttle").select("acl", "id")


QUERIES = {f.__name__: f for f in (stream_cutoff, stream_dedup, stream_unknown, stream_fresh, stream_cleaned, stream_rotated, stream_polite, stream_lookup, stream_windows, stream_throttle)}
ORACLE = {
    "stream_dedup": "SELECT DISTINCT url FROM feed_article_urls WHERE url IS NOT NULL",
    "stream_unknown": "SELECT DISTINCT url FROM batch_item WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM feed_article_urls WHERE url IS NOT NULL)",
    "stream_fresh": f"SELECT id FROM feed_article WHERE found IS NULL OR found >= {SQL_NOW} - INTERVAL 7 DAY",
    "stream_polite": "SELECT siteid, id, CAST(max(t - 4000 * k) OVER (PARTITION BY siteid ORDER BY k) + 4000 * k AS BIGINT) AS start_ms FROM (SELECT siteid, id, epoch_us(found) // 1000 AS t, row_number() OVER (PARTITION BY siteid ORDER BY found, id) AS k FROM feed_article)",
    "stream_rotated": f"SELECT * FROM {_FILES}",
    "stream_lookup": "SELECT DISTINCT f.id, siteid, feedid FROM feed_article f WHERE id IN (SELECT feed_articleid FROM processed_article WHERE mode = 'cleartext' AND length(content) > 0)",
    "stream_windows": "SELECT acl, CAST(floor(epoch(found)) AS BIGINT) // 86400 * 86400 AS start_s, count(*) AS records FROM (SELECT found, unnest(CASE WHEN acl_tagset IS NULL OR len(acl_tagset) = 0 THEN ['public'] ELSE acl_tagset END) AS acl FROM feed_article) WHERE CAST(floor(epoch(found)) AS BIGINT) // 86400 * 86400 + 86400 <= (SELECT max(epoch(found)) - 3600 FROM feed_article) GROUP BY 1, 2",
}
