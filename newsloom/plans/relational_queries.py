"""Scans, joins, aggregates, windows, top-k and set operations over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import arrays, text, times, urls
from newsloom.runtime import table

NOW = "TIMESTAMP '2024-11-28 00:00:00'"
SQL_NOW = "TIMESTAMPTZ '2024-11-28 00:00:00+00'"


def now():
    return F.expr(NOW)


def due_feed_per_site(spark, d) -> DataFrame:
    """The most overdue enabled feed of each site."""
    due = table(spark, d, "feed").where(~F.col("disabled") & (F.col("next_scan") < now()))
    w = Window.partitionBy("siteid").orderBy("next_scan", "id")
    return due.withColumn("k", F.row_number().over(w)).where("k < 2").select("siteid", "id", "url", F.unix_micros("next_scan").alias("next_scan"))


def most_overdue_feed(spark, d) -> DataFrame:
    """The single most overdue feed, and how long it has been due."""
    due = table(spark, d, "feed").where(~F.col("disabled") & (F.col("next_scan") < now()))
    return due.orderBy("next_scan", "id").limit(1).select("id", "siteid", (F.unix_timestamp(now()) - F.unix_timestamp("next_scan")).alias("late_s"))


def newest_pages_per_site(spark, d) -> DataFrame:
    """The 16 newest decoded articles of each site, with the URL they were reached by."""
    meta = table(spark, d, "feed_article_meta").where("is_utf8 = '1'").select("id").distinct()
    fa = table(spark, d, "feed_article").select("id", "siteid", "found").join(meta, "id", "left_semi")
    w = Window.partitionBy("siteid").orderBy(F.desc("found"), F.desc("id"))
    top = fa.withColumn("k", F.row_number().over(w)).where("k < 17").select("id", "siteid", F.col("k").alias("rank"))
    last = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("url"))
    return top.join(last, top.id == last.fa_id, "left").select("siteid", "rank", "id", "url")


def url_ends_per_article(spark, d) -> DataFrame:
    """First and last URL of each article: arg-min and arg-max in one aggregate."""
    return table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.min(F.struct("seq", "url"))["url"].alias("first_url"), F.max(F.struct("seq", "url"))["url"].alias("last_url"), F.max("seq").alias("last_seq"))


def crawl_requests(spark, d) -> DataFrame:
    """Requests ready to be fetched: four-way join grouped by article."""
    fa = table(spark, d, "feed_article").where(F.col("enqueued") & (F.col("next_attempt").isNull() | (F.col("next_attempt") < now())))
    feed = table(spark, d, "feed").select(F.col("id").alias("feedid"), F.col("url").alias("feed_url"))
    site = table(spark, d, "site").where("not disabled and not locked").select(F.col("id").alias("siteid"), "hostname")
    u = table(spark, d, "feed_article_urls").select(F.col("fa_id").alias("id"), "seq", "url")
    j = fa.select("id", "siteid", "feedid").join(feed, "feedid").join(site, "siteid").join(u, "id")
    return j.groupBy("id", "siteid", "feedid", "feed_url", "hostname").agg(F.min(F.struct("seq", "url"))["url"].alias("url"), F.max("seq").alias("last_seq"))


def newest_article_per_site(spark, d) -> DataFrame:
    fa = table(spark, d, "feed_article").join(table(spark, d, "site").where("not disabled").select(F.col("id").alias("siteid"), "hostname"), "siteid")
    return fa.groupBy("siteid", "hostname").agg(F.max("id").alias("newest_id"), F.count("*").alias("articles"))


def pending_counts(spark, d) -> DataFrame:
    """Articles that wait for decoding, for extraction and for a language."""
    m = table(spark, d, "feed_article_meta").select("id", "is_utf8", "is_cleartext", "lang_iso").distinct()
    return m.agg(
        F.count_if(F.col("is_utf8") == "0").alias("to_decode"), F.count_if((F.col("is_cleartext") == "0") & (F.col("is_utf8") == "1")).alias("to_extract"),
        F.count_if(F.col("lang_iso").isNull() & (F.col("is_cleartext") == "1")).alias("to_label"),
    )


def pending_decode(spark, d) -> DataFrame:
    """Raw pages by list of ids: a semi join."""
    ids = table(spark, d, "feed_article_meta").where("is_utf8 = '0'").select(F.col("id").alias("feed_articleid"))
    return table(spark, d, "article").join(ids, "feed_articleid", "left_semi").select("feed_articleid", "http_code", F.octet_length("content").alias("bytes"), F.unix_micros("retrieved").alias("retrieved")).distinct()


def missing_pages(spark, d) -> DataFrame:
    """Articles of which no page was stored: an anti join."""
    return table(spark, d, "feed_article").join(table(spark, d, "article").select(F.col("feed_articleid").alias("id")), "id", "left_anti").select("id", "siteid", F.unix_micros("found").alias("found"))


def labelled_texts(spark, d) -> DataFrame:
    """Cleartexts joined to their labels and counted by label."""
    p = table(spark, d, "processed_article").where("mode = 'cleartext'").select(F.col("feed_articleid").alias("id"), F.length("content").alias("n")).distinct()
    m = table(spark, d, "feed_article_meta").select("id", "lang_iso", "lang_is_cld").distinct()
    return p.join(m, "id").groupBy("lang_iso", "lang_is_cld").agg(F.count("*").alias("texts"), F.sum("n").cast("long").alias("chars"))


def articles_of_host(spark, d) -> DataFrame:
    """Articles of the host with the most feeds: scalar lookup."""
    host = table(spark, d, "feed").groupBy("siteid").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "siteid").limit(1).select("siteid")
    return table(spark, d, "feed_article").join(F.broadcast(host), "siteid").select("id", "siteid", "feedid", F.unix_micros("found").alias("found"))  # one row is broadcast


def duplicate_lookup(spark, d) -> DataFrame:
    """New items whose URL is known: in the last three months, else ever; one scan, one join."""
    known = table(spark, d, "feed_article_urls").groupBy("url").agg(F.max_by("fa_id", F.struct("ts", "fa_id")).alias("fa_id"), F.max("ts").alias("ts"))
    items = table(spark, d, "batch_item").where("url is not null").select("id", "url", "arrived")
    recent = (times.month_id(F.col("arrived")) - times.month_id(F.col("ts"))).between(0, 2)
    return items.join(known, "url", "left").select("id", "fa_id", F.when(F.col("fa_id").isNull(), "new").when(recent, "recent").otherwise("old").alias("tier"))


def feed_overlap(spark, d) -> DataFrame:
    """How many URLs two feeds share, each unordered pair once."""
    u = table(spark, d, "feed_article_urls").select("url", "fa_feed_id").distinct()
    a, b = u.select("url", F.col("fa_feed_id").alias("lfeed")), u.select("url", F.col("fa_feed_id").alias("rfeed"))
    return a.join(b, "url").where("lfeed < rfeed").groupBy("lfeed", "rfeed").agg(F.count("*").alias("urls"))


def entry_outcomes(spark, d) -> DataFrame:
    """Each feed's items by outcome: failed, pruned by the feed's cutoff, known in the feed, known elsewhere, new."""
    f = table(spark, d, "feed").select(F.col("id").alias("feedid"), "pruning_ts_last", "trust_level")
    known = table(spark, d, "feed_article_urls").groupBy("url").agg(F.min("fa_feed_id").alias("known_feed"), F.count_if(F.lit(True)).alias("times"))
    own = table(spark, d, "feed_article_urls").select("url", F.col("fa_feed_id").alias("feedid"), F.lit(True).alias("same")).distinct()
    e = table(spark, d, "batch_item").select("id", "feedid", "url", "arrived").join(f, "feedid").join(known, "url", "left").join(own, ["url", "feedid"], "left")
    o = F.when(~F.coalesce(urls.acceptable(F.col("url"), F.col("trust_level")), F.lit(False)), "failed").when(F.col("arrived") < F.col("pruning_ts_last"), "pruned").when(F.col("same"), "same_feed").when(F.col("known_feed").isNotNull(), "other_feed").otherwise("new")
    e = e.withColumn("outcome", o)
    return e.groupBy("feedid").agg(*(F.count_if(F.col("outcome") == x).alias(x) for x in ("failed", "pruned", "same_feed", "other_feed", "new")), F.count("*").alias("entries"))


def feed_stats(spark, d) -> DataFrame:
    """Found and new per feed, the newest entry, and the share of new ones (1 where there is no entry)."""
    n = table(spark, d, "feed_article").groupBy("feedid").agg(F.count("*").alias("n"), F.max("found").alias("newest"))
    f = table(spark, d, "feed").join(n, F.col("id") == F.col("feedid"), "left")
    ratio = F.when(F.col("found_total") == 0, F.lit(1.0)).otherwise(F.col("found_new") / F.col("found_total"))
    return f.select("id", F.coalesce("n", F.lit(0)).alias("n"), F.unix_micros("newest").alias("newest"), F.round(ratio, 6).alias("overlap"), (F.col("found_total") + F.coalesce("n", F.lit(0))).alias("found_total"))


def resume_point(spark, d) -> DataFrame:
    """Where an incremental reader of all feeds resumes: the least of the feeds' newest times."""
    return table(spark, d, "feed_article").groupBy("feedid").agg(F.max("found").alias("newest")).agg(F.unix_micros(F.min("newest")).alias("resume"), F.count("*").alias("feeds"))


def feed_order(spark, d) -> DataFrame:
    """Whether each feed's articles come in ascending or descending time order, in order of id."""
    w = Window.partitionBy("feedid").orderBy("id")
    f = table(spark, d, "feed_article").select("feedid", "id", "found").withColumn("before", F.lag("found").over(w))
    up, down = F.coalesce(F.col("before") <= F.col("found"), F.lit(True)), F.coalesce(F.col("before") >= F.col("found"), F.lit(True))
    future = F.col("found") > now()
    return f.groupBy("feedid").agg(F.bool_and(up).alias("ascending"), F.bool_and(down).alias("descending"), F.bool_or(future).alias("future"), F.count("*").alias("n"))


def crawl_schedule(spark, d) -> DataFrame:
    """Polite fetch times: requests of one site four seconds apart."""
    fa = table(spark, d, "feed_article").where("enqueued").select("siteid", "id")
    k = F.row_number().over(Window.partitionBy("siteid").orderBy("id"))
    return fa.select("siteid", "id", (F.lit(4) * (k - 1)).cast("long").alias("start_s"))


def offset_page(spark, d) -> DataFrame:
    return table(spark, d, "feed_article").orderBy(F.desc("id")).offset(1000).limit(1000).select("id", "siteid")


def random_slice(spark, d) -> DataFrame:
    """A repeatable slice of articles: a multiplicative hash between bounds."""
    p = (F.col("id") * 7919 % 10007) / 10007.0
    return table(spark, d, "feed_article").where(p.between(0.25, 0.5)).select("id", F.round(p, 9).alias("position"))


def language_histogram(spark, d) -> DataFrame:
    """The commonest labels of two classifiers."""
    m = table(spark, d, "feed_article_meta").select("id", "lang_iso", "lang_altcode").distinct()
    each = m.select(F.explode(F.array(F.struct(F.lit("iso").alias("kind"), F.col("lang_iso").alias("lang")), F.struct(F.lit("alt").alias("kind"), F.col("lang_altcode").alias("lang")))).alias("x")).select("x.*")
    n = each.groupBy("kind", "lang").agg(F.count("*").alias("n"))
    w = Window.partitionBy("kind").orderBy(F.desc("n"), F.asc_nulls_first("lang"))
    return n.withColumn("rank", F.row_number().over(w)).where("rank <= 60")


def titles_of_day(spark, d) -> DataFrame:
    """Titles that several articles share, with their articles in order."""
    m = table(spark, d, "feed_article_meta").where("title is not null").select("id", "title").distinct()
    g = m.groupBy("title").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("ids"))
    return g.where("n > 1")


def hosts_by_tld(spark, d) -> DataFrame:
    """Hostnames of each top-level domain as one string."""
    return table(spark, d, "site").groupBy("tld").agg(F.array_join(F.sort_array(F.collect_list("hostname")), " ").alias("hosts"), F.count("*").alias("n"))


def stratified_hosts(spark, d) -> DataFrame:
    """The first article of each host, at most 50 of each language."""
    u = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("url")).withColumn("host", urls.host_part(F.col("url")))
    first = u.groupBy("host").agg(F.min("fa_id").alias("id"))
    m = table(spark, d, "feed_article_meta").select("id", F.coalesce(F.col("lang_altcode"), F.lit("")).alias("lang")).distinct()
    w = Window.partitionBy("lang").orderBy("id")
    return first.join(m, "id").withColumn("k", F.row_number().over(w)).where("k <= 50").select("lang", "host", "id")


def hosts_seen(spark, d) -> DataFrame:
    """Hosts of the site table and of all URLs, each once, and whether the site table has them."""
    a = table(spark, d, "site").select(F.lower("hostname").alias("host"))
    b = table(spark, d, "feed_article_urls").select(F.lower(urls.host_part(F.col("url"))).alias("host"))
    return a.union(b).distinct().join(a.withColumn("known", F.lit(True)), "host", "left").select("host", F.coalesce("known", F.lit(False)).alias("known"))


def publisher_inference(spark, d) -> DataFrame:
    """The publisher of each article: as stored, else the site whose host the last URL has."""
    last = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("url")).select(F.col("fa_id").alias("id"), F.lower(urls.host_part(F.col("url"))).alias("host"))
    s = table(spark, d, "site").select(F.col("id").alias("host_site"), F.lower("hostname").alias("host"))
    fa = table(spark, d, "feed_article").select("id", "siteid", "publisher_siteid")
    j = fa.join(last, "id", "left").join(s, "host", "left")
    guess = F.when(F.col("host_site") != F.col("siteid"), F.col("host_site"))
    return j.select("id", F.coalesce("publisher_siteid", guess).alias("publisher"), F.coalesce("publisher_siteid", guess, "siteid").alias("source"))


def feed_versions(spark, d) -> DataFrame:
    """The next snapshot of the feeds: latest known version of each, feeds without one kept (an upsert)."""
    ps = table(spark, d, "feed_ps").groupBy("feedid").agg(F.max(F.struct("updated", "title", "language")).alias("v"))
    return table(spark, d, "feed").select("id", "url").join(ps, F.col("id") == F.col("feedid"), "full").select(F.coalesce("id", "feedid").alias("id"), "url", F.col("v.title").alias("title"), F.col("v.language").alias("language"), F.unix_micros("v.updated").alias("updated"))


def duplicate_tags(spark, d) -> DataFrame:
    """Each article's tags, sorted and once each."""
    m = table(spark, d, "feed_article_meta").select("id", "tags").distinct()
    return m.select("id", F.array_join(F.sort_array(F.array_distinct(arrays.full_tags(F.col("tags")))), "|").alias("tags"))


def wide_article_record(spark, d) -> DataFrame:
    """The assembled record: article, source, feed, metadata, cleartext and page in one row."""
    fa = table(spark, d, "feed_article").select("id", "feedid", "siteid", "publisher_siteid", "found", "acl_tagset")
    last = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("url"))
    s = table(spark, d, "site").select(F.col("id").alias("source_id"), "hostname", "name", "tld")
    f = table(spark, d, "feed").select(F.col("id").alias("feedid"), F.col("url").alias("feed_url"))
    ps = table(spark, d, "feed_ps").groupBy("feedid").agg(F.max(F.struct("updated", F.coalesce("manual_title", "title").alias("title"), "language")).alias("ps"))
    m = table(spark, d, "feed_article_meta").select(F.col("id").alias("mid"), "title", "pub_date", "img", "lang_iso").distinct()
    p = table(spark, d, "processed_article").where("mode = 'cleartext'").groupBy("feed_articleid").agg(F.min("content").alias("content")).select(F.col("feed_articleid").alias("pid"), "content")
    a = table(spark, d, "article").groupBy("feed_articleid").agg(F.min("retrieved").alias("retrieved")).select(F.col("feed_articleid").alias("aid"), "retrieved")
    j = fa.withColumn("source_id", F.coalesce("publisher_siteid", "siteid")).join(s, "source_id", "left").join(f, "feedid", "left").join(ps, "feedid", "left")
    j = j.join(last, j.id == last.fa_id, "left").join(m, j.id == m.mid, "left").join(p, j.id == p.pid, "left").join(a, j.id == a.aid, "left")
    tags = F.array_join(F.when(F.col("acl_tagset").isNull() | (F.size("acl_tagset") == 0), F.array(F.lit("public"))).otherwise(F.col("acl_tagset")), ",")
    return j.where("length(content) > 0").select(
        "id", "url", times.iso_utc(F.col("pub_date")).alias("publish_date"), times.iso_utc(F.col("found")).alias("found_date"), times.iso_utc(F.col("retrieved")).alias("retrieved_date"),
        F.coalesce("title", F.when(text.title_line(F.col("content")) != "", text.title_line(F.col("content")))).alias("title"), text.without_title(F.col("content")).alias("cleartext"),
        F.coalesce("lang_iso", "ps.language").alias("lang"), "img", F.col("hostname").alias("source_hostname"), F.col("name").alias("source_name"), "feed_url", F.col("ps.title").alias("feed_title"), tags.alias("acl"),
    )


def active_spells(spark, d) -> DataFrame:
    """Spells of days on which a site found articles, neighbouring days merged (gaps and islands)."""
    day = F.floor(F.unix_timestamp("found") / 86400)
    days = table(spark, d, "feed_article").groupBy("siteid", day.alias("day")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("siteid").orderBy("day")
    starts = F.when(F.col("day") - F.lag("day").over(w) <= 1, 0).otherwise(1)
    spell = days.withColumn("s", starts).withColumn("spell", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return spell.groupBy("siteid", "spell").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("n").alias("articles"))


def export_pending(spark, d) -> DataFrame:
    """Texts an export has yet to write: those with a cleartext, less those whose teaser is out already."""
    p = table(spark, d, "processed_article")
    out = p.where("mode = 'teaser'").select("feed_articleid")
    return p.where("mode = 'cleartext'").select("feed_articleid").distinct().join(out, "feed_articleid", "left_anti")


def articles_by_month(spark, d) -> DataFrame:
    """Articles, sites and URLs by month."""
    fa = table(spark, d, "feed_article").select("id", "siteid", times.month_id(F.col("found")).alias("month"))
    u = table(spark, d, "feed_article_urls").select(F.col("fa_id").alias("id"), "url").distinct().groupBy("id").agg(F.count("*").alias("urls"))
    return fa.join(u, "id", "left").groupBy("month").agg(F.count("*").alias("articles"), F.count_distinct("siteid").alias("sites"), F.sum("urls").cast("long").alias("urls"))


QUERIES = {
    f.__name__: f
    for f in (
        active_spells, export_pending, articles_by_month, due_feed_per_site, most_overdue_feed, newest_pages_per_site, url_ends_per_article, crawl_requests, newest_article_per_site, pending_counts, pending_decode,
        missing_pages, labelled_texts, articles_of_host, duplicate_lookup, feed_overlap, entry_outcomes, feed_stats, resume_point, feed_order, crawl_schedule, offset_page,
        random_slice, language_histogram, titles_of_day, hosts_by_tld, stratified_hosts, hosts_seen, publisher_inference, feed_versions, duplicate_tags, wide_article_record,
    )
}

_LAST = "(SELECT fa_id, arg_max(url, (seq, url)) AS url FROM feed_article_urls GROUP BY 1)"
_HOST = "split_part(url || '/-/-/', '/', 3)"
ORACLE = {
    "active_spells": "WITH d AS (SELECT siteid, CAST(floor(epoch(found)) AS BIGINT) // 86400 AS day, count(*) AS n FROM feed_article GROUP BY 1, 2), s AS (SELECT *, sum(s) OVER (PARTITION BY siteid ORDER BY day) AS spell FROM (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY siteid ORDER BY day) <= 1 THEN 0 ELSE 1 END AS s FROM d)) SELECT siteid, CAST(spell AS BIGINT) AS spell, min(day) AS first_day, max(day) AS last_day, CAST(sum(n) AS BIGINT) AS articles FROM s GROUP BY 1, 2",
    "export_pending": "SELECT DISTINCT feed_articleid FROM processed_article p WHERE mode = 'cleartext' AND NOT EXISTS (SELECT 1 FROM processed_article t WHERE t.mode = 'teaser' AND t.feed_articleid = p.feed_articleid)",
    "articles_by_month": "SELECT CAST(year(found AT TIME ZONE 'UTC') * 12 + month(found AT TIME ZONE 'UTC') AS INT) AS month, count(*) AS articles, count(DISTINCT siteid) AS sites, CAST(sum(urls) AS BIGINT) AS urls FROM feed_article a LEFT JOIN (SELECT fa_id, count(DISTINCT url) AS urls FROM feed_article_urls WHERE url IS NOT NULL GROUP BY 1) u ON u.fa_id = a.id GROUP BY 1",
    "due_feed_per_site": f"SELECT siteid, id, url, epoch_us(next_scan) AS next_scan FROM (SELECT *, row_number() OVER (PARTITION BY siteid ORDER BY next_scan, id) AS k FROM feed WHERE NOT disabled AND next_scan < {SQL_NOW}) WHERE k < 2",
    "most_overdue_feed": f"SELECT id, siteid, CAST(floor(epoch({SQL_NOW})) - floor(epoch(next_scan)) AS BIGINT) AS late_s FROM feed WHERE NOT disabled AND next_scan < {SQL_NOW} ORDER BY next_scan, id LIMIT 1",
    "newest_pages_per_site": f"SELECT siteid, CAST(k AS INT) AS rank, id, url FROM (SELECT id, siteid, row_number() OVER (PARTITION BY siteid ORDER BY found DESC, id DESC) AS k FROM feed_article WHERE id IN (SELECT id FROM feed_article_meta WHERE is_utf8 = '1')) t LEFT JOIN {_LAST} u ON u.fa_id = t.id WHERE k < 17",
    "url_ends_per_article": "SELECT fa_id, arg_min(url, (seq, url)) AS first_url, arg_max(url, (seq, url)) AS last_url, max(seq) AS last_seq FROM feed_article_urls GROUP BY 1",
    "crawl_requests": f"SELECT a.id, a.siteid, a.feedid, f.url AS feed_url, hostname, arg_min(u.url, (seq, u.url)) AS url, max(seq) AS last_seq FROM feed_article a JOIN feed f ON f.id = a.feedid JOIN site s ON s.id = a.siteid JOIN feed_article_urls u ON u.fa_id = a.id WHERE enqueued AND (next_attempt IS NULL OR next_attempt < {SQL_NOW}) AND NOT s.disabled AND NOT s.locked GROUP BY ALL",
    "newest_article_per_site": "SELECT siteid, hostname, max(a.id) AS newest_id, count(*) AS articles FROM feed_article a JOIN site s ON s.id = a.siteid WHERE NOT s.disabled GROUP BY ALL",
    "pending_counts": "SELECT count(*) FILTER (is_utf8 = '0') AS to_decode, count(*) FILTER (is_cleartext = '0' AND is_utf8 = '1') AS to_extract, count(*) FILTER (lang_iso IS NULL AND is_cleartext = '1') AS to_label FROM (SELECT DISTINCT id, is_utf8, is_cleartext, lang_iso FROM feed_article_meta)",
    "pending_decode": "SELECT DISTINCT feed_articleid, http_code, CAST(octet_length(content) AS INT) AS bytes, epoch_us(retrieved) AS retrieved FROM article WHERE feed_articleid IN (SELECT id FROM feed_article_meta WHERE is_utf8 = '0')",
    "missing_pages": "SELECT id, siteid, epoch_us(found) AS found FROM feed_article WHERE id NOT IN (SELECT feed_articleid FROM article)",
    "labelled_texts": "SELECT lang_iso, lang_is_cld, count(*) AS texts, CAST(sum(n) AS BIGINT) AS chars FROM (SELECT DISTINCT feed_articleid AS id, length(content) AS n FROM processed_article WHERE mode = 'cleartext') p JOIN (SELECT DISTINCT id, lang_iso, lang_is_cld FROM feed_article_meta) m USING (id) GROUP BY ALL",
    "articles_of_host": "SELECT id, siteid, feedid, epoch_us(found) AS found FROM feed_article WHERE siteid = (SELECT siteid FROM feed GROUP BY 1 ORDER BY count(*) DESC, siteid LIMIT 1)",
    "duplicate_lookup": "SELECT id, fa_id, CASE WHEN fa_id IS NULL THEN 'new' WHEN (year(arrived AT TIME ZONE 'UTC') * 12 + month(arrived AT TIME ZONE 'UTC')) - (year(ts AT TIME ZONE 'UTC') * 12 + month(ts AT TIME ZONE 'UTC')) BETWEEN 0 AND 2 THEN 'recent' ELSE 'old' END AS tier FROM batch_item b LEFT JOIN (SELECT url, arg_max(fa_id, (ts, fa_id)) AS fa_id, max(ts) AS ts FROM feed_article_urls GROUP BY 1) k USING (url) WHERE url IS NOT NULL",
    "feed_overlap": "WITH u AS (SELECT DISTINCT url, fa_feed_id AS f FROM feed_article_urls) SELECT a.f AS lfeed, b.f AS rfeed, count(*) AS urls FROM u a JOIN u b ON a.url = b.url AND a.f < b.f GROUP BY 1, 2",
    "entry_outcomes": "WITH e AS (SELECT b.feedid, CASE WHEN NOT coalesce(lower(left(b.url, 4)) = 'http' AND lower(right(b.url, 4)) <> '.mp3' AND trust_level < 3 AND length(b.url) <= 4095, false) THEN 'failed' WHEN arrived < pruning_ts_last THEN 'pruned' WHEN EXISTS (SELECT 1 FROM feed_article_urls u WHERE u.url = b.url AND u.fa_feed_id = b.feedid) THEN 'same_feed' WHEN EXISTS (SELECT 1 FROM feed_article_urls u WHERE u.url = b.url) THEN 'other_feed' ELSE 'new' END AS o FROM batch_item b JOIN feed f ON f.id = b.feedid) SELECT feedid, count(*) FILTER (o = 'failed') AS failed, count(*) FILTER (o = 'pruned') AS pruned, count(*) FILTER (o = 'same_feed') AS same_feed, count(*) FILTER (o = 'other_feed') AS other_feed, count(*) FILTER (o = 'new') AS new, count(*) AS entries FROM e GROUP BY 1",
    "feed_stats": "SELECT f.id, coalesce(n, 0) AS n, epoch_us(newest) AS newest, round(CASE WHEN found_total = 0 THEN 1.0 ELSE found_new / found_total END, 6) AS overlap, found_total + coalesce(n, 0) AS found_total FROM feed f LEFT JOIN (SELECT feedid, count(*) AS n, max(found) AS newest FROM feed_article GROUP BY 1) a ON a.feedid = f.id",
    "resume_point": "SELECT epoch_us(min(newest)) AS resume, count(*) AS feeds FROM (SELECT feedid, max(found) AS newest FROM feed_article GROUP BY 1)",
    "feed_order": f"SELECT feedid, bool_and(coalesce(b <= found, true)) AS ascending, bool_and(coalesce(b >= found, true)) AS descending, bool_or(found > {SQL_NOW}) AS future, count(*) AS n FROM (SELECT feedid, found, lag(found) OVER (PARTITION BY feedid ORDER BY id) AS b FROM feed_article) GROUP BY 1",
    "crawl_schedule": "SELECT siteid, id, 4 * (row_number() OVER (PARTITION BY siteid ORDER BY id) - 1) AS start_s FROM feed_article WHERE enqueued",
    "offset_page": "SELECT id, siteid FROM feed_article ORDER BY id DESC LIMIT 1000 OFFSET 1000",
    "random_slice": "SELECT id, round((id * 7919 % 10007) / 10007.0::DOUBLE, 9) AS position FROM feed_article WHERE (id * 7919 % 10007) / 10007.0::DOUBLE BETWEEN 0.25 AND 0.5",
    "language_histogram": "WITH m AS (SELECT DISTINCT id, lang_iso, lang_altcode FROM feed_article_meta), e AS (SELECT 'iso' AS kind, lang_iso AS lang FROM m UNION ALL SELECT 'alt', lang_altcode FROM m), n AS (SELECT kind, lang, count(*) AS n FROM e GROUP BY 1, 2) SELECT kind, lang, n, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, lang NULLS FIRST) AS rank FROM n) WHERE rank <= 60",
    "titles_of_day": "SELECT title, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM (SELECT DISTINCT id, title FROM feed_article_meta WHERE title IS NOT NULL) GROUP BY 1 HAVING count(*) > 1",
    "hosts_by_tld": "SELECT tld, string_agg(hostname, ' ' ORDER BY hostname) AS hosts, count(*) AS n FROM site GROUP BY 1",
    "stratified_hosts": f"WITH u AS (SELECT {_HOST} AS host, fa_id FROM {_LAST}), f AS (SELECT host, min(fa_id) AS id FROM u GROUP BY 1) SELECT lang, host, id FROM (SELECT lang, host, id, row_number() OVER (PARTITION BY lang ORDER BY id) AS k FROM f JOIN (SELECT DISTINCT id, coalesce(lang_altcode, '') AS lang FROM feed_article_meta) m USING (id)) WHERE k <= 50",
    "hosts_seen": f"WITH a AS (SELECT lower(hostname) AS host FROM site), b AS (SELECT lower({_HOST}) AS host FROM feed_article_urls) SELECT host, host IN (SELECT host FROM a) AS known FROM (SELECT host FROM a UNION SELECT host FROM b)",
    "publisher_inference": f"SELECT a.id, coalesce(publisher_siteid, CASE WHEN s.id <> siteid THEN s.id END) AS publisher, coalesce(publisher_siteid, CASE WHEN s.id <> siteid THEN s.id END, siteid) AS source FROM feed_article a LEFT JOIN (SELECT fa_id, lower({_HOST}) AS host FROM {_LAST}) u ON u.fa_id = a.id LEFT JOIN site s ON lower(hostname) = host",
    "feed_versions": "SELECT coalesce(f.id, p.feedid) AS id, url, p.title, p.language, epoch_us(p.updated) AS updated FROM feed f FULL JOIN (SELECT feedid, v.title, v.language, v.updated FROM (SELECT feedid, max({'updated': updated, 'title': title, 'language': language}) AS v FROM feed_ps GROUP BY 1)) p ON p.feedid = f.id",
    "duplicate_tags": "SELECT id, coalesce(array_to_string(list_sort(list_distinct(list_filter(tags, lambda t: t <> ''))), '|'), '') AS tags FROM (SELECT DISTINCT id, tags FROM feed_article_meta)",
    "wide_article_record": f"""WITH ps AS (SELECT feedid, v.title, v.language FROM (SELECT feedid, max({{'updated': updated, 'title': coalesce(manual_title, title), 'language': language}}) AS v FROM feed_ps GROUP BY 1))
SELECT a.id, u.url, strftime(pub_date AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS publish_date, strftime(found AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS found_date, strftime(retrieved AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS retrieved_date,
coalesce(m.title, nullif(split_part(content, chr(10), 1), '')) AS title, regexp_replace(content, '^[^\\n]*\\n?', chr(10)) AS cleartext, coalesce(lang_iso, ps.language) AS lang, img, hostname AS source_hostname, name AS source_name, f.url AS feed_url, ps.title AS feed_title,
CASE WHEN acl_tagset IS NULL OR len(acl_tagset) = 0 THEN 'public' ELSE array_to_string(acl_tagset, ',') END AS acl
FROM feed_article a LEFT JOIN site s ON s.id = coalesce(publisher_siteid, siteid) LEFT JOIN feed f ON f.id = a.feedid LEFT JOIN ps ON ps.feedid = a.feedid LEFT JOIN {_LAST} u ON u.fa_id = a.id
LEFT JOIN (SELECT DISTINCT id, title, pub_date, img, lang_iso FROM feed_article_meta) m ON m.id = a.id
LEFT JOIN (SELECT feed_articleid, min(content) AS content FROM processed_article WHERE mode = 'cleartext' GROUP BY 1) p ON p.feed_articleid = a.id
LEFT JOIN (SELECT feed_articleid, min(retrieved) AS retrieved FROM article GROUP BY 1) r ON r.feed_articleid = a.id WHERE length(content) > 0""",
}
