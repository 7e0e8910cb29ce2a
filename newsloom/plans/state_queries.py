"""Next snapshots of feeds, sites, requests and metadata; outcome codes and size gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import times, urls
from newsloom.operators import state as S
from newsloom.plans.relational_queries import SQL_NOW, now
from newsloom.runtime import table


def _scans(spark, d) -> DataFrame:
    """(feedid, outcome) of this round: feeds that are due and brought items are 'ok', with an error page first 'gone', else 'failed'."""
    due = table(spark, d, "feed").where(~F.col("disabled") & (F.col("next_scan") < now())).select(F.col("id").alias("feedid"))
    n = table(spark, d, "batch_item").groupBy("feedid").agg(F.count("*").alias("n"))
    out = F.when(F.col("n") > 0, "ok").when(F.col("feedid") % 5 == 0, "gone").otherwise("failed")
    return due.join(n, "feedid", "left").select("feedid", out.alias("outcome"))


def feed_next_state(spark, d) -> DataFrame:
    """Feeds after this round of scans: disabled, failures, next scan."""
    f = table(spark, d, "feed").join(_scans(spark, d).withColumnRenamed("feedid", "id"), "id", "left")
    return S.after_scan(f, F.col("outcome"), now()).select("id", "disabled", "failures", F.unix_micros("next_scan").alias("next_scan"))


def reschedule_jitter(spark, d) -> DataFrame:
    """How far from now every feed is scheduled again, beside its interval."""
    f = table(spark, d, "feed")
    s = S.after_scan(f, F.lit("ok"), now())
    return f.select("id", "effective_ttl").join(s, "id").select("id", "effective_ttl", (F.unix_timestamp("next_scan") - F.unix_timestamp(now())).alias("in_s"))


def feed_scan_stats(spark, d) -> DataFrame:
    """Statistics of each feed after the round: a new item is one whose URL the history doesn't have."""
    known = table(spark, d, "feed_article_urls").select("url").distinct().withColumn("old", F.lit(True))
    e = table(spark, d, "batch_item").select("feedid", "url").join(known, "url", "left")
    n = e.groupBy("feedid").agg(F.count("*").alias("n_entries"), F.count_if(F.col("old").isNull()).alias("n_new")).withColumnRenamed("feedid", "id")
    found = table(spark, d, "feed").select("id").join(n, "id", "left").fillna(0)
    return S.statistics(table(spark, d, "feed"), found)


def pruning_mode(spark, d) -> DataFrame:
    """The pruning mode of each feed after its items were seen, in order of id."""
    from pyspark.sql import Window

    w = Window.partitionBy("feedid").orderBy("id")
    e = table(spark, d, "batch_item").select("feedid", "id", "arrived").withColumn("before", F.lag("arrived").over(w))
    o = e.groupBy("feedid").agg(
        F.bool_and(F.coalesce(F.col("before") <= F.col("arrived"), F.lit(True))).alias("up"), F.bool_and(F.coalesce(F.col("before") >= F.col("arrived"), F.lit(True))).alias("down"),
        F.bool_or(F.col("arrived").isNull() | (F.col("arrived") > now())).alias("faulty"),
    )
    j = table(spark, d, "feed").select(F.col("id").alias("feedid"), "pruning_mode").join(o, "feedid", "left")
    yes = F.lit(True)
    return j.select("feedid", F.col("pruning_mode").alias("mode"), S.next_mode(F.col("pruning_mode"), F.coalesce("up", yes), F.coalesce("down", yes), F.coalesce("faulty", F.lit(False))).alias("next_mode"))


def requests_retried(spark, d) -> DataFrame:
    """Requests after a round of fetches: those whose page was an error or is missing are due again in 20 minutes."""
    a = table(spark, d, "article").groupBy(F.col("feed_articleid").alias("id")).agg(F.min("http_code").alias("code"))
    r = table(spark, d, "feed_article").where("enqueued").select("id", "next_attempt").join(a, "id", "left")
    return S.retried(r, F.col("code").isNull() | (F.col("code") >= 400), now()).select("id", F.unix_micros("next_attempt").alias("next_attempt"))


def sites_unlocked(spark, d) -> DataFrame:
    s = S.unlocked(table(spark, d, "site"), now())
    return s.select("id", "locked", F.unix_micros("next_request").alias("next_request"))


def metadata_refreshed(spark, d) -> DataFrame:
    """Feed metadata after a scan gave new titles: rows younger than a week stay as they are."""
    ps = table(spark, d, "feed_ps").groupBy("feedid").agg(F.max(F.struct("updated", "title")).alias("r")).select("feedid", F.col("r.title").alias("title"), F.col("r.updated").alias("updated"))
    seen = table(spark, d, "feed").select(F.col("id").alias("feedid"), F.col("url").alias("title"), now().alias("updated"))
    return S.refreshed(ps, seen, "feedid", now()).select("feedid", "title", F.unix_micros("updated").alias("updated"), "changed")


def site_upsert(spark, d) -> DataFrame:
    """Sites with those added that the URLs name and the table doesn't have (a negative id until one is given)."""
    old = table(spark, d, "site").select("hostname", "id", "tld")
    host = F.lower(urls.host_part(F.col("url")))
    new = table(spark, d, "feed_article_urls").select(host.alias("hostname")).distinct().join(old.select(F.lower("hostname").alias("hostname")), "hostname", "left_anti")
    new = new.select("hostname", F.lit(-1).cast("long").alias("id"), F.regexp_extract("hostname", r"([^.:]*)(?::\d+)?$", 1).alias("tld"))
    return S.upserted(old, new, "hostname")


def cleartext_upsert(spark, d) -> DataFrame:
    """Cleartexts by size after the batches' items are written over them, by what changed."""
    old = table(spark, d, "processed_article").where("mode = 'cleartext'").groupBy(F.col("feed_articleid").alias("id")).agg(F.min(F.length("content")).alias("chars"))
    new = table(spark, d, "batch_item").where("content is not null").select((F.col("id") - 100).alias("id"), F.length("content").alias("chars"))
    return S.upserted(old, new, "id").groupBy("changed").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


def fetch_codes(spark, d) -> DataFrame:
    """The code each fetched page is logged with."""
    a = table(spark, d, "article").select("feed_articleid", "http_code", "mimetype", F.octet_length("content").alias("size"), F.col("content").isNull().alias("lost")).distinct()
    return a.select(F.col("feed_articleid").alias("id"), S.fetch_code(F.col("http_code"), F.col("mimetype"), F.col("size"), F.col("lost")).alias("code")).distinct()


def feed_scan_codes(spark, d) -> DataFrame:
    """The code of each feed's scan this round: its status where there are entries."""
    s = _scans(spark, d)
    n = table(spark, d, "batch_item").groupBy("feedid").agg(F.count("title").alias("titles"), F.count("*").alias("n"))
    j = s.join(n, "feedid", "left")
    code = F.when(F.col("outcome") == "gone", S.SCAN_CODES["gone"]).when(F.col("n").isNull(), S.SCAN_CODES["no_result"]).when(F.col("titles") == 0, S.SCAN_CODES["no_entries"]).otherwise(200)
    return j.groupBy(code.alias("code")).agg(F.count("*").alias("feeds"))


def size_gates(spark, d) -> DataFrame:
    """How many pages and texts pass each size gate."""
    a = table(spark, d, "article").where("content is not null").select("feed_articleid", F.octet_length("content").alias("n")).distinct()
    p = table(spark, d, "processed_article").where("mode = 'cleartext' and content is not null").select("feed_articleid", F.length("content").alias("n")).distinct()
    gates = [(a, "raw", F.col("n") <= 10_000_000), (a, "download", F.col("n") <= 2_000_000), (p, "cleaner", F.col("n").between(200, 100_000))]
    out = [x.agg(F.lit(name).alias("gate"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("stopped")) for x, name, ok in gates]
    return out[0].unionByName(out[1]).unionByName(out[2])


def duplicate_tiers(spark, d) -> DataFrame:
    """Counters of the duplicate look-up: found in the last three months, in older history, new, failed."""
    known = table(spark, d, "feed_article_urls").groupBy("url").agg(F.max("ts").alias("ts"))
    e = table(spark, d, "batch_item").select("url", "arrived").join(known, "url", "left")
    recent = (times.month_id(F.col("arrived")) - times.month_id(F.col("ts"))).between(0, 2)
    tier = F.when(F.col("url").isNull(), "f").when(F.col("ts").isNull(), "new").when(recent, "c6").otherwise("c4")
    return e.groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))


def entries_checked(spark, d) -> DataFrame:
    """Each item under its feed's cutoff: without a time it fails, strictly older it is pruned, without a link it is faulty."""
    f = table(spark, d, "feed").select(F.col("id").alias("feedid"), "pruning_ts_last")
    e = table(spark, d, "batch_item").select("id", "feedid", "url", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("arrived")).alias("pub")).join(f, "feedid")
    under = F.col("pruning_ts_last").isNotNull()
    o = F.when(under & F.col("pub").isNull(), "failed").when(under & (F.col("pub") < F.col("pruning_ts_last")), "pruned").when(F.coalesce("url", F.lit("")) == "", "failed").otherwise("taken")
    return e.select("id", o.alias("outcome"))


QUERIES = {
    f.__name__: f
    for f in (
        feed_next_state, reschedule_jitter, feed_scan_stats, pruning_mode, requests_retried, sites_unlocked, metadata_refreshed, site_upsert, cleartext_upsert, fetch_codes,
        feed_scan_codes, size_gates, duplicate_tiers, entries_checked,
    )
}

_SCANS = f"(SELECT f.id AS feedid, CASE WHEN n > 0 THEN 'ok' WHEN f.id % 5 = 0 THEN 'gone' ELSE 'failed' END AS outcome FROM feed f LEFT JOIN (SELECT feedid, count(*) AS n FROM batch_item GROUP BY 1) b ON b.feedid = f.id WHERE NOT disabled AND next_scan < {SQL_NOW})"
_DUE = f"epoch_us({SQL_NOW}) + 1000000 * CAST(floor(effective_ttl * (0.5 + (id * 7919 % 10007) / 10007.0::DOUBLE)) AS BIGINT)"
ORACLE = {
    "feed_next_state": f"SELECT id, CASE WHEN outcome = 'gone' THEN true WHEN outcome = 'failed' THEN disabled OR coalesce(failures, 0) > 4 ELSE disabled END AS disabled, CASE WHEN outcome = 'failed' THEN coalesce(failures, 0) + 1 WHEN outcome = 'ok' THEN 0 ELSE coalesce(failures, 0) END AS failures, CASE WHEN outcome IS NOT NULL THEN {_DUE} ELSE epoch_us(next_scan) END AS next_scan FROM feed LEFT JOIN {_SCANS} s ON s.feedid = id",
    "reschedule_jitter": "SELECT id, effective_ttl, CAST(floor(effective_ttl * (0.5 + (id * 7919 % 10007) / 10007.0::DOUBLE)) AS BIGINT) AS in_s FROM feed",
    "feed_scan_stats": "WITH n AS (SELECT feedid, count(*) AS e, count(*) FILTER (url IS NULL OR url NOT IN (SELECT url FROM feed_article_urls WHERE url IS NOT NULL)) AS w FROM batch_item GROUP BY 1) SELECT id, CASE WHEN coalesce(w, 0) = 0 THEN coalesce(unchanged_iter, 0) + 1 ELSE 0 END AS unchanged_iter, round(CASE WHEN coalesce(e, 0) = 0 THEN 1.0 ELSE w / e END, 6) AS last_overlap, found_total + coalesce(e, 0) AS found_total, found_new + coalesce(w, 0) AS found_new FROM feed LEFT JOIN n ON feedid = id",
    "pruning_mode": f"WITH o AS (SELECT feedid, bool_and(coalesce(b <= arrived, true)) AS up, bool_and(coalesce(b >= arrived, true)) AS down, bool_or(arrived IS NULL OR arrived > {SQL_NOW}) AS faulty FROM (SELECT feedid, arrived, lag(arrived) OVER (PARTITION BY feedid ORDER BY id) AS b FROM batch_item) GROUP BY 1), j AS (SELECT f.id AS feedid, pruning_mode AS m, coalesce(up, true) AS up, coalesce(down, true) AS down, coalesce(faulty, false) AS faulty FROM feed f LEFT JOIN o ON o.feedid = f.id) SELECT feedid, m AS mode, CASE WHEN m = 'L' THEN CASE WHEN faulty THEN '0' WHEN down THEN 'D' WHEN up THEN 'A' ELSE 'X' END WHEN m IN ('D', 'A') THEN CASE WHEN faulty THEN 'F' WHEN (m = 'D' AND NOT down) OR (m = 'A' AND NOT up) THEN 'Y' ELSE m END ELSE m END AS next_mode FROM j",
    "requests_retried": f"SELECT id, CASE WHEN code IS NULL OR code >= 400 THEN epoch_us({SQL_NOW}) + 1200000000 ELSE epoch_us(next_attempt) END AS next_attempt FROM feed_article LEFT JOIN (SELECT feed_articleid, min(http_code) AS code FROM article GROUP BY 1) a ON feed_articleid = id WHERE enqueued",
    "sites_unlocked": f"SELECT id, false AS locked, CASE WHEN locked THEN epoch_us({SQL_NOW}) + 4000000 ELSE epoch_us(next_request) END AS next_request FROM site",
    "metadata_refreshed": f"WITH p AS (SELECT feedid, r.title AS title, r.updated AS updated FROM (SELECT feedid, max({{'updated': updated, 'title': title}}) AS r FROM feed_ps GROUP BY 1)) SELECT feedid, CASE WHEN o THEN url ELSE title END AS title, CASE WHEN o THEN epoch_us({SQL_NOW}) ELSE epoch_us(updated) END AS updated, CASE WHEN o THEN 'replaced' ELSE 'kept' END AS changed FROM (SELECT p.*, f.url, coalesce(updated < {SQL_NOW} - INTERVAL 7 DAY AND f.id IS NOT NULL, false) AS o FROM p LEFT JOIN feed f ON f.id = feedid)",
    "site_upsert": "SELECT hostname, id, tld, 'kept' AS changed FROM site UNION ALL SELECT h, -1, regexp_extract(h, '([^.:]*)(?::\\d+)?$', 1), 'added' FROM (SELECT DISTINCT lower(split_part(url || '/-/-/', '/', 3)) AS h FROM feed_article_urls) WHERE h NOT IN (SELECT lower(hostname) FROM site)",
    "cleartext_upsert": "WITH a AS (SELECT feed_articleid AS id, min(length(content)) AS c FROM processed_article WHERE mode = 'cleartext' GROUP BY 1), b AS (SELECT id - 100 AS id, length(content) AS c FROM batch_item WHERE content IS NOT NULL) SELECT CASE WHEN b.id IS NULL THEN 'kept' WHEN a.id IS NULL THEN 'added' WHEN a.c IS NOT DISTINCT FROM b.c THEN 'same' ELSE 'replaced' END AS changed, count(*) AS n, CAST(sum(CASE WHEN b.id IS NULL THEN a.c ELSE b.c END) AS BIGINT) AS chars FROM a FULL JOIN b ON a.id = b.id GROUP BY 1",
    "fetch_codes": "SELECT DISTINCT feed_articleid AS id, CASE WHEN http_code IS NULL THEN 901 WHEN http_code BETWEEN 900 AND 979 THEN http_code WHEN http_code >= 400 THEN 918 WHEN octet_length(content) > 2000000 THEN 904 WHEN NOT coalesce(starts_with(mimetype, 'text/'), false) THEN 905 WHEN content IS NULL THEN 917 ELSE http_code END AS code FROM article",
    "feed_scan_codes": f"SELECT CASE WHEN outcome = 'gone' THEN 976 WHEN n IS NULL THEN 978 WHEN titles = 0 THEN 975 ELSE 200 END AS code, count(*) AS feeds FROM {_SCANS} s LEFT JOIN (SELECT feedid, count(title) AS titles, count(*) AS n FROM batch_item GROUP BY 1) b USING (feedid) GROUP BY 1",
    "size_gates": "WITH a AS (SELECT DISTINCT feed_articleid, octet_length(content) AS n FROM article WHERE content IS NOT NULL), p AS (SELECT DISTINCT feed_articleid, length(content) AS n FROM processed_article WHERE mode = 'cleartext' AND content IS NOT NULL) SELECT 'raw' AS gate, count(*) FILTER (n <= 10000000) AS passed, count(*) FILTER (n > 10000000) AS stopped FROM a UNION ALL SELECT 'download', count(*) FILTER (n <= 2000000), count(*) FILTER (n > 2000000) FROM a UNION ALL SELECT 'cleaner', count(*) FILTER (n BETWEEN 200 AND 100000), count(*) FILTER (NOT n BETWEEN 200 AND 100000) FROM p",
    "duplicate_tiers": "SELECT CASE WHEN url IS NULL THEN 'f' WHEN ts IS NULL THEN 'new' WHEN (year(arrived AT TIME ZONE 'UTC') * 12 + month(arrived AT TIME ZONE 'UTC')) - (year(ts AT TIME ZONE 'UTC') * 12 + month(ts AT TIME ZONE 'UTC')) BETWEEN 0 AND 2 THEN 'c6' ELSE 'c4' END AS tier, count(*) AS n FROM batch_item LEFT JOIN (SELECT url, max(ts) AS ts FROM feed_article_urls GROUP BY 1) k USING (url) GROUP BY 1",
    "entries_checked": "SELECT id, CASE WHEN p IS NOT NULL AND pub IS NULL THEN 'failed' WHEN p IS NOT NULL AND pub < p THEN 'pruned' WHEN coalesce(url, '') = '' THEN 'failed' ELSE 'taken' END AS outcome FROM (SELECT b.id, b.url, CASE WHEN b.id % 11 = 0 THEN NULL ELSE arrived END AS pub, pruning_ts_last AS p FROM batch_item b JOIN feed f ON f.id = feedid)",
}
