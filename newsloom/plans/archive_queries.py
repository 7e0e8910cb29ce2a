"""Records as XML, archive files, access lists, entries, enrichment ids and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import arrays, times
from newsloom.operators import archive as A
from newsloom.plans.relational_queries import now
from newsloom.plans.text_queries import _T, _texts, _xml
from newsloom.runtime import table, written


def _records(spark, d) -> DataFrame:
    last = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("url")).withColumnRenamed("fa_id", "id")
    s = table(spark, d, "site").select(F.col("id").alias("siteid"), "hostname", "name")
    f = table(spark, d, "feed").select(F.col("id").alias("feedid"), F.col("url").alias("feed_url"))
    ps = table(spark, d, "feed_ps").groupBy("feedid").agg(F.max(F.struct("updated", "title"))["title"].alias("feed_title"))
    m = table(spark, d, "feed_article_meta").select("id", "title", F.col("pub_date").alias("published"), F.col("lang_iso").alias("lang")).distinct()
    a = table(spark, d, "article").groupBy("feed_articleid").agg(F.min("retrieved").alias("retrieved")).withColumnRenamed("feed_articleid", "id")
    fa = table(spark, d, "feed_article").select("id", "siteid", "feedid", "found", "acl_tagset")
    return _texts(spark, d).withColumnRenamed("content", "cleartext").join(fa, "id").join(s, "siteid").join(f, "feedid").join(ps, "feedid", "left").join(last, "id", "left").join(m, "id", "left").join(a, "id", "left")


def article_records(spark, d) -> DataFrame:
    """Every article with a cleartext as an XML record."""
    r = _records(spark, d)
    return r.select("id", A.article_xml(r).alias("xml"))


def archive_files(spark, d) -> DataFrame:
    """The archive file each text goes to: by access tag, half-hour window and size."""
    return _placed(spark, d, _texts(spark, d).select("id", F.octet_length("content").alias("bytes")))


def _placed(spark, d, sizes: DataFrame) -> DataFrame:
    t = sizes.join(table(spark, d, "feed_article").select("id", "found", "acl_tagset"), "id")
    r = t.select("id", F.explode(arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string"))).alias("acl"), F.col("found").alias("at"), "bytes")
    return A.rotated(r, limit=2000).select("acl", "id", "slot", "part", "bytes")


def _sizes(spark, d, owner: str) -> DataFrame:
    """(id, bytes) of the cleartexts, of the least where an id has several. Contents are shuffled only of ids whose texts
    differ in size; those ids are written first, so that the planner knows how many there are."""
    t = table(spark, d, "processed_article").where("mode = 'cleartext' and feed_articleid is not null").select(F.col("feed_articleid").alias("id"), "content")
    size = F.octet_length("content")
    ends = t.select("id", size.alias("n")).groupBy("id").agg(F.min("n").alias("bytes"), F.max("n").alias("most"))
    open_ = written(ends.where("bytes < most").select("id"), owner)
    least = t.join(open_, "id", "left_semi").groupBy("id").agg(F.min("content").alias("content"))
    return ends.where("bytes is null or bytes = most").select("id", "bytes").unionByName(least.select("id", size.alias("bytes")))


def archive_index(spark, d) -> DataFrame:
    """Files of the archive with their records and bytes, and the times in their names."""
    f = archive_files(spark, d).groupBy("acl", "slot", "part").agg(F.count("*").alias("records"), F.sum("bytes").cast("long").alias("bytes"))
    name = F.concat("acl", F.lit("-"), F.date_format(F.timestamp_seconds(F.col("slot") * A.AGE_S), "yyyy-MM-dd'T'HH-mm-ss'Z'"), F.lit("-"), F.lpad(F.col("part").cast("string"), 4, "0"), F.lit(".xml.gz"))
    return f.select("acl", name.alias("file"), "records", "bytes").withColumn("at_s", F.unix_timestamp(times.file_time(F.col("file"))))


def archive_next(spark, d) -> DataFrame:
    """For each access tag the oldest file after a given one, within the year that is kept."""
    f = archive_index(spark, d).where((F.unix_timestamp(now()) - F.col("at_s")) <= 365 * 86400)
    after = F.concat("acl", F.lit("-2024-06"))
    return f.where(F.col("file") > after).groupBy("acl").agg(F.min("file").alias("file"), F.count("*").alias("later"))


PASSWORDS = ["# users", "ann:x1", "#acl partner, render", "bob:x2", "cid:x3", "#acl partner"]


def access_granted(spark, d) -> DataFrame:
    """Which users of a password file may read how many articles."""
    lines = spark.createDataFrame(list(enumerate(PASSWORDS)), "line_no int, line string")
    t = table(spark, d, "feed_article").select("id", F.explode(F.array_distinct(arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string")))).alias("acl"))
    return t.join(F.broadcast(A.grants(lines)), "acl").groupBy("user", "acl").agg(F.count("*").alias("articles"))  # a password file is broadcast


def entries_exploded(spark, d) -> DataFrame:
    """Feed results (entries packed in arrays, one scan's entries each) unpacked again, with each feed's cutoff applied."""
    e = table(spark, d, "batch_item").groupBy("feedid").agg(F.array_sort(F.collect_list(F.struct("arrived", "id", "url", "title"))).alias("entries"))
    f = table(spark, d, "feed").select(F.col("id").alias("feedid"), "pruning_ts_last")
    x = e.join(f, "feedid").select("feedid", "pruning_ts_last", F.posexplode("entries").alias("pos", "e"))
    return x.select("feedid", "pos", "e.id", "e.url", (F.col("pruning_ts_last").isNull() | (F.col("e.arrived") >= F.col("pruning_ts_last"))).alias("kept"))


def enriched_places(spark, d) -> DataFrame:
    """Place ids found in enricher output, with their coordinates, beside the article's own (a union)."""
    m = table(spark, d, "feed_article_meta").where("geo is not null").select("id", "geo").distinct()
    xml = F.concat(F.lit('<x resource="http://sws.geonames.org/'), (F.col("id") % 97).cast("string"), F.lit('/"/>'))
    ids = m.select("id", F.explode(F.regexp_extract_all(xml, F.lit(r'resource="http://sws\.geonames\.org/(\d+)/"'), F.lit(1))).alias("place"))
    places = table(spark, d, "site").select(F.col("id").cast("string").alias("place"), F.explode(F.coalesce("tags", F.array().cast("array<string>"))).alias("t")).where("t rlike '^geo:-?[0-9.]+ -?[0-9.]+$'").select("place", F.substring("t", 5, 100).alias("geo"))
    own = m.select("id", F.explode(arrays.points(F.col("geo"))).alias("p")).select("id", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))
    more = ids.join(places, "place").select("id", F.explode(arrays.points(F.col("geo"))).alias("p")).select("id", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))
    return own.union(more).distinct()


def _searchable(spark, d) -> DataFrame:
    return _records(spark, d).select("id", "title", "cleartext", "lang", "hostname", "found")


def search_words(spark, d) -> DataFrame:
    return A.search(_searchable(spark, d), q="council bridge", lang="eng").select("id", "hostname")


def search_json(spark, d) -> DataFrame:
    return A.json_search(_searchable(spark, d), {"$from": "Article", "Title": "museum", "Body": "budget"}).select("id", "title")


QUERIES = {f.__name__: f for f in (article_records, archive_files, archive_index, archive_next, access_granted, entries_exploded, enriched_places, search_words, search_json)}

_ACL = "CASE WHEN acl_tagset IS NULL OR len(acl_tagset) = 0 THEN ['public'] ELSE acl_tagset END"
_FILES = f"""(SELECT acl, id, slot, CAST(floor(coalesce(sum(bytes) OVER (PARTITION BY acl, slot ORDER BY found, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 2000) AS BIGINT) AS part, bytes
FROM (SELECT id, unnest({_ACL}) AS acl, found, CAST(floor(epoch(found)) AS BIGINT) // 1800 AS slot, CAST(strlen(content) AS INT) AS bytes FROM {_T} t JOIN feed_article f USING (id)))"""
_INDEX = f"(SELECT acl, acl || '-' || strftime(make_timestamp(slot * 1800000000), '%Y-%m-%dT%H-%M-%SZ') || '-' || lpad(CAST(part AS VARCHAR), 4, '0') || '.xml.gz' AS file, count(*) AS records, CAST(sum(bytes) AS BIGINT) AS bytes, slot * 1800 AS at_s FROM {_FILES} GROUP BY acl, slot, part)"
_TOK = "string_split_regex(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{Nd}}]+')"
_REC = f"(SELECT t.id, m.title, content AS cleartext, lang_iso AS lang, hostname, found FROM {_T} t JOIN feed_article f ON f.id = t.id JOIN site s ON s.id = f.siteid LEFT JOIN (SELECT DISTINCT id, title, lang_iso FROM feed_article_meta) m ON m.id = t.id)"
_EL = lambda n, c: f"CASE WHEN {c} <> '' THEN '<{n}>' || {c} || '</{n}>' END"
_TIME = lambda c: f"strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')"
_BODY = f"array_to_string(list_transform(list_filter(list_transform(string_split(content, chr(10)), lambda y: trim(y)), lambda y: y <> ''), lambda y: '<p>' || {_xml('y')} || '</p>'), chr(10))"
ORACLE = {
    "article_records": f"""SELECT id, concat_ws(chr(10), '<article id="' || id || '">', '<source>' || coalesce({_EL('name', 'n')}, '') || coalesce({_EL('hostname', 'h')}, '') || '</source>',
'<feed>' || coalesce({_EL('title', 'ft')}, '') || coalesce({_EL('uri', 'fu')}, '') || '</feed>', {_EL('uri', 'u')}, {_EL('publish-date', 'pd')}, {_EL('retrieved-date', 'rd')}, {_EL('lang', 'l')}, {_EL('title', 't')}, {_EL('body-cleartext', 'b')}, '</article>') AS xml
FROM (SELECT x.id, {_xml('s.name')} AS n, {_xml('hostname')} AS h, {_xml('p.title')} AS ft, {_xml('f.url')} AS fu, {_xml('k.url')} AS u, {_TIME('m.pub_date')} AS pd, {_TIME('r.retrieved')} AS rd, {_xml('m.lang_iso')} AS l, {_xml('m.title')} AS t, {_BODY} AS b
FROM {_T} x JOIN feed_article a ON a.id = x.id JOIN site s ON s.id = a.siteid JOIN feed f ON f.id = a.feedid LEFT JOIN (SELECT feedid, r.title AS title FROM (SELECT feedid, max({{'updated': updated, 'title': title}}) AS r FROM feed_ps GROUP BY 1)) p ON p.feedid = a.feedid
LEFT JOIN (SELECT fa_id, arg_max(url, (seq, url)) AS url FROM feed_article_urls GROUP BY 1) k ON k.fa_id = x.id LEFT JOIN (SELECT DISTINCT id, title, pub_date, lang_iso FROM feed_article_meta) m ON m.id = x.id LEFT JOIN (SELECT feed_articleid, min(retrieved) AS retrieved FROM article GROUP BY 1) r ON r.feed_articleid = x.id)""",
    "archive_files": f"SELECT * FROM {_FILES}",
    "archive_index": f"SELECT * FROM {_INDEX}",
    "archive_next": f"SELECT acl, min(file) AS file, count(*) AS later FROM {_INDEX} WHERE epoch(TIMESTAMPTZ '2024-11-28 00:00:00+00') - at_s <= 31536000 AND file > acl || '-2024-06' GROUP BY 1",
    "access_granted": f"SELECT u AS user, acl, count(*) AS articles FROM (SELECT id, unnest(list_distinct({_ACL})) AS acl FROM feed_article) a JOIN (VALUES ('ann', 'partner'), ('ann', 'render'), ('ann', 'public'), ('bob', 'public'), ('cid', 'partner'), ('cid', 'public')) g(u, acl) USING (acl) GROUP BY 1, 2",
    "entries_exploded": "SELECT b.feedid, CAST(row_number() OVER (PARTITION BY b.feedid ORDER BY arrived, b.id) - 1 AS INT) AS pos, b.id, b.url, pruning_ts_last IS NULL OR arrived >= pruning_ts_last AS kept FROM batch_item b JOIN feed f ON f.id = b.feedid",
    "enriched_places": r"""WITH m AS (SELECT DISTINCT id, geo FROM feed_article_meta WHERE geo IS NOT NULL), e AS (SELECT id, unnest(string_split(geo, ';')) AS g FROM m),
p AS (SELECT CAST(id AS VARCHAR) AS place, substring(t, 5) AS g FROM (SELECT id, unnest(tags) AS t FROM site) WHERE regexp_matches(t, '^geo:-?[0-9.]+ -?[0-9.]+$')),
x AS (SELECT id, g FROM e UNION ALL SELECT m.id, p.g FROM m JOIN p ON p.place = CAST(m.id % 97 AS VARCHAR)), y AS (SELECT id, string_split_regex(trim(g), '\s+') AS w FROM x)
SELECT DISTINCT id, TRY_CAST(w[1] AS DOUBLE) AS lat, TRY_CAST(w[2] AS DOUBLE) AS lon FROM y WHERE len(w) = 2 AND TRY_CAST(w[1] AS DOUBLE) IS NOT NULL AND TRY_CAST(w[2] AS DOUBLE) IS NOT NULL""",
    "search_words": f"SELECT id, hostname FROM {_REC} WHERE lang = 'eng' AND list_contains(list_concat({_TOK.format('title')}, {_TOK.format('cleartext')}), 'council') AND list_contains(list_concat({_TOK.format('title')}, {_TOK.format('cleartext')}), 'bridge') ORDER BY found DESC, id DESC LIMIT 100",
    "search_json": f"SELECT id, title FROM {_REC} WHERE list_contains({_TOK.format('title')}, 'museum') AND list_contains({_TOK.format('cleartext')}, 'budget') ORDER BY found DESC, id DESC LIMIT 100",
}
