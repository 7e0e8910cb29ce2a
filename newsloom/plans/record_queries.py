"""Records: filters, capped fields, samples, groups of work, enrichers, envelopes, language labels and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import arrays, text, urls
from newsloom.functions.iso639 import language
from newsloom.operators import archive as A
from newsloom.operators.enrich import enriched
from newsloom.plans.archive_queries import _FILES, _placed, _sizes
from newsloom.plans.language_queries import sql_language
from newsloom.plans.relational_queries import SQL_NOW, now
from newsloom.plans.text_queries import _T, _texts, _titles, _xml
from newsloom.runtime import fresh, owned, shared_dir, table
from newsloom.sources.readers import ngram_hash


def _meta(spark, d) -> DataFrame:
    return table(spark, d, "feed_article_meta")


def scorable(spark, d, word: str = "herald") -> DataFrame:
    """Articles that a scorer takes: German ones, and those of hosts whose name has a word."""
    fa = table(spark, d, "feed_article").select("id", "siteid").join(table(spark, d, "site").select(F.col("id").alias("siteid"), "hostname"), "siteid")
    j = fa.join(_meta(spark, d).select("id", language(F.col("lang_iso")).alias("lang")).distinct(), "id", "left")
    return j.where((F.col("lang") == "deu") | F.contains("hostname", F.lit(word))).select("id").distinct()


def public_only(spark, d) -> DataFrame:
    """Articles that anybody may read."""
    tags = arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string"))
    return table(spark, d, "feed_article").where(F.array_contains(tags, "public")).select("id")


def requests_after(spark, d, mark: int = 2000) -> DataFrame:
    """Requests above a high-water mark that may be fetched now, as ``crawl_requests`` joins them."""
    fa = table(spark, d, "feed_article").where(F.col("enqueued") & (F.col("id") > mark) & (F.col("next_attempt").isNull() | (F.col("next_attempt") < now())))
    s = table(spark, d, "site").where("not disabled and not locked").select(F.col("id").alias("siteid"), "hostname")
    return fa.select("id", "siteid").join(s, "siteid").select("id", "hostname")


def capped_fields(spark, d) -> DataFrame:
    """Feed descriptions cut to the lengths a store takes."""
    cap = lambda c, n: F.left(F.col(c), F.lit(n)).alias(c)
    return table(spark, d, "feed_ps").select("feedid", cap("title", 1000), cap("description", 10_000), cap("copyright", 100_000)).distinct()


def final_urls(spark, d) -> DataFrame:
    """Each article's address: as reached last, where it was followed at all, else as discovered."""
    u = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.min(F.struct("seq", "url"))["url"].alias("url"), F.max(F.when(F.col("seq") > 1, F.struct("seq", "url")))["url"].alias("final_url"))
    return u.select("fa_id", F.coalesce("final_url", "url").alias("url"), F.col("final_url").isNotNull().alias("followed"))


#: Languages left out of training sets. Fixed value.
EXCLUDED = ("enz",)


def training_sample(spark, d, most: int = 1000) -> DataFrame:
    """A training set for language models: articles of sites whose domain is of one country, with text, label and site; an
    excluded label never counts, at most ``most`` articles of each label, by a hash of their id."""
    s = table(spark, d, "site").where("length(tld) = 2").select(F.col("id").alias("siteid"), "hostname", "tld")
    fa = table(spark, d, "feed_article").select("id", "siteid")
    m = _meta(spark, d).select("id", language(F.col("lang_iso")).alias("lang")).where(F.col("lang").isNotNull() & ~F.col("lang").isin(*EXCLUDED)).distinct()
    p = table(spark, d, "processed_article").where("mode = 'cleartext'").select(F.col("feed_articleid").alias("id")).distinct()
    w = Window.partitionBy("lang").orderBy(F.expr("id * 7919 % 10007"), "id")
    j = fa.join(s, "siteid").join(m, "id").join(p, "id")
    return j.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).select("id", "lang", "hostname", "tld")


def story_articles(spark, d) -> DataFrame:
    """Articles of stories (titles that several articles share), each with its story's number and size: an inner join."""
    t = _titles(spark, d)
    s = t.groupBy("title").agg(F.min("id").alias("story_id"), F.count("*").alias("articles")).where("articles > 1")
    return table(spark, d, "feed_article").select("id", "siteid").join(t, "id").join(s, "title").select("id", "siteid", "story_id", "articles")


def cleartext_legs(spark, d) -> DataFrame:
    """Every article with its cleartext's size if it has one: the mode stands in the join's condition, so none is lost."""
    p = table(spark, d, "processed_article").select("feed_articleid", "mode", F.length("content").alias("chars")).distinct()
    fa = table(spark, d, "feed_article").select("id")
    return fa.join(p, (p.feed_articleid == fa.id) & (p.mode == "cleartext"), "left").select("id", "mode", "chars")


def work_by_site(spark, d, block: int = 1000) -> DataFrame:
    """Requests of each site as one map of ids and addresses, in blocks of at most ``block`` so that no row grows with a site."""
    u = table(spark, d, "feed_article_urls").groupBy(F.col("fa_id").alias("id")).agg(F.min(F.struct("seq", "url"))["url"].alias("url"))
    r = table(spark, d, "feed_article").where("enqueued").select("id", "siteid").join(u, "id").withColumn("part", F.floor(F.col("id") / block))
    m = F.map_from_entries(F.array_sort(F.collect_list(F.struct("id", "url"))))
    g = r.groupBy("siteid", "part").agg(m.alias("work"))
    return g.select("siteid", "part", F.size("work").alias("n"), F.array_join(F.transform(F.map_entries("work"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"])), " ").alias("work"))


def contact_lines_cut(spark, d) -> DataFrame:
    """Cleartexts without closing lines that say whom to write to: their lines and size."""
    c = F.regexp_replace("content", r"(?:\n\s*(?i:to contact the (?:editor|reporter))[^\n]*)+\s*$", "")
    return _texts(spark, d).select("id", F.size(F.split(c, "\n")).alias("lines"), F.length(c).alias("chars"))


def stop_runs_cut(spark, d, n: int = 9) -> DataFrame:
    """Cleartexts without the runs of nine words that more than five texts share, found by the runs' hashes: words left."""
    split = _texts(spark, d).where("content is not null").select("id", F.explode(F.array(F.split(F.regexp_replace("content", r"\s+", " "), " "))).alias("w"))  # split once, not for each run
    tokens = F.col("w")
    grams = F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: ngram_hash(F.array_join(F.slice(tokens, i, F.lit(n)), " "))))
    t = split.select("id", F.size(tokens).alias("words"), grams.alias("g"))
    at = t.select("id", F.posexplode("g").alias("p", "h"))
    stops = at.select("id", "h").distinct().groupBy("h").agg(F.count("*").alias("c")).where("c > 5").select("h")
    hit = at.join(stops, "h", "left_semi").select("id", F.explode(F.sequence(F.col("p"), F.col("p") + (n - 1))).alias("i")).groupBy("id").agg(F.count_distinct("i").alias("cut"))
    return t.join(hit, "id", "left").select("id", (F.col("words") - F.coalesce("cut", F.lit(0))).cast("int").alias("left"))


def labels_compared(spark, d) -> DataFrame:
    """How often two classifiers name which pair of languages, and how often they agree."""
    m = _meta(spark, d).select("id", language(F.col("lang_iso")).alias("one"), language(F.col("lang_altcode")).alias("two")).distinct()
    return m.groupBy("one", "two").agg(F.count("*").alias("n"), F.count_if(F.col("one") == F.col("two")).alias("agree"))


def labels_mapped(spark, d) -> DataFrame:
    """Every label that occurs, with the language it names by the whole of ISO 639-1."""
    return _meta(spark, d).select(F.col("lang_iso").alias("label")).union(table(spark, d, "feed_ps").select("language")).distinct().select("label", language(F.col("label")).alias("lang"))


#: Languages the first classifier knows, so that a second one never overrules it there. Fixed values.
FIRST_KNOWS = ("eng", "deu", "fra", "spa", "por", "rus")


def cascade_suppressed(spark, d) -> DataFrame:
    """The first classifier's language, else the second's, but never one of those the first knows and didn't name."""
    m = _meta(spark, d).select("id", F.when(F.col("lang_is_cld"), language(F.col("lang_iso"))).alias("first"), language(F.col("lang_altcode")).alias("second")).distinct()
    kept = F.when(~F.col("second").isin(*FIRST_KNOWS), F.col("second"))
    return m.select("id", F.coalesce("first", kept).alias("lang")).distinct()


def random_top(spark, d, n: int = 100) -> DataFrame:
    """A repeatable random choice: the n articles whose hash comes first."""
    return table(spark, d, "feed_article").orderBy(F.expr("id * 7919 % 10007"), "id").limit(n).select("id")


def tags_in_order(spark, d) -> DataFrame:
    """Each article's tags once each, in the order they stand."""
    return _meta(spark, d).select("id", "tags").distinct().select("id", F.array_join(F.array_distinct(arrays.full_tags(F.col("tags"))), "|").alias("tags"))


def display_events(spark, d) -> DataFrame:
    """Public articles as events of a live display, all ten keys each."""
    last = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("url")).withColumnRenamed("fa_id", "id")
    s = table(spark, d, "site").select(F.col("id").alias("siteid"), "hostname", F.col("name").alias("source"))
    tags = arrays.access_tags(F.col("acl_tagset"), F.lit(None).cast("string"))
    fa = table(spark, d, "feed_article").where(F.array_contains(tags, "public")).select("id", "siteid", "feedid", F.unix_timestamp("found").alias("found"))
    m = _meta(spark, d).groupBy("id").agg(F.min(F.struct("title", "img", "geo", "lang_iso")).alias("m"))
    j = fa.join(s, "siteid").join(last, "id", "left").join(m, "id", "left")
    keys = F.struct("id", "feedid", "hostname", "source", "url", F.col("m.title").alias("title"), F.col("m.img").alias("img"), F.col("m.geo").alias("geo"), F.col("m.lang_iso").alias("lang"), "found")
    return j.select("id", F.to_json(keys, {"ignoreNullFields": "false"}).alias("json"))


def source_geo(spark, d) -> DataFrame:
    """Each site's place: what its tags say goes before what its domain says, field by field, coordinates as well."""
    m = arrays.tag_map(F.col("tags"))
    s = table(spark, d, "site").select("id", "tld", m.alias("m"))
    point = F.try_element_at(arrays.points(F.try_element_at("m", F.lit("geo"))), F.lit(1))
    return s.select("id", F.coalesce(F.try_element_at("m", F.lit("country")), F.upper("tld")).alias("country"), F.try_element_at("m", F.lit("city")).alias("city"), point["lat"].alias("lat"), point["lon"].alias("lon"))


def geo_overridden(spark, d) -> DataFrame:
    """An enricher's places, where it gave any, instead of the article's own; else these stay."""
    own = _meta(spark, d).where("geo is not null").select("id", "geo").distinct().select("id", F.explode(arrays.points(F.col("geo"))).alias("p")).select("id", "p.lat", "p.lon")
    site = table(spark, d, "feed_article").select("id", F.col("siteid")).join(source_geo(spark, d).select(F.col("id").alias("siteid"), "lat", "lon").where("lat is not null"), "siteid").select("id", "lat", "lon")
    kept = own.join(site.select("id").distinct(), "id", "left_anti")
    return site.union(kept).distinct()


def enriched_titles(spark, d) -> DataFrame:
    """Titles through two enrichers in turn: one counts the words and fails on titles with figures, the other fails where the
    first gave none; every record comes out."""

    def words(r: dict) -> str:
        if any(c in "0123456789" for c in r["title"]):
            raise ValueError("figures")
        return str(len(r["title"].split(" ")))

    def grade(r: dict) -> str:
        return "long" if int(r["words"]) > 8 else "short"

    t = enriched(_titles(spark, d), words, "words", ["title"])
    return enriched(t, grade, "grade", ["words"]).select("id", "words", "grade")


def archive_written(spark, d) -> DataFrame:
    """The archive as compressed files, each with its envelope, read back: records and envelopes of each file."""
    fresh("archive")
    spark_dir = owned(f"{shared_dir(spark)}/newsloom-archive-{abs(hash(d)) % 10**8}", "archive")
    r = _placed(spark, d, _sizes(spark, d, "archive")).join(_meta(spark, d).groupBy("id").agg(F.min("title").alias("title")), "id", "left")
    xml = F.concat(F.lit('<article id="'), F.col("id").cast("string"), F.lit('">'), F.coalesce(A.element("title", text.xml_escape(F.col("title"))), F.lit("")), F.lit("</article>"))
    A.write_archive(r.select("acl", "slot", "part", "id", xml.alias("xml")), spark_dir)
    got = A.read_archive(spark, spark_dir)
    return got.groupBy("acl", "slot", "part").agg(F.count_if(F.startswith("value", F.lit("<article id"))).alias("records"), F.count_if(F.startswith("value", F.lit("<?xml"))).alias("heads"), F.count_if(F.col("value") == A.FOOTER).alias("feet"))


def records_unwrapped(spark, d) -> DataFrame:
    """XML texts whose declaration is taken away again, and lists as escaped elements."""
    t = _meta(spark, d).select("id", "title", "tags").where("title is not null").distinct()
    x = text.remove_xml_header(F.concat(F.lit('<?xml version="1.0"?>'), text.xml_escape(F.col("title"))))
    return t.select("id", x.alias("xml"), text.xml_list(arrays.full_tags(F.col("tags")), "tag").alias("tags"))


def entry_images(spark, d) -> DataFrame:
    """The image of each article: the one its metadata links, else the only one of its page."""
    from newsloom.plans.text_queries import only_images

    m = _meta(spark, d).groupBy("id").agg(F.max("img").alias("linked"))
    return m.join(only_images(spark, d).select("id", F.col("img").alias("only")), "id", "left").select("id", F.coalesce("linked", "only").alias("img"))


def entry_fields(spark, d) -> DataFrame:
    """Items as article fields: flat title, tags of the feed's site, point, time or the feed's default; faulty ones are told apart."""
    f = table(spark, d, "feed").select(F.col("id").alias("feedid"), "siteid", "pruning_ts_last")
    s = source_geo(spark, d).select(F.col("id").alias("siteid"), "lat", "lon")
    t = table(spark, d, "site").select(F.col("id").alias("siteid"), F.size(arrays.plain_tags(F.col("tags"))).alias("tags"))
    e = table(spark, d, "batch_item").join(f, "feedid").join(s, "siteid", "left").join(t, "siteid", "left")
    faulty = ~F.coalesce(urls.acceptable(F.col("url"), F.lit(0)), F.lit(False))
    return e.select("id", F.when(~faulty, F.col("url")).alias("url"), F.regexp_replace("title", r"\n", " ").alias("title"), "tags", "lat", "lon", F.unix_micros(F.coalesce("arrived", "pruning_ts_last")).alias("at"), faulty.alias("faulty"))


def search_urls(spark, d) -> DataFrame:
    """A search by host and day, the second page of ten."""
    from newsloom.plans.archive_queries import _records

    r = _records(spark, d).select("id", "title", "cleartext", "lang", "hostname", "found", "url")
    return A.search(r, url="news", offset=10, page=10).select("id", "hostname")


QUERIES = {
    f.__name__: f
    for f in (
        scorable, public_only, requests_after, capped_fields, final_urls, training_sample, story_articles, cleartext_legs, work_by_site, contact_lines_cut, stop_runs_cut, labels_compared,
        labels_mapped, cascade_suppressed, random_top, tags_in_order, display_events, source_geo, geo_overridden, enriched_titles, archive_written, records_unwrapped, entry_images, entry_fields, search_urls,
    )
}

_ACL = "CASE WHEN acl_tagset IS NULL OR len(acl_tagset) = 0 THEN ['public'] ELSE acl_tagset END"
_PLACE = r"""(WITH t AS (SELECT id, tld, list_filter(coalesce(tags, []), lambda x: x <> '' AND len(string_split(x, ':')) = 2) AS p FROM site), g AS (SELECT id, tld, list_filter(p, lambda x: split_part(x, ':', 1) = 'country')[-1] AS c, list_filter(p, lambda x: split_part(x, ':', 1) = 'city')[-1] AS y, split_part(list_filter(p, lambda x: split_part(x, ':', 1) = 'geo')[-1], ':', 2) AS g FROM t),
w AS (SELECT *, list_filter(list_transform(string_split(g, ';'), lambda x: string_split_regex(trim(x), '\s+')), lambda x: len(x) = 2 AND TRY_CAST(x[1] AS DOUBLE) IS NOT NULL AND TRY_CAST(x[2] AS DOUBLE) IS NOT NULL)[1] AS q FROM g)
SELECT id, coalesce(split_part(c, ':', 2), upper(tld)) AS country, split_part(y, ':', 2) AS city, TRY_CAST(q[1] AS DOUBLE) AS lat, TRY_CAST(q[2] AS DOUBLE) AS lon FROM w)"""
_JS = lambda k, c: f"'\"{k}\":' || coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"
ORACLE = {
    "scorable": f"SELECT DISTINCT f.id FROM feed_article f JOIN site s ON s.id = f.siteid LEFT JOIN feed_article_meta m ON m.id = f.id WHERE {sql_language('lang_iso')} = 'deu' OR contains(hostname, 'herald')",
    "public_only": f"SELECT id FROM feed_article WHERE list_contains({_ACL}, 'public')",
    "requests_after": f"SELECT f.id, hostname FROM feed_article f JOIN site s ON s.id = f.siteid WHERE enqueued AND f.id > 2000 AND (next_attempt IS NULL OR next_attempt < {SQL_NOW}) AND NOT s.disabled AND NOT locked",
    "capped_fields": "SELECT DISTINCT feedid, left(title, 1000) AS title, left(description, 10000) AS description, left(copyright, 100000) AS copyright FROM feed_ps",
    "final_urls": "SELECT fa_id, coalesce(f, u) AS url, f IS NOT NULL AS followed FROM (SELECT fa_id, arg_min(url, (seq, url)) AS u, arg_max(url, (seq, url)) FILTER (seq > 1) AS f FROM feed_article_urls GROUP BY 1)",
    "training_sample": f"SELECT id, lang, hostname, tld FROM (SELECT f.id, lang, hostname, tld, row_number() OVER (PARTITION BY lang ORDER BY f.id * 7919 % 10007, f.id) AS k FROM feed_article f JOIN site s ON s.id = f.siteid AND length(tld) = 2 JOIN (SELECT DISTINCT id, {sql_language('lang_iso')} AS lang FROM feed_article_meta) m ON m.id = f.id WHERE lang <> 'enz' AND f.id IN (SELECT feed_articleid FROM processed_article WHERE mode = 'cleartext')) WHERE k <= 1000",
    "story_articles": "WITH t AS (SELECT DISTINCT id, title FROM feed_article_meta WHERE title IS NOT NULL), s AS (SELECT title, min(id) AS story_id, count(*) AS articles FROM t GROUP BY 1 HAVING count(*) > 1) SELECT f.id, siteid, story_id, articles FROM feed_article f JOIN t USING (id) JOIN s USING (title)",
    "cleartext_legs": "SELECT f.id, mode, chars FROM feed_article f LEFT JOIN (SELECT DISTINCT feed_articleid, mode, length(content) AS chars FROM processed_article) p ON p.feed_articleid = f.id AND mode = 'cleartext'",
    "work_by_site": "SELECT siteid, id // 1000 AS part, CAST(count(*) AS INT) AS n, string_agg(id || '=' || url, ' ' ORDER BY id) AS work FROM feed_article JOIN (SELECT fa_id, arg_min(url, (seq, url)) AS url FROM feed_article_urls GROUP BY 1) u ON fa_id = id WHERE enqueued GROUP BY 1, 2",
    "contact_lines_cut": f"SELECT id, CAST(len(string_split(c, chr(10))) AS INT) AS lines, CAST(length(c) AS INT) AS chars FROM (SELECT id, regexp_replace(content, '(?:\\n\\s*(?i:to contact the (?:editor|reporter))[^\\n]*)+\\s*$', '') AS c FROM {_T})",
    "stop_runs_cut": f"""WITH t AS (SELECT id, string_split(regexp_replace(content, '\\s+', ' ', 'g'), ' ') AS w FROM {_T} x WHERE content IS NOT NULL), g AS (SELECT id, i, array_to_string(w[i:i + 8], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 7)) AS i FROM t)),
s AS (SELECT g FROM (SELECT DISTINCT id, g FROM g) GROUP BY 1 HAVING count(*) > 5), c AS (SELECT id, count(DISTINCT i + k) AS cut FROM g JOIN s USING (g), (SELECT unnest(range(0, 9)) AS k) GROUP BY 1) SELECT t.id, CAST(len(w) - coalesce(cut, 0) AS INT) AS left FROM t LEFT JOIN c USING (id)""",
    "labels_compared": f"SELECT one, two, count(*) AS n, count(*) FILTER (one = two) AS agree FROM (SELECT DISTINCT id, {sql_language('lang_iso')} AS one, {sql_language('lang_altcode')} AS two FROM feed_article_meta) GROUP BY 1, 2",
    "labels_mapped": f"SELECT label, {sql_language('label')} AS lang FROM (SELECT lang_iso AS label FROM feed_article_meta UNION SELECT language FROM feed_ps)",
    "cascade_suppressed": f"SELECT DISTINCT id, coalesce(a, CASE WHEN b NOT IN ('eng', 'deu', 'fra', 'spa', 'por', 'rus') THEN b END) AS lang FROM (SELECT id, CASE WHEN lang_is_cld THEN {sql_language('lang_iso')} END AS a, {sql_language('lang_altcode')} AS b FROM feed_article_meta)",
    "random_top": "SELECT id FROM feed_article ORDER BY id * 7919 % 10007, id LIMIT 100",
    "tags_in_order": "SELECT id, coalesce(array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), '|'), '') AS tags FROM (SELECT id, list_filter(coalesce(tags, []), lambda t: t <> '') AS f FROM (SELECT DISTINCT id, tags FROM feed_article_meta))",
    "display_events": f"""SELECT f.id, '{{' || {_JS('id', 'f.id')} || ',' || {_JS('feedid', 'f.feedid')} || ',' || {_JS('hostname', 'hostname')} || ',' || {_JS('source', 'name')} || ',' || {_JS('url', 'url')} || ',' || {_JS('title', 'm.title')} || ',' || {_JS('img', 'm.img')} || ',' || {_JS('geo', 'm.geo')} || ',' || {_JS('lang', 'm.lang_iso')} || ',' || {_JS('found', 'CAST(floor(epoch(found)) AS BIGINT)')} || '}}' AS json
FROM feed_article f JOIN site s ON s.id = f.siteid LEFT JOIN (SELECT fa_id, arg_max(url, (seq, url)) AS url FROM feed_article_urls GROUP BY 1) u ON fa_id = f.id LEFT JOIN (SELECT DISTINCT id, title, img, geo, lang_iso FROM feed_article_meta) m ON m.id = f.id WHERE list_contains({_ACL}, 'public')""",
    "source_geo": f"SELECT * FROM {_PLACE}",
    "geo_overridden": f"""WITH s AS (SELECT f.id, lat, lon FROM feed_article f JOIN {_PLACE} p ON p.id = siteid WHERE lat IS NOT NULL), o AS (SELECT id, string_split_regex(trim(g), '\\s+') AS w FROM (SELECT DISTINCT id, unnest(string_split(geo, ';')) AS g FROM feed_article_meta WHERE geo IS NOT NULL))
SELECT id, lat, lon FROM s UNION SELECT id, TRY_CAST(w[1] AS DOUBLE), TRY_CAST(w[2] AS DOUBLE) FROM o WHERE len(w) = 2 AND TRY_CAST(w[1] AS DOUBLE) IS NOT NULL AND TRY_CAST(w[2] AS DOUBLE) IS NOT NULL AND id NOT IN (SELECT id FROM s)""",
    "enriched_titles": "SELECT id, CASE WHEN NOT d THEN CAST(n AS VARCHAR) END AS words, CASE WHEN d THEN NULL WHEN n > 8 THEN 'long' ELSE 'short' END AS grade FROM (SELECT id, regexp_matches(title, '[0-9]') AS d, len(string_split(title, ' ')) AS n FROM (SELECT DISTINCT id, title FROM feed_article_meta WHERE title IS NOT NULL))",
    "archive_written": f"SELECT acl, slot, part, count(*) AS records, CAST(1 AS BIGINT) AS heads, CAST(1 AS BIGINT) AS feet FROM {_FILES} GROUP BY acl, slot, part",
    "records_unwrapped": f"SELECT id, {_xml('title')} AS xml, coalesce(array_to_string(list_transform(list_filter(tags, lambda t: t <> ''), lambda t: '<tag>' || {_xml('t')} || '</tag>'), ''), '') AS tags FROM (SELECT DISTINCT id, title, tags FROM feed_article_meta WHERE title IS NOT NULL)",
    "entry_images": "WITH p AS (SELECT feed_articleid AS id, decode(min(content)) AS html FROM article WHERE content IS NOT NULL AND feed_articleid IN (SELECT id FROM feed_article_meta WHERE is_utf8 = '1') GROUP BY 1), o AS (SELECT id, regexp_extract_all(html, '(?i)<img[^>]*src=[\"'']([^\"'']+)', 1) AS i FROM p) SELECT m.id, coalesce(linked, CASE WHEN len(i) = 1 THEN i[1] END) AS img FROM (SELECT id, max(img) AS linked FROM feed_article_meta GROUP BY 1) m LEFT JOIN o ON o.id = m.id",
    "entry_fields": f"SELECT b.id, CASE WHEN NOT faulty THEN b.url END AS url, replace(title, chr(10), ' ') AS title, CAST(len(list_filter(coalesce(s.tags, []), lambda x: x <> '' AND NOT regexp_matches(x, '^(city|country|region|geo):'))) AS INT) AS tags, lat, lon, epoch_us(coalesce(arrived, pruning_ts_last)) AS at, faulty FROM (SELECT *, NOT coalesce(lower(left(url, 4)) = 'http' AND lower(right(url, 4)) <> '.mp3' AND length(url) <= 4095, false) AS faulty FROM batch_item) b JOIN feed f ON f.id = b.feedid LEFT JOIN {_PLACE} p ON p.id = f.siteid LEFT JOIN site s ON s.id = f.siteid",
    "search_urls": f"SELECT t.id, hostname FROM {_T} t JOIN feed_article f ON f.id = t.id JOIN site s ON s.id = f.siteid JOIN feed e ON e.id = f.feedid LEFT JOIN (SELECT fa_id, arg_max(url, (seq, url)) AS url FROM feed_article_urls GROUP BY 1) u ON fa_id = t.id WHERE contains(lower(u.url), 'news') ORDER BY found DESC, t.id DESC LIMIT 10 OFFSET 10",
}
