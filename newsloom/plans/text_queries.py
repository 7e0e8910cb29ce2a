"""Text, URL, header, time and array queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import arrays, text, times, urls
from newsloom.operators import decode, extract
from newsloom.plans.relational_queries import SQL_NOW, now
from newsloom.runtime import once, table


def _texts(spark, d) -> DataFrame:
    """(id, content) of the cleartexts, once each: only rows of repeated ids are shuffled."""
    t = table(spark, d, "processed_article").where("mode = 'cleartext' and feed_articleid is not null").select(F.col("feed_articleid").alias("id"), "content")
    return once(t, "id")


def _titles(spark, d) -> DataFrame:
    return table(spark, d, "feed_article_meta").where("title is not null").select("id", "title").distinct()


def _pages(spark, d) -> DataFrame:
    utf8 = table(spark, d, "feed_article_meta").where("is_utf8 = '1'").select("id").distinct()
    a = once(table(spark, d, "article").where("content is not null and feed_articleid is not null").select(F.col("feed_articleid").alias("id"), "content"), "id")
    return a.join(utf8, "id", "left_semi").select("id", text.utf8(F.col("content")).alias("html"))


def text_forms(spark, d) -> DataFrame:
    """Title line, length of the body, bare form's size and digest of each cleartext."""
    c = F.col("content")
    return _texts(spark, d).select("id", text.title_line(c).alias("title"), F.length(text.without_title(c)).alias("body_chars"), text.data_len(c).alias("bytes"), F.md5(text.bare_form(c).cast("binary")).alias("bare_md5"), F.length(text.collapse_digits(c)).alias("collapsed"))


def intros(spark, d) -> DataFrame:
    return _texts(spark, d).select("id", text.intro(F.col("content")).alias("intro"))


def title_matches(spark, d) -> DataFrame:
    """Whether an article's first line is its stored title but for small edits."""
    j = _texts(spark, d).join(_titles(spark, d), "id").select("id", F.col("title").alias("a"), text.title_line(F.col("content")).alias("b"))
    return j.select("id", text.title_like(F.col("a"), F.col("b")).alias("same"))


def page_text(spark, d) -> DataFrame:
    """Running text of the decoded pages by tag stripping: size and digest."""
    t = text.textify(F.col("html"))
    return _pages(spark, d).select("id", F.length(t).alias("chars"), F.md5(t.cast("binary")).alias("md5"))


def page_lines(spark, d) -> DataFrame:
    """Lines of the decoded pages after cleanup: count and digest."""
    t = text.tidy_lines(F.col("html"))
    return _pages(spark, d).select("id", F.size(F.split(t, "\n")).alias("lines"), F.md5(t.cast("binary")).alias("md5"))


def plain_titles(spark, d) -> DataFrame:
    """Titles with typographic characters made plain."""
    return _titles(spark, d).select("id", text.normalize_punctuation(F.col("title"), whitespace=True).alias("plain"))


def titles_encoded(spark, d) -> DataFrame:
    """Titles as they stand in a query string."""
    return _titles(spark, d).select("id", urls.percent_encode(F.col("title")).alias("encoded"))


def xml_titles(spark, d) -> DataFrame:
    """Titles escaped to ASCII XML."""
    return _titles(spark, d).select("id", text.xml_escape(F.col("title")).alias("xml"))


def xml_paragraphs(spark, d) -> DataFrame:
    """Cleartexts as escaped paragraphs: number and digest."""
    p = text.mark_paras(F.col("content"))
    return _texts(spark, d).select("id", F.size(F.split(p, "\n")).alias("paras"), F.md5(p.cast("binary")).alias("md5"))


def text_digests(spark, d) -> DataFrame:
    """64-bit digests: last eight bytes of the MD5 as an unsigned number."""
    return _texts(spark, d).select("id", text.md5_tail(F.col("content")).cast("string").alias("digest"))


def ngrams_removed(spark, d) -> DataFrame:
    """Titles without the three-word runs that more than 20 titles share."""
    tokens = F.split("title", " ")
    grams = F.when(F.size(tokens) >= 3, F.transform(F.sequence(F.lit(1), F.size(tokens) - 2), lambda i: F.array_join(F.slice(tokens, i, F.lit(3)), " ")))
    t = _titles(spark, d)
    often = t.select("id", F.explode(F.array_distinct(grams)).alias("g")).groupBy("g").agg(F.count("*").alias("n")).where("n > 20").select("g", F.lit(True).alias("stop"))
    # positions covered by a stop run, by join: the stop list may grow with the corpus
    at = t.select("id", F.posexplode(F.filter(grams, lambda g: g.isNotNull())).alias("p", "g")).join(often, "g").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(F.array("p", F.col("p") + 1, F.col("p") + 2)))).alias("cut"))
    kept = F.filter(F.transform(tokens, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: F.col("cut").isNull() | ~F.array_contains("cut", s["i"]))
    return t.join(at, "id", "left").select("id", F.array_join(F.transform(kept, lambda s: s["x"]), " ").alias("rest"))


def url_parts(spark, d) -> DataFrame:
    """Authority, host piece, media suffix and acceptability of every URL."""
    u = table(spark, d, "feed_article_urls").select("url").union(table(spark, d, "batch_item").select("url")).where("url is not null").distinct()
    return u.select("url", urls.authority(F.regexp_replace("url", r"^\s+|\s+$", "")).alias("authority"), urls.host_part(F.col("url")).alias("host"), urls.is_media(F.col("url")).alias("media"), urls.acceptable(F.col("url"), F.lit(1)).alias("ok"))


def urls_rewritten(spark, d) -> DataFrame:
    """URLs rewritten by their feed's pattern."""
    f = table(spark, d, "feed").select(F.col("id").alias("fa_feed_id"), "regex")
    u = table(spark, d, "feed_article_urls").select("fa_id", "fa_feed_id", "url").distinct().join(f, "fa_feed_id")
    return u.select("fa_id", "url", urls.rewritten(F.col("url"), F.col("regex"), F.lit(False)).alias("rewritten"))


def urls_decoded(spark, d) -> DataFrame:
    """URLs with their escapes decoded, where the feed asks for it."""
    f = table(spark, d, "feed").where("parse_unquote").select(F.col("id").alias("fa_feed_id"))
    u = table(spark, d, "feed_article_urls").join(f, "fa_feed_id", "left_semi").select("fa_id", "url").distinct()
    return u.select("fa_id", "url", urls.percent_decode(F.col("url")).alias("plain"))


def headers_read(spark, d) -> DataFrame:
    """Content type, charset and server of each page's header lines."""
    a = table(spark, d, "article").where("headers is not null").groupBy("feed_articleid").agg(F.min("headers").alias("headers"))
    h = a.select("feed_articleid", arrays.header_map(F.col("headers")).alias("h"))
    ct = F.try_element_at("h", F.lit("content-type"))
    return h.select(F.col("feed_articleid").alias("id"), ct.alias("content_type"), F.regexp_extract(ct, r"charset=[\"']?([a-z0-9_-]+)", 1).alias("charset"), F.try_element_at("h", F.lit("server")).alias("server"))


_META = r"(?i)<meta[^>]*charset=[\"']?([A-Za-z0-9_-]+)"
_NAMED = r"(?i)charset=[\"']?([A-Za-z0-9_-]+)"


def charset_of(a: DataFrame) -> DataFrame:
    """(id, charset, content) of pages (feed_articleid, headers, content): the META tag names the charset, else the header, else Latin-1."""
    meta = F.lower(F.regexp_extract(F.decode("content", "ISO-8859-1"), _META, 1))
    hdr = F.lower(F.regexp_extract(F.coalesce("headers", F.lit("")), _NAMED, 1))
    return a.select(F.col("feed_articleid").alias("id"), F.when(meta != "", meta).when(hdr != "", hdr).otherwise("iso-8859-1").alias("charset"), "content")


def _charsets(spark, d) -> DataFrame:
    """``charset_of`` each page as stored; rows may repeat."""
    return charset_of(table(spark, d, "article").where("content is not null"))


def charset_guess(spark, d) -> DataFrame:
    """The charset each page would be decoded in."""
    return _charsets(spark, d).select("id", "charset").distinct()


def pages_decoded(spark, d) -> DataFrame:
    """Every stored page decoded in its charset (bytes it can't read are marked): characters, marks and digest."""
    c = _charsets(spark, d)
    t = F.col("text")
    return decode.decoded(c).select("id", "charset", F.length(t).alias("chars"), F.regexp_count(t, F.lit("\ufffd")).alias("marks"), F.md5(t.cast("binary")).alias("md5")).distinct()


def fetch_outcomes(spark, d) -> DataFrame:
    """Pages by outcome: error, not text, too large, too small, fetched."""
    a = table(spark, d, "article").select("feed_articleid", "http_code", "mimetype", F.octet_length("content").alias("size"), "retrieved").distinct()
    o = F.when(F.col("http_code") >= 900, "internal").when(F.col("http_code") >= 400, "http_error").when(F.col("size").isNull(), "lost").when(~F.coalesce(F.startswith("mimetype", F.lit("text/")), F.lit(False)), "not_text").when(F.col("size") > 2_000_000, "too_large").otherwise("fetched")
    return a.groupBy(o.alias("outcome"), "http_code").agg(F.count("*").alias("n"), F.count_if(F.col("http_code") < 400).alias("downloads"))


def times_written(spark, d) -> DataFrame:
    """Publication times in both written forms, the age in days and whether an article is stale."""
    m = table(spark, d, "feed_article_meta").select("id", "pub_date").distinct().join(table(spark, d, "feed_article").select("id", "found"), "id")
    age = times.age_days(F.coalesce("pub_date", "found"), now())
    return m.select("id", times.iso_utc(F.col("pub_date")).alias("iso"), times.plain_utc(F.col("found")).alias("plain"), age.alias("days"), (age > 7).alias("stale"), times.month_id(F.col("found")).alias("month"))


def geo_points(spark, d) -> DataFrame:
    """Coordinates as points (pieces by semicolons only), their number, first latitude and joined form."""
    m = table(spark, d, "feed_article_meta").where("geo is not null").select("id", "geo").distinct()
    p = m.select("id", arrays.points(F.col("geo")).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: F.concat_ws(" ", F.format_string("%.4f", x["lat"]), F.format_string("%.4f", x["lon"]))), ";")
    return p.select("id", F.size("p").alias("n"), F.try_element_at("p", F.lit(1))["lat"].alias("lat"), F.try_element_at("p", F.lit(1))["lon"].alias("lon"), joined.alias("joined"))


def source_places(spark, d) -> DataFrame:
    """Country and city of each site: its tags, else the country by its top-level domain."""
    s = table(spark, d, "site").select("id", "tld", arrays.tag_map(F.col("tags")).alias("m"), F.size(arrays.plain_tags(F.col("tags"))).alias("plain"))
    return s.select("id", F.coalesce(F.try_element_at("m", F.lit("country")), F.upper("tld")).alias("country"), F.try_element_at("m", F.lit("city")).alias("city"), "plain")


def access_rows(spark, d) -> DataFrame:
    """One row for each article and access tag."""
    fa = table(spark, d, "feed_article").select("id", "acl_tagset").join(table(spark, d, "feed_article_meta").select("id", F.lower("lang_iso").alias("lang")).distinct(), "id", "left")
    return fa.select("id", F.explode(F.array_distinct(arrays.access_tags(F.col("acl_tagset"), F.col("lang")))).alias("acl"))


def event_json(spark, d) -> DataFrame:
    """Events for a live display: one JSON text each."""
    m = table(spark, d, "feed_article_meta").where("title is not null").select("id", "title", "img").distinct()
    return m.select("id", F.to_json(F.struct("id", "title", "img")).alias("json"))


def enrichment_routes(spark, d) -> DataFrame:
    """Which enricher a text goes to by language and size, with its sentences."""
    lang = F.lower(F.regexp_extract(F.coalesce("lang_iso", F.lit("")), "^([A-Za-z]*)", 1))
    t = _texts(spark, d).join(table(spark, d, "feed_article_meta").select("id", "lang_iso").distinct(), "id")
    fit = (F.length("content") > 0) & (F.length("content") < 50_000)
    route = F.when(fit & lang.isin("en", "eng", "enz"), "english").when(fit & lang.isin("sl", "slv"), "slovene").when(fit & lang.isin("es", "spa"), "es").when(fit & (lang == "cat"), "ca")
    parts = F.split("content", r"\. ")
    return t.select("id", route.alias("route"), F.size(parts).alias("sentences"), F.array_max(F.transform(parts, lambda x: F.length(x))).alias("longest"))


def only_images(spark, d) -> DataFrame:
    """The image of a page that has exactly one, else null."""
    found = F.regexp_extract_all(F.col("html"), F.lit(r"(?i)<img[^>]*src=[\"']([^\"']+)"), F.lit(1))
    return _pages(spark, d).select("id", F.size(found).alias("images"), F.when(F.size(found) == 1, F.try_element_at(found, F.lit(1))).alias("img"))


def feeds_discovered(spark, d) -> DataFrame:
    """Feed links of the pages, made absolute, that the feed table doesn't have."""
    last = table(spark, d, "feed_article_urls").groupBy("fa_id").agg(F.max(F.struct("seq", "url"))["url"].alias("base")).withColumnRenamed("fa_id", "id")
    p = _pages(spark, d).where(F.col("html").rlike(r"(?i)\balternate\b|\brss\b")).join(last, "id")
    return extract.feeds(p).select("url").distinct().join(table(spark, d, "feed").select("url"), "url", "left_anti")


def page_extracts(spark, d) -> DataFrame:
    """Title and main text of each decoded page by its own structure, with the intro and the outcome."""
    return extract.extracts(_pages(spark, d))


def entities_decoded(spark, d) -> DataFrame:
    """Titles of pages with character references decoded, and whether the text starts like a dateline."""
    return extract.titles(_pages(spark, d))


def datelines(spark, d) -> DataFrame:
    """Lead-in and dateline flags of each line of the cleartexts."""
    return extract.lead_ins(_texts(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        text_forms, intros, title_matches, page_text, page_lines, plain_titles, titles_encoded, xml_titles, xml_paragraphs, text_digests, ngrams_removed, url_parts, urls_rewritten,
        urls_decoded, headers_read, charset_guess, pages_decoded, fetch_outcomes, times_written, geo_points, source_places, access_rows, event_json, enrichment_routes, only_images,
        feeds_discovered, page_extracts, entities_decoded, datelines,
    )
}

_T = "(SELECT feed_articleid AS id, min(content) AS content FROM processed_article WHERE mode = 'cleartext' GROUP BY 1)"
_TITLES = "(SELECT DISTINCT id, title FROM feed_article_meta WHERE title IS NOT NULL)"
_PAGES = "(SELECT feed_articleid AS id, decode(min(content)) AS html FROM article WHERE content IS NOT NULL AND feed_articleid IN (SELECT id FROM feed_article_meta WHERE is_utf8 = '1') GROUP BY 1)"
_LAST = "(SELECT fa_id, arg_max(url, (seq, url)) AS url FROM feed_article_urls GROUP BY 1)"
_BARE = r"regexp_replace(lower({0}), '[^\p{{L}}]', '', 'g')"
_ALNUM = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{Nd}}]', '', 'g')"
#: Letters outside ASCII of the test languages, each as one byte: the other engine's edit distance counts bytes. Bare forms have no capitals or signs.
_WIDE = "абвгдежзийклмнопрстуфхцчшщъыьэюяё" + "äöüßéèêëàâçîïôûùñáíóúãõćčđšž"
_ONE_BYTE = "translate({0}, '" + _WIDE + "', '" + "".join(chr(c) for c in (*range(1, 9), *range(33, 127)) if not chr(c).isdigit() and not chr(c).islower() and chr(c) not in "'{{}}")[: len(_WIDE)] + "')"
_TAGS = r"""'<(?:[^<>"'']|"[^"]*"|''[^'']*'')*>'"""


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _plain(c: str, whitespace: bool = True) -> str:
    one = {k: v for k, v in text.PUNCTUATION.items() if len(v) == 1} | ({"\n": " ", "\r": " ", "\t": " "} if whitespace else {})
    chars = lambda s: "concat(" + ", ".join(f"chr({ord(x)})" for x in s) + ")"
    out = f"translate({c}, {chars(one)}, {chars(one.values())})"
    for k, v in text.PUNCTUATION.items():
        if len(v) > 1:
            out = f"replace({out}, chr({ord(k)}), {_sql_text(v)})"
    return out


def _xml(c: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({c}, ''), lambda x: CASE WHEN x = '&' THEN '&amp;' WHEN x = '<' THEN '&lt;' WHEN x = '>' THEN '&gt;' "
        "WHEN NOT (unicode(x) IN (9, 10, 13) OR unicode(x) BETWEEN 32 AND 55294 OR unicode(x) BETWEEN 57345 AND 65532 OR unicode(x) BETWEEN 65536 AND 1114109) THEN '' "
        "WHEN unicode(x) < 128 THEN x ELSE '&#' || unicode(x) || ';' END), '')"
    )


_SCRIPTLESS = r"regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g')"
_NOCOMMENT = r"regexp_replace({0}, '(?s)<!--.*?-->', '', 'g')"
_BLOCKS = "'(?i)</?(?:" + text.BLOCKS + ")\\b[^>]*>'"
_STRIPPED = f"regexp_replace(regexp_replace({_NOCOMMENT.format(_SCRIPTLESS)}, {_BLOCKS}, chr(10), 'g'), {_TAGS}, '', 'g')"
ORACLE = {
    "text_forms": f"SELECT id, split_part(content, chr(10), 1) AS title, CAST(CASE WHEN content = '' THEN 0 ELSE length(regexp_replace(content, '^[^\\n]*\\n?', chr(10))) END AS INT) AS body_chars, CAST(strlen({_BARE.format('content')}) AS INT) AS bytes, md5({_BARE.format('content')}) AS bare_md5, CAST(length(regexp_replace(content, '[\\s0-9]+', ' ', 'g')) AS INT) AS collapsed FROM {_T}",
    "intros": f"SELECT id, CASE WHEN length(content) > e THEN substring(content, 1, e) || ' (...)' ELSE content END AS intro FROM (SELECT id, content, least(CASE WHEN strpos(substring(content, 401), ' ') > 0 THEN 399 + strpos(substring(content, 401), ' ') ELSE 500 END, 500) AS e FROM {_T})",
    "title_matches": f"SELECT id, CASE WHEN greatest(length(x), length(y)) = 0 THEN false WHEN length(x) > 4 * length(y) THEN false ELSE (levenshtein(x, y) - abs(length(x) - length(y))) / greatest(length(x), length(y)) < 0.1 END AS same FROM (SELECT id, {_ONE_BYTE.format(_ALNUM.format('title'))} AS x, {_ONE_BYTE.format(_ALNUM.format('split_part(content, chr(10), 1)'))} AS y FROM {_T} t JOIN {_TITLES} m USING (id))",
    "plain_titles": f"SELECT id, {_plain('title')} AS plain FROM {_TITLES}",
    "titles_encoded": f"SELECT id, url_encode(title) AS encoded FROM {_TITLES}",
    "xml_titles": f"SELECT id, {_xml('title')} AS xml FROM {_TITLES}",
    "text_digests": f"SELECT id, CAST(md5_number_lower(content) AS VARCHAR) AS digest FROM {_T}",
    "url_parts": "SELECT url, CASE WHEN regexp_matches(lower(u), '^https?://') AND NOT contains(u, ' ') AND length(a) >= 5 THEN a END AS authority, split_part(url || '/-/-/', '/', 3) AS host, regexp_matches(lower(url), '\\.(" + "|".join(urls.MEDIA) + ")$') AS media, lower(left(url, 4)) = 'http' AND lower(right(url, 4)) <> '.mp3' AND length(url) <= 4095 AS ok FROM (SELECT url, regexp_replace(url, '^\\s+|\\s+$', '', 'g') AS u, nullif(regexp_extract(trim(url), '(?i)^https?://([^/?#\\s]+)', 1), '') AS a FROM (SELECT url FROM feed_article_urls UNION SELECT url FROM batch_item) WHERE url IS NOT NULL)",
    "urls_rewritten": "SELECT DISTINCT fa_id, u.url, CASE WHEN regex IS NOT NULL AND regexp_extract(u.url, '^(?:' || regex || ')', 1) <> '' THEN regexp_extract(u.url, '^(?:' || regex || ')', 1) ELSE u.url END AS rewritten FROM feed_article_urls u JOIN feed f ON f.id = fa_feed_id",
    "urls_decoded": "SELECT DISTINCT fa_id, u.url, url_decode(u.url) AS plain FROM feed_article_urls u JOIN feed f ON f.id = fa_feed_id WHERE parse_unquote",
    "headers_read": r"""WITH a AS (SELECT feed_articleid AS id, min(headers) AS headers FROM article WHERE headers IS NOT NULL GROUP BY 1),
l AS (SELECT id, i, x FROM (SELECT id, unnest(string_split_regex(headers, '\r?\n')) AS x, generate_subscripts(string_split_regex(headers, '\r?\n'), 1) AS i FROM a) WHERE contains(x, ':')),
v AS (SELECT id, lower(trim(split_part(x, ':', 1))) AS k, arg_max(lower(trim(regexp_replace(x, '^[^:]*:', ''))), i) AS v FROM l GROUP BY 1, 2)
SELECT a.id, c.v AS content_type, regexp_extract(c.v, 'charset=["'']?([a-z0-9_-]+)', 1) AS charset, s.v AS server FROM a LEFT JOIN v c ON c.id = a.id AND c.k = 'content-type' LEFT JOIN v s ON s.id = a.id AND s.k = 'server'""",
    "fetch_outcomes": "SELECT CASE WHEN http_code >= 900 THEN 'internal' WHEN http_code >= 400 THEN 'http_error' WHEN size IS NULL THEN 'lost' WHEN NOT coalesce(starts_with(mimetype, 'text/'), false) THEN 'not_text' WHEN size > 2000000 THEN 'too_large' ELSE 'fetched' END AS outcome, http_code, count(*) AS n, count(*) FILTER (http_code < 400) AS downloads FROM (SELECT DISTINCT feed_articleid, http_code, mimetype, octet_length(content) AS size, retrieved FROM article) GROUP BY ALL",
    "times_written": f"SELECT id, strftime(pub_date AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(found AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || ' (UTC)' AS plain, date_sub('day', coalesce(pub_date, found), {SQL_NOW}) AS days, date_sub('day', coalesce(pub_date, found), {SQL_NOW}) > 7 AS stale, CAST(year(found AT TIME ZONE 'UTC') * 12 + month(found AT TIME ZONE 'UTC') AS INT) AS month FROM (SELECT DISTINCT id, pub_date FROM feed_article_meta) m JOIN feed_article f USING (id)",
    "geo_points": r"WITH p AS (SELECT id, list_filter(list_transform(string_split(geo, ';'), lambda x: CASE WHEN len(string_split_regex(trim(x), '\s+')) = 2 THEN {'lat': TRY_CAST(string_split_regex(trim(x), '\s+')[1] AS DOUBLE), 'lon': TRY_CAST(string_split_regex(trim(x), '\s+')[2] AS DOUBLE)} END), lambda q: q.lat IS NOT NULL AND q.lon IS NOT NULL) AS p FROM (SELECT DISTINCT id, geo FROM feed_article_meta WHERE geo IS NOT NULL)) SELECT id, CAST(len(p) AS INT) AS n, p[1].lat AS lat, p[1].lon AS lon, array_to_string(list_transform(p, lambda x: printf('%.4f', x.lat) || ' ' || printf('%.4f', x.lon)), ';') AS joined FROM p",
    "source_places": "WITH t AS (SELECT id, tld, list_filter(coalesce(tags, []), lambda x: x <> '') AS tags FROM site), m AS (SELECT id, tld, tags, list_filter(tags, lambda x: len(string_split(x, ':')) = 2) AS p FROM t), g AS (SELECT *, list_filter(p, lambda x: split_part(x, ':', 1) = 'country') AS c, list_filter(p, lambda x: split_part(x, ':', 1) = 'city') AS y FROM m) SELECT id, coalesce(split_part(c[-1], ':', 2), upper(tld)) AS country, split_part(y[-1], ':', 2) AS city, CAST(len(list_filter(tags, lambda x: NOT regexp_matches(x, '^(city|country|region|geo):'))) AS INT) AS plain FROM g",
    "access_rows": "SELECT DISTINCT id, unnest(CASE WHEN lang = 'eng' THEN list_append(own, 'render') ELSE own END) AS acl FROM (SELECT f.id, CASE WHEN acl_tagset IS NULL OR len(acl_tagset) = 0 THEN ['public'] ELSE acl_tagset END AS own, lang FROM feed_article f LEFT JOIN (SELECT DISTINCT id, lower(lang_iso) AS lang FROM feed_article_meta) m USING (id))",
    "event_json": "SELECT id, CASE WHEN img IS NULL THEN '{\"id\":' || id || ',\"title\":' || CAST(to_json(title) AS VARCHAR) || '}' ELSE '{\"id\":' || id || ',\"title\":' || CAST(to_json(title) AS VARCHAR) || ',\"img\":' || CAST(to_json(img) AS VARCHAR) || '}' END AS json FROM (SELECT DISTINCT id, title, img FROM feed_article_meta WHERE title IS NOT NULL)",
    "enrichment_routes": f"SELECT id, CASE WHEN NOT (length(content) > 0 AND length(content) < 50000) THEN NULL WHEN l IN ('en', 'eng', 'enz') THEN 'english' WHEN l IN ('sl', 'slv') THEN 'slovene' WHEN l IN ('es', 'spa') THEN 'es' WHEN l = 'cat' THEN 'ca' END AS route, CAST(len(string_split(content, '. ')) AS INT) AS sentences, CAST(list_max(list_transform(string_split(content, '. '), lambda x: length(x))) AS INT) AS longest FROM (SELECT id, content, lower(regexp_extract(coalesce(lang_iso, ''), '^([A-Za-z]*)', 1)) AS l FROM {_T} t JOIN (SELECT DISTINCT id, lang_iso FROM feed_article_meta) m USING (id))",
    "only_images": f"SELECT id, CAST(len(i) AS INT) AS images, CASE WHEN len(i) = 1 THEN i[1] END AS img FROM (SELECT id, regexp_extract_all(html, '(?i)<img[^>]*src=[\"'']([^\"'']+)', 1) AS i FROM {_PAGES})",
    "feeds_discovered": f"""WITH p AS (SELECT id, html, regexp_extract_all(html, '<link[^>]*rel="alternate"[^>]*href="([^"]+)"', 1) AS l FROM {_PAGES}), h AS (SELECT id, unnest(CASE WHEN len(l) > 0 THEN l ELSE list_concat(
regexp_extract_all(html, '(?i)<a [^>]*href="([^"]+)"[^>]*>[^<]*\\brss\\b', 1), regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*[/._-]rss(?:[/._-][^"]*)?)"', 1)) END) AS h FROM p)
SELECT DISTINCT url FROM (SELECT CASE WHEN regexp_matches(h, '^[a-z]+:') THEN h WHEN starts_with(h, '//') THEN split_part(u.url, ':', 1) || ':' || h WHEN starts_with(h, '/') THEN regexp_extract(u.url, '(?i)^(https?://[^/?#]+)', 1) || h
WHEN starts_with(h, '?') THEN regexp_replace(u.url, '[?#].*$', '') || h ELSE regexp_replace(regexp_replace(regexp_replace(u.url, '[?#].*$', ''), '[^/]*$', '') || h, '/[^/]+/\\.\\./', '/') END AS url FROM h JOIN (SELECT fa_id, lower(split_part(url, ':', 1)) || substring(url, strpos(url, ':')) AS url FROM {_LAST}) u ON u.fa_id = h.id) WHERE url NOT IN (SELECT url FROM feed)""",
    "charset_guess": r"""SELECT DISTINCT id, CASE WHEN m <> '' THEN m WHEN h <> '' THEN h ELSE 'iso-8859-1' END AS charset FROM (SELECT feed_articleid AS id,
lower(regexp_extract(CAST(content AS VARCHAR), '(?i)<meta[^>]*charset=(?:["'']|\\x22|\\x27)?([A-Za-z0-9_-]+)', 1)) AS m, lower(regexp_extract(coalesce(headers, ''), '(?i)charset=["'']?([A-Za-z0-9_-]+)', 1)) AS h FROM article WHERE content IS NOT NULL)""",
    "xml_paragraphs": f"SELECT id, CAST(CASE WHEN p = '' THEN 1 ELSE len(string_split(p, chr(10))) END AS INT) AS paras, md5(p) AS md5 FROM (SELECT id, array_to_string(list_transform(list_filter(list_transform(string_split(content, chr(10)), lambda y: trim(y)), lambda y: y <> ''), lambda y: '<p>' || {_xml('y')} || '</p>'), chr(10)) AS p FROM {_T})",
    "page_lines": f"SELECT id, CAST(len(string_split(t, chr(10))) AS INT) AS lines, md5(t) AS md5 FROM (SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_NOCOMMENT.format('html')}, '(?i)<(br|/?p)\\b[^>]*>', chr(10), 'g'), {_TAGS}, '', 'g'), '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), '\\n+', chr(10), 'g') AS t FROM {_PAGES})",
    "ngrams_removed": f"""WITH t AS (SELECT id, string_split(title, ' ') AS w FROM {_TITLES}), g AS (SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
o AS (SELECT g FROM (SELECT DISTINCT id, g FROM g) GROUP BY 1 HAVING count(*) > 20), c AS (SELECT DISTINCT id, i + k AS i FROM g JOIN o USING (g), (SELECT unnest([0, 1, 2]) AS k)),
x AS (SELECT id, w[i] AS x, i FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM t))
SELECT t.id, coalesce(rest, '') AS rest FROM t LEFT JOIN (SELECT id, string_agg(x, ' ' ORDER BY i) AS rest FROM x ANTI JOIN c USING (id, i) GROUP BY 1) r USING (id)""",
    "page_text": f"SELECT id, CAST(length(t) AS INT) AS chars, md5(t) AS md5 FROM (SELECT id, trim(regexp_replace({_plain(_STRIPPED)}, '\\s+', ' ', 'g')) AS t FROM {_PAGES})",
}
