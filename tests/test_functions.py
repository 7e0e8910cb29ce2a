import gzip
import math
import re
import xml.dom.minidom
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import arrays, text, urls
from newsloom.operators import archive, extract, trigrams
from newsloom.plans import archive_queries


def one(spark, col, **cols):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items())).select(col).first()[0]


def test_ngrams_overlap(spark):
    t = "majhna sem bila, piske sem pasla piske so civkale jaz sem pa rasla"
    got = one(spark, text.without_ngrams(F.col("t"), ["sem bila, piske", "piske sem pasla", "jaz sem pa"], 3), t=t)
    assert got == "majhna piske so civkale rasla"


def test_trigrams(spark):
    assert one(spark, text.trigrams(F.col("t")), t="ab cd") == ["ab>", "<cd"]
    assert one(spark, text.trigrams(F.col("t")), t="ab") == []


def test_xml_is_ascii_and_well_formed(spark):
    s = "a & b < c > d é 日 😀 \x01 end"
    got = one(spark, text.xml_escape(F.col("t")), t=s)
    assert got.isascii()
    assert xml.dom.minidom.parseString(f"<x>{got}</x>").documentElement.firstChild.data == s.replace("\x01", "")


def test_urls(spark):
    assert one(spark, urls.authority(F.col("u")), u="http://me@a.example:81/x?y") == "me@a.example:81"
    assert one(spark, urls.authority(F.col("u")), u="ftp://a.example/") is None
    assert one(spark, urls.percent_decode(F.col("u")), u="http://a/b%20c+d") == "http://a/b c+d"
    assert one(spark, urls.percent_decode(F.col("u")), u="http://a/b%zz") == "http://a/b%zz"
    assert one(spark, urls.is_media(F.col("u")), u="http://a/b.MP3") and not one(spark, urls.is_media(F.col("u")), u="http://a/events")


def test_headers_last_wins(spark):
    m = one(spark, arrays.header_map(F.col("h")), h="A: 1\nnone\nB: x\r\na: 2")
    assert m == {"a": "2", "b": "x"}


def test_points(spark):
    assert [tuple(p) for p in one(spark, arrays.points(F.col("g")), g="1.5 2;x y;3 4")] == [(1.5, 2.0), (3.0, 4.0)]


def test_grants_and_next_file(spark):
    lines = spark.createDataFrame([(0, "ann:x"), (1, "#acl a b"), (2, "bob:y")], "line_no int, line string")
    assert {(r.user, r.acl) for r in archive.grants(lines).collect()} == {("ann", "a"), ("ann", "b"), ("ann", "public"), ("bob", "public")}
    files = spark.createDataFrame([("p", "a-1"), ("p", "a-2"), ("p", "a-3")], "acl string, file string")
    assert archive.next_file(files, "a-1").first().file == "a-2" and archive.next_file(files, None).first().file == "a-3"


def test_rotation_bounds(spark):
    r = spark.range(100).select(F.lit("p").alias("acl"), "id", F.timestamp_seconds(F.col("id")).alias("at"), F.lit(300).alias("bytes"))
    sizes = archive.rotated(r, limit=1000).groupBy("slot", "part").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0]
    assert sizes <= 1000 + 300


def test_archive_files(spark, tmp_path):
    path = f"file://{tmp_path}/an archive"
    rows = [("a/b", 5, 0, 2, "<y>"), ("a/b", 5, 0, 1, "<x>"), ("a/b", 5, 1, 3, "two\nlines"), ("007", 50, 0, 1, "ü"), ("", 5, 0, 1, None), (None, 5, 0, 1, "n"), ("..", None, 0, 1, "z")]
    schema = "acl string, slot long, part long, id long, xml string"
    for some in (rows[:1] + [("gone", 1, 0, 1, "old")], rows):  # the second replaces the first
        archive.write_archive(spark.createDataFrame(some, schema), path)
    files = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert len(files) == 6 and all(p.name.endswith(".xml.gz") for p in files)  # one for each part, nothing beside it
    got = sorted((str(r.acl), str(r.slot), r.part, r.value) for r in archive.read_archive(spark, path).collect() if r.value not in (*archive.HEADER.split("\n"), archive.FOOTER))
    assert got == sorted([("a/b", "5", 0, "<x>"), ("a/b", "5", 0, "<y>"), ("a/b", "5", 1, "two"), ("a/b", "5", 1, "lines"), ("007", "50", 0, "ü"), ("", "5", 0, ""), ("None", "5", 0, "n"), ("..", "None", 0, "z")])
    first = gzip.decompress(next(p for p in files if p.name == "5_0.xml.gz" and "a%2Fb" in str(p)).read_bytes()).decode()
    assert first == f"{archive.HEADER}\n<x>\n<y>\n{archive.FOOTER}\n"
    archive.write_archive(spark.createDataFrame([], schema), path)
    assert archive.read_archive(spark, path).count() == 0


SAMPLES = [("eng", "the bridge and the house of the town"), ("eng", "another day in the town"), ("deu", "die Brücke und das Haus der Stadt"), ("nld", "de brug en het huis van de stad")]
TEXTS = [(1, "the town house"), (2, "das Haus der Stadt 12"), (3, "het huis van de stad"), (4, "xq"), (5, None), (6, "ωψφ ωψφ"), (7, "die Stadt"), (7, "the and the house"), (8, "st"), (9, ""), (10, "stad"), (None, "the town")]


def bayes(samples, texts):
    """Naive Bayes by hand: {id: language}."""
    def grams(t):
        t = re.sub(r"[\s0-9]+", " ", t or "").lower()
        return [("<" if g[0] == " " else g[0]) + g[1] + (">" if g[2] == " " else g[2]) for g in (t[i : i + 3] for i in range(len(t) - 2)) if g[1] != " "]

    c = {lang: Counter() for lang, _ in samples}
    for lang, t in samples:
        c[lang].update(grams(t))
    kinds, every = set().union(*c.values()), sum(x.total() for x in c.values())
    out = {}
    for i in {i for i, _ in texts}:
        g = [x for j, t in texts if j == i for x in grams(t) if x in kinds]
        t = [(round(math.log(n.total() / every) + sum(math.log((n[x] + 1) / (n.total() + len(kinds))) for x in g), 6), lang) for lang, n in c.items() if any(x in n for x in g)]
        out[i] = max(t)[1] if t and i is not None else None
    return out


@pytest.mark.parametrize("small", [0, 2**17])
def test_trigram_languages(spark, small):
    m, langs = trigrams.train(spark.createDataFrame(SAMPLES, "lang string, text string"))
    got = trigrams.predict(spark.createDataFrame(TEXTS, "id long, text string"), m, langs, small)
    assert sorted(map(str, ((r.id, r.lang) for r in got.collect()))) == sorted(map(str, bayes(SAMPLES, TEXTS).items()))
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) > 1 and not any(re.search(r"\bid#", x) for x in joins)  # nothing with a row for each document can be broadcast


def test_sizes_of_repeated_texts(spark, tmp_path):
    rows = [(1, "cleartext", "b"), (1, "cleartext", "aaaa"), (2, "cleartext", "xy"), (2, "cleartext", "zü"), (3, "cleartext", None), (3, "cleartext", "q"), (4, "cleartext", None), (5, "html", "w"), (6, "cleartext", "é"), (None, "cleartext", "n")]
    spark.createDataFrame(rows, "feed_articleid long, mode string, content string").write.parquet(f"{tmp_path}/processed_article.parquet")
    got = archive_queries._sizes(spark, str(tmp_path), "test-sizes")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 4), (2, 2), (3, 1), (4, None), (6, 2)]


def test_archive_outside_a_file_tree(spark, tmp_path, monkeypatch):
    whole = archive._folder
    monkeypatch.setattr(archive, "_folder", lambda *a: (*whole(*a)[:2], None))
    archive.write_archive(spark.createDataFrame([("p", 5, 0, 2, "<y>"), ("p", 5, 0, 1, "<x>")], "acl string, slot long, part long, id long, xml string"), f"file://{tmp_path}/a")
    assert [tuple(r) for r in archive.read_archive(spark, f"file://{tmp_path}/a").collect()] == [("p", 5, 0, x) for x in (*archive.HEADER.split("\n"), "<x>", "<y>", archive.FOOTER)]


PAGE = "<html><head><title>Big day for the river town - Daily News</title></head><body><nav><p>{nav}</p></nav><div class='story'>{body}</div><div id='footer'><p>{nav}</p></div></body></html>"


def test_extraction():
    para = "The council opened the bridge after a long debate about money, and the town welcomed it warmly with songs and speeches all day. "
    page = PAGE.format(nav="Home Sport " * 60, body="".join(f"<p>{para * 2}</p>" for _ in range(3)))
    root = extract.tree(page)
    _, lines, how = extract.body(root)
    assert how == "paragraphs" and len(lines) == 3 and "Home" not in "".join(lines)
    assert extract.title(root, "www.daily.example") == "Big day for the river town"
    marked = "<div itemprop='articleBody'>" + f"<p>{para * 4}</p>" + "</div><div>" + f"<p>{para * 40}</p>" + "</div>"
    assert extract.body(extract.tree(marked))[2] == "marked"
    assert extract.body(extract.tree("<p>short</p>"))[2] == "no_text"
    assert extract.body(extract.tree("<div>" * 3000 + "x"))[2] == "no_text"


def test_datelines():
    assert extract.lead_in("Ljubljana, Apr 16 (STA) -- The council met.") == "Ljubljana, Apr 16 (STA) -- "
    assert extract.lead_in("The council met in a hall that was far too small for all of them") == ""
    assert extract.is_dateline("Updated 12 May") and extract.is_dateline("3 4 2024") and not extract.is_dateline("no time here")
    assert extract.unescape("a &amp; b &#233; &nosuch;") == "a & b é &nosuch;"


@given(st.text(max_size=300))
def test_tree_never_fails(s):
    extract.body(extract.tree(s))
