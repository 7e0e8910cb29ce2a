"""The queries of this subpackage, by name: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import boilerplate as B
from newsloom.llm import incremental as I
from newsloom.llm import language as X
from newsloom.llm import lines as L
from newsloom.llm import mojibake as M
from newsloom.llm import mixing as Y
from newsloom.llm import neardup as N
from newsloom.llm import packing as P
from newsloom.llm import spam as S
from newsloom.llm import tokens as T
from newsloom.runtime import fresh, once, owned, table, written


def cleartexts(spark: SparkSession, d: str) -> DataFrame:
    """(id, text) of the cleartexts; rows may repeat."""
    return table(spark, d, "processed_article").where("mode = 'cleartext'").select(F.col("feed_articleid").alias("id"), F.col("content").alias("text"))


def sites(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "feed_article").select("id", F.col("siteid").alias("site"))


def hostnames(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "site").select(F.col("id").alias("site"), "hostname")


# ---- 1: languages


def labels(spark, d):
    """(id, lang): the language each article's own label or else its feed's label names; null where neither does."""
    ps = X.with_named(table(spark, d, "feed_ps").select("feedid", "updated", "language"), "language", "named").where("named is not null")
    ps = ps.groupBy("feedid").agg(F.max_by("named", F.struct("updated", "named")).alias("feed_lang"))
    meta = X.with_named(table(spark, d, "feed_article_meta").select("id", "lang_iso"), "lang_iso", "named").groupBy("id").agg(F.max("named").alias("own"))
    feed = table(spark, d, "feed_article").select("id", "feedid").distinct()
    known = feed.join(meta, "id", "full").join(ps, "feedid", "left")
    return known.groupBy("id").agg(F.max(F.coalesce("own", "feed_lang")).alias("lang"))


def _tagged(spark, d):
    docs = cleartexts(spark, d)
    samples = table(spark, d, "lang_sample").select(F.col("lang_iso").alias("lang"), "text")
    return X.tagged(docs, X.fitted(samples, docs, labels(spark, d)), M.corpus_of(docs.select("text")))


def p1_found(spark, d):
    """Articles of 60 letters or more whose label is missing, differs from the language that counts, or where several count."""
    found = X.shares(_tagged(spark, d)).where((F.col("letters") >= 60) & (F.size("langs") > 0))
    found = found.join(labels(spark, d), "id", "left")
    case = F.col("lang").isNull() | (F.size("langs") > 1) | (F.col("lang") != F.col("langs")[0]["lang"])
    return found.where(case).select(F.col("id").alias("feed_articleid"), F.explode(F.col("langs")["lang"]).alias("lang")).distinct()


def p1_documents(spark, d):
    """Each article's main language with its share of the letters and the model's confidence."""
    s = X.shares(_tagged(spark, d), 0.0)
    main = F.array_max(F.transform("langs", lambda x: F.struct(x["share"], x["confidence"], x["lang"])))
    return s.select(F.col("id").alias("feed_articleid"), "letters", main["lang"].alias("lang"), main["share"].alias("share"), main["confidence"].alias("confidence")).distinct()


def p1_stretches(spark, d):
    """The stretches of one language of each article, in reading order."""
    t = _tagged(spark, d).distinct()
    return t.select(F.col("id").alias("feed_articleid"), F.explode("stretches").alias("s")).select("feed_articleid", "s.*")


# ---- 2: near-duplicates


def _similar(spark, d, owner):
    fresh(owner)
    return N.similar(cleartexts(spark, d), k=3, t=0.5, least_words=30, owner=owner)


def p2_found(spark, d):
    return N.pairs(*_similar(spark, d, "p2f"))


def p2_classes(spark, d):
    """One row for each article of 30 words or more: its class of equal texts, and the class's links."""
    return N.classes(*_similar(spark, d, "p2c")).select(F.col("id").alias("feed_articleid"), "class_id", "copies", "links")


def p2_groups(spark, d):
    """Each article that has an edited copy, with the least id of its group."""
    g = N.groups(N.pairs(*_similar(spark, d, "p2g")), "p2g")
    return g.select(F.col("id").alias("feed_articleid"), "group_id")


# ---- 3: text decoded in the wrong charset


def pages(spark, d):
    """(id, text) of all pages: content as it stands; rows may repeat."""
    return table(spark, d, "article").where("content is not null").select(F.col("feed_articleid").alias("id"), F.col("content").alias("text"))


def _garbled(spark, d):
    """Of the pages said to be decoded; the flag is joined to the few garbled ones, not to all texts."""
    docs = table(spark, d, "article").where("content is not null").select(F.col("feed_articleid").alias("id"), F.col("content").alias("text"), "headers")
    utf8 = table(spark, d, "feed_article_meta").where("is_utf8 = '1'").select("id").distinct()
    return M.garbled(docs, M.corpus_of(docs.select("text"))).join(utf8, "id", "left_semi")


def p3_found(spark, d):
    """Articles with a garbled stretch: the rows of ``p3_restored``, decoded and filled by the same search."""
    return _garbled(spark, d).select(F.col("id").alias("feed_articleid")).distinct()


def p3_restored(spark, d):
    """Each garbled page with the channels it went through, the marks of lost bytes and its text as written."""
    return _garbled(spark, d).select(F.col("id").alias("feed_articleid"), "channels", "lost", "restored").distinct()


# ---- 4: new batches against all history


def _checked(spark, d, owner):
    """(item, first_id, batch_no) of the six batches, taken one after the other."""
    fresh(owner)
    texts = cleartexts(spark, d)
    urls = table(spark, d, "feed_article_urls").select(F.col("fa_id").alias("id"), "url").distinct()
    items = table(spark, d, "batch_item").select("id", "batch_no", "url", F.col("content").alias("text"))
    history = I.History.create(spark, owned(I.scratch_store(spark, owner), owner), k=3, t=0.5, least_words=30).build(texts, urls)
    out = None
    for (no,) in items.select("batch_no").distinct().orderBy("batch_no").collect():
        got = history.check(items.where(F.col("batch_no").eqNullSafe(F.lit(no)))).withColumn("batch_no", F.lit(no))
        out = got if out is None else out.unionByName(got)
    history.close()
    return out


def p4_found(spark, d):
    return _checked(spark, d, "p4f").where("first_id is not null").select("first_id", F.col("item").alias("item_id"))


def p4_batches(spark, d):
    """How many items of each batch were accepted and how many repeat something."""
    got = _checked(spark, d, "p4b")
    return got.groupBy("batch_no").agg(F.count_if(F.col("first_id").isNull()).alias("accepted"), F.count("first_id").alias("repeats"))


# ---- 5: repeated lines


def _sited(spark, d, owner):
    fresh(owner)
    return L.with_sites(cleartexts(spark, d), sites(spark, d), owner)


def p5_found(spark, d):
    return L.repeated_lines(_sited(spark, d, "p5f"), "p5f").join(hostnames(spark, d), "site").select("hostname", "line").distinct()


def p5_method(spark, d):
    """Each cleartext without the content-defined chunks that its site repeats excessively."""
    got = L.without_chunks(_sited(spark, d, "p5m"), "p5m")
    return got.withColumnRenamed("id", "feed_articleid")


def p5_clean(spark, d):
    """Each cleartext without the lines that its site repeats excessively."""
    docs = _sited(spark, d, "p5c")
    return L.without_lines(docs, L.repeated_lines(docs, "p5c"), "p5c").select(F.col("id").alias("feed_articleid"), "content", "cut")


# ---- 6: page boilerplate


def _paged(spark, d):
    """(site, id, page, text): extracts with their pages, joined by id once."""
    text = once(cleartexts(spark, d).where("id is not null and text is not null"), "id")
    page = once(pages(spark, d).where("id is not null").select("id", F.col("text").alias("page")), "id")
    return text.join(sites(spark, d).distinct(), "id", "left").join(page, "id", "left").select("site", "id", "page", "text")


def p6_found(spark, d):
    fresh("p6f")
    return B.unwanted_lines(B.surveyed(_paged(spark, d), "p6f")).select(F.col("id").alias("feed_articleid"), "line_no")


def p6_bodies(spark, d):
    """Title and main body of every page that has an extract, read by its host's winning paths."""
    fresh("p6b")
    docs = written(_paged(spark, d), "p6b")
    return B.bodies(docs, B.surveyed(docs, "p6b")).select(F.col("id").alias("feed_articleid"), "title", "body", "blocks")


# ---- 8: containers


def _sized(spark, d, owner):
    fresh(owner)
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    return written(T.sized(docs), owner)


def _specs(spark, d):
    return table(spark, d, "pack_spec").select("spec_id", F.col("capacity_tokens").alias("capacity"), "source")


def p8_windows(spark, d):
    """Every text in its container, for each container size."""
    return P.packed(_sized(spark, d, "p8w"), _specs(spark, d)).withColumnRenamed("id", "doc_id")


def p8_fill(spark, d):
    """Containers used and how full they are, beside the least number possible."""
    return P.fill_report(P.packed(_sized(spark, d, "p8f"), _specs(spark, d)), _specs(spark, d))


# ---- 9: mixtures


def p9_draws(spark, d):
    """The draws of each mix in training order."""
    return Y.draws(_sized(spark, d, "p9d"), table(spark, d, "mix_target")).withColumnRenamed("id", "doc_id")


def p9_shares(spark, d):
    """The share of each source beside its target."""
    return Y.shares(Y.draws(_sized(spark, d, "p9s"), table(spark, d, "mix_target")), table(spark, d, "mix_target"))


# ---- 10: keyword and link spam


def documents(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


def _counts(spark, d, owner):
    fresh(owner)
    return S.corpus_counts(documents(spark, d), owner)


def p10_found(spark, d):
    got = S.scored(documents(spark, d), _counts(spark, d, "p10f"), least=0.5)
    return got.where("spam > 0.5").select(F.col("id").alias("doc_id")).distinct()


def p10_method(spark, d):
    """Every document by the method alone: the mean PMI of its neighbouring words, and whether repeated collocations and word salad make up more than half of it."""
    got = S.measured(documents(spark, d), _counts(spark, d, "p10m"), least=0.5)
    return got.select(F.col("id").alias("doc_id"), "pmi", (F.col("stuffed") > 0.5).alias("spam")).distinct()


def p10_scores(spark, d):
    """Each document's share of spam, of links and tags, and the mean PMI of its neighbouring words."""
    return S.scored(documents(spark, d), _counts(spark, d, "p10s")).select(F.col("id").alias("doc_id"), "spam", "links", "pmi").distinct()


QUERIES = {f.__name__: f for f in (p1_found, p1_documents, p1_stretches, p2_found, p2_classes, p2_groups, p3_found, p3_restored, p4_found, p4_batches, p5_method, p5_found, p5_clean, p6_found, p6_bodies, p8_windows, p8_fill, p9_draws, p9_shares, p10_method, p10_found, p10_scores)}
