"""Trigram language models, scripts, label normalisation and the cascade of classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.iso639 import BIBLIOGRAPHIC, OLD, PLACEHOLDERS, TWO, language
from newsloom.operators import trigrams as G
from newsloom.plans.text_queries import _T, _texts
from newsloom.runtime import table

def _samples(spark, d) -> DataFrame:
    return table(spark, d, "lang_sample").select(F.col("lang_iso").alias("lang"), "text")


def _titles(spark, d) -> DataFrame:
    return table(spark, d, "feed_article_meta").where("title is not null").select("id", F.col("title").alias("text")).distinct()


def trigram_counts(spark, d) -> DataFrame:
    """Trigrams of the sample texts by language."""
    s = _samples(spark, d).withColumn("id", F.xxhash64("lang", "text"))
    return G.counts(s).join(s.select("id", "lang").distinct(), "id").groupBy("lang", "gram").agg(F.sum("c").alias("n"))


def trigram_model(spark, d) -> DataFrame:
    m, langs = G.train(_samples(spark, d))
    return m.join(langs, "lang").select("lang", "gram", F.round("m", 6).alias("m"), F.round("prior", 6).alias("prior"), F.round("unknown", 6).alias("unknown"))


def title_languages(spark, d) -> DataFrame:
    """The language of each title by naive Bayes."""
    m, langs = G.train(_samples(spark, d))
    return G.predict(_titles(spark, d), m, langs)


def script_histogram(spark, d) -> DataFrame:
    n = G.script_counts(F.col("content"))
    return _texts(spark, d).select("id", n["Latin"].alias("latin"), n["Cyrillic"].alias("cyrillic"), n["Greek"].alias("greek"), n["Han"].alias("han"), G.script_language(F.col("content")).alias("lang"))


def text_languages(spark, d) -> DataFrame:
    """The language of each cleartext by naive Bayes."""
    m, langs = G.train(_samples(spark, d))
    return G.predict(_texts(spark, d).withColumnRenamed("content", "text"), m, langs)


def labels_normalised(spark, d) -> DataFrame:
    """Language labels as three-letter codes by the whole of ISO 639-1: the part before a region, looked up; else null."""
    m = table(spark, d, "feed_article_meta").select("id", "lang_iso").distinct()
    return m.select("id", language(F.col("lang_iso")).alias("lang")).distinct()


def language_cascade(spark, d) -> DataFrame:
    """Label, else script, else naive Bayes on the text: how often each decides."""
    lab = labels_normalised(spark, d).withColumnRenamed("lang", "label")
    scr = _texts(spark, d).select("id", G.script_language(F.col("content")).alias("script"))
    nb = text_languages(spark, d).withColumnRenamed("lang", "nb")
    j = lab.join(scr, "id", "left").join(nb, "id", "left")
    by = F.when(F.col("label").isNotNull(), "label").when(F.col("script").isNotNull(), "script").when(F.col("nb").isNotNull(), "trigrams").otherwise("none")
    return j.groupBy(by.alias("decided_by"), F.coalesce("label", "script", "nb").alias("lang")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (trigram_counts, trigram_model, title_languages, text_languages, script_histogram, labels_normalised, language_cascade)}

_GRAMS = """(SELECT {key}, CASE WHEN g[1] = ' ' THEN '<' ELSE g[1] END || g[2] || CASE WHEN g[3] = ' ' THEN '>' ELSE g[3] END AS gram
 FROM (SELECT {key}, substring(t, CAST(i AS BIGINT), 3) AS g FROM (SELECT {key}, t, unnest(range(1, length(t) - 1)) AS i FROM (SELECT {key}, lower(regexp_replace({col}, '[\\s0-9]+', ' ', 'g')) AS t FROM {src}))) WHERE g[2] <> ' ')"""
_S = _GRAMS.format(key="lang_iso", col="text", src="lang_sample")
_M = f"""g AS (SELECT lang_iso AS lang, gram, count(*) AS c FROM {_S} GROUP BY 1, 2), z AS (SELECT count(DISTINCT gram) AS v, sum(c) AS a FROM g),
l AS (SELECT lang, n, v, ln(n / a) AS prior, ln(1.0::DOUBLE / (n + v)) AS unknown FROM (SELECT lang, sum(c) AS n FROM g GROUP BY 1), z),
m AS (SELECT gram, g.lang, ln((c + 1)::DOUBLE / (n + v)) AS m FROM g JOIN l ON l.lang = g.lang)"""


def _bayes(key: str, col: str, src: str) -> str:
    return f"""{_M}, c AS (SELECT id, gram, count(*) AS c FROM {_GRAMS.format(key=key, col=col, src=src)} GROUP BY 1, 2), k AS (SELECT * FROM c WHERE gram IN (SELECT gram FROM m)), a AS (SELECT id, sum(c) AS a FROM k GROUP BY 1),
s AS (SELECT id, lang, sum(c * m) AS s, sum(c) AS n FROM k JOIN m USING (gram) GROUP BY 1, 2), t AS (SELECT s.id, s.lang, round(s + prior + (a - s.n) * unknown, 6) AS t FROM s JOIN l ON l.lang = s.lang JOIN a ON a.id = s.id),
nb AS (SELECT d.id, b.lang FROM (SELECT DISTINCT id FROM {src}) d LEFT JOIN (SELECT id, arg_max(lang, (t, lang)) AS lang FROM t GROUP BY 1) b USING (id))"""


_P = _bayes("id", "title", "(SELECT DISTINCT id, title FROM feed_article_meta WHERE title IS NOT NULL)")
_PT = _bayes("id", "content", _T)
_CODES = TWO | OLD | BIBLIOGRAPHIC
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in _CODES.items()) + "}"


def sql_language(c: str) -> str:
    code = f"lower(regexp_extract(trim({c}), '^([A-Za-z]{{2,3}})(?:[-_][A-Za-z0-9]+)*$', 1))"
    none = ", ".join(f"'{x}'" for x in PLACEHOLDERS)
    return f"coalesce({_MAP}[{code}], CASE WHEN length({code}) = 3 AND {code} NOT IN ({none}) AND NOT regexp_matches({code}, '^q[a-t][a-z]$') THEN {code} END)"


_LABEL = f"(SELECT DISTINCT id, {sql_language('lang_iso')} AS lang FROM feed_article_meta)"
_CLASS = {"Kana": r"[\p{Hiragana}\p{Katakana}]"} | {k: rf"\p{{{k}}}" for k in (*G.SCRIPTS, "Latin", "Cyrillic") if k != "Kana"}
_N = ", ".join(f"len(regexp_extract_all(content, '{v}')) AS {k.lower()}" for k, v in _CLASS.items())
_TOTAL = " + ".join(k.lower() for k in _CLASS)
_SCRIPT = f"(SELECT *, CASE " + " ".join(f"WHEN {k.lower()} * {n} > total THEN '{lang}'" for k, (n, lang) in G.SCRIPTS.items()) + f" END AS lang FROM (SELECT *, {_TOTAL} AS total FROM (SELECT id, {_N} FROM {_T})))"
ORACLE = {
    "trigram_counts": f"SELECT lang_iso AS lang, gram, count(*) AS n FROM {_S} GROUP BY 1, 2",
    "trigram_model": f"WITH {_M} SELECT m.lang, gram, round(m, 6) AS m, round(prior, 6) AS prior, round(unknown, 6) AS unknown FROM m JOIN l ON l.lang = m.lang",
    "title_languages": f"WITH {_P} SELECT id, lang FROM nb",
    "text_languages": f"WITH {_PT} SELECT id, lang FROM nb",
    "script_histogram": f"SELECT id, CAST(latin AS INT) AS latin, CAST(cyrillic AS INT) AS cyrillic, CAST(greek AS INT) AS greek, CAST(han AS INT) AS han, lang FROM {_SCRIPT}",
    "labels_normalised": f"SELECT id, lang FROM {_LABEL}",
    "language_cascade": f"WITH {_PT} SELECT CASE WHEN b.lang IS NOT NULL THEN 'label' WHEN s.lang IS NOT NULL THEN 'script' WHEN nb.lang IS NOT NULL THEN 'trigrams' ELSE 'none' END AS decided_by, coalesce(b.lang, s.lang, nb.lang) AS lang, count(*) AS n FROM {_LABEL} b LEFT JOIN {_SCRIPT} s ON s.id = b.id LEFT JOIN nb ON nb.id = b.id GROUP BY ALL",
}
