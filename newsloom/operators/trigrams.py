"""Language by letter trigrams: counts, a multinomial naive Bayes model, scoring; scripts by character classes.

Everything is a DataFrame: the model (trigrams of the training corpus, each with its languages) is counted and, while
it is small, broadcast to the trigrams of the documents, so that only sums by document and language are shuffled; a
larger one is joined as the planner likes. Documents are joined with nothing else, as what has a row for each of them
must not be broadcast. Cases: texts of fewer than three letters have no trigram and language null; a
trigram the model doesn't know has no say; ties go to the language last in the alphabet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import collapse_digits, trigrams

#: Script -> (times its letters must outweigh the text's, language). Order matters: kana before Han. Fixed values.
SCRIPTS = {
    "Hangul": (5, "kor"), "Kana": (5, "jpn"), "Han": (5, "cmn"), "Khmer": (5, "khm"), "Hebrew": (3, "heb"), "Arabic": (3, "arb"),
    "Ethiopic": (3, "amh"), "Armenian": (3, "hye"), "Bengali": (3, "ben"), "Myanmar": (3, "mya"), "Georgian": (3, "kat"), "Lao": (3, "lao"),
    "Sinhala": (3, "sin"), "Thai": (3, "tha"), "Tibetan": (3, "bod"), "Greek": (3, "ell"),
}


def _grams(docs: DataFrame) -> DataFrame:
    """(id, gram) of (id, text), a null where there is none."""
    plain = docs.select("id", F.explode(F.array(F.lower(collapse_digits(F.col("text"))))).alias("plain"))  # made once, not for each trigram
    return plain.select("id", F.explode_outer(trigrams(F.col("plain"))).alias("gram"))


def counts(docs: DataFrame) -> DataFrame:
    """(id, gram, c) of (id, text)."""
    return _grams(docs).where("gram is not null").groupBy("id", "gram").agg(F.count("*").alias("c"))


def train(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, lang, m) log likelihoods with add-one smoothing, and (lang, prior, unknown)."""
    g = samples.select("lang", F.explode(trigrams(F.lower(collapse_digits(F.col("text"))))).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("c"))
    size = g.agg(F.count_distinct("gram").alias("v"), F.sum("c").alias("all"))
    langs = g.groupBy("lang").agg(F.sum("c").alias("n")).join(F.broadcast(size))  # one row is broadcast
    langs = langs.select("lang", "n", "v", F.log(F.col("n") / F.col("all")).alias("prior"), F.log(1 / (F.col("n") + F.col("v"))).alias("unknown"))
    model = g.join(langs, "lang").select("gram", "lang", F.log((F.col("c") + 1) / (F.col("n") + F.col("v"))).alias("m"))
    return model, langs.select("lang", "prior", "unknown")


def predict(docs: DataFrame, model: DataFrame, langs: DataFrame, small: int = 2**17) -> DataFrame:
    """(id, lang): known trigrams by their likelihood, those another language knows by the unknown mass. A model of at most
    ``small`` rows is broadcast."""
    # the entry without a language counts all known trigrams
    known = model.groupBy("gram").agg(F.array_append(F.collect_list(F.struct("lang", "m")), F.struct(F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("m"))).alias("e"))
    if model.count() <= small:
        known = F.broadcast(known)
    e = _grams(docs).join(known, "gram", "left").select("id", F.explode_outer("e").alias("e"))
    seen = e.groupBy("id", "e.lang").agg(F.sum("e.m").alias("s"), F.count("e").alias("n"))
    scored = seen.join(F.broadcast(langs), "lang", "left")  # a row for each language
    by = scored.groupBy("id").agg(F.max(F.when(F.col("lang").isNull(), F.col("n"))).alias("all"), F.collect_list(F.when(F.col("lang").isNotNull(), F.struct("s", "n", "prior", "unknown", "lang"))).alias("by"))
    best = F.array_max(F.transform("by", lambda x: F.struct(F.round(x["s"] + x["prior"] + (F.col("all") - x["n"]) * x["unknown"], 6).alias("t"), x["lang"].alias("lang"))))
    return by.select("id", F.when(F.col("id").isNotNull(), best["lang"]).alias("lang"))


def script_counts(c: Column) -> dict[str, Column]:
    """Letters of each script in a text."""
    cls = {k: rf"\p{{Is{k}}}" for k in SCRIPTS if k != "Kana"} | {"Kana": r"[\p{IsHiragana}\p{IsKatakana}]", "Latin": r"\p{IsLatin}", "Cyrillic": r"\p{IsCyrillic}"}
    return {k: F.regexp_count(c, F.lit(v)) for k, v in cls.items()}


def script_language(c: Column) -> Column:
    """The language a text's script alone decides, else null."""
    n = script_counts(c)
    total = reduce(lambda a, b: a + b, n.values())
    rules = iter(SCRIPTS.items())
    k, (times, lang) = next(rules)
    out = F.when(n[k] * times > total, lang)
    for k, (times, lang) in rules:
        out = out.when(n[k] * times > total, lang)
    return out
