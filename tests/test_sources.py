"""Readers on small files, enrichers, and next states on edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from newsloom.functions.iso639 import TWO, language
from newsloom.operators import state as S
from newsloom.operators.enrich import enriched
from newsloom.sources import readers as R


def test_address_list(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("http://a.example\n# note\n\nhttp://b.example\nhttp://c.example\n")
    assert [r.url for r in R.address_list(spark, str(tmp_path / "urls.txt")).orderBy("line_no").collect()] == ["http://a.example", "http://b.example", "http://c.example"]
    assert [r.url for r in R.address_list(spark, str(tmp_path / "urls.txt"), skip=4).collect()] == ["http://c.example"]


def test_trigram_corpus(spark, tmp_path):
    (tmp_path / "table.txt").write_text("en\teng\tEnglish\nde\tdeu\tGerman\n")
    (tmp_path / "en-3grams.txt").write_text("12 the\n3  th\nbroken\n")
    (tmp_path / "xx-3grams.txt").write_text("5 abc\n")
    assert {tuple(r) for r in R.trigram_corpus(spark, str(tmp_path)).collect()} == {("eng", "the", 12), ("eng", " th", 3)}


def test_script_ranges(spark, tmp_path):
    (tmp_path / "Scripts.txt").write_text("0041..005A ; Latin # L\n005B..0060 ; Latin # next\n0061..007A ; Latin\n0400..0484    ; Cyrillic # c\n0487 ; Cyrillic\n# comment\n")
    r = R.script_ranges(spark, str(tmp_path / "Scripts.txt"))
    assert {tuple(x) for x in r.collect()} == {("Latin", 0x41, 0x7A), ("Cyrillic", 0x400, 0x484), ("Cyrillic", 0x487, 0x487)}
    c = spark.createDataFrame([("a",), ("ж",), ("1",), ("z",)], "char string")
    assert {x.char: x.script for x in R.script_of(c, r).collect()} == {"a": "Latin", "ж": "Cyrillic", "1": "#unknown#", "z": "Latin"}


def test_stop_ngrams_and_schemas(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("one two three\n\none two three\nfour five six\n")
    got = R.stop_ngrams(spark, str(tmp_path / "stops.txt"))
    want = spark.createDataFrame([("one two three",), ("four five six",)], "g string").select(R.ngram_hash(F.col("g")).alias("h"))
    assert got.count() == 2 and got.exceptAll(want).count() == 0
    t = R.typed(spark.createDataFrame([("1", "x", 9)], "id string, hostname string, other int"), "site")
    assert t.columns[:2] == ["id", "hostname"] and "other" not in t.columns and t.first().id == 1 and t.first().tags is None


def test_languages(spark):
    rows = [("en", "eng"), ("EN-us", "eng"), ("ger", "deu"), ("uz", "uzb"), ("az-Latn-AZ", "aze"), ("iw", "heb"), ("non", "non"), ("nan", "nan"), ("und", None), ("", None), ("xx", None), ("qaa", None), ("n/a", None), (None, None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "label string")
    assert {r.label: r.out for r in df.select("label", language(F.col("label")).alias("out")).collect()} == dict(rows) and len(TWO) == 184


def test_enrichers_pass_records_on(spark):
    df = spark.createDataFrame([(1, "a", "old"), (2, None, "old"), (3, "b", None)], "id long, t string, extra string")
    got = {r.id: (r.t, r.extra) for r in enriched(df, lambda r: r["t"].upper(), "extra", ["t"]).collect()}
    assert got == {1: ("a", "A"), 2: (None, None), 3: ("b", "B")} and enriched(df.limit(0), lambda r: 1, "x", ["t"]).count() == 0


def test_next_states(spark):
    now = F.expr("timestamp '2024-01-01 00:00:00'")
    f = spark.createDataFrame([(1, False, 5, 100), (2, False, 4, 100), (3, False, None, 100), (4, False, 0, 100), (5, True, 9, 100)], "id long, disabled boolean, failures int, effective_ttl int").withColumn("next_scan", now)
    out = F.when(F.col("id") == 4, "gone").when(F.col("id") == 5, "ok").otherwise("failed")
    got = {r.id: (r.disabled, r.failures) for r in S.after_scan(f, out, now).collect()}
    assert got == {1: (True, 6), 2: (False, 5), 3: (False, 1), 4: (True, 0), 5: (True, 0)}
    later = [r.next_scan - dt.datetime(2024, 1, 1) for r in S.after_scan(f, out, now).collect()]
    assert all(dt.timedelta(seconds=50) <= x < dt.timedelta(seconds=150) for x in later)
    old, new = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string"), spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k long, v string")
    assert {tuple(r) for r in S.upserted(old, new, "k").collect()} == {(1, "a", "kept"), (2, "c", "replaced"), (3, None, "same"), (4, "d", "added")}
    modes = [("L", True, True, False), ("L", True, False, False), ("L", False, False, False), ("L", True, True, True), ("D", True, False, False), ("D", False, True, True), ("A", True, False, False), ("X", True, True, False), (None, True, True, False)]
    m = spark.createDataFrame(modes, "mode string, up boolean, down boolean, faulty boolean")
    assert [r[0] for r in m.select(S.next_mode(F.col("mode"), F.col("up"), F.col("down"), F.col("faulty"))).collect()] == ["D", "A", "X", "0", "Y", "F", "A", "X", None]
