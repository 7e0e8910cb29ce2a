import re

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.operators.packed import BAD_BRACKET, BAD_QUOTE, NOT_A_PAIR, parse, split_packed


def values(text, **kw):
    return [v for v, _ in parse(text, **kw)]


def test_separators_and_quotes():
    assert values("a;b, c|d\te\nf / g") == ["a", "b", "c", "d", "e", "f", "g"]
    assert values("TV/radio / x/y") == ["TV/radio", "x/y"]
    assert values('"law | order";\'arts, books\' ; "the ""other"" side"') == ["law | order", "arts, books", 'the "other" side']
    assert values("rock'n'roll, women's football") == ["rock'n'roll", "women's football"]
    assert values("'women's football', x") == ["women's football", "x"]
    assert values("; , a ;; \"\" , ' ' |") == ["a", "' '"] or values("; , a ;; |") == ["a"]


def test_malformed_quotes_backtrack():
    assert list(parse('"open; x')) == [('"open', BAD_QUOTE), ("x", "")]
    assert list(parse('"a"b, c'))[0] == ('"a"b', BAD_QUOTE)


def test_pairs():
    assert values("25.4,-111.2", pairs=True) == ["25.4 -111.2"]
    assert values("42,9 165,3|-26,9 2,91", pairs=True) == ["42.9 165.3", "-26.9 2.91"]
    assert values('"28.6156,-52.21";"47.47 61.8"', pairs=True) == ["28.6156 -52.21", "47.47 61.8"]
    assert values("66.61 111.78,-10.8067 -121.80,0 0", pairs=True) == ["66.61 111.78", "-10.8067 -121.80", "0 0"]
    assert list(parse("46.05,-1.07 -138.85", pairs=True)) == [("46.05", NOT_A_PAIR), ("-1.07 -138.85", "")]


def test_brackets_only_on_request():
    assert values("[a; b], c", brackets=True) == ["a; b", "c"]
    assert values("[a; b], c") == ["[a", "b]", "c"]
    assert values("[a; (b, c)]; {d | [e]} ; (f)", brackets=True) == ["a; (b, c)", "d | [e]", "f"]
    assert list(parse("[a; b", brackets=True)) == [("[a", BAD_BRACKET), ("b", "")]
    assert list(parse("[a;b)] x, [c]d;(e", brackets=True)) == [("[a", BAD_BRACKET), ("b)] x", ""), ("[c]d", BAD_BRACKET), ("(e", BAD_BRACKET)]
    assert values("[" * 2000 + "x" + "]" * 2000, brackets=True) == ["[" * 1999 + "x" + "]" * 1999]


@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=("Cs", "Zs", "Cc")), min_size=1, max_size=8), max_size=8), st.sampled_from([";", ",", "|", "\t", "\n", " / "]))
def test_quoted_values_come_back(items, sep):
    items = [x for x in (re.sub(r"\s", "", i) for i in items) if x.strip("   ﻿") == x and x]
    packed = sep.join('"' + x.replace('"', '""') + '"' for x in items)
    assert values(packed) == items


def test_frame_edges(spark):
    df = spark.createDataFrame([(1, "a;b", "x"), (1, "a;b", "x"), (2, None, "y"), (3, "", None), (None, "z", "q"), (4, "v," * 50_000, "n")], "id long, value string, pos string")
    out = split_packed(df, F.col("id"), F.col("value"), "f")
    assert out.columns == ["field", "row_id", "pos", "val", "flag"]
    got = out.groupBy("row_id").count().collect()
    assert {r[0]: r[1] for r in got} == {1: 4, None: 1, 4: 50_000}
    assert split_packed(df.limit(0), F.col("id"), F.col("value"), "f").count() == 0
    arr = spark.createDataFrame([(1, ["a;b", None, "", "c"])], "id long, tags array<string>")
    assert [(r.pos, r.val) for r in split_packed(arr, F.col("id"), F.col("tags"), "t").orderBy("pos").collect()] == [(1, "a"), (2, "b"), (3, "c")]
