"""Text functions as Column expressions (no Python workers)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Typographic characters and the plain text they stand for. Fixed values.
PUNCTUATION = {
    " ": " ", "–": "-", "—": " -- ", "―": " -- ", "−": "-", "─": "--", "━": "|", "∕": "/", "⁄": "/",
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "»": '"', "«": '"',
    "‹": '"', "›": '"', "•": "*", "′": "'", "″": "''", "`": "'", "˝": '"', "˜": "~", "¦": "|", "…": "...",
    "ĳ": "ij", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st",
    "\u0091": "'", "\u0092": "'", "\u0082": "'", "\u0084": '"', "\u0093": '"', "\u0094": '"', "\u0095": "*", "\u0096": "-", "\u0097": " -- ", "\u0085": "...",
}
BLOCKS = "p|div|br|h[1-6]|li|ul|ol|tr|td|th|table|blockquote|article|section|header|footer|pre"


def normalize_punctuation(c: Column, whitespace: bool = False) -> Column:
    """Typographic characters to plain ones: one-to-one by a single ``translate``, the rest by ``replace``."""
    one = {k: v for k, v in PUNCTUATION.items() if len(v) == 1} | ({"\n": " ", "\r": " ", "\t": " "} if whitespace else {})
    out = F.translate(c, "".join(one), "".join(one.values()))
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), ((k, v) for k, v in PUNCTUATION.items() if len(v) > 1), out)


def bare_form(c: Column, numbers: bool = False) -> Column:
    """Lower case, letters only (and digits on request)."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{Nd}]" if numbers else r"[^\p{L}]", "")


def data_len(c: Column) -> Column:
    """Bytes of the bare form: one per Latin letter, more where a letter carries more."""
    return F.octet_length(bare_form(c))


def strip_tags(c: Column) -> Column:
    """Markup out, quoted attributes respected."""
    return F.regexp_replace(c, r"""<(?:[^<>"']|"[^"]*"|'[^']*')*>""", "")


def kill_scripts(c: Column) -> Column:
    return F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")


def textify(c: Column) -> Column:
    """Page to running text: scripts and comments out, block tags to blanks, other tags out, blanks collapsed."""
    x = F.regexp_replace(kill_scripts(c), r"(?s)<!--.*?-->", "")
    x = strip_tags(F.regexp_replace(x, rf"(?i)</?({BLOCKS})\b[^>]*>", "\n"))
    return F.trim(F.regexp_replace(normalize_punctuation(x, whitespace=True), r"\s+", " "))


def tidy_lines(c: Column) -> Column:
    """Comments out, breaks and paragraphs to line ends, tags out, blanks at line ends and runs of lines collapsed."""
    x = F.regexp_replace(F.regexp_replace(c, r"(?s)<!--.*?-->", ""), r"(?i)<(br|/?p)\b[^>]*>", "\n")
    x = F.regexp_replace(F.regexp_replace(strip_tags(x), r"[ \t]+", " "), r" ?\n ?", "\n")
    return F.regexp_replace(x, r"\n+", "\n")


def collapse_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[\s0-9]+", " ")


def title_line(c: Column) -> Column:
    return F.split_part(c, F.lit("\n"), F.lit(1))


def without_title(c: Column) -> Column:
    """The lines after the first, led by a line end; empty text stays empty."""
    return F.when(c == "", "").otherwise(F.regexp_replace(c, r"^[^\n]*\n?", "\n"))


def intro(c: Column, soft: int = 400, hard: int = 500) -> Column:
    """The start of a text, cut at the first blank from ``soft`` characters on, at ``hard`` at most."""
    at = F.locate(" ", c, soft + 1)
    end = F.least(F.when(at > 0, at - 1).otherwise(hard), F.lit(hard))
    return F.when(F.length(c) > end, F.concat(F.substring(c, F.lit(1), end), F.lit(" (...)"))).otherwise(c)


def xml_escape(c: Column) -> Column:
    """ASCII with XML escapes; other legal characters as numeric references, illegal ones dropped."""
    def one(ch: Column) -> Column:
        n = F.ascii(ch)
        legal = n.isin(9, 10, 13) | n.between(32, 0xD7FE) | n.between(0xE001, 0xFFFC) | n.between(0x10000, 0x10FFFF)
        return (
            F.when(ch == "&", "&amp;").when(ch == "<", "&lt;").when(ch == ">", "&gt;").when(~legal, "")
            .when(n < 128, ch).otherwise(F.concat(F.lit("&#"), n.cast("string"), F.lit(";")))
        )
    return F.array_join(F.transform(F.split(c, ""), one), "")


def mark_paras(c: Column) -> Column:
    """Each non-blank line as an escaped paragraph."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), xml_escape(x), F.lit("</p>"))), "\n")


def remove_xml_header(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*<\?xml[^>]*>", "")


def md5_tail(c: Column) -> Column:
    """The last eight bytes of the MD5 digest as a little-endian unsigned number."""
    h = F.md5(c.cast("binary"))
    swapped = F.concat(*(F.substring(h, 31 - 2 * i, 2) for i in range(8)))
    return F.conv(swapped, 16, 10).cast("decimal(20,0)")


def trigrams(c: Column) -> Column:
    """Letter trigrams of a text; none with a blank in the middle, a blank at an end is a word's edge."""
    n = F.length(c)
    three = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.substring(c, i, F.lit(3)))
    kept = F.filter(three, lambda t: F.substring(t, F.lit(2), F.lit(1)) != " ")
    marked = F.transform(kept, lambda t: F.concat(
        F.when(F.left(t, F.lit(1)) == " ", "<").otherwise(F.left(t, F.lit(1))), F.substring(t, F.lit(2), F.lit(1)),
        F.when(F.right(t, F.lit(1)) == " ", ">").otherwise(F.right(t, F.lit(1)))))
    return F.when(n >= 3, marked).otherwise(F.array().cast("array<string>"))


def without_ngrams(c: Column, stops: list[str], n: int) -> Column:
    """The text without tokens covered by a stop n-gram (tokens split at single blanks; overlaps join)."""
    tokens = F.split(c, " ")
    last = F.size(tokens) - n + 1
    grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    hit = F.transform(grams, lambda g: g.isin(*stops))
    kept = F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda s: ~F.coalesce(F.exists(F.slice(hit, F.greatest(s["i"] - n + 2, F.lit(1)), F.least(s["i"] + 1, F.lit(n))), lambda h: h), F.lit(False)))
    return F.when(last < 1, c).otherwise(F.array_join(F.transform(kept, lambda s: s["t"]), " "))


def title_like(a: Column, b: Column) -> Column:
    """Whether two titles are the same but for small edits (bare forms, length difference not counted)."""
    x, y = bare_form(a, numbers=True), bare_form(b, numbers=True)
    longer = F.greatest(F.length(x), F.length(y))
    edits = F.levenshtein(x, y) - F.abs(F.length(x) - F.length(y))
    return F.when(longer == 0, False).when(F.length(x) > 4 * F.length(y), False).otherwise(edits / longer < 0.1)


def utf8(content: Column) -> Column:
    """Bytes as UTF-8 text; bytes that are none become U+FFFD, so no row can fail."""
    return F.make_valid_utf8(content.cast("string"))


def xml_list(c: Column, name: str) -> Column:
    """The values of an array of texts as escaped elements; no other type is taken. An empty array gives an empty text."""
    return F.array_join(F.transform(c.cast("array<string>"), lambda x: F.concat(F.lit(f"<{name}>"), xml_escape(x), F.lit(f"</{name}>"))), "")
