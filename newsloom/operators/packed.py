"""Several values packed in one field: a parsing expression grammar that splits them.

Grammar (ordered alternatives; the first that matches wins, a failed one backtracks)::

    field   <- blank* (item? sep)* item?
    item    <- pair / quoted / bracketed / bare        (pair only with pairs=True)
    quoted  <- '"' ('""' / !'"' .)* '"' &end  /  "'" (!("'" end) .)+ "'" &end
    bracket <- '[' (bracket / !']' .)* ']' &end        (only with brackets=True; round and curly ones alike, nested)
    bare    <- (!sep .)+
    pair    <- number ('.') blanks / ',' number        (a latitude and a longitude)
    sep     <- blank* [;,|\t\r\n] blank*  /  blank+ '/' blank+
    end     <- blank* (sep / EOF)

A quote or bracket that never closes, or closes before more text, is none: the parser backtracks, reads
the value bare and sets the flag. Cases: null field -> no rows; empty or blank values are not
counted; very long fields are scanned once, left to right; repeated rows give equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.runtime import ship

_BLANK = " \u00a0\u2009\u202f\ufeff"
_B = f"[{_BLANK}]"
_SEP = re.compile(rf"{_B}*[;,|\t\r\n\v\f]{_B}*|{_B}+/{_B}+")
_END = re.compile(rf"{_B}*(?:[;,|\t\r\n\v\f]|{_B}/{_B}|$(?!\n))")
_BARE = re.compile(rf"(?:(?![;,|\t\r\n\v\f]|{_B}+/{_B}).)+", re.S)
_SKIP = re.compile(rf"{_B}*")
_QUOTED = {'"': re.compile(r'"((?:""|[^"])*)"'), "'": re.compile(rf"'((?:(?!'{_END.pattern}).)+)'", re.S)}
_BRACKET = {"[": "]", "(": ")", "{": "}"}
_EITHER = re.compile(r"[\[\](){}]")
_NUM = r"[+-]?\d+"
_PAIRS = (
    re.compile(rf"({_NUM},\d+){_B}+({_NUM},\d+)"),
    re.compile(rf"({_NUM}(?:\.\d+)?)(?:{_B}*,{_B}*|{_B}+)({_NUM}(?:\.\d+)?)"),
)
OK, BAD_QUOTE, BAD_BRACKET, NOT_A_PAIR = "", "bad_quote", "bad_bracket", "not_a_pair"


def as_pair(text: str) -> str | None:
    """'lat lon' if the whole text is a pair of numbers, however written."""
    t = text.strip(_BLANK)
    for p in _PAIRS:
        if m := p.fullmatch(t):
            return f"{m[1].replace(',', '.')} {m[2].replace(',', '.')}"
    return None


def closing(text: str, at: int) -> int:
    """Where the bracket opened at ``at`` closes, brackets within it matched; -1 if it doesn't."""
    open_ones: list[str] = []
    for m in _EITHER.finditer(text, at):
        if m[0] in _BRACKET:
            open_ones.append(_BRACKET[m[0]])
        elif m[0] != open_ones.pop():
            return -1
        elif not open_ones:
            return m.start()
    return -1


def parse(text: str, pairs: bool = False, brackets: bool = False) -> Iterator[tuple[str, str]]:
    """(value, flag) of each non-empty value of one field."""
    at, size = 0, len(text)
    while at < size:
        at = _SKIP.match(text, at).end()
        if at >= size:
            return
        value, flag, end = None, OK, at
        if pairs:
            for p in _PAIRS:
                if (m := p.match(text, at)) and _END.match(text, m.end()):
                    value, end = f"{m[1].replace(',', '.')} {m[2].replace(',', '.')}", m.end()
                    break
        c = text[at]
        if value is None and c in _QUOTED:
            m = _QUOTED[c].match(text, at)
            if m and _END.match(text, m.end()):
                value, end = m[1].replace('""', '"' if c == '"' else '""').strip(_BLANK + "\t\r\n"), m.end()
                if pairs:
                    value = as_pair(value) or value
            else:
                flag = BAD_QUOTE
        if value is None and brackets and c in _BRACKET:
            shut = closing(text, at)
            if shut > 0 and _END.match(text, shut + 1):
                value, end = text[at + 1 : shut].strip(_BLANK), shut + 1
            else:
                flag = BAD_BRACKET
        if value is None:
            m = _BARE.match(text, at)
            value, end = (m[0].strip(_BLANK), m.end()) if m else ("", at)
        if value:
            yield value, flag or (NOT_A_PAIR if pairs and not as_pair(value) else OK)
        m = _SEP.match(text, end)
        at = m.end() if m else end + (end == at)


def split_packed(df: DataFrame, row_id: Column, value: Column, field: str, pairs: bool = False, brackets: bool = False) -> DataFrame:
    """One row per value: field, row_id, pos (from 1 over the whole field), val, flag.

    ``value`` is a string, or an array of strings whose elements are read in order. The rows are
    parsed where they lie, in Arrow batches: no shuffle. Equal input rows give equal output rows;
    remove them before if they must count once.
    """
    ship(df.sparkSession)
    src = df.select(row_id.cast("long").alias("row_id"), value.alias("value")).where(F.col("value").isNotNull())
    if src.schema["value"].dataType.typeName() != "array":
        src = src.select("row_id", F.array("value").alias("value"))

    def run(batches):
        for b in batches:
            ids, pos, vals, flags = [], [], [], []
            for i, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = 0
                for part in parts:
                    for v, flag in parse(part or "", pairs, brackets):
                        k += 1
                        ids.append(i), pos.append(k), vals.append(v), flags.append(flag)
            yield pa.RecordBatch.from_arrays(
                [pa.array([field] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(pos, pa.int32()), pa.array(vals, pa.string()), pa.array(flags, pa.string())],
                ["field", "row_id", "pos", "val", "flag"],
            )

    return src.mapInArrow(run, "field string, row_id long, pos int, val string, flag string")
