"""Pages decoded in the charset each names.

UTF-8 and Latin-1 are read by the engine itself; other charsets, of which it has none, in Arrow batches. Bytes that a
charset can't read become U+FFFD. Cases: null content gives null; a charset that isn't known is read as Latin-1.
"""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import utf8
from newsloom.runtime import ship

NATIVE = ("utf-8", "utf8", "iso-8859-1", "latin1", "us-ascii")


def codec(name: str | None) -> str:
    try:
        return codecs.lookup((name or "").lower()).name
    except LookupError:
        return "iso8859-1"


def decoded(pages: DataFrame) -> DataFrame:
    """(id, charset, text) of pages (id, charset, content)."""
    ship(pages.sparkSession)

    def run(batches):
        for b in batches:
            out = []
            for name, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    out.append(None if x is None else bytes(x).decode(codec(name), "replace"))
                except (LookupError, UnicodeError):  # a codec that isn't one of text
                    out.append(bytes(x).decode("latin_1"))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["id", "charset", "text"])

    name = F.lower("charset")
    own = F.when(name.isin("utf-8", "utf8"), utf8(F.col("content"))).otherwise(F.decode("content", "ISO-8859-1"))
    here = F.coalesce(name.isin(*NATIVE), F.lit(True))
    native = pages.where(here).select("id", "charset", own.alias("text"))
    return native.unionByName(pages.where(~here).select("id", "charset", "content").mapInArrow(run, "id long, charset string, text string"))
