"""Sizes of texts in tokens of a public byte-level BPE vocabulary, read where it lies."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.runtime import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published pre-tokenisation pattern of this family of vocabularies. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 50_000


@lru_cache(maxsize=4)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: A letter or digit, a blank, a letter: the pattern always cuts before that blank, so pieces cut there count as the whole.
_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W\d_])")


def count(text: str, path: str = VOCABULARY) -> int:
    """Tokens of one text; very long ones are encoded in pieces, cut only where the encoding cuts as well."""
    enc = encoding(path)
    n, at = 0, 0
    while len(text) - at > PIECE:
        m = _CUT.search(text, at + PIECE)
        if m is None:
            break
        n += len(enc.encode_ordinary(text[at : m.start()]))
        at = m.start()
    return n + len(enc.encode_ordinary(text[at:]))


def sized(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(id, source, tokens, key) of each text (id, source, text); key is a hash of the text. Null text: left out."""
    ship(docs.sparkSession)

    def run(batches):
        import xxhash

        for b in batches:
            texts = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([count(x, path) for x in texts], pa.int64()), pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in texts], pa.int64())],
                ["id", "source", "tokens", "key"],
            )

    return docs.where(F.col("text").isNotNull() & F.col("id").isNotNull()).select("id", "source", "text").mapInArrow(run, "id long, source string, tokens long, key long")
