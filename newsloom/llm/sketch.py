"""Tables of counts and bitmaps of a bounded size, gathered from all tasks in a tree.

A task turns its share of the corpus into one array of counts, cut into chunks and compressed. Chunks of equal
number are added FAN tasks at a time, the sums FAN at a time again, and so on: however many tasks there are, no
group holds more than FAN arrays of one chunk. Bitmaps are built by Spark's own bitmap aggregate, which merges in
each task before anything is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN, LEVELS = 64, 3
SCHEMA = "task int, chunk int, blob binary"
#: Bits of the largest bitmap that is broadcast (32 MB); screens of more keys are joined instead.
MOST_BITS, LEAST_BITS = 1 << 28, 1 << 16


def task_number() -> int:
    from pyspark import TaskContext

    t = TaskContext.get()
    return t.partitionId() if t else 0


def blobs(flat: np.ndarray, chunks: int) -> pa.RecordBatch:
    """The counts of this task, as rows of SCHEMA."""
    z = zstandard.ZstdCompressor(level=1)
    task = task_number()
    cells = [z.compress(np.ascontiguousarray(c, np.uint64).tobytes()) for c in flat.reshape(chunks, -1)]
    return pa.RecordBatch.from_arrays([pa.array([task] * chunks, pa.int32()), pa.array(range(chunks), pa.int32()), pa.array(cells, pa.binary())], ["task", "chunk", "blob"])


def _add(table: pa.Table) -> pa.Table:
    total: np.ndarray | int = 0
    for x in table.column("blob").to_pylist():
        total = total + np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint64)
    task, chunk = table.column("task").to_pylist()[0], table.column("chunk").to_pylist()[0]
    blob = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
    return pa.table({"task": pa.array([task // FAN], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "blob": pa.array([blob], pa.binary())})


def summed(partials: DataFrame, chunks: int, cells: int) -> np.ndarray:
    """The sum of all tasks' rows of SCHEMA as one array of ``cells`` (a fixed size, so bounded on the driver)."""
    for level in range(LEVELS):
        # the last level takes what is left: at most tasks / FAN^(LEVELS - 1) arrays of a chunk
        by = F.floor(F.col("task") / F.lit(FAN)) if level < LEVELS - 1 else F.lit(0)
        partials = partials.groupBy("chunk", by.cast("int").alias("g")).applyInArrow(lambda t: _add(t), SCHEMA)
    out = np.zeros((chunks, cells // chunks), np.uint64)
    for r in partials.select("chunk", "blob").collect():
        out[r.chunk] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r.blob)), np.uint64)
    return out.reshape(-1)


def bits_for(keys: int, each: int = 16) -> int:
    """Bits of a screen for so many keys: ``each`` a key, a power of two, or 0 where the screen would exceed MOST_BITS."""
    bits = LEAST_BITS
    while bits < keys * each:
        bits <<= 1
    return bits if bits <= MOST_BITS else 0


def bitmap(at: DataFrame, bits: int) -> np.ndarray:
    """Packed bitmap (low bit first) of bit numbers, the one column of ``at``."""
    name, size = at.columns[0], 32_768  # bits of one bucket of Spark's bitmap aggregate
    rows = (
        at.where(F.col(name).isNotNull()).select(F.floor(F.col(name) / F.lit(size)).alias("bucket"), (F.col(name) % size).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect()
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r.bucket * size // 8 : (r.bucket + 1) * size // 8] = np.frombuffer(bytes(r.map), np.uint8)
    return out


def held(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the bits are set."""
    return (packed[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
