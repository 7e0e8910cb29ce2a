"""Containers of fixed capacity filled by multiway differencing.

A text longer than a container is cut into full containers and a rest; nothing else is cut. The items
of each container size are dealt by hash into groups of some GROUP items, each packed by itself: k
windows, k the least number that could hold the items, are made near-equal by Karmarkar-Karp
differencing (the two partial partitions with the largest spreads are merged, full windows against
empty ones). Where a window exceeds the capacity the number of windows rises and differencing is run again.

Cases: texts without tokens take no space and are left out; capacity of one token and more; ties by
id; repeated rows are items of their own only if their ids differ; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.runtime import ship

GROUP = 1024


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """k near-equal windows of item numbers, by largest differencing of partial partitions."""
    n = len(sizes)
    if k <= 1:
        return [list(range(n))]
    order = np.argsort(-sizes, kind="stable")
    left = [-1] * n
    right = [-1] * n
    # a partial partition: sums and node of each window, largest first; only its occupied windows are stored
    heap = [(-int(sizes[i]), r, np.array([sizes[i]], np.int64), np.array([i], np.int64)) for r, i in enumerate(order)]
    heapq.heapify(heap)
    serial = n
    lefts: list[np.ndarray] = []
    rights: list[np.ndarray] = []
    nodes = n
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        a, b = len(sa), len(sb)
        if a + b <= k:
            s, node = np.concatenate([sa, sb]), np.concatenate([na, nb])
        else:
            # the smallest b windows of a meet the windows of b in reverse
            m = a + b - k
            s, node = np.concatenate([sa, sb[: b - m]]), np.concatenate([na, nb[: b - m]])
            at = np.arange(a - m, a)
            lefts.append(node[at].copy()), rights.append(nb[b - m :][::-1].copy())
            s[at] += sb[b - m :][::-1]
            node[at] = np.arange(nodes, nodes + m)
            nodes += m
        o = np.argsort(-s, kind="stable")
        s, node = s[o], node[o]
        spread = int(s[0] - (s[-1] if len(s) == k else 0))
        heapq.heappush(heap, (-spread, serial, s, node))
        serial += 1
    lo = np.concatenate([np.array(left), *lefts]) if lefts else np.array(left)
    hi = np.concatenate([np.array(right), *rights]) if rights else np.array(right)
    out = []
    for root in heap[0][3].tolist():
        stack, items = [root], []
        while stack:
            x = stack.pop()
            if x < n:
                items.append(x)
            else:
                stack += [int(lo[x]), int(hi[x])]
        out.append(sorted(items))
    return out


def pack(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of item numbers, none above the capacity; each item is at most the capacity. Differencing is run for the
    least number of windows that could hold the items, and again for more as long as one is too full: as many more as half
    the excess would fill, one at least. With a window for each item none is, so it ends."""
    if not len(sizes):
        return []
    k = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        windows = [w for w in difference(sizes, min(k, len(sizes))) if w]
        excess = sum(max(0, int(sizes[w].sum()) - capacity) for w in windows)
        if not excess:
            return windows
        k += max(1, excess // (2 * capacity))


def packed(items: DataFrame, capacity: DataFrame) -> DataFrame:
    """(spec_id, window, id, piece, tokens) of items (id, source, tokens) in the containers of ``capacity``
    (spec_id, capacity, source; a null source takes all). ``piece`` is 0 for a whole text, else its part from 1."""
    ship(items.sparkSession)
    specs = capacity.where("spec_id is not null and capacity > 0").collect()  # configuration: a handful of rows
    sized = items.where("tokens > 0").select("id", "source", "tokens")
    each = F.array(*(F.struct(F.lit(s.spec_id).alias("spec_id"), F.lit(int(s.capacity)).alias("capacity"), F.lit(s.source).cast("string").alias("only")) for s in specs))
    own = sized.withColumn("s", F.explode(F.filter(each, lambda s: s["only"].isNull() | (s["only"] == F.col("source"))))).select("id", "tokens", "s.spec_id", "s.capacity")
    cut = own.withColumn("full", F.floor(F.col("tokens") / F.col("capacity")).cast("int")).withColumn("rest", F.col("tokens") % F.col("capacity"))
    cut = cut.withColumn("whole", F.col("tokens") <= F.col("capacity"))
    full = cut.where("not whole").select("spec_id", "id", F.explode(F.expr("sequence(1, full)")).alias("piece"), F.col("capacity").cast("long").alias("tokens"))
    full = full.select("spec_id", F.concat_ws("-", F.lit("f"), "id", "piece").alias("window"), "id", "piece", "tokens")
    loose = cut.select("spec_id", "capacity", "id", F.when(F.col("whole"), 0).otherwise(F.col("full") + 1).alias("piece"), F.when(F.col("whole"), F.col("tokens")).otherwise(F.col("rest")).alias("tokens")).where("tokens > 0")
    groups = {r.spec_id: max(1, math.ceil(r.n / GROUP)) for r in loose.groupBy("spec_id").agg(F.count("*").alias("n")).collect()}
    if not groups:
        return full
    many = F.create_map(*(F.lit(x) for kv in groups.items() for x in kv))
    dealt = loose.withColumn("g", F.pmod(F.xxhash64("id", "piece"), F.element_at(many, F.col("spec_id"))).cast("int"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        where = np.zeros(len(pdf), np.int64)
        for j, w in enumerate(pack(pdf["tokens"].to_numpy(), int(pdf["capacity"].iloc[0]))):
            where[w] = j
        pdf["window"] = [f"g{g}-{j}" for g, j in zip(pdf["g"], where)]
        return pdf[["spec_id", "window", "id", "piece", "tokens"]]

    rest = dealt.groupBy("spec_id", "g").applyInPandas(fill, "spec_id int, window string, id long, piece int, tokens long")
    return full.unionByName(rest)


def fill_report(windows: DataFrame, capacity: DataFrame) -> DataFrame:
    """(spec_id, capacity, windows, tokens, fill, lower_bound) of each container size."""
    w = windows.groupBy("spec_id").agg(F.count_distinct("window").alias("windows"), F.sum("tokens").alias("tokens"))
    out = w.join(capacity.select("spec_id", "capacity"), "spec_id")
    return out.select("spec_id", "capacity", "windows", "tokens", F.round(F.col("tokens") / (F.col("windows") * F.col("capacity")), 6).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity")).alias("lower_bound"))
