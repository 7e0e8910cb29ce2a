"""Sources mixed to target weights along a training run.

Each source has a weight schedule over the run's time t in [0, 1]: w(t) = weight * (1 + a * (2t - 1)),
a curriculum whose weights add up to one at every t and whose mean is the target. Its integral is the
source's cumulative token demand W(t) = weight * (t + a * (t^2 - t)); a draw whose tokens end at share
c of its source's draws takes the position t with W(t) = c * weight, solved exactly. Draws are then
range-sorted by position.

A source draws its texts in a hashed order, again in further rounds up to ``max_repeat``, until its
demand (weight times the run's tokens) is met; one that is too small ends below its share, and the
shares reached are reported. Running sums are made of bucket sums and sums within buckets, so a
source with a third of all rows is never one task.

Cases: equal texts of a mix's sources count as one text of that mix (the least id stays, of a source with
weight if there is one), so none is drawn more than ``max_repeat`` times; null texts and null sources are never drawn; a source without texts gets share 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 20_000
SLOPE = 0.5


def schedules(targets: DataFrame) -> DataFrame:
    """targets with slope a: heavier sources early, lighter ones late; sum of weight * a is 0 in each mix."""
    by = Window.partitionBy("mix_id")
    rank = F.percent_rank().over(by.orderBy(F.desc("weight"), "source"))
    t = targets.withColumn("q", rank)
    t = t.withColumn("q", F.col("q") - F.sum(F.col("q") * F.col("weight")).over(by) / F.sum("weight").over(by))
    top = F.max(F.abs("q")).over(by)
    return t.withColumn("slope", F.when(top > 0, SLOPE * F.col("q") / top).otherwise(F.lit(0.0))).drop("q")


def plan(items: DataFrame, targets: DataFrame, run_tokens: DataFrame | None = None) -> DataFrame:
    """One row for each mix and source of ``items`` (mix_id, source, tokens): supply, demand, rounds, buckets. The run's tokens default to the
    tokens of the mix's distinct texts."""
    supply = items.groupBy("mix_id", "source").agg(F.sum("tokens").alias("supply"), F.count("*").alias("texts"))
    p = schedules(targets).join(supply, ["mix_id", "source"], "left").fillna(0, ["supply", "texts"])
    total = p.groupBy("mix_id").agg(F.sum("supply").alias("run")) if run_tokens is None else run_tokens
    p = p.join(total, "mix_id")
    p = p.withColumn("demand", F.col("weight") * F.col("run"))
    rounds = F.least(F.col("max_repeat"), F.ceil(F.col("demand") / F.greatest("supply", F.lit(1)))).cast("int")
    return p.withColumn("rounds", F.when(F.col("supply") > 0, F.greatest(rounds, F.lit(1))).otherwise(0)).withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("texts") / BUCKET)).cast("int"))


def draws(items: DataFrame, targets: DataFrame, run_tokens: DataFrame | None = None) -> DataFrame:
    """(mix_id, position, id, source, round, tokens) in training order; ``items`` has id, source, tokens, key."""
    own = F.broadcast(targets.select("mix_id", "source", (F.col("weight") <= 0).alias("idle")))
    one = items.where("source is not null and tokens > 0").join(own, "source").groupBy("mix_id", "key").agg(F.min(F.struct("idle", "id", "source", "tokens")).alias("r")).select("mix_id", "key", "r.id", "r.source", "r.tokens")
    p = plan(one, targets, run_tokens).where("rounds > 0").select("mix_id", "source", "slope", "demand", "supply", "rounds", "buckets")
    # which bucket of which round a text falls in: its place in the source's order is (round, hash)
    every = one.join(F.broadcast(p), ["mix_id", "source"]).withColumn("round", F.explode(F.expr("sequence(1, rounds)")))
    place = F.shiftrightunsigned(F.xxhash64("key", "round", "mix_id"), 11).cast("double") / F.lit(float(1 << 53))
    every = every.withColumn("place", place).withColumn("bucket", F.least(F.floor(F.col("place") * F.col("buckets")).cast("int"), F.col("buckets") - 1))
    keys = ["mix_id", "source", "round", "bucket"]
    sums = every.groupBy(*keys).agg(F.sum("tokens").alias("s"))
    before = Window.partitionBy("mix_id", "source").orderBy("round", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("s").over(before), F.lit(0))).drop("s")
    inside = Window.partitionBy(*keys).orderBy("place", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = every.join(sums, keys).withColumn("upto", F.col("base") + F.sum("tokens").over(inside))
    drawn = F.least(F.col("demand"), F.col("supply") * F.col("rounds"))
    took = run.where(F.col("upto") - F.col("tokens") / 2 < F.col("demand"))
    c = F.least(F.lit(1.0), (F.col("upto") - F.col("tokens") / 2) / drawn)
    a = F.col("slope")
    # a t^2 + (1 - a) t - c = 0
    root = F.when(F.abs(a) < 1e-9, c).otherwise((F.sqrt((1 - a) * (1 - a) + 4 * a * c) - (1 - a)) / (2 * a))
    return took.withColumn("position", root).select("mix_id", "position", "id", "source", "round", "tokens").repartitionByRange("mix_id", "position", "id", "round").sortWithinPartitions("mix_id", "position", "id", "round")


def shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, weight, share, tokens, draws, most_repeats, reached) of every target."""
    d = drawn.groupBy("mix_id", "source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("draws"), F.max("round").alias("most_repeats"))
    t = targets.join(d, ["mix_id", "source"], "left").fillna(0, ["tokens", "draws", "most_repeats"])
    total = F.sum("tokens").over(Window.partitionBy("mix_id"))
    t = t.withColumn("share", F.when(total > 0, F.round(F.col("tokens") / total, 6)).otherwise(F.lit(0.0)))
    return t.select("mix_id", "source", "weight", "max_repeat", "share", "tokens", "draws", "most_repeats", (F.abs(F.col("share") - F.col("weight")) <= 0.01).alias("reached"))
