from pyspark.sql import functions as F

from newsloom.llm import mixing as Y

TARGET = [(1, "a", 0.5, 3), (1, "b", 0.3, 3), (1, "c", 0.2, 3), (1, "gone", 0.0, 3), (2, "c", 0.9, 2), (2, "a", 0.1, 2)]


def test_shares_repeats_and_order(spark):
    rows = [(i, "a", 50 + i % 7, i) for i in range(4000)] + [(10_000 + i, "b", 60, 10_000 + i) for i in range(900)] + [(20_000 + i, "c", 40, 20_000 + i) for i in range(500)]
    rows += [(30_000, "c", 40, 20_000), (30_001, None, 40, 1), (30_002, "a", 0, 77_777)]
    items = spark.createDataFrame([(*x, 1) for x in rows], "id long, source string, tokens long, key long, round int").drop("round")
    target = spark.createDataFrame(TARGET, "mix_id int, source string, weight double, max_repeat int")
    d = Y.draws(items, target).cache()
    s = {(x.mix_id, x.source): x for x in Y.shares(d, target).collect()}
    total = sum(x[2] for x in rows if x[1] and x[0] < 30_000)
    for src in "abc":
        want = {"a": 0.5, "b": 0.3, "c": 0.2}[src] * total
        supply = sum(x[2] for x in rows if x[1] == src and x[0] < 30_000)
        assert abs(s[1, src].tokens - min(want, 3 * supply)) < 100
    assert s[1, "gone"].share == 0.0 and s[2, "c"].most_repeats == 2 and not s[2, "c"].reached
    assert d.groupBy("mix_id", "id").count().where("count > 3").count() == 0
    assert d.where("id = 30000 or id = 30001 or id = 30002").count() == 0  # a copy, no source, no tokens
    flat = [(x.mix_id, x.position) for x in d.collect()]
    assert flat == sorted(flat) and all(0 <= p <= 1 for _, p in flat)
    half = d.where("mix_id = 1").groupBy((F.col("position") < 0.5).alias("early")).agg((F.sum(F.when(F.col("source") == "a", F.col("tokens"))) / F.sum("tokens")).alias("share"))
    by = {x.early: x.share for x in half.collect()}
    assert by[True] > by[False]  # the heavy source comes early
    assert Y.draws(items.limit(0), target).count() == 0


def test_weights_hold_at_every_time(spark):
    t = Y.schedules(spark.createDataFrame(TARGET, "mix_id int, source string, weight double, max_repeat int"))
    for x in t.groupBy("mix_id").agg(F.sum(F.col("weight") * F.col("slope")).alias("z"), F.max(F.abs("slope")).alias("m")).collect():
        assert abs(x.z) < 1e-12 and x.m <= Y.SLOPE + 1e-9


def test_equal_texts_are_lost_only_within_a_mix(spark):
    """Mix 1 has both sources of the copies, mix 2 only the one with the larger ids, mix 3 the other without weight."""
    rows = [(i, "a", 50, i) for i in range(20)] + [(100 + i, "b", 50, i) for i in range(20)] + [(200 + i, "b", 50, 200 + i) for i in range(5)]
    items = spark.createDataFrame([(*x, 1) for x in rows], "id long, source string, tokens long, key long, round int").drop("round")
    target = spark.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.5, 1), (2, "b", 1.0, 1), (3, "a", 0.0, 1), (3, "b", 1.0, 1)], "mix_id int, source string, weight double, max_repeat int")
    d = Y.draws(items, target).cache()
    ids = lambda m: {x.id for x in d.where(f"mix_id = {m}").collect()}
    assert ids(2) == ids(3) == {*range(100, 120), *range(200, 205)} and not ids(1) & set(range(100, 120))
    s = {(x.mix_id, x.source): x.tokens for x in Y.shares(d, target).collect()}
    assert s[2, "b"] == 1250
