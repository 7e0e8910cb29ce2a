"""Streams give what the batch form gives."""

import datetime as dt

from newsloom.streaming import stages as S

T0 = dt.datetime(2024, 1, 1)


def put(spark, path, rows, schema, part):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}")


def test_cutoff_across_batches(spark, tmp_path):
    schema = "feedid long, id long, at timestamp"
    path = str(tmp_path / "in")
    put(spark, path, [(1, 1, T0), (1, 2, T0 + dt.timedelta(hours=2)), (2, 3, T0)], schema, 0)
    src = S.source(spark, path, spark.read.parquet(path).schema)
    assert sorted(r.id for r in S.run_once(S.after_cutoff(src), "c1").collect()) == [1, 2, 3]


def test_dedup(spark, tmp_path):
    path = str(tmp_path / "in")
    put(spark, path, [("a", 1, T0), ("a", 2, T0), ("b", 3, T0)], "url string, id long, at timestamp", 0)
    src = S.source(spark, path, spark.read.parquet(path).schema)
    assert sorted(r.url for r in S.run_once(S.first_seen(src), "d1").collect()) == ["a", "b"]


def test_throttle(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [("p", i, T0 + dt.timedelta(milliseconds=200 * i), i == 4) for i in range(6)]
    put(spark, path, rows, "acl string, id long, at timestamp, rich boolean", 0)
    src = S.source(spark, path, spark.read.parquet(path).schema)
    assert sorted(r.id for r in S.run_once(S.throttled(src, 500), "t1").collect()) == [0, 3, 4]


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    """A second run with the same folder reads only what came since; a session that ends at once leaves its input for the next."""
    path, folder = str(tmp_path / "in"), str(tmp_path / "own")
    schema = "url string, id long, at timestamp"
    put(spark, path, [("a", 1, T0)], schema, 0)
    src = lambda: S.source(spark, path, spark.read.parquet(path).schema)
    seen = []
    each = lambda b: (seen.append(b.count()), b)[1]
    S.run_once(src(), "r", each=each, folder=folder)
    put(spark, path, [("b", 2, T0), ("c", 3, T0)], schema, 1)
    got = S.run_once(src(), "r", each=each, folder=folder)
    assert sorted(r.url for r in got.collect()) == ["a", "b", "c"] and seen == [1, 2]
    assert S.run_once(src(), "r", folder=folder, seconds=60).count() == 3


def test_late_rows_leave_windows_and_duplicates_expire(spark, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "own")
    schema = "acl string, id long, at timestamp, bytes long"
    hours = lambda h: T0 + dt.timedelta(hours=h)
    for part, rows in enumerate([[("p", 1, hours(0), 1), ("p", 2, hours(5), 1)], [("p", 3, hours(0), 1), ("p", 4, hours(9), 1)], [("p", 5, hours(20), 1)]]):
        put(spark, path, rows, schema, part)
        src = S.source(spark, path, spark.read.parquet(path).schema)
        got = S.run_once(S.windows(src, "1 hour", "2 hours"), "w", folder=folder)
    assert {(r.start.hour, r.records) for r in got.collect()} >= {(0, 1), (5, 1), (9, 1)}  # id 3 came when its hour was closed


def test_polite_and_fresh(spark, tmp_path):
    path = str(tmp_path / "in")
    ms = lambda n: T0 + dt.timedelta(milliseconds=n)
    put(spark, path, [(1, 10, ms(0)), (1, 11, ms(100)), (1, 12, ms(20_000)), (2, 13, ms(0)), (1, 14, ms(9_000))], "siteid long, id long, at timestamp", 0)
    src = S.source(spark, path, spark.read.parquet(path).schema)
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert {r.id: r.start_ms - base for r in S.run_once(S.polite(src), "p1").collect()} == {10: 0, 11: 4000, 14: 9000, 12: 20_000, 13: 0}
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=3)), (3, None)], "id long, at timestamp")
    assert sorted(r.id for r in S.fresh_enough(df, F.lit(T0 + dt.timedelta(days=8))).collect()) == [2, 3]


def test_cleaning_stage(spark, tmp_path):
    path = str(tmp_path / "in")
    put(spark, path, [(1, "windows-1251", "<p>Привет, это небольшой текст</p>".encode("cp1251")), (2, "utf-8", b"<p>plain</p>"), (3, "utf-8", None), (4, "utf-8", "<p>Ελληνικά</p>".encode())], "id long, charset string, content binary", 0)
    src = S.source(spark, path, spark.read.parquet(path).schema)
    got = {r.id: (r.text, r.lang) for r in S.run_once(S.cleaned(src), "cl").collect()}
    assert got == {1: ("Привет, это небольшой текст", "und"), 2: ("plain", "und"), 3: (None, "und"), 4: ("Ελληνικά", "ell")}
