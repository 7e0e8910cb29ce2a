"""Structured Streaming stages: the batch functions on unbounded input, state only where the meaning needs it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsloom.functions import text
from newsloom.operators import decode, trigrams
from newsloom.runtime import shared_dir, ship


def run_once(df: DataFrame, name: str, mode: str = "append", each: Callable | None = None, folder: str | None = None, seconds: float | None = None) -> DataFrame:
    """Drive a stream over what its source holds now; the result is a table in the shared folder, a batch of which
    that is written again after a failure replaces itself. With a ``folder`` of its own a stream goes on where its last
    run ended, from its checkpoint; with ``seconds`` a session ends then, and what it didn't reach is left for the next."""
    spark = df.sparkSession
    path = folder or f"{shared_dir(spark)}/newsloom-stream-{name}-{uuid.uuid4().hex}"

    def sink(batch: DataFrame, epoch: int) -> None:
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{path}/out/epoch={epoch}")

    query = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{path}/state").foreachBatch(sink).start()
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
    return spark.read.parquet(f"{path}/out").drop("epoch")


def source(spark: SparkSession, path: str, schema, files_per_trigger: int = 8) -> DataFrame:
    """A file stream with back-pressure over a folder, or over one file of a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def after_cutoff(entries: DataFrame) -> DataFrame:
    """Entries (feedid, id, at) not older than the newest of their feed before their batch; equal ones stay.
    One timestamp of state for each feed."""
    ship(entries.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cutoff = state.get[0] if state.exists else None
        newest = cutoff
        for f in frames:
            at = f["at"].to_numpy().astype("datetime64[us]").astype("int64")
            top = int(at.max())
            newest = top if newest is None else max(newest, top)
            yield f[at >= cutoff] if cutoff is not None else f
        state.update((newest,))

    return entries.groupBy("feedid").applyInPandasWithState(step, "feedid long, id long, at timestamp", "newest long", "append", GroupStateTimeout.NoTimeout)


def first_seen(urls: DataFrame, delay: str = "92 days") -> DataFrame:
    """URLs (url, id, at) not met within the delay: duplicate state is dropped by watermark."""
    return urls.withWatermark("at", delay).dropDuplicatesWithinWatermark(["url"])


def fresh_enough(events: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Events (at) not older than some days: a plain filter, since a watermark alone drops no row."""
    return events.where(F.col("at").isNull() | (F.col("at") >= now - F.make_dt_interval(days=F.lit(days))))


def unknown(urls: DataFrame, history: DataFrame, delay: str = "92 days") -> DataFrame:
    """URLs (url, at) neither met within the delay nor in the whole history (url): stream state for the recent, an anti join for the rest."""
    return first_seen(urls, delay).join(history.select("url").distinct(), "url", "left_anti")


def cleaned(pages: DataFrame) -> DataFrame:
    """Pages (id, charset, content) to (id, text, lang), one after the other in one query, so that all become visible at once:
    decoded in the charset each names, tags stripped, language by script where that decides it. A page that fails comes out with null text."""
    t = decode.decoded(pages).select("id", text.textify(F.col("text")).alias("text"))
    return t.select("id", "text", F.coalesce(trigrams.script_language(F.col("text")), F.lit("und")).alias("lang"))


def polite(requests: DataFrame, pause_ms: int = 4000) -> DataFrame:
    """Requests (siteid, id, at) with the time each may start: not before it came, and a pause after the one before of its site.
    One timestamp of state for each site, forgotten by a timer when the site has been quiet for an hour of event time."""
    ship(requests.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        free = state.get[0] if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["at", "id"])  # one site's requests of one micro-batch, which maxFilesPerTrigger bounds
        start = []
        for t in rows["at"].to_numpy().astype("datetime64[us]").astype("int64") // 1000:
            begin = int(t) if free is None else max(int(t), free)
            start.append(begin)
            free = begin + pause_ms
        state.update((free,))
        state.setTimeoutTimestamp(max(free, state.getCurrentWatermarkMs()) + 3_600_000)
        yield pd.DataFrame({"siteid": rows["siteid"], "id": rows["id"], "start_ms": start})

    marked = requests.select("siteid", "id", "at").withWatermark("at", "1 hour")
    return marked.groupBy("siteid").applyInPandasWithState(step, "siteid long, id long, start_ms long", "free long", "append", GroupStateTimeout.EventTimeTimeout)


def with_static(stream: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Each id of the stream with its full record: a stream-static join."""
    return stream.join(table, on)


def windows(events: DataFrame, length: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Records and bytes of each access tag (acl, at, bytes) in tumbling windows."""
    w = events.withWatermark("at", delay).groupBy("acl", F.window("at", length).alias("w")).agg(F.count("*").alias("records"), F.sum("bytes").alias("bytes"))
    return w.select("acl", F.col("w.start").alias("start"), "records", "bytes")


def throttled(events: DataFrame, gap_ms: int = 500) -> DataFrame:
    """Events (acl, id, at, rich) at least ``gap_ms`` after the last shown of their tag, unless they are rich."""
    ship(events.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        for f in frames:
            f = f.sort_values(["at", "id"])
            keep = []
            for t, rich in zip(f["at"].to_numpy().astype("datetime64[us]").astype("int64") // 1000, f["rich"]):
                show = bool(rich) or last is None or t - last >= gap_ms
                keep.append(show)
                last = t if show else last
            yield f[pd.Series(keep, index=f.index, dtype=bool)]
        if last is not None:
            state.update((int(last),))

    return events.groupBy("acl").applyInPandasWithState(step, "acl string, id long, at timestamp, rich boolean", "last long", "append", GroupStateTimeout.NoTimeout)
