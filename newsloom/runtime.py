"""Session, package shipping, table access and shared scratch tables."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
_SCRATCH: dict[str, list[str]] = {}


def session(name: str = "newsloom") -> SparkSession:
    """A session with the settings the engine relies on; an existing one is reused."""
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable on every executor (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for base, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="newsloom-"), "newsloom.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where that is unset, one of our own in local mode, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="newsloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(shutil.rmtree, base[7:], True)
    return base.rstrip("/")


def fresh(owner: str) -> None:
    """Forget scratch tables that an earlier run of the same owner wrote; its results can't be read any more."""
    spark = SparkSession.getActiveSession()
    for p in _SCRATCH.pop(owner, []):
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def owned(path: str, owner: str) -> str:
    """The path, as one that ``fresh`` of its owner deletes."""
    _SCRATCH.setdefault(owner, []).append(path)
    return path


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in the shared folder, replaced as a whole."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    new = spark._jvm.org.apache.hadoop.fs.Path(path + ".new")
    with_stream = fs.create(new, True)
    with_stream.write(bytearray(text.encode()))
    with_stream.close()
    fs.delete(p, False)
    fs.rename(new, p)


def get_text(spark: SparkSession, path: str) -> str:
    """A small file written by ``put_text``."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def written(df: DataFrame, owner: str, partition: str | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts lineage and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/newsloom-{owner}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(owner, []).append(path)
    w = df.write
    if partition:
        w = w.partitionBy(partition)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_all(owner: str, *dfs: DataFrame) -> list[DataFrame]:
    """``written`` of several tables at once: independent small jobs share the cluster."""
    with ThreadPoolExecutor(len(dfs)) as pool:
        return list(pool.map(inheritable_thread_target(dfs[0].sparkSession)(lambda x: written(x, owner)), dfs))


def once(df: DataFrame, key: str) -> DataFrame:
    """One row for each key, for tables in which few keys repeat: only rows of repeated keys are shuffled
    (the list of those keys is joined; the planner broadcasts it while it is small). Of differing rows the least stays."""
    rest = [c for c in df.columns if c != key]
    more = df.groupBy(key).count().where("count > 1").select(key)
    least = F.min(F.struct(*rest)).alias("row")
    return df.join(more, key, "left_anti").select(key, *rest).unionByName(df.join(more, key, "left_semi").groupBy(key).agg(least).select(key, *(F.col(f"row.{c}").alias(c) for c in rest)))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
