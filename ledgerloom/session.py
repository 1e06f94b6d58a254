"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import time
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()
_STEPS = threading.local()


def build_session(app: str = "ledgerloom", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no Python stack capture for every Column call: it makes building a plan several times slower
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is made only for a local master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a small result once to the shared folder and go on from the written table.

    Used where several results hang on it, so the facts below are read once; and where it is the small
    side of a join, since Spark takes an aggregate to be as large as its input until it has run, and
    would shuffle the facts. The size of the written table is known: Spark broadcasts it if it is below
    the broadcast threshold and else joins by shuffle. The table also outlives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if getattr(_STEPS, "paths", None) is not None:
        _STEPS.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_last(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``make``, written once like ``settle``. The tables that ``make`` settled on the way, in this thread, are deleted: nothing
    else may hang on them. They stay if it fails."""
    outer, _STEPS.paths = getattr(_STEPS, "paths", None), []
    try:
        result = settle(make(), name)
        *steps, last = _STEPS.paths
    finally:
        _STEPS.paths = outer
    if outer is not None:
        outer.append(last)
    jvm, conf = result.sparkSession._jvm, result.sparkSession._jsc.hadoopConfiguration()
    for step in steps:
        path = jvm.org.apache.hadoop.fs.Path(step)
        path.getFileSystem(conf).delete(path, True)
    return result


def settle_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Settle independent small results side by side: their jobs share the executors, and each plan stays
    small, where one plan over all of them would be re-optimised after every stage."""
    if not frames:
        return {}
    # threads that take over the caller's job group and tags
    one = inheritable_thread_target(next(iter(frames.values())).sparkSession)(lambda item: settle(item[1], item[0]))
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return dict(zip(frames, pool.map(one, frames.items())))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for functions that run in Python workers there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def release(spark: SparkSession) -> None:
    """Let go of finished steps: Spark deletes the shuffle files of plans that nothing refers to when the driver collects its
    garbage, which it may do too late for jobs of many large steps. It takes two rounds: the first one finds the
    plans, the second one what they held."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)
