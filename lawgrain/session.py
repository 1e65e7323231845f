"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed for. Deployment sizes (executors, memory,
# shuffle partitions) belong to spark-submit; AQE coalesces from a high number.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Do not record a Python stack for every column expression of a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Documents differ in size by orders of magnitude: bound Arrow batches by
    # bytes, so that one batch of long documents cannot fill a Python worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # De-duplication state grows with the distinct URIs; keep it off the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "lawgrain", master: str | None = None, **extra: str
) -> SparkSession:
    """Session with the recommended settings; `extra` overrides (dots as `__`)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf.update({key.replace("__", "."): value for key, value in extra.items()})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Folders of local sessions without a setting, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in `spark.checkpoint.dir`.

    Only a local session may go without it; there a temporary folder serves,
    since driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="lawgrain-")
    return _LOCAL_ROOTS[application]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system: the store may be one that only Spark reads."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    found, store = _path(spark, path)
    return store.exists(found)


def remove_path(spark: SparkSession, path: str) -> None:
    found, store = _path(spark, path)
    store.delete(found, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder."""
    found, store = _path(spark, path)
    return [s.getPath().getName() for s in store.listStatus(found) if s.isDirectory()] if store.exists(found) else []


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below a folder; none if it is not there."""
    found, store = _path(spark, path)
    return [s.getPath().getName() for s in store.listStatus(found) if s.isFile()] if store.exists(found) else []


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file and its folders; fails if it is there."""
    found, store = _path(spark, path)
    stream = store.create(found, False)
    if text:
        stream.write(bytearray(text.encode()))
    stream.close()


def file_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    found, store = _path(spark, path)
    stream = store.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders read inside are listed by a few tasks a core.

    Spark makes a task a folder up to 10,000 at every level; starting them takes longer
    than listing a folder of few files.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Paths staged inside each `staging_area` that is open, innermost last.
_AREAS: list[list[str]] = []


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was staged inside; for jobs that finish inside."""
    _AREAS.append([])
    try:
        yield
    finally:
        for path in _AREAS.pop():
            remove_path(spark, path)


def staged(table: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: what follows is planned on real sizes, reads only the
    columns it needs and survives the loss of the executors that made it.
    """
    path = scratch_dir(table.sparkSession, label)
    if _AREAS:
        _AREAS[-1].append(path)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
