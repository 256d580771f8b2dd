"""Session settings, the shared scratch folder, and materialised intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
CHECKPOINT_KEY = "spark.checkpoint.dir"
_scratch = threading.local()  # .root: where this thread's intermediate tables go, if they are to be removed
_local_folders: dict[str, str] = {}  # application id -> folder, for local masters only

# Settings every job needs for right results (time zone, ANSI) and for runtime re-planning.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a Python worker holds a few of these at a time, whatever the length of the texts
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    # the JVM never compiles methods above 8000 bytes; wide cleaning projections are split instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# A task sorts what it reads: 16 MB of Parquet or of a shuffle are some 100 to 300 MB of rows. Set only
# where a session has more, so that a task's rows stay as many however large the tables are.
TASK_BYTES = 16 << 20
TASK_SIZES = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key in TASK_SIZES:
        if _in_bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, str(TASK_BYTES))
    return spark


def _in_bytes(size: str) -> int:
    """'64MB', '16k', '67108864b' or a bare number of bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) << {"b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[(unit or "b")[0]]


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caselake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by the cluster in spark.checkpoint.dir.

    Only a local master may fall back to a folder of its own; on a cluster a machine-local
    folder would be invisible to the other executors, so the setting is required there.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="caselake-")
        folder = _local_folders[app]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    root = getattr(_scratch, "root", None) or f"{shared_dir(spark)}/caselake"
    return f"{root}/{uuid.uuid4().hex}/{name}"


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed at the end. What is to be read later must be
    written to a path taken outside."""
    before = getattr(_scratch, "root", None)
    _scratch.root = root = f"{shared_dir(spark)}/caselake/{uuid.uuid4().hex}"
    try:
        yield
    finally:
        _scratch.root = before
        remove_folder(spark, root)


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps column pruning and filter
    pushdown for the readers, and gives Catalyst the real size of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a table in folders may hold no file to read it from


def side_by_side(jobs: dict[str, Callable[[], T]], at_once: int = 4) -> dict[str, T]:
    """Submit independent jobs from a few threads, so that a small one need not wait for the others."""
    root = getattr(_scratch, "root", None)

    def run(job: Callable[[], T]) -> T:
        _scratch.root = root
        return job()

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = {name: pool.submit(run, job) for name, job in jobs.items()}
        return {name: future.result() for name, future in futures.items()}
