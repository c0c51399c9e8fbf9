"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings the jobs count on. All but the time zone are Spark defaults or close to them; none
# is tied to a data size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as month=07 are text and must stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app: str = "batchlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever made up for a local master, where driver and
    executors are one process.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="batchlake-")
    return _LOCAL_DIRS[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, never used before."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists on its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below a folder, sorted; none if there is no such folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(hadoop)) if files.exists(hadoop) else []


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file, if nobody has yet; whether it was this call that did."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        made = files.create(hadoop, False)  # fails if the file is there
    except Exception:
        if files.exists(hadoop):
            return False
        raise
    made.write(bytearray(text.encode()))
    made.close()
    return True


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of any executor: a retry reads files, it
    does not replay the plan behind them.
    """
    path = run_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable):
    """Run steps that need nothing of each other at the same time, as jobs of one session; their results in order.

    A small job, or the last tasks of a large one, leaves most of a cluster idle. A fault is raised once all
    steps have ended, so none is still writing then.
    """
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [run.result() for run in runs]
