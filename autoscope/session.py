"""Session construction and the few cluster-facing settings we rely on."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale, applied to sessions we build ourselves.
# AQE re-plans joins at runtime from real shuffle sizes: a side that turns
# out small becomes a broadcast, a side that does not stays sort-merge, and
# hot keys (one city / state holding a third of all rows) are split by the
# skew-join rule.  Partition coalescing keeps tiny aggregates cheap.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles a method of more than 8000 bytes of code; a
    # projection of 50 columns fused into one stage is longer and would be
    # interpreted.  Above the limit Spark generates it in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def compiled(spark: SparkSession) -> SparkSession:
    """``spark`` with the method limit of ``SCALE_CONF``, for wide projections."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SCALE_CONF[name])
    return spark


#: rows handed to Python at once: batches of whole texts lie in the Python
#: worker and, outside its heap, in the executor
TEXT_BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> SparkSession:
    """``spark`` with Arrow batches of at most ``TEXT_BATCH_ROWS`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_to = int(spark.conf.get(name, "10000"))
    if not 0 < set_to <= TEXT_BATCH_ROWS:
        spark.conf.set(name, str(TEXT_BATCH_ROWS))
    return spark


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, a query's shuffle files are removed when it ends, not when the driver
    happens to collect garbage.  A plan that runs again computes them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of our own from the file system it is on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


ADVISORY_PARTITION_BYTES = 128 * 1024 * 1024


def partition_conf(input_bytes: int, total_cores: int,
                   target_bytes: int = ADVISORY_PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a job over ``input_bytes`` of input on
    ``total_cores`` executor cores.

    Scan splits and shuffle partitions aim at ``target_bytes`` each (so a
    task's working set fits executor memory and spills stay small); the
    initial shuffle partition count is generous (at least 2 waves of tasks)
    and AQE coalesces the small ones at runtime.  100 TB at 128 MB gives
    ~800k initial partitions, which AQE reduces per stage from real sizes.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
    }


def build_session(master: str | None = None, app: str = "autoscope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied.

    ``master`` is set only when given: without it spark-submit, the session
    that is running, or Spark's own default decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if master and master.startswith("local"):  # tasks run in the driver then
        conf["spark.driver.memory"] = os.environ.get("AUTOSCOPE_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared file system all executors see).  Only when
    it is unset and everything runs in this process -- a local test session --
    do we create one of our own; on a cluster a machine's own folder would
    lose data, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[.*\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="autoscope-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str = "cut"):
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint
    folder and return the re-read table.

    Like ``checkpoint()`` it survives executor loss (the data sits in the
    shared folder, not on an executor), but it computes ``df`` only once --
    an RDD checkpoint of an unpersisted plan runs it twice -- and the
    re-read is a columnar scan with pruning and pushdown.  What the write
    shuffled is removed with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"cut/{name}-{uuid.uuid4().hex[:12]}")
    with shuffles_removed(spark):
        df.write.mode("overwrite").parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.parquet(path)


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes, at its end, the tables that ``materialize`` wrote inside.

    What is computed from them must be written or collected before: a job
    wraps itself in this, so that a long-lived application does not pile up
    copies.  Without it they stay until the checkpoint folder is cleaned.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)
