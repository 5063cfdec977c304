"""Session construction and shared-folder helpers.

Cluster jobs must cut lineage and keep scratch data in the shared folder named by
``spark.checkpoint.dir``. We read that setting from the session and only create a
local folder when it is unset *and* Spark runs in local mode (tests, bench).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings every newsmart job relies on. UTC pins date parts to the article's
# instant (the source timestamps end in "Z").
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove reliable checkpoint files once nothing references them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "newsmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Date parts come from the UTC instant, whatever the host zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_CHECKPOINT_LOCK = threading.Lock()


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only in local mode."""
    with _CHECKPOINT_LOCK:
        return _checkpoint_dir(spark)


def _checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor shares"
        )
    local = tempfile.mkdtemp(prefix="newsmart-ckpt-", dir=os.environ.get("NEWSMART_TMP", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder. What is written there may be
    read lazily as long as the application runs; it is deleted when the application ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/newsmart-scratch/{spark.sparkContext.applicationId}"
    if root not in _SCRATCH_ROOTS:
        _SCRATCH_ROOTS.add(root)
        atexit.register(delete_path, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH_ROOTS: set[str] = set()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on any store; nothing happens once the session has ended."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never ``localCheckpoint``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_INHERITED_PROPERTIES = ("spark.jobGroup.id", "spark.job.description", "spark.scheduler.pool")


def run_concurrently(tasks: dict[str, Callable[[], object]], max_workers: int = 8) -> dict[str, object]:
    """Run independent Spark actions from a few driver threads, so their small jobs
    share the executors instead of queueing one after another. The caller's job group,
    description and scheduler pool carry over to the threads' jobs."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    inherited = {k: sc.getLocalProperty(k) for k in _INHERITED_PROPERTIES} if sc else {}

    def wrap(fn: Callable[[], object]) -> Callable[[], object]:
        def run() -> object:
            for key, value in inherited.items():
                if value is not None:
                    sc.setLocalProperty(key, value)
            return fn()

        return run

    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(tasks)))) as pool:
        futures = {name: pool.submit(wrap(fn)) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
