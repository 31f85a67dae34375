"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Timestamps are stored as UTC instants; calendar fields are taken after an
    # explicit shift to local time, so the session zone must be UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot device is worth the extra shuffle it may cause downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
STATIC_CONF = {
    "spark.ui.enabled": "false",
    # Recording a Python call site for every column expression makes wide plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app_name: str = "hazeframe", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session. Cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app_name).config(map={**STATIC_CONF, **RUNTIME_CONF})
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


#: The temporary folder of a local session that names none.
_temporary: tempfile.TemporaryDirectory | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, else (local mode only) a temporary one, gone when Python ends."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        global _temporary
        _temporary = tempfile.TemporaryDirectory(prefix="hazeframe-checkpoint-", ignore_cleanup_errors=True)
        configured = _temporary.name
    context.setCheckpointDir(configured)
    return configured


#: Checkpoint files made within `released_checkpoints`.
_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so iterative jobs survive the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    frame = df.checkpoint(eager=True)
    made = _made.get()
    if made is not None:
        made.append(frame._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return frame


@contextmanager
def released_checkpoints(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the checkpoints that were made within: for work whose result is then stored. The driver is asked
    to collect what it no longer refers to, upon which Spark removes the shuffle files of that work."""
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get() or []
        _made.reset(token)
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        gc.collect()
        spark._jvm.System.gc()
