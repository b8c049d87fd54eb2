"""Session helpers: where intermediate tables go."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="voicelane-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder of the session.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local session
    without that setting may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/voicelane/{name}-{uuid.uuid4().hex}"


def small_batches(df: DataFrame) -> DataFrame:
    """Bound what Spark hands to Python at a time, unless the session sets a bound.

    The default of 64 MB per batch is held several times over by a task (in the JVM,
    on the way and in Python), which is much beside two tasks of an executor.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if str(conf.get(key)).rstrip("b") == str(64 << 20):
        conf.set(key, str(4 << 20))
    return df
