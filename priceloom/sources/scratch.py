"""Shared scratch space: reliable checkpoints and short-lived tables.

The cluster names the folder in ``spark.checkpoint.dir``; it has to be visible
to every executor. Only a local-mode session, where driver and executors are
one process, may fall back to a folder of its own."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder and make sure Spark checkpoints into it."""
    context = spark.sparkContext
    active = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if active is None:
        folder = configured
        if not folder:
            if not re.match(r"local($|\[)", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="priceloom-")
        context.setCheckpointDir(folder)
        active = context.getCheckpointDir()
    return configured or active


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run has used."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and pins the partition layout."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, owned: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, so the
    rows outlive any executor without being recomputed. The path is added to
    ``owned`` first, so that whoever owns it can discard it on an error too."""
    path = scratch_path(df.sparkSession, name)
    if owned is not None:
        owned.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, owned: list[str]) -> None:
    """Delete scratch tables that are no longer read, and empty the list."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while owned:
        path = jvm.org.apache.hadoop.fs.Path(owned.pop())
        path.getFileSystem(conf).delete(path, True)
