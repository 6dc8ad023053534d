"""Where intermediate data goes: the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    that names none gets a temporary folder; a cluster session without one is
    an error, because a machine-local folder is invisible to other executors.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured or current:
        if not current:
            context.setCheckpointDir(configured)
        return configured or current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="viewtide-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/viewtide-{uuid.uuid4().hex}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table under the shared folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
