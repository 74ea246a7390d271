"""Where jobs keep intermediate tables and stream checkpoints."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session that is known to run in local mode may fall back to a temporary folder,
    which is removed when the program ends: on a cluster such a folder would not be visible
    to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="trackloom-")
            atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
        return _local_roots[app]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    return f"{shared_root(spark)}/trackloom/{label}-{uuid.uuid4().hex}"
