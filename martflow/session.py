"""Session helpers: a local session for tests/benchmarks and the shared
scratch location for intermediate tables."""
from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with adaptive execution on and the UI off."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martflow")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MARTFLOW_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none and runs in one process (local runs,
    tests) is a private temporary folder made; on a cluster a folder of the
    driver's machine would be out of the executors' reach, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="martflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once a session, so that it need be on the
    driver's path only: zipped into the shared folder and added to the session's
    Python files."""
    sc = spark.sparkContext
    if getattr(sc, "_martflow_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("martflow", os.path.relpath(full, here)))
    target = f"{scratch_path(spark, 'package')}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(data.getvalue()))
    finally:
        stream.close()
    sc.addPyFile(target)
    sc._martflow_shipped = True
