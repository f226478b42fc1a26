"""Session and shared-storage helpers.

Library code never builds its own session; callers pass one in. ``build_session``
is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app: str = "tripflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be shared storage. Only
    when it is unset (tests, a laptop) is ``default`` installed.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or _installed.get(sc.applicationId)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if default is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no default was given")
    sc.setCheckpointDir(default)
    _installed[sc.applicationId] = default
    return default.rstrip("/")


_installed: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir; it goes when the session's JVM ends."""
    home = f"{checkpoint_dir(spark)}/tripflow/{name}-{uuid.uuid4().hex[:12]}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{home}/data"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, for Python that runs in tasks. Where it is installed there
    already, that is the same code."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    home = tempfile.mkdtemp(prefix="tripflow-")
    archive = f"{home}/{os.path.basename(here)}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)  # served to the executors by Spark
    _shipped.add(sc.applicationId)
