"""Session defaults and the shared scratch folder.

The engine never picks its own partition counts: everything below is a
default that a cluster submit may override.  AQE stays on so that join
strategy, partition coalescing and skew splitting are decided from runtime
sizes rather than guesses.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "finseries", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
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


MAX_SHUFFLE_PARTITIONS = 100_000


def sizing_conf(input_bytes: int, total_cores: int, shuffle_bytes: int | None = None,
                target_partition_bytes: int = 256 << 20) -> dict:
    """Partition settings for a job whose largest input is ``input_bytes``.

    Scan splits aim at ``target_partition_bytes`` each.  Shuffle partitions
    are sized from the largest shuffle (default: a quarter of the input, as
    partial aggregation and column pruning shrink what is shuffled), at least
    three per core and at most ``MAX_SHUFFLE_PARTITIONS`` (the map-output
    bookkeeping grows with maps x reducers).  AQE coalesces small partitions
    and splits skewed ones at run time.  For 100 TB on 1000 executors with 8
    cores: 409,600 scan splits of 256 MiB and 100,000 shuffle partitions.
    """
    shuffle_bytes = int(input_bytes) // 4 if shuffle_bytes is None else int(shuffle_bytes)
    parts = -(-shuffle_bytes // target_partition_bytes)
    parts = min(max(3 * total_cores, parts), MAX_SHUFFLE_PARTITIONS)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates (landing files, published runs).

    Taken from ``spark.checkpoint.dir`` or the context's checkpoint folder.
    Only a local-mode session without one gets a private temporary folder;
    a cluster session without a shared folder is an error, because a
    machine-local path would not be visible to the other executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="finseries-ckpt-")
        # spark.checkpoint.dir cannot be changed at run time; the context's
        # checkpoint folder can, and later calls find it there
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder name under the scratch root (not created)."""
    return "/".join([scratch_root(spark), "finseries", *parts, uuid.uuid4().hex])


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written folder, on whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything this package wrote under the scratch root.

    For the end of a job: DataFrames that still read a staged or published
    scratch table cannot be evaluated afterwards.
    """
    remove_path(spark, f"{scratch_root(spark)}/finseries")

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``finseries`` importable in Python workers (once per application).

    Grouped-map functions refer to modules of this package; on a cluster the
    workers only see it if it is shipped, so the package's sources are zipped
    on the driver and added with ``addPyFile`` (Spark serves the file to
    every executor).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="finseries-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
