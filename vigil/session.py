"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ...); we only invent a local one when the session has none,
which is the case in unit tests.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_SCRATCH: list[str] = []


def get_spark(app: str = "vigil", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # dynamic partition overwrite is what the replay-safe daily store needs
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # window / dedup state of long-running streams lives in RocksDB on
        # local disk (bounded JVM heap), checkpointed as change logs
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; set a local one only if unset.

    Also makes sure the SparkContext checkpoints there, so reliable
    ``DataFrame.checkpoint()`` works whenever the folder is known.
    """
    root = None
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - conf lookups differ between modes
        root = None
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            root = None
    try:
        sc_dir = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001
        sc_dir = None
    if not root:
        root = sc_dir
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        # tests / single machine only: nothing configured
        root = tempfile.mkdtemp(prefix="vigil-ckpt-")
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, removed with the program."""
    if not _SCRATCH:
        atexit.register(clear_scratch, spark)
    _SCRATCH.append(f"{checkpoint_root(spark)}/vigil/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this program (frozen tables, staged files)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        while _SCRATCH:
            path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
            path.getFileSystem(conf).delete(path, True)
    except Exception:  # noqa: BLE001 - the session has ended before
        _SCRATCH.clear()


def ship_package(spark: SparkSession) -> None:
    """Make ``vigil`` importable in Python workers (what ``--py-files`` does).

    Pandas UDFs and ``applyInPandas`` functions refer to this package, so the
    workers need it too.  The package is zipped once per SparkContext and
    added with ``addPyFile``, which distributes it to every executor.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Connect)
        return
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    # code, not data: the driver serves this zip to the executors itself
    out = os.path.join(tempfile.mkdtemp(prefix="vigil-pyfiles-"), "vigil.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
