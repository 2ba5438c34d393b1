"""Session construction and shared-folder helpers.

Nothing here hand-schedules work: it only sets the knobs Catalyst/AQE read.
"""
from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "regiolake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE, UTC time and the UI off.

    ``shuffle_partitions`` should be sized to the data (about 128-256 MB per
    post-shuffle partition on a cluster); AQE coalesces small ones at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # python dict semantics for duplicate map keys (last one wins)
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be there and name a shared file system: without it this raises, as
    executors would each write to a disk of their own.  Only a local master, where driver and
    executors are one process, gets a folder of its own, for the life of the process.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = _LOCAL.get(sc.applicationId) or _LOCAL.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="regiolake-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_LOCAL: dict[str, str] = {}


def _owned(spark: SparkSession) -> str:
    """This application's part of the shared folder; removed when the application's driver ends."""
    sc = spark.sparkContext
    top = f"{checkpoint_dir(spark).rstrip('/')}/regiolake-{sc.applicationId}"
    if top not in _OWNED:
        _OWNED.add(top)
        atexit.register(_remove, sc, top)
    return top


_OWNED: set[str] = set()


def _remove(sc, path: str) -> None:
    try:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may have ended before its process
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in this application's part of the shared folder."""
    return f"{_owned(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once as Parquet below the shared checkpoint folder and return a frame that
    reads it back.

    Used for a pre-aggregate that several branches of one plan consume: Catalyst
    pushes each branch's filters and column pruning below a shared subtree, which
    defeats exchange reuse and re-runs the scan and join per branch.  A written
    table is computed once, survives executor loss (it lives on the shared file
    system, not in executor memory), cuts the lineage, and is still read with
    column pruning and predicate pushdown."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no inference job over the written footers
    return spark.read.schema(df.schema).parquet(path)
