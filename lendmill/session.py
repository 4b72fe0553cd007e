"""Session building and the few session-level facts the operators depend on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SHARED: dict[str, str] = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def build_session(app_name: str = "lendmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC times switched on.

    Cluster sizing (executors, memory, shuffle partitions) is left to spark-submit; pass
    `conf` for anything else.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # call-site capture costs several JVM round trips per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    defaults.update(conf)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can read: `spark.checkpoint.dir`.

    Only a local session may do without it; it then gets one temporary folder per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="lendmill-")
        atexit.register(shutil.rmtree, _LOCAL_SHARED[app], True)
    return _LOCAL_SHARED[app]


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where a derived table is read several times: the files survive lost executors and
    cut the lineage. `compression` is the session's where it is not given.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path, compression=compression)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_at = path
    return back


def release(df: DataFrame | None) -> None:
    """Delete what `materialize` wrote for `df`, once nothing reads it any more."""
    path = getattr(df, "_written_at", None)
    if path:
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed (same path on each node)."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, known) if p)
