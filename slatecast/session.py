"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_MAX_GROUP_ROWS = 1_000_000

_local_roots: dict[str, str] = {}
_ending: set[str] = set()


def get_session(app: str = "slatecast", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session with the settings the jobs assume.

    On a cluster the submit configuration decides executors, memory and the
    initial shuffle partition count; AQE then coalesces or splits at run time.
    """
    local = SparkSession.builder.appName(app)
    if "spark.master" not in conf and not os.environ.get("SPARK_MASTER"):
        local = local.master(f"local[{cores}]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot join key even where that costs one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # streaming state beyond executor memory
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        local = local.config(key, value)
    return local.getOrCreate()


def max_group_rows(spark: SparkSession) -> int:
    """Rows of one window group a single task may be asked to sort."""
    return int(spark.conf.get("slatecast.maxGroupRows", str(DEFAULT_MAX_GROUP_ROWS)))


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, reachable from every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _local_roots:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        path = tempfile.mkdtemp(prefix="slatecast-")
        _local_roots[app] = path
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of this application in the shared folder."""
    sc = spark.sparkContext
    folder = f"{scratch_root(spark)}/slatecast-{sc.applicationId}"
    if folder not in _ending:
        # the file system removes the application's folder when its JVM ends
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _ending.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of replaying the
    job), gives later reads column pruning and filters, and gives the planner
    a true size for its broadcast check.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``store``, in hash buckets of ``key``: groups and joins on keys that
    hold it find their rows together and move nothing."""
    spark = df.sparkSession
    table = f"slatecast_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("error").bucketBy(buckets, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)
