"""Session helpers: a tuned local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Upper bound for anything this library ships to executors as a broadcast
# (query blocks, centroids, codebooks).  Every broadcast is checked against it.  A cluster can
# raise it with the session setting below: larger query blocks mean fewer passes over the base.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_CONF = "knnspark.broadcast.maxBytes"


def broadcast_bound(max_bytes: int | None = None) -> int:
    """The broadcast bound: an explicit non-default value, else the session setting, else 64 MB."""
    if max_bytes is not None and max_bytes != DEFAULT_MAX_BROADCAST_BYTES:
        return int(max_bytes)
    spark = SparkSession.getActiveSession()
    value = spark.conf.get(BROADCAST_CONF, None) if spark is not None else None
    return int(value) if value else DEFAULT_MAX_BROADCAST_BYTES

# Scan task count.  Each scan task ships at most N rows per query to the top-N shuffle, so that
# shuffle carries (scan tasks x queries x N) rows.  When that product would pass
# ``knnspark.scan.maxShuffleRows`` the base is coalesced (a narrow operation, no shuffle) into
# fewer, larger tasks -- never fewer than twice the cluster's parallelism.
# ``knnspark.scan.partitions`` fixes the task count explicitly.
SCAN_PARTITIONS_CONF = "knnspark.scan.partitions"
SCAN_SHUFFLE_ROWS_CONF = "knnspark.scan.maxShuffleRows"
DEFAULT_SCAN_SHUFFLE_ROWS = 500_000_000


def scan_source(df, rows_per_task: int | None = None):
    """The base side of a scan, with its task count sized for the top-N shuffle."""
    spark = df.sparkSession
    fixed = spark.conf.get(SCAN_PARTITIONS_CONF, None)
    if fixed:
        return df.coalesce(int(fixed))
    if rows_per_task:
        budget = int(spark.conf.get(SCAN_SHUFFLE_ROWS_CONF, None) or DEFAULT_SCAN_SHUFFLE_ROWS)
        floor = 2 * spark.sparkContext.defaultParallelism
        target = max(floor, budget // max(rows_per_task, 1))
        if df.rdd.getNumPartitions() > target:
            return df.coalesce(target)
    return df


def get_spark(master: str | None = None, cpus: int | None = None,
              app: str = "knnspark", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests and the bench.  On a cluster use the provided session."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.worker.reuse", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``knnspark`` importable on executors: zip the package and ``addPyFile`` it once per
    application (the same as ``--py-files``; task closures reference the package's functions)."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="knnspark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Everything a session needs before running this library's jobs."""
    ship_package(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only when it is unset
    (local tests) a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="knnspark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


#: Paths handed out inside the scopes that are open, innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written intermediate table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table whose last reader is done."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class StateTable:
    """A table that a loop writes anew in every round; the round before's goes once the new one is whole."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df):
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        self.drop()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        if self.path is not None:
            delete_scratch(self.spark, self.path)
            self.path = None


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes the intermediate tables made inside it at its end: for callers that have written or collected
    every result by then (results are lazy and read those tables when they run)."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_scratch(spark, path)
