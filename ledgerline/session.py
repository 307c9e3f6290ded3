"""Spark session defaults and the shared scratch location.

The pipeline only relies on standard Spark settings:

* timestamps are zone-less (``TIMESTAMP_NTZ``) and the session zone is UTC, so
  the same wall-clock values come out of every executor;
* ANSI mode stays on (Spark 4 default): overflow in a decimal cast or a
  division by zero raises instead of silently producing NULL;
* adaptive execution re-plans joins at runtime: it turns a join into a
  broadcast only when the measured size of one side is under the threshold,
  coalesces small shuffle partitions and splits skewed ones.

Scratch data (round-trip tests of the readers, published layer runs) goes to
the folder the cluster names in ``spark.checkpoint.dir``. Only when that is
unset (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast only below a measured size; never on estimates alone.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured with the pipeline defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control of the
    cluster manager. ``shuffle_partitions`` should be sized to the data; on a
    cluster leave it to AQE's coalescing with a generous initial number.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Set the SQL semantics the pipeline depends on on an existing session."""
    for key in ("spark.sql.session.timeZone", "spark.sql.timestampType", "spark.sql.ansi.enabled"):
        spark.conf.set(key, DEFAULT_CONF[key])


#: How the sinks run their jobs: a job's shuffle files go when it ends (Spark keeps them until the driver
#: collects garbage), and a stage of wide rows runs operator by operator where its generated method
#: would be too large for HotSpot to compile (8000 bytes; such methods are interpreted).
SINK_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def sink_conf(spark: SparkSession) -> Iterator[None]:
    """The session with ``SINK_CONF`` while a sink writes; set back afterwards."""
    before = {key: spark.conf.get(key, None) for key in SINK_CONF}
    for key, value in SINK_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def runs_sink(fn: Callable) -> Callable:
    """A function whose first parameter is the session, run under ``sink_conf``."""
    @wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        with sink_conf(spark):
            return fn(spark, *args, **kwargs)
    return run


def shared_dir(spark: SparkSession) -> str:
    """Shared scratch root: the cluster's checkpoint dir; a local one on a local master only."""
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if configured:
            spark.sparkContext.setCheckpointDir(configured)
        elif not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
        current = spark.sparkContext.getCheckpointDir()
    # Spark appends a per-application subdirectory; scratch data lives beside it.
    return current.rsplit("/", 1)[0] if current else current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root."""
    return f"{shared_dir(spark)}/ledgerline-scratch/{name}-{uuid.uuid4().hex[:12]}"


def to_local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local-only helpers (tests) can use the path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        total += int(hpath.getFileSystem(conf).getContentSummary(hpath).getLength())
    return total


def size_shuffle_partitions(spark: SparkSession, total_input_bytes: int,
                            target_bytes: int = 256 << 20, max_partitions: int = 100_000) -> int:
    """Set the initial shuffle partition count from the input size.

    One partition per ``target_bytes`` of input (on-disk, so decoded shuffle
    blocks stay well inside executor memory), at least two per core, at most
    ``max_partitions``. AQE then coalesces small partitions at runtime and
    splits skewed ones, so the number only has to be large enough.
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(cores * 2, min(max_partitions, -(-total_input_bytes // target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
