"""Session construction and the shared scratch location.

Jobs never invent a machine-local folder on a cluster: the shared folder is
the one the cluster names in ``spark.checkpoint.dir``.  Only a local master
(tests, benches) gets a private scratch folder when nothing is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no per-call call-site capture while plans are built (error context only):
    # it costs several JVM round trips for every Column function call
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # keep the partial top-n before the shuffle for row_number() <= n
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def build_session(master: str | None = None, app: str = "labelfold",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every job here expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the
    context).  Only when nothing is set and the master is local, a private
    scratch folder is created, as tests need.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    local = tempfile.mkdtemp(prefix="labelfold-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_made: list[str] = []  # scratch folders handed out by this driver


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for a written intermediate."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this driver was handed and its checkpoints; call it
    when no result that reads them is needed any more.  Returns how many it deleted."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    folders = _made + ([spark.sparkContext.getCheckpointDir()] if spark.sparkContext.getCheckpointDir() else [])
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        if folder in _made:
            done += bool(fs.delete(path, True))
        elif fs.exists(path):
            for child in fs.listStatus(path):  # checkpointed frames: rdd-<n>
                if child.getPath().getName().startswith("rdd-"):
                    done += bool(fs.delete(child.getPath(), True))
    _made.clear()
    return done


@contextmanager
def temporary_scratch(spark: SparkSession, keep: list[str]):
    """Delete the scratch folders handed out inside the block when it ends, but for those in ``keep``
    (extend the list inside); earlier ones, which other results may read, stay."""
    start = len(_made)
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in [f for f in _made[start:] if f not in keep]:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
            _made.remove(folder)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of its files.  A table may be a folder of part files, which is streamed
    as it is, or one file, which a file source reads only through its folder."""
    src = table_path(sf_dir, name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(src)
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
    reader = spark.readStream.schema(spark.read.parquet(src).schema)
    if status.isDirectory():
        return reader.parquet(src)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
