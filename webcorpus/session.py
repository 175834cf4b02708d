"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings for sessions this package builds, and (the SQL ones) for sessions
# it is handed.  A value that the caller or submitter has set wins.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what was measured: no static broadcast from file-size
    # estimates (compressed parquet understates memory size); AQE turns a
    # sort-merge join into a broadcast join once a side's shuffle output is
    # known to be under the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML rows are large (tens of KB); smaller Arrow batches keep the
    # Python worker's memory flat when pages are parsed in mapInPandas.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    # Unbounded first-seen state lives off-heap in RocksDB, not in the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Repeated keys in `k=v; k=v` text: the last one wins, as in a dict.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


SEMANTIC_CONF = ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy")


def build_session(master: str | None = None, app: str = "webcorpus",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    for k, v in {**conf, **(extra or {})}.items():
        # a running session keeps what it was given; only explicit extras change it
        if active is None or k in (extra or {}):
            b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def _given(spark: SparkSession, key: str) -> bool:
    """Whether the session or its launcher has set ``key`` (not just Spark's default)."""
    return spark.conf.get(key, None) is not None


def apply_runtime_conf(spark: SparkSession) -> None:
    """Give a session the SQL settings of :data:`DEFAULT_CONF` that it has none for.

    Two are set in any case, as results depend on them: the time zone and
    the rule for repeated map keys."""
    for k in SEMANTIC_CONF:
        spark.conf.set(k, DEFAULT_CONF[k])
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k not in SEMANTIC_CONF and not _given(spark, k):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (iterations, stream state).

    Read from the session (``spark.checkpoint.dir`` or the context's
    directory).  Only a local-mode session without one gets a private
    folder; a cluster without a configured shared folder is an error,
    since a machine-local path would not survive losing an executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
    d = tempfile.mkdtemp(prefix="webcorpus-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other trouble with the store is raised."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store's scheme."""
    fs, where = _file_system(spark, path)
    return fs.makeQualified(where).toString()


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as tasks can open it, if it lies on a mounted file system (shared, as all scratch paths are)."""
    where = qualified(spark, path)
    return where.removeprefix("file:").replace("//", "/") if where.startswith("file:") else None


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.mkdirs(where)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, where = _file_system(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file so that it appears whole or not at all; False if it exists already.

    The rename that makes it visible does not replace a file (HDFS, local
    files; a store without such a rename needs one writer at a time)."""
    fs, where = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    fs.mkdirs(where.getParent())
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, where, spark._sc._gateway.new_array(hadoop.Options.Rename, 0))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table under the shared scratch folder, and nothing elsewhere."""
    base = checkpoint_dir(spark).rstrip("/") + "/"
    if not path.startswith(base):
        raise ValueError(f"{path} is not under {base}")
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
