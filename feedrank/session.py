"""Session construction and shared-folder helpers."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every feedrank job relies on. AQE re-plans joins at run time
# (broadcast conversion from measured shuffle sizes, skew splitting, partition
# coalescing); the session zone is pinned to UTC because all event times are
# epoch milliseconds and the fixtures read timestamp_ntz columns.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "feedrank", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with feedrank's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition after
    the map side combine), AQE coalesces the rest.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (time zone aware casts resolve at analysis)."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master gets a folder under
    the system temp directory (tests); a cluster job is refused, because a
    machine-local folder would not be seen by the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="feedrank-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


@functools.cache
def _package_zip() -> str:
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="feedrank-py-"), "feedrank.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors through Spark, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        spark.sparkContext.addPyFile(_package_zip())
        _shipped.add(app)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's FileSystem (works for any scheme)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def make_path(spark: SparkSession, path: str) -> None:
    """Create a folder, if it isn't there, through Hadoop's FileSystem."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if it does not exist)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(jpath)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, through Hadoop's FileSystem."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(jpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, temporary: str) -> None:
    """Write a small text file whole: to ``temporary`` first, then by a rename."""
    jvm = spark.sparkContext._jvm
    jpath, jtemp = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, temporary))
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(jtemp, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(jtemp, jpath):
        fs.delete(jtemp, False)
        raise OSError(f"{path} was written by another writer")


def modified_ms(spark: SparkSession, path: str) -> int:
    """Time of the last change of a file or folder (epoch milliseconds)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getFileStatus(jpath).getModificationTime())


__all__ = ["get_session", "ensure_utc", "checkpoint_root", "scratch_dir", "ship_package",
           "path_exists", "delete_path", "make_path", "list_names", "read_text",
           "write_text", "modified_ms", "DEFAULT_CONF"]
