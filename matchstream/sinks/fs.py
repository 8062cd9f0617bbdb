"""Small file-system helpers on the cluster's Hadoop FileSystem.

Paths may be local, HDFS or object-store URIs; the JVM's FileSystem for the
path is used so that commit markers land in the same shared storage as the
data (never on a machine-local disk of the driver).  Without JVM access
(Spark Connect clients) only local ``file:`` paths are supported.
"""

from __future__ import annotations

import os
import shutil
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _jvm_fs(spark: SparkSession, path: str):
    try:
        sc = spark.sparkContext
        jvm = sc._jvm
    except Exception:  # Spark Connect
        return None
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def _local(path: str) -> str:
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    if "://" in path:
        raise RuntimeError(f"no JVM file system access for {path}")
    return path


def exists(spark: SparkSession, path: str) -> bool:
    h = _jvm_fs(spark, path)
    if h is None:
        return os.path.exists(_local(path))
    fs, p = h
    return bool(fs.exists(p))


def make_directory(spark: SparkSession, path: str) -> None:
    h = _jvm_fs(spark, path)
    if h is None:
        os.makedirs(_local(path), exist_ok=True)
    else:
        fs, p = h
        fs.mkdirs(p)


def list_names(spark: SparkSession, directory: str) -> list[str]:
    h = _jvm_fs(spark, directory)
    if h is None:
        d = _local(directory)
        return sorted(os.listdir(d)) if os.path.isdir(d) else []
    fs, p = h
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` in one step; False if it already exists.

    The text goes to a temporary file next to it, which is then renamed without
    overwriting: a crash leaves either no file or the whole one.
    """
    directory, name = path.rsplit("/", 1)
    temporary = f"{directory}/.{name}.{uuid.uuid4().hex}.tmp"
    h = _jvm_fs(spark, path)
    if h is None:
        local = _local(path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(_local(temporary), "x", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(_local(temporary), local)  # fails if the name is taken
        except FileExistsError:
            return False
        finally:
            os.unlink(_local(temporary))
        return True
    fs, p = h
    if fs.exists(p):
        return False
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft = jvm.org.apache.hadoop.fs.Path(temporary)
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        context.rename(draft, p, rename)
    except Py4JJavaError:
        fs.delete(draft, False)
        if fs.exists(p):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    h = _jvm_fs(spark, path)
    if h is None:
        with open(_local(path), encoding="utf-8") as f:
            return f.read()
    fs, p = h
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def delete_tree(spark: SparkSession, path: str) -> None:
    h = _jvm_fs(spark, path)
    if h is None:
        shutil.rmtree(_local(path), ignore_errors=True)
        return
    fs, p = h
    fs.delete(p, True)
