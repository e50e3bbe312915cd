"""Tiny driver-side file operations on the shared file system.

Used only for sink bookkeeping (batch state, pending partitions, success
markers) and for moving a batch's finished files into its table. Goes through the Hadoop
FileSystem API of the session, so HDFS / S3 / ABFS paths work alike.
"""

from __future__ import annotations

import glob
import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _local(fs, p) -> str | None:
    """The absolute path on the mounted file system, None on any other.

    Hadoop without its native library forks two processes for each local file
    it creates, and each call crosses the gateway; plain system calls do not.
    """
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(
            spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under a temporary name, then rename: readers see all or nothing.

    ``path`` should be new (state files carry a batch id); an existing one
    is replaced. A failed rename is an error.
    """
    fs, p = _fs(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not rename {tmp} to {path}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def list_files(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Data files ``depth`` folders below ``path``, relative to it.

    One glob call: listing with block locations would ask for each file's
    permissions as well.
    """
    fs, p = _fs(spark, path)
    local = _local(fs, p)
    if local is not None:
        return sorted(glob.glob("*/" * depth + "part-*", root_dir=local))
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(p, "*/" * depth + "part-*"))
    names = (s.getPath().toUri().getPath() for s in found or [])
    return sorted("/".join(n.split("/")[-depth - 1:]) for n in names)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def in_parallel(call, items: list, *, threads: int = 16) -> None:
    """File-system calls are latency-bound, so a few driver threads overlap
    them (each gets its own gateway connection)."""
    if len(items) <= 1:
        for item in items:
            call(item)
        return
    with ThreadPoolExecutor(max_workers=min(threads, len(items))) as pool:
        list(pool.map(call, items))


def touch_all(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Create (or overwrite) empty marker files below ``folder``."""
    fs, p = _fs(spark, folder)
    local = _local(fs, p)
    if local is None:
        path = spark._jvm.org.apache.hadoop.fs.Path
        in_parallel(lambda name: fs.create(path(f"{folder}/{name}"), True).close(), names)
        return
    for name in names:
        os.makedirs(os.path.dirname(f"{local}/{name}"), exist_ok=True)
        open(f"{local}/{name}", "wb").close()


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
