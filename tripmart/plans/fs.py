"""Small file-system helpers over the Hadoop FileSystem of the session.

Paths may be on any Hadoop-supported store (hdfs, s3a, abfs, file); the
driver only lists, renames and deletes -- no data flows through it.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst``; a refused move is an error."""
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise OSError(f"could not rename {src} to {dst}")


def swap_in(spark: SparkSession, src: str, dst: str) -> None:
    """Put ``src`` in the place of ``dst``.

    What ``dst`` held is set aside first and deleted last; if ``src`` can not be
    moved it is put back, so a failure leaves the old content readable.  Between
    the two moves ``dst`` is missing: stores without renames are not atomic."""
    aside = f"{dst.rstrip('/')}.old-{uuid.uuid4().hex}" if exists(spark, dst) else None
    if aside:
        rename(spark, dst, aside)
    try:
        rename(spark, src, dst)
    except Exception:
        if aside:
            rename(spark, aside, dst)
        raise
    if aside:
        delete(spark, aside)


def qualified(spark: SparkSession, path: str) -> str:
    """Scheme, authority and path without ``.`` and ``..``."""
    fs, p = _fs(spark, path)
    uri = fs.makeQualified(p).toUri()
    where = posixpath.normpath(uri.getPath())
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{where}"


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [str(st.getPath()) for st in fs.listStatus(p)]


def has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one data file or partition."""
    return any(not f.rsplit("/", 1)[-1].startswith(("_", ".")) for f in list_files(spark, path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside, then renamed."""
    fs, p = _fs(spark, path + ".part")
    out = fs.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    rename(spark, path + ".part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
