"""Small file-system helpers on the Hadoop FileSystem API, so small files
and folder checks work on any URI the cluster uses (hdfs, s3a, file)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines, line = [], reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a name of its own, then rename it to ``path``;
    if another writer was first, theirs stays."""
    fs, p = _fs(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        out.append(str(it.next().getPath()))
    return sorted(out)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Immediate sub-folder names of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory())


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def first_file(spark: SparkSession, path: str, suffix: str) -> str | None:
    """Some file under ``path`` with that ending, without a full listing."""
    fs, p = _fs(spark, path)
    it = fs.listFiles(p, True)
    while it.hasNext():
        f = str(it.next().getPath())
        if f.endswith(suffix):
            return f
    return None


def replace_file(spark: SparkSession, path: str, folder: str, suffix: str) -> None:
    """Put the one file of ``folder`` with that ending at ``path``."""
    fs, p = _fs(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(first_file(spark, folder, suffix))
    fs.delete(p, False)
    if not fs.rename(new, p):
        raise OSError(f"{path} not replaced")
