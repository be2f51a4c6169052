"""Small control files in shared storage: a ledger's entries, manifests and hints.

Data is written by Spark's writers.  What decides which data counts is one small file, and it has to appear
whole and once: :func:`publish` writes it aside and moves it to its name, which fails if the name is taken.
A local or mounted folder does that with a hard link, a Hadoop file system with a rename that doesn't
overwrite.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _local(fs, p) -> str | None:
    """The plain path, if the file system is the local one."""
    return p.toUri().getPath() if fs.getScheme() == "file" else None


def _aside(path: str) -> str:
    """A hidden name beside ``path``: listings of Spark's readers leave it out."""
    return os.path.join(os.path.dirname(path), f"_{os.path.basename(path)}.{uuid.uuid4().hex}")


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with that content; False, and nothing done, if there is one already."""
    fs, p = _hadoop(spark, path)
    local = _local(fs, p)
    if local is not None:
        return publish_local(local, text)
    temp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_aside(path))
    out = fs.create(temp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    done = not fs.exists(p) and fs.rename(temp, p)
    if not done:
        fs.delete(temp, False)
    return bool(done)


def publish_local(path: str, text: str) -> bool:
    """:func:`publish` for a folder that this process sees; needs no session."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temp = _aside(path)
    with open(temp, "x", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(temp, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(temp)
    return True


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Put a new content in place of a file's; for hints, which may be old."""
    fs, p = _hadoop(spark, path)
    local = _local(fs, p)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        temp = _aside(local)
        with open(temp, "x", encoding="utf-8") as f:
            f.write(text)
        os.replace(temp, local)
        return
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A control file's content; None if there is none."""
    fs, p = _hadoop(spark, path)
    local = _local(fs, p)
    if local is not None:
        try:
            with open(local, encoding="utf-8") as f:
                return f.read()
        except FileNotFoundError:
            return None
    if not fs.exists(p):
        return None
    return spark.read.text(path, wholetext=True).first()[0]
