"""Small driver-side file operations through the Hadoop FileSystem API.

Used only for tiny control files (a CSV header line, version-log entries,
audit records): one file-system call instead of a Spark job each. Folders of
more than ``FEW`` entries are not walked here but listed by a Spark job. Works
for any Hadoop-compatible store (local, HDFS, S3A, ABFS, GCS).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_STATUS = re.compile(r"path=(.*?); isDirectory=(true|false)(?:; length=(\d+))?")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


#: Entries of a folder that the driver looks at one by one.
FEW = 64


def listing(spark: SparkSession, path: str) -> list[tuple[str, bool, int]] | None:
    """(path, is folder, length) of what lies in a folder, or of one file; None
    if there are more than ``FEW``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = fs.listStatus(p)
    if len(found) > FEW:
        return None
    return [(m[1], m[2] == "true", int(m[3] or 0)) for m in (_STATUS.search(x.toString()) for x in found)]


def count(spark: SparkSession, path: str) -> int:
    """Number of entries of a folder, 0 if there is none."""
    fs, p = _fs(spark, path)
    return len(fs.listStatus(p)) if fs.exists(p) else 0


def modified(spark: SparkSession, path: str) -> int:
    """Time of the last change of a file or folder, 0 if there is none."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else 0


def shown(path: str) -> bool:
    return not path.rsplit("/", 1)[-1].startswith((".", "_"))


def uri_name(spark: SparkSession, path: str) -> str:
    """Name of a file as ``_metadata.file_name`` has it: percent-encoded."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getRawPath().rsplit("/", 1)[-1]


def data_files(spark: SparkSession, path: str) -> tuple[str | None, int, int]:
    """(first file by name, greatest length, number) of the files under
    ``path`` (recursive), without hidden, marker and empty files."""
    found = listing(spark, path)
    if found is None:
        row = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0")
               .agg(F.min("path"), F.max("length"), F.count("*")).first())
        return row[0], row[1] or 0, row[2]
    parts = [data_files(spark, p) if folder else (p, n, 1) for p, folder, n in found if shown(p) and (folder or n)]
    return (min((p for p, _, _ in parts if p), default=None), max((n for _, n, _ in parts), default=0), sum(k for _, _, k in parts))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The first line of a control file, or None if there is no such file."""
    return first_line(spark, path) if exists(spark, path) else None


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a file (None when it is empty); compressed files are
    opened with the codec of their name."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def _put(spark: SparkSession, path: str, text: str):
    """Write a file whole; gives its Hadoop path."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return p


def _beside(path: str) -> str:
    """A hidden name of its own in the same folder: renames stay in one place."""
    folder, name = path.rsplit("/", 1)
    return f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"


def splittable(spark: SparkSession, path: str) -> bool:
    """Is a file plain, so that it can be read from the middle?"""
    _, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p) is None


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Publish ``path`` with ``text``, whole or not at all; False, and nothing
    changed, if it exists.

    The text goes to a hidden file first. On a local or mounted file system
    that file is then linked under the name, which fails if the name is taken;
    elsewhere it is renamed without overwriting, one atomic step of the name
    node on HDFS. On object stores, whose objects appear whole but whose
    renames are copies, the file is created under its name, if that is free."""
    fs, target = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    scheme = fs.getUri().getScheme()
    if scheme in OBJECT_STORES:
        try:
            out = fs.create(target, False)
            out.write(bytearray(text.encode("utf-8")))
            out.close()
            return True
        except Exception as e:  # a Java exception: only "it exists" is expected here
            if fs.exists(target):
                return False
            raise e
    hidden = _put(spark, _beside(path), text)
    try:
        if scheme == "file":
            nio = jvm.java.io.File
            jvm.java.nio.file.Files.createLink(nio(target.toUri().getPath()).toPath(), nio(hidden.toUri().getPath()).toPath())
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(hidden, target, none)
    except Exception as e:
        if fs.exists(target):
            return False
        raise e
    finally:
        fs.delete(hidden, False)
    return True


#: Schemes whose files appear under their name when they are closed.
OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "wasb", "wasbs", "oss", "cosn", "abfs", "abfss"}


def write_over(spark: SparkSession, path: str, text: str) -> None:
    """Write ``path`` whole, replacing it in one step: readers see the old text
    or the new one."""
    fs, target = _fs(spark, path)
    if fs.getUri().getScheme() in OBJECT_STORES:
        _put(spark, path, text)
        return
    hidden = _put(spark, _beside(path), text)
    jvm = spark.sparkContext._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, target, over)
    finally:
        fs.delete(hidden, False)


def files(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(path, False, length) of all files in a folder, listed by a Spark job if
    there are many."""
    found = listing(spark, path)
    if found is None:
        return [(r.path, False, r.length) for r in spark.read.format("binaryFile").load(path).select("path", "length").collect()]
    return [x for x in found if not x[1]]


def rename_new(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a file or folder unless the target exists: False then."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(target)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, to, none)
    except Exception as e:  # a Java exception: only "it exists" is expected here
        if fs.exists(to):
            return False
        raise e
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the shown files and folders in a folder; many are listed by a
    Spark job."""
    found = listing(spark, path)
    if found is None:
        rows = spark.read.format("binaryFile").load(path).select("path").collect()
        return sorted(r[0].rsplit("/", 1)[-1] for r in rows)
    return sorted(p.rsplit("/", 1)[-1] for p, _, _ in found if shown(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
