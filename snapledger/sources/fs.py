"""Small file-system helpers over Spark's own Hadoop client, so that any path Spark reads works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it was there already."""
    fs, target = _resolve(spark, path)
    fs.mkdirs(target.getParent())
    try:
        return fs.createNewFile(target)
    except Exception:
        if fs.exists(target):
            return False
        raise


def rename_new(spark: SparkSession, path: str, target: str) -> bool:
    """Give a file its final name; False, and nothing is changed, if that name is taken."""
    jvm = spark._jvm
    fs, source = _resolve(spark, path)
    final = jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(final), none)
        return True
    except Exception:
        if fs.exists(final):
            return False
        raise


def ages(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder with the seconds since they were last changed."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return {}
    now = spark._jvm.System.currentTimeMillis()
    return {s.getPath().getName(): (now - s.getModificationTime()) / 1000 for s in fs.listStatus(target)}


def touch(spark: SparkSession, path: str) -> None:
    """Change the time of a file to now; fails if there is none."""
    fs, target = _resolve(spark, path)
    fs.setTimes(target, spark._jvm.System.currentTimeMillis(), -1)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a folder."""
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _resolve(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def match(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, target = _resolve(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
