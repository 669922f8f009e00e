"""Files through the session's Hadoop configuration (works for any shared store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of a table; nothing happens if it isn't there."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another (or of none) of the same store."""
    delete(spark, target)
    fs, p = _path(spark, target)
    fs.mkdirs(p.getParent())
    if not fs.rename(_path(spark, source)[1], p):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that others see whole or not at all."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}.tmp"
    write_text(spark, hidden, text)
    fs, p = _path(spark, path)
    if not fs.rename(_path(spark, hidden)[1], p):
        raise OSError(f"{path} could not be published")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    fs, p = _path(spark, path)
    src = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(src)).decode()
    finally:
        src.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none where there is no such folder."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
