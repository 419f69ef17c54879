"""Small files through Hadoop's file systems, so that any store Spark can reach will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def made_folder(spark: SparkSession, path: str) -> str:
    """The folder, made if it is not there, by its full name in the store that really holds it."""
    system, where = _system(spark, path)
    system.mkdirs(where)
    return system.resolvePath(where).toString()


def files_in(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path below the folder and size of every file in it, hidden ones left out; sorted."""
    system, where = _system(spark, folder)
    if not system.exists(where):
        return []
    root = system.makeQualified(where).toString().rstrip("/") + "/"
    found, listing = [], system.listFiles(where, True)
    while listing.hasNext():
        status = listing.next()
        path = status.getPath().toString()
        below = path[len(root) :]
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            found.append((below, status.getLen()))
    return sorted(found)


def folders_in(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Name and time of change (milliseconds) of the folders directly in a folder."""
    system, where = _system(spark, folder)
    if not system.exists(where):
        return []
    return sorted(
        (s.getPath().getName(), s.getModificationTime())
        for s in system.listStatus(where)
        if s.isDirectory()
    )


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _system(spark, path)
    stream = system.open(where)
    try:
        read = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString
        return read(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file under a name that is not taken yet; false if it is.

    The content is complete before the name exists: it is written beside and renamed.
    """
    system, where = _system(spark, path)
    beside = where.suffix(".writing")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.exists(where) and system.rename(beside, where):
        return True
    system.delete(beside, False)
    return False


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if it is not there."""
    system, where = _system(spark, path)
    system.delete(where, True)
