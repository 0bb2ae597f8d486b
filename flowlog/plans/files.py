"""Small files and folders of a job's state, through the file systems Spark reads.

This goes through the session's JVM, so runs need a classic session, not Spark Connect.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as Spark's readers give the paths of files."""
    system, place = _place(spark, path)
    uri = system.makeQualified(place).toUri()
    authority = uri.getAuthority()
    return f"{uri.getScheme()}:{f'//{authority}' if authority else ''}{uri.getPath()}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    system, place = _place(spark, path)
    system.delete(place, True)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    system, place = _place(spark, path)
    system.create(place, True).close()


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def any_path(spark: SparkSession, glob: str) -> bool:
    """Whether a path glob has any match."""
    system, place = _place(spark, glob)
    return bool(system.globStatus(place))


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, none if it is not there."""
    system, place = _place(spark, folder)
    if not system.exists(place):
        return []
    return [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, none if it is not there."""
    system, place = _place(spark, folder)
    if not system.exists(place):
        return []
    return [s.getPath().getName() for s in system.listStatus(place) if s.isFile()]
