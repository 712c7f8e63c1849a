"""Folders that are written aside and then put in place, and listings of one folder level.

This is for folders that readers name themselves, such as reports; a process that dies between the two moves leaves the old folder aside.
Tables have a commit point instead (``commits``). Names that begin with an underscore are not read by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder, without what lies below them; empty when it is absent."""
    files, target = filesystem(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, as the file system lists them."""
    files, target = filesystem(spark, path)
    return files.getContentSummary(target).getLength()


def staging_folder(path: str) -> str:
    """An unused hidden folder beside ``path``, on the same file system."""
    return f"{path.rstrip('/').rpartition('/')[0]}/_staging-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    files, target = filesystem(spark, path)
    files.delete(target, True)


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """``staged`` becomes ``path``; what was there is set aside first, and comes back if the move fails."""
    files, source = filesystem(spark, staged)
    target = filesystem(spark, path)[1]
    files.mkdirs(target.getParent())
    aside = filesystem(spark, staging_folder(path))[1] if files.exists(target) else None
    if aside is not None and not files.rename(target, aside):
        raise OSError(f"{path} cannot be set aside")
    try:
        if not files.rename(source, target):
            raise OSError(f"{staged} cannot be put in place of {path}")
    except Exception:
        if aside is not None:
            files.rename(aside, target)
        raise
    if aside is not None:
        files.delete(aside, True)
