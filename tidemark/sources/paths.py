"""File-system questions answered on the driver, for any Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _handle(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; empty if there is no such folder."""
    target, system = _handle(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def is_folder(spark: SparkSession, path: str) -> bool:
    target, system = _handle(spark, path)
    return system.exists(target) and system.getFileStatus(target).isDirectory()


def rename_file(spark: SparkSession, path: str, target: str) -> None:
    source, system = _handle(spark, path)
    if not system.rename(source, _handle(spark, target)[0]):
        raise OSError(f"cannot move {path} to {target}")


def rename_to_new(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a folder that holds files; False, and nothing done, if the target is there.

    Of two callers with the same target one gets False, on file systems with an atomic
    rename: it never replaces a folder with files in it.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, aim = hadoop.Path(path), hadoop.Path(target)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = hadoop.FileContext.getFileContext(source.getFileSystem(conf).getUri(), conf)
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(source, aim, options)
    except Py4JJavaError:
        if exists(spark, target):
            return False
        raise
    return True


def move_files(spark: SparkSession, source: str, target: str) -> list[str]:
    """Move the data files below a folder to the same places below another; their new names.

    Names that begin with an underscore or a dot are left behind.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root, system = _handle(spark, source)
    found, moved = system.listFiles(root, True), []
    base = system.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    while found.hasNext():
        place = found.next().getPath()
        inner = place.toUri().getPath().removeprefix(base)
        if inner.rsplit("/", 1)[-1][0] in "_.":
            continue
        # From parts, so that escaped characters of partition folders stay as they are.
        aim = hadoop.Path(hadoop.Path(target), inner)
        system.mkdirs(aim.getParent())
        if not system.rename(place, aim):
            raise OSError(f"cannot move {place} to {aim}")
        moved.append(inner)
    return moved


def delete(spark: SparkSession, path: str) -> None:
    target, system = _handle(spark, path)
    system.delete(target, True)
