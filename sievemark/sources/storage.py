"""Listing and moving folders through the Hadoop file system of the session."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    size_bytes: int
    is_file: bool


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def entries(spark: SparkSession, folder: str) -> list[Entry] | None:
    """What a folder holds, or ``None`` when there is no such folder."""
    system, target = _locate(spark, folder)
    if not system.exists(target) or not system.getFileStatus(target).isDirectory():
        return None
    return [
        Entry(
            status.getPath().getName(),
            status.getPath().toString(),
            status.getLen(),
            status.isFile(),
        )
        for status in system.listStatus(target)
    ]


def file_entry(spark: SparkSession, path: str) -> Entry | None:
    system, target = _locate(spark, path)
    if not system.exists(target):
        return None
    status = system.getFileStatus(target)
    found = status.getPath()
    return Entry(found.getName(), found.toString(), status.getLen(), status.isFile())


def empty_file(spark: SparkSession, path: str) -> None:
    """A new file of no bytes; an error if there is one already."""
    system, target = _locate(spark, path)
    system.create(target, False).close()


def first_bytes(spark: SparkSession, path: str, count: int) -> bytes:
    """The first bytes of a file, fewer if it is shorter."""
    system, target = _locate(spark, path)
    stream = system.open(target)
    try:
        read = [stream.read() for _ in range(count)]
    finally:
        stream.close()
    return bytes(byte for byte in read if byte >= 0)


def data_size(spark: SparkSession, folder: str) -> int | None:
    """Bytes of an output folder, in few calls whatever the number of files; ``None`` for none.

    The marker that writers leave beside the data does not count.
    """
    system, target = _locate(spark, folder)
    if not system.exists(target):
        return None
    marker = spark._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")
    beside = system.getFileStatus(marker).getLen() if system.exists(marker) else 0
    return system.getContentSummary(target).getLength() - beside or None


def qualified(spark: SparkSession, path: str) -> str:
    system, target = _locate(spark, path)
    return system.makeQualified(target).toString()


def replace_folder(spark: SparkSession, new: str, current: str, aside: str) -> None:
    """Put ``new`` in the place of ``current``.

    The old content is set aside first, put back if the new one does not get into
    place, and removed once it has.
    """
    system, target = _locate(spark, current)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(target.getParent())
    old = path(aside)
    held = bool(system.exists(target))
    if held:
        system.mkdirs(old.getParent())
        if not system.rename(target, old):
            raise OSError(f"cannot move {current} aside")
    try:
        if not system.rename(path(new), target):
            raise OSError(f"cannot move {new} to {current}")
    except Exception as error:
        if held and not system.rename(old, target):
            raise OSError(f"cannot put {current} back; its content is in {aside}") from error
        raise
    if held:
        system.delete(old, True)


def remove_folder(spark: SparkSession, folder: str) -> None:
    system, target = _locate(spark, folder)
    system.delete(target, True)
