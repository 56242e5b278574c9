"""Folders: scratch space every executor can reach, and moves on the cluster's file system."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..errors import NoSharedFolder


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a fresh temporary folder; on a cluster that would
    not be seen by other machines, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder all executors can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    For a result used by several jobs: they read a short plan, and a lost executor costs the
    tasks it ran instead of the whole history.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """A path on whatever file system the cluster uses."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._path_class = self._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._at = self._path_class(path)
        self._fs = self._at.getFileSystem(self._conf)

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def is_file(self) -> bool:
        return self.exists() and self._fs.getFileStatus(self._at).isFile()

    def names(self) -> list[str]:
        """Entries of the folder; none if it does not exist. Other failures are raised."""
        if not self.exists():
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at))

    def modified(self) -> float:
        """When the path was changed last, in seconds."""
        return self._fs.getFileStatus(self._at).getModificationTime() / 1000

    def remove(self) -> None:
        self._fs.delete(self._at, True)

    def text(self) -> str:
        """A small file as text."""
        stream = self._fs.open(self._at)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        """A new small file."""
        self._fs.mkdirs(self._at.getParent())
        stream = self._fs.create(self._at, False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def move_if_absent(self, target: str) -> bool:
        """Move this file to ``target`` in one step; False, and the file is gone, if something is there."""
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at.toUri(), self._conf)
        plain = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(self._at, self._path_class(target), plain)
        except Py4JJavaError as failed:
            if not Folder.exists(self._other(target)):
                raise
            self.remove()
            if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
                raise
            return False
        return True

    def _other(self, path: str) -> Folder:
        other = object.__new__(Folder)
        other.__dict__ = self.__dict__ | {"path": path, "_at": self._path_class(path)}
        return other
