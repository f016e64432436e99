"""Small files of a shared store, through the same file systems that Spark reads: listing, reading, publishing, removing."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """The store below one folder. Paths are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(entry.getPath().getName() for entry in self._fs.listStatus(path))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Makes a file appear whole under a name; False if the name is taken already."""
        draft, target = self._path(f"{name}.{uuid.uuid4().hex}.draft"), self._path(name)
        stream = self._fs.create(draft, False)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        options = getattr(self._hadoop, "Options$Rename")
        no_overwrite = self._gateway.new_array(options, 1)
        no_overwrite[0] = options.NONE
        context = self._hadoop.FileContext.getFileContext(self._path("").toUri(), self._conf)
        try:
            context.rename(draft, target, no_overwrite)
            return True
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
