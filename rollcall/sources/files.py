"""The few file operations no Spark reader or writer offers, on whatever file system Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder of a Hadoop file system; names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> dict[str, int]:
        """Names in a folder, with the time of their last change in milliseconds."""
        if not self.has(name):
            return {}
        return {s.getPath().getName(): s.getModificationTime()
                for s in self._fs.listStatus(self._path(name))}

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, name: str, to: str) -> None:
        """One rename; callers look afterwards whose file is there."""
        self._fs.rename(self._path(name), self._path(to))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
