"""Files and folders of the cluster's storage, seen from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """Existence, move and removal under one root, on whatever file system the root names."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def create(self, path: str) -> bool:
        """Create an empty file; false where it was there."""
        return self._fs.createNewFile(self._path(path))

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none where there is no folder."""
        if not self.exists(folder):
            return []
        return [entry.getPath().getName() for entry in self._fs.listStatus(self._path(folder))]

    def modified(self, path: str) -> int:
        """When a file was last written, in milliseconds of the storage's clock."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime()

    def move(self, path: str, to: str) -> None:
        target = self._path(to)
        if target.getParent() is not None:
            self._fs.mkdirs(target.getParent())
        if self._fs.exists(target) or not self._fs.rename(self._path(path), target):
            raise FileExistsError(f"{path} could not be moved to {to}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
