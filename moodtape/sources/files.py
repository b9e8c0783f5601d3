"""The few file operations that commits need, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _on(self, path: str):
        where = self._path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._on(path)
        return fs.exists(where)

    def names(self, path: str) -> list[str]:
        """What lies in a folder; nothing if there is none."""
        fs, where = self._on(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def delete(self, path: str) -> None:
        fs, where = self._on(path)
        fs.delete(where, True)

    def move(self, source: str, target: str) -> None:
        fs, where = self._on(source)
        fs.mkdirs(self._path(target).getParent())
        if not fs.rename(where, self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def mark(self, path: str, text: str = "") -> None:
        """A small file that is there as a whole or not at all."""
        fs, where = self._on(path)
        fs.mkdirs(where.getParent())
        draft = self._path(f"{path}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(where, False)
        if not fs.rename(draft, where):
            raise OSError(f"cannot write {path}")

    def text(self, path: str) -> str:
        fs, where = self._on(path)
        stream = fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
