"""The archive's file system, through Hadoop's API: any store Spark reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..functions.naming import ArchiveFile, parse


@dataclass(frozen=True)
class Entry:
    path: str
    size: int
    modified_ms: int


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def _entries(self, found) -> list[Entry]:
        local = "://" not in self.root and not self.root.startswith("file:")
        out = [Entry(s.getPath().toUri().getPath() if local else s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found or [] if s.isFile()]
        return sorted(out, key=lambda e: e.path)

    def list(self) -> list[Entry]:
        """Files exactly two levels down."""
        return self._entries(self._fs.globStatus(self._path(f"{self.root}/*/*")))

    def days(self) -> list[str]:
        """Days that have a folder: one listing, of folders alone."""
        names = [s.getPath().getName() for s in self._fs.globStatus(self._path(f"{self.root}/dt=*")) or [] if s.isDirectory()]
        return sorted(n.removeprefix("dt=") for n in names)

    def files(self, days: list[str] | None = None) -> list[ArchiveFile]:
        """The archive's files, or those of some days: then only their folders are listed."""
        if days is None:
            found = self.list()
        else:
            found = [e for d in days for e in self._entries(self._fs.globStatus(self._path(f"{self.root}/dt={d}/*")))]
        return [f for e in found if (f := parse(e.path, self.root))]

    def parts(self, folder: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{folder}/part-*"))
        return sorted(s.getPath().toString() for s in found or [])

    def size(self, path: str) -> int:
        return self._fs.getFileStatus(self._path(path)).getLen()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, old: str, new: str) -> None:
        """Move a file over whatever is there: reruns write the same names again."""
        target = self._path(new)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target):
            self._fs.delete(target, False)
        if not self._fs.rename(self._path(old), target):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)
