"""File system access through Hadoop, so that every path Spark can read can be managed too."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FoundPath:
    path: str
    is_directory: bool


class Storage:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def _resolve(self, path: str):
        hadoop_path = self._path_class(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def qualified(self, path: str) -> str:
        """The path with scheme and authority: equal for two spellings of one file."""
        file_system, hadoop_path = self._resolve(path)
        return file_system.makeQualified(hadoop_path).toString()

    def exists(self, path: str) -> bool:
        file_system, hadoop_path = self._resolve(path)
        return file_system.exists(hadoop_path)

    def is_directory(self, path: str) -> bool:
        file_system, hadoop_path = self._resolve(path)
        return file_system.exists(hadoop_path) and file_system.getFileStatus(hadoop_path).isDirectory()

    def glob(self, pattern: str) -> list[FoundPath]:
        """Visible files and directories that match, in path order."""
        file_system, hadoop_path = self._resolve(pattern)
        return _visible(file_system.globStatus(hadoop_path) or [])

    def children(self, path: str) -> list[FoundPath]:
        """Visible entries of a directory; none if it does not exist."""
        file_system, hadoop_path = self._resolve(path)
        return _visible(file_system.listStatus(hadoop_path)) if file_system.exists(hadoop_path) else []

    def state(self, path: str) -> tuple[tuple[str, int, int], ...] | None:
        """Names, lengths and times of what lies directly in a dataset; None if there is none."""
        file_system, hadoop_path = self._resolve(path)
        if not file_system.exists(hadoop_path):
            return None
        listed = file_system.listStatus(hadoop_path)
        return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in listed))

    def size(self, path: str) -> int:
        file_system, hadoop_path = self._resolve(path)
        return file_system.getContentSummary(hadoop_path).getLength()

    def make_directory(self, path: str) -> None:
        file_system, hadoop_path = self._resolve(path)
        file_system.mkdirs(hadoop_path)

    def rename(self, source: str, target: str) -> None:
        file_system, source_path = self._resolve(source)
        target_path = self._path_class(target)
        file_system.mkdirs(target_path.getParent())
        if not file_system.rename(source_path, target_path):
            raise OSError(f"Could not rename {source} to {target}")

    def delete(self, path: str) -> None:
        file_system, hadoop_path = self._resolve(path)
        file_system.delete(hadoop_path, True)

    def write_bytes(self, path: str, content: bytes) -> None:
        """Put a small file in place of what is there."""
        file_system, hadoop_path = self._resolve(path)
        stream = file_system.create(hadoop_path, True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()

    def read_bytes(self, path: str) -> bytes:
        """A small file, also one whose name hides it from readers of data."""
        file_system, hadoop_path = self._resolve(path)
        stream = file_system.open(hadoop_path)
        try:
            return bytes(self._spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_text(self, path: str) -> str:
        """A small text file, such as a schema configuration."""
        return self._spark.read.text(path, wholetext=True).first()[0]


def _visible(statuses) -> list[FoundPath]:
    found = [FoundPath(status.getPath().toString(), status.isDirectory()) for status in statuses]
    return sorted((f for f in found if not _hidden(f.path)), key=lambda f: f.path)


def _hidden(path: str) -> bool:
    return path.rstrip("/").rsplit("/", 1)[-1].startswith(("_", "."))


def parent_of(path: str) -> str:
    head, separator, _ = path.rstrip("/").rpartition("/")
    return head if separator else "."


def name_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]
