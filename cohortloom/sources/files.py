"""The few file operations that publishing a folder or a manifest needs."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer has committed since the manifest was read."""


class Files:
    """Operations below a folder, on any file system that Spark can open."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        self.system = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self.path(folder)):
            return []
        return [x.getPath().getName() for x in self.system.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a whole new file: first beside it, then renamed if the name is free."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.system.create(self.path(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.system.exists(self.path(name)) or not self.system.rename(
                self.path(draft), self.path(name)):
            self.system.delete(self.path(draft), False)
            raise CommitConflict(name)

    def delete(self, folder: str) -> None:
        self.system.delete(self.path(folder), True)

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def move(self, source: str, target: str) -> None:
        """Rename a folder to a free name, making the folders above it."""
        self.system.mkdirs(self.path(target).getParent())
        if not self.system.rename(self.path(source), self.path(target)):
            raise OSError(f"could not move {source} to {target} below {self.root}")

    def replace(self, source: str, target: str) -> None:
        """Put a folder in the place of another, which goes once the new one is there."""
        old = f"{source}.old"
        held = self.exists(target)
        if held:
            self.move(target, old)
        self.move(source, target)
        if held:
            self.delete(old)
