"""Names, small texts and renames on whatever file system a path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The few operations on files that readers and writers of tables do not offer."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at(self.root).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """Names directly below ``folder``; none if it does not exist."""
        path = self._at(f"{self.root}/{folder}".rstrip("/"))
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(f"{self.root}/{name}"))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(f"{self.root}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a new file under its name at once; fails if the name is taken."""
        folder, _, last = name.rpartition("/")
        draft = self._at(f"{self.root}/{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        target = self._at(f"{self.root}/{name}")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._at(self.root).toUri(), self._conf
        ) if self._at(self.root).toUri().getScheme() else (
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._conf)
        )
        never = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, target, never)
        except Exception:
            self._fs.delete(draft, False)
            raise

    def rename(self, name: str, to: str) -> None:
        """Move a file or folder; fails if the new name is taken."""
        if self.exists(to) or not self._fs.rename(self._at(f"{self.root}/{name}"), self._at(f"{self.root}/{to}")):
            raise FileExistsError(f"{self.root}/{to}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(f"{self.root}/{name}"), True)
