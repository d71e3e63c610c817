"""Small file operations on any file system Spark can reach, done on the driver."""

import time
import uuid

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def children(self, name: str, prefix: str = "") -> list[str]:
        """Names below ``name`` that start with ``prefix``, without it, in order."""
        return sorted(self.ages(name, prefix))

    def ages(self, name: str, prefix: str = "") -> dict[str, float]:
        """Like ``children``, with the hours since each last changed."""
        if not self.exists(name):
            return {}
        ages = {}
        for status in self._fs.listStatus(self._path(name)):
            child = status.getPath().getName()
            if child.startswith(prefix):
                seconds = time.time() - status.getModificationTime() / 1000
                ages[child[len(prefix) :]] = seconds / 3600
        return ages

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Make a file appear whole by one rename; False when there is one already."""
        draft = self._path(f".draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._fs.mkdirs(self._path(name).getParent())
        if not self.exists(name) and self._fs.rename(draft, self._path(name)):
            return True
        self._fs.delete(draft, False)
        return False

    def replace(self, name: str, text: str) -> None:
        """Put a file in place of another of its name, in one rename where the store can."""
        draft = self._path(f".draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target, hadoop = self._path(name), self._jvm.org.apache.hadoop
        self._fs.mkdirs(target.getParent())
        context = hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        over = self._jvm.java.lang.reflect.Array.newInstance(
            hadoop.fs.Options.Rename.OVERWRITE.getClass(), 1
        )
        over[0] = hadoop.fs.Options.Rename.OVERWRITE
        context.rename(
            self._fs.makeQualified(draft), self._fs.makeQualified(target), over
        )

    def move(self, name: str, to: str) -> None:
        """Rename a file or folder; what has the new name must not be there."""
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(name), self._path(to)):
            raise OSError(f"cannot rename {name} to {to} below {self.root}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
