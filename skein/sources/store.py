"""Files in any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """A folder in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        self._fs.mkdirs(self._at(to).getParent())
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"can't move {name} to {to}")

    def replace(self, name: str, to: str) -> None:
        """Move over what may stand at ``to``, in one step where the file system has one: a reader finds the old or the new file."""
        self._fs.mkdirs(self._at(to).getParent())
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        whole = lambda n: self._at(n).makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory())
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf()).rename(whole(name), whole(to), how)

    def write(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
