"""Small files in a folder of any file system Hadoop knows, written so that a name is taken once."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder; what is in it is named by paths below it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._hadoop(self.path)
        self._files = self._root.getFileSystem(self._conf)

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _at(self, name: str):
        return self._hadoop(f"{self.path}/{name}")

    def names(self) -> list[str]:
        """Files and folders directly in it, sorted; none where it does not exist."""
        if not self._files.exists(self._root):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._root))

    def sizes(self, name: str) -> dict[str, int]:
        """Path below this folder and bytes of all files below ``name``, hidden ones left out."""
        prefix, found = self._files.makeQualified(self._root).toString().rstrip("/") + "/", {}
        if not self._files.exists(self._at(name)):
            return found
        listed = self._files.listFiles(self._at(name), True)
        while listed.hasNext():
            status = listed.next()
            path = status.getPath().toString().removeprefix(prefix)
            if not any(part.startswith(("_", ".")) for part in path.split("/")):
                found[path] = status.getLen()
        return found

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a file whole, or leave what has the name already and return False.

        Of several that publish one name one succeeds. The file is written under another name and gets its own by a step
        that fails where the name is taken: a link on local file systems, a rename without overwriting on others.
        """
        held = f".{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._at(held), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            (self._link if self._files.getScheme() == "file" else self._rename)(held, name)
        except Py4JJavaError as problem:
            if "FileAlreadyExistsException" not in problem.java_exception.getClass().getName():
                raise
            return False
        finally:
            self._files.delete(self._at(held), False)
        return True

    def _link(self, held: str, name: str) -> None:
        new, old = (self._jvm.java.nio.file.Path.of(self._at(n).toUri().getPath(), self._strings()) for n in (name, held))
        self._jvm.java.nio.file.Files.createLink(new, old)

    def _strings(self):
        return self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.String, 0)

    def _rename(self, held: str, name: str) -> None:
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kinds, 1)
        options[0] = kinds.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        context.rename(self._at(held), self._at(name), options)

    def age_hours(self, name: str) -> float:
        """Hours since a file or folder was last changed, by the clock of its file system's own times."""
        changed = self._files.getFileStatus(self._at(name)).getModificationTime()
        return (self._jvm.java.lang.System.currentTimeMillis() - changed) / 3_600_000

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)
