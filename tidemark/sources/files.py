"""Small files and folders of the lake, through the file systems that Spark uses."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    """Driver-side file operations by Hadoop's interfaces, so that they reach
    every store that Spark reads. Only for lists of tables and small files."""

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext
        self._fs = self._sc._jvm.org.apache.hadoop.fs
        self._conf = self._sc._jsc.hadoopConfiguration()

    def _path(self, path: str):
        made = self._fs.Path(path)
        return made, made.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        made, fs = self._path(path)
        return fs.exists(made)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it is not there."""
        made, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(made)) if fs.exists(made) else []

    def read(self, path: str) -> str:
        made, fs = self._path(path)
        stream = fs.open(made)
        try:
            size = fs.getFileStatus(made).getLen()
            return bytes(stream.readNBytes(int(size))).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file under another name and rename it to ``path`` unless that
        is taken: true if this call made it, with its whole content."""
        target = self._fs.Path(path)
        draft = self._fs.Path(os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}.tmp"))
        fs = draft.getFileSystem(self._conf)
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = getattr(self._fs, "Options$Rename")
        options = self._sc._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), self._conf)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        except Exception as e:  # py4j wraps every Java exception in one class
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(getattr(e, "java_exception", e)):
                return False
            raise
        return True

    def versions(self, folder: str) -> list[tuple[str, int]]:
        """(folder, time of change) of all ``v=<id>`` folders under a folder."""
        made, fs = self._path(folder)
        if not fs.exists(made):
            return []
        out = []
        for status in fs.listStatus(made):
            if not status.isDirectory():
                continue
            path = os.path.join(folder, status.getPath().getName())
            if status.getPath().getName().startswith("v="):
                out.append((path, status.getModificationTime()))
            else:
                out += self.versions(path)
        return out

    def delete(self, path: str) -> None:
        made, fs = self._path(path)
        fs.delete(made, True)
