"""Small files and folders in any store that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self._hadoop, self._gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(root).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def list(self, folder: str) -> dict[str, float]:
        """Names in a folder, with the seconds they were last changed at; none if there is no folder."""
        path = self._path(folder)
        if not self._files.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._files.listStatus(path)}

    def exists(self, name: str) -> bool:
        return self._files.exists(self._path(name))

    def make_folder(self, folder: str) -> None:
        self._files.mkdirs(self._path(folder))

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a file with this text, all of it at once; False if it is there already."""
        folder, own = name.rsplit("/", 1)
        draft = self._path(f"{folder}/.{own}-{uuid.uuid4().hex}")
        stream = self._files.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        none = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._hadoop.FileContext.getFileContext(draft.getFileSystem(self._conf).getUri(), self._conf).rename(
                self._files.makeQualified(draft), self._files.makeQualified(self._path(name)), none
            )
        except Exception as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._files.delete(self._path(name), True)
