"""Folders of a Hadoop file system, and tables in versions of which one is current."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Store:
    """Files and folders below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def move(self, a: str, b: str, overwrite: bool = False) -> None:
        """A rename; with overwrite it takes the place of a file at once, without it an existing target is an error."""
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(options, int(overwrite))
        if overwrite:
            how[0] = options.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(a).toUri(), self.conf).rename(self.path(a), self.path(b), how)

    def write(self, p: str, text: str, overwrite: bool = True) -> None:
        """A small file that appears whole, in place of an earlier one or not at all where there is one."""
        parent, name = p.rsplit("/", 1)
        draft = f"{parent}/.{name}-{uuid.uuid4().hex}"
        out = self.fs.create(self.path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self.move(draft, p, overwrite)
        except Exception:
            self.delete(draft)
            raise

    def read(self, p: str) -> str | None:
        if not self.exists(p):
            return None
        stream = self.fs.open(self.path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def size(self, p: str) -> int:
        return self.fs.getContentSummary(self.path(p)).getLength()

    def children(self, p: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(p))) if self.exists(p) else []

    def identity(self, p: str) -> list:
        """What a rename keeps: files, folders and bytes below a folder, and name, length and time of each child."""
        total = self.fs.getContentSummary(self.path(p))
        own = sorted((s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in self.fs.listStatus(self.path(p)))
        return [total.getFileCount(), total.getDirectoryCount(), total.getLength(), own]


class Versions:
    """Numbered states of a folder, each a small JSON file; the greatest number is the current one.

    A state is taken by creating the next number. Of two that take it at once the second fails, and a writer that dies
    before it leaves the earlier state current; there is no moment without one.
    """

    def __init__(self, store: Store, folder: str, name: str = "_STATE"):
        self.store, self.folder, self.name = store, folder.rstrip("/"), name

    def numbers(self) -> list[int]:
        return sorted(int(c[len(self.name) + 1 :]) for c in self.store.children(self.folder) if c.startswith(f"{self.name}-"))

    def current(self) -> dict:
        """The current state with its number; number 0 and nothing else before the first."""
        numbers = self.numbers()
        return json.loads(self.store.read(self._file(numbers[-1]))) | {"number": numbers[-1]} if numbers else {"number": 0}

    def take(self, before: dict, state: dict) -> dict:
        """Makes a state current that was made from the one before."""
        number = before["number"] + 1
        self.store.write(self._file(number), json.dumps(state, sort_keys=True), overwrite=False)
        return state | {"number": number}

    def forget(self, below: int) -> None:
        for n in self.numbers():
            if n < below:
                self.store.delete(self._file(n))

    def _file(self, number: int) -> str:
        return f"{self.folder}/{self.name}-{number:012d}"
