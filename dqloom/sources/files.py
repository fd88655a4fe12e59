"""Files and folders where Spark keeps its tables: local ones, HDFS, or any store with a Hadoop connector, by the same paths that spark.read takes."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_PIECE = 1 << 20


class Place(os.PathLike):
    """A file or folder; whatever it holds is read and written by the JVM, not through the driver's own file system."""

    def __init__(self, at: str | os.PathLike, spark: SparkSession | None = None):
        self.spark = spark or SparkSession.active()
        self.at = os.fspath(at) if not isinstance(at, Place) else at.at
        sc = self.spark.sparkContext
        self._jvm = sc._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(self.at)
        self._fs = self._path.getFileSystem(sc._jsc.hadoopConfiguration())

    def __str__(self) -> str:
        return self.at

    def __fspath__(self) -> str:
        """The path for code that only knows local files; refused elsewhere."""
        parts = urlsplit(str(self._fs.makeQualified(self._path).toString()))
        if parts.scheme != "file":
            raise TypeError(f"{self.at} is not a local file")
        return self._path.toUri().getPath()

    def __truediv__(self, name: str) -> Place:
        return Place(f"{self.at.rstrip('/')}/{name}", self.spark)

    @property
    def name(self) -> str:
        return self._path.getName()

    @property
    def parent(self) -> Place:
        return Place(self._path.getParent().toString(), self.spark)

    @property
    def full(self) -> str:
        return str(self._fs.makeQualified(self._path).toString())

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def is_file(self) -> bool:
        return self.exists() and self._fs.getFileStatus(self._path).isFile()

    def size(self) -> int:
        return self._fs.getFileStatus(self._path).getLen()

    def names(self) -> list[str]:
        """Names in the folder, in order; none if there is no folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path)) if self.exists() else []

    def files(self) -> list[str]:
        """All files below the folder."""
        found, out = self._fs.listFiles(self._path, True), []
        while found.hasNext():
            out.append(found.next().getPath().toString())
        return sorted(out)

    def read_bytes(self) -> bytes:
        stream = self._fs.open(self._path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_text(self) -> str:
        return self.read_bytes().decode("utf-8")

    def claim(self) -> bool:
        """Creates the empty file; False if someone has it already."""
        try:
            self._fs.create(self._path, False).close()
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise

    def write_text(self, text: str) -> None:
        """Puts the whole text in place at once: a reader sees the old file or the new one."""
        new = self.parent / f".{self.name}-{uuid.uuid4().hex}"
        stream = self._fs.create(new._path, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(self._path):
            self._fs.delete(self._path, False)
        new.rename_to(self)

    def rename_to(self, other: Place) -> None:
        if not self._fs.rename(self._path, other._path):
            raise OSError(f"{self.at} can't become {other.at}")

    def copy_to(self, other: Place) -> str:
        """Copies a file to a new one; SHA-256 of the bytes that were read."""
        digest = self._jvm.java.security.MessageDigest.getInstance("SHA-256")
        into = other._fs.create(other._path, False)
        self._drained(digest, into)
        return bytes(digest.digest()).hex()

    def sha256(self) -> str:
        digest = self._jvm.java.security.MessageDigest.getInstance("SHA-256")
        self._drained(digest, self._jvm.java.io.OutputStream.nullOutputStream())
        return bytes(digest.digest()).hex()

    def _drained(self, digest, into) -> None:
        stream = self._jvm.java.security.DigestInputStream(self._fs.open(self._path), digest)
        self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, into, _PIECE, True)

    def protect(self) -> None:
        self._fs.setPermission(self._path, self._jvm.org.apache.hadoop.fs.permission.FsPermission("444"))

    def delete(self) -> None:
        self._fs.delete(self._path, True)
