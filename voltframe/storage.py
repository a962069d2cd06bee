"""Files on whatever storage Spark reaches: every call goes through Hadoop's file system interface.

Places are texts: URIs, or local paths, which become file URIs. Nothing here assumes that the driver
and the executors share a disk, unless the place itself is a local one.
"""
from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession


def uri(place: str | Path) -> str:
    """A URI as it is, or file:// and a local path: Hadoop does not decode percent escapes, which Path.as_uri makes."""
    text = str(place)
    return text if "://" in text or text.startswith(("file:/", "hdfs:/")) else f"file://{Path(text).absolute()}"


def below(place: str | Path, *parts: str) -> str:
    return "/".join([uri(place).rstrip("/"), *parts])


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: the one that the session names, a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return uri(named)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return uri(tempfile.mkdtemp(prefix="voltframe-"))


@dataclass(frozen=True)
class Storage:
    spark: SparkSession

    def _at(self, place: str | Path):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri(place))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, place: str | Path) -> bool:
        path, fs = self._at(place)
        return fs.exists(path)

    def names(self, place: str | Path) -> list[str]:
        path, fs = self._at(place)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def remove(self, place: str | Path) -> None:
        path, fs = self._at(place)
        fs.delete(path, True)

    def read(self, place: str | Path) -> bytes:
        path, fs = self._at(place)
        stream = fs.open(path)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def marked(self, place: str | Path) -> list[str]:
        """Names of the files under a place (a file or a folder) that begin with a UTF-8 byte-order mark."""
        path, fs = self._at(place)
        out = []
        for status in fs.globStatus(path) or []:
            for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if f.isFile() and f.getLen() >= 3:
                    stream = fs.open(f.getPath())
                    try:
                        head = bytes(stream.read() for _ in range(3))
                    finally:
                        stream.close()
                    if head == b"\xef\xbb\xbf":
                        out.append(f.getPath().getName())
        return out

    def write(self, place: str | Path, data: bytes) -> None:
        """Put a whole file in place, over one that is there; readers see the old one or the new."""
        path, fs = self._at(place)
        aside, _ = self._at(f"{uri(place)}.{uuid.uuid4().hex}")
        self._fill(fs.create(aside, True), data)
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(aside, path, options)

    def claim(self, place: str | Path, data: bytes) -> bool:
        """Write a file that must not be there; False if it is. Of several callers one succeeds."""
        path, fs = self._at(place)
        try:
            stream = fs.create(path, False)
        except Exception as error:  # py4j gives the Java exception
            if "AlreadyExists" in str(error) or fs.exists(path):
                return False
            raise
        self._fill(stream, data)
        return True

    @staticmethod
    def _fill(stream, data: bytes) -> None:
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
