"""Files and folders wherever Hadoop's file systems reach: what there is, removal, and single files put together from what Spark has written."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        """A path and its file system; for local files the one that writes no checksums beside them, as people read these folders."""
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.conf)
        return p, fs.getRawFileSystem() if fs.getUri().getScheme() == "file" else fs

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def remove(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def parts(self, folder: str) -> list[str]:
        """The part files of a folder that Spark has written, in order of partitions."""
        p, fs = self._at(folder)
        return sorted(x.getPath().toString() for x in fs.listStatus(p) if x.getPath().getName().startswith("part-"))

    def replace(self, new: str, path: str) -> None:
        """Renames a file to one that may exist already."""
        (a, _), (b, _) = self._at(new), self._at(path)
        if a.toUri().getScheme() in (None, "file"):
            os.replace(a.toUri().getPath(), b.toUri().getPath())
            return
        how = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        how[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), self.conf).rename(a, b, how)

    def put_together(self, path: str, head: bytes, parts: Iterable[str]) -> None:
        """One file of head and parts, whose bytes are copied one buffer at a time. It replaces an old one when it is whole; on failure the old one stands."""
        folder, _, name = path.rpartition("/")
        temp = f"{folder}/.{name}.new" if folder else f".{name}.new"
        p, fs = self._at(temp)
        try:
            out = fs.create(p, True)
            try:
                out.write(bytearray(head))
                for part in parts:
                    q, own = self._at(part)
                    read = own.open(q)
                    try:
                        self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, self.conf, False)
                    finally:
                        read.close()
            finally:
                out.close()
            self.replace(temp, path)
        finally:
            if fs.exists(p):
                fs.delete(p, False)
