"""File-system steps beside Spark's writers: moving a finished file or folder into place.

Goes through Hadoop's file system, so any store that Spark writes to will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Paths of one session; every call is a metadata operation."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def is_file(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isFile()

    def size(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getLen()

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)]

    def walk(self, path: str) -> list[str]:
        """Every file below ``path``."""
        fs, p = self._at(path)
        found, out = fs.listFiles(p, True), []
        while found.hasNext():
            out.append(found.next().getPath().toString())
        return out

    def first_line(self, path: str) -> str:
        """A text file's first line, without reading on ('' if the file is empty)."""
        fs, p = self._at(path)
        reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    def read_text(self, path: str) -> str:
        """A small text file as a whole."""
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """A small new text file; its name is visible before it is whole, so move it into place afterwards."""
        fs, p = self._at(path)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        """Rename; the target's parent is made, the target itself must not exist."""
        fs, p = self._at(source)
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(p, to):
            raise OSError(f"could not move {source} to {target}")


def single_file(spark: SparkSession, df, path: str) -> int:
    """Write the one text row of ``df`` as one file at ``path`` (replacing it); its size in bytes."""
    files, staging = Files(spark), f"{path}.{uuid.uuid4().hex[:8]}.staging"
    df.coalesce(1).write.text(staging)
    part = [n for n in files.names(staging) if n.startswith("part-")]
    if len(part) != 1:
        raise ValueError(f"{len(part)} files for one document")
    files.delete(path)
    files.move(f"{staging}/{part[0]}", path)
    files.delete(staging)
    return files.size(path)
