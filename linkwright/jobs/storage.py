"""Small files on any file system that Spark can reach: the driver's reports, and single-file tables."""

from __future__ import annotations

import json
import uuid
import zipfile
from io import BytesIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Storage:
    """A folder, seen through Hadoop's file systems (so also one that only Spark's readers can open)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._java = spark._jvm.org.apache.hadoop.fs

    def path(self, name: str = "") -> str:
        return f"{self.root}/{name}" if name else self.root

    def _open(self, name: str):
        path = self._java.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def size(self, name: str) -> int | None:
        """Bytes of a file, or None if there is none of that name."""
        fs, path = self._open(name)
        return fs.getFileStatus(path).getLen() if fs.exists(path) and fs.getFileStatus(path).isFile() else None

    def stamp(self, name: str) -> list:
        """What changes when a file does: its name, size and time."""
        fs, path = self._open(name)
        status = fs.getFileStatus(path)
        return [name, status.getLen(), status.getModificationTime()]

    def remove(self, name: str = "") -> None:
        fs, path = self._open(name)
        fs.delete(path, True)

    def put(self, name: str, content: bytes) -> None:
        """Written beside its place, then moved there."""
        fs, path = self._open(name)
        _, beside = self._open(f"{name}.{uuid.uuid4().hex}.tmp")
        out = fs.create(beside, True)
        out.write(bytearray(content))
        out.close()
        fs.delete(path, False)
        fs.rename(beside, path)

    def get(self, name: str) -> bytes:
        fs, path = self._open(name)
        stream = fs.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def put_json(self, name: str, value) -> None:
        self.put(name, (json.dumps(value, indent=2, sort_keys=True, default=str, ensure_ascii=False) + "\n").encode())

    def put_table(self, name: str, df: DataFrame, order: list[str], hidden: tuple[str, ...] = ()) -> int:
        """``df`` as one TSV file, sorted by ``order`` (``-name``: falling): parts are written in parallel, each a range of the
        order, then joined end to end. Columns in ``hidden`` only sort. Returns the number of rows."""
        shown = [c for c in df.columns if c not in hidden]
        fs, path = self._open(name)
        parts, whole = f"{name}.{uuid.uuid4().hex}.parts", f"{name}.{uuid.uuid4().hex}.tmp"
        cell = lambda c: F.regexp_replace(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), r"[\t\r\n]", " ")
        df.orderBy(*(F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order)).select(F.concat_ws("\t", *map(cell, shown)).alias("value")).write.text(self.path(parts))
        copy = self.spark._jvm.org.apache.hadoop.io.IOUtils
        out = fs.create(self._open(whole)[1], True)
        out.write(bytearray(("\t".join(shown) + "\n").encode()))
        for status in sorted(fs.listStatus(self._open(parts)[1]), key=lambda s: s.getPath().getName()):
            if status.getPath().getName().startswith("part-"):
                stream = fs.open(status.getPath())
                copy.copyBytes(stream, out, 1 << 20, False)
                stream.close()
        out.close()
        rows = self.spark.read.text(self.path(parts)).count()
        fs.delete(self._open(parts)[1], True)
        fs.delete(path, False)
        fs.rename(self._open(whole)[1], path)
        return rows

    def put_zip(self, name: str, files: dict[str, str]) -> None:
        """An archive of files of this folder: {name in the archive: name here}."""
        packed = BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for inside, here in files.items():
                z.writestr(inside, self.get(here))
        self.put(name, packed.getvalue())
