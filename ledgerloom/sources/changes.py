"""Changes of a Parquet dataset by whole files, safe against jobs that fail half-way.

A change is first made beside the dataset, in a folder ``_change-<id>`` inside it that readers pass over: the new files under
``data``, then the names of the files that they replace under ``replaced``. That second write decides: until it is complete the dataset is as it
was, and the folder is dropped by the next change; once it is, the change only moves names. New files are renamed into
their places, then replaced ones are deleted. Both can be done again after a stop, which ``finish_changes`` does.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.literals import literal_table

PREFIX = "_change-"


class Folder:
    """File names through the file system that Spark reads the path with."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path, self._uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
        self.root = self._path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.fs.makeQualified(self.root)

    def at(self, *parts: str):
        out = self.root
        for p in parts:
            out = self._path(out, p)
        return out

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.at(*parts))

    def named(self, uri: str):
        return self._path(self._uri(uri))

    def names(self) -> list[str]:
        """Names of the folders inside."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.root) if s.isDirectory()) if self.exists() else []

    def changes(self) -> list[str]:
        """Unfinished changes, by name."""
        return [n for n in self.names() if n.startswith(PREFIX)]

    def files(self, *parts: str) -> list:
        """Data files below a folder: none whose name, or a folder's name on the way, is hidden from readers."""
        top, out = self.at(*parts), []
        if not self.fs.exists(top):
            return out
        found = self.fs.listFiles(top, True)
        while found.hasNext():
            path = found.next().getPath()
            below = path.toUri().getPath()[len(top.toUri().getPath()) + 1 :].split("/")
            if not any(x.startswith((".", "_")) and "=" not in x for x in below):
                out.append((path, below))
        return out


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of a dataset's files."""
    return [p.toUri().toString() for p, _ in Folder(spark, path).files()]


def readable(spark: SparkSession, path: str, uris: list[str]) -> list[str]:
    """Names of files, as scans give them, as paths for a reader: without URI escapes, and no sign of them taken for a pattern."""
    folder = Folder(spark, path)
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", folder.named(u).toString()) for u in uris]


def _publish(spark: SparkSession, folder: Folder, change: str) -> None:
    old = [r[0] for r in spark.read.text(folder.at(change, "replaced").toString()).collect()]
    for path, below in folder.files(change, "data"):
        place = folder.at(*below)
        if not folder.fs.exists(place.getParent()):
            folder.fs.mkdirs(place.getParent())
        if not folder.fs.rename(path, place):
            raise OSError(f"cannot move {path} to {place}")
    for uri in filter(None, old):
        folder.fs.delete(folder.named(uri), False)
    folder.fs.delete(folder.at(change), True)


def finish_changes(spark: SparkSession, path: str) -> list[str]:
    """Complete the changes that were decided and drop those that were not; gives back the names of the completed ones."""
    folder, done = Folder(spark, path), []
    for change in folder.changes():
        if folder.exists(change, "replaced", "_SUCCESS"):
            _publish(spark, folder, change)
            done.append(change)
        else:
            folder.fs.delete(folder.at(change), True)
    return done


def change_files(rows: DataFrame, path: str, replaced: list[str], partition_by: list[str] | None = None) -> None:
    """Add ``rows`` to a dataset in place of the files named in ``replaced``, which ``rows`` may read. One writer at a time."""
    spark = rows.sparkSession
    finish_changes(spark, path)
    folder, change = Folder(spark, path), f"{PREFIX}{uuid.uuid4().hex[:12]}"
    writer = rows.write.option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder.at(change, "data").toString())
    names = literal_table(spark, [(f,) for f in replaced], "file string").coalesce(1)
    names.write.text(folder.at(change, "replaced").toString())
    _publish(spark, folder, change)
    spark.catalog.refreshByPath(path)
