"""Reports that are replaced as a whole: readers see the old one until the new one is complete.

A report's folder holds versions and a small pointer file with the name of the
current one. A version is written beside the others and becomes current by one
rename of the pointer; a run that is lost before leaves the old report as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.writers import write_csv, write_parquet

POINTER = "_current"
VERSION = "version-"
KEPT = 2  # versions: the current one, and the one before for readers that have begun


class _Folder:
    """A folder of any Hadoop file system, by Spark's own configuration."""

    def __init__(self, spark: SparkSession, uri: str):
        self.jvm, self.uri = spark.sparkContext._jvm, uri
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.uri}/{name}" if name else self.uri)

    def read(self, name: str) -> str | None:
        if not self.files.exists(self.path(name)):
            return None
        stream = self.files.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a new file and rename it over the old one, in one step of the file system."""
        new = self.path(f"_{uuid.uuid4().hex}")
        stream = self.files.create(new, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.conf)
        context.rename(context.makeQualified(new), context.makeQualified(self.path(name)), options)

    def versions(self) -> list[str]:
        """Names of the versions, the newest first."""
        if not self.files.exists(self.path("")):
            return []
        found = [(s.getModificationTime(), s.getPath().getName()) for s in self.files.listStatus(self.path(""))]
        return [name for _, name in sorted(found, reverse=True) if name.startswith(VERSION)]


def current_version(spark: SparkSession, uri: str) -> str | None:
    """The path of the current version of a report, None if none has been completed."""
    name = _Folder(spark, uri).read(POINTER)
    return f"{uri}/{name}" if name else None


def publish(spark: SparkSession, uri: str, write: Callable[[str], object], label: str = "") -> str:
    """Let ``write`` fill a new version, make it the current one and return its path.

    If ``write`` fails, its error goes on and nothing has changed for readers;
    what it left is removed by a later run, as are versions older than ``KEPT``.
    Of two runs at once the one that ends last is current.
    """
    folder = _Folder(spark, uri)
    before = folder.read(POINTER)
    name = f"{VERSION}{label}{'-' * bool(label)}{uuid.uuid4().hex}"
    write(f"{uri}/{name}")
    folder.replace(POINTER, name)
    kept = [name, *([before] if before else [])][:KEPT]
    for old in folder.versions():
        if old not in kept:
            folder.files.delete(folder.path(old), True)
    return f"{uri}/{name}"


def publish_report(df: DataFrame, uri: str, kind: str = "parquet", **options) -> str:
    """Publish a frame as ``parquet`` or ``csv``; the options are those of the two writers."""
    writers = {"parquet": write_parquet, "csv": write_csv}
    if options.get("on_empty") == "skip":
        raise ValueError("an empty report is published, or not made at all")
    return publish(df.sparkSession, uri, lambda path: writers[kind](df, path, **options))
