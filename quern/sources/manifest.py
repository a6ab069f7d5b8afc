"""Numbered versions of a table: each is one small file that names a folder, and whoever writes the file first has the number."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_DIGITS = 20


class Conflict(RuntimeError):
    """Another writer has published since the version that was read."""


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system: any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_file(spark: SparkSession, path: str) -> str:
    at, fs = _path(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file whole under a name that nobody has; false if somebody has it.

    The file is written under a name of its own and then gets the wanted one in one step that fails where the name is taken: a link on a
    local disk, a rename that doesn't overwrite elsewhere.
    """
    at, fs = _path(spark, path)
    jvm = spark.sparkContext._jvm
    own = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(own, True)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            os.link(own.toUri().getPath(), at.toUri().getPath())
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(own, at, options)
        return True
    except FileExistsError:
        return False
    except Exception:
        if fs.exists(at):
            return False
        raise
    finally:
        fs.delete(own, False)


class Versions:
    """The versions of a table in ``folder``. A version's number is one more than that of the version it was made from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _name(self, number: int) -> str:
        return f"{self.folder}/_versions/{number:0{_DIGITS}d}.json"

    def head(self) -> dict | None:
        """The last version: its number, what it was published with, or none. Only the names of small files are listed, never rows."""
        at, fs = _path(self.spark, f"{self.folder}/_versions")
        if not fs.exists(at):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1] != "."]
        return self.version(max(numbers)) if numbers else None

    def version(self, number: int) -> dict:
        return json.loads(read_file(self.spark, self._name(number))) | {"number": number}

    def publish(self, parent: dict | None, **what) -> dict:
        """Publish what follows ``parent``, as it was read by ``head``; ``Conflict`` if another version follows it already."""
        number = parent["number"] + 1 if parent else 0
        if not claim(self.spark, self._name(number), json.dumps(what)):
            raise Conflict(f"version {number} of {self.folder} is there already")
        return what | {"number": number}

    def new_folder(self) -> str:
        """A name, relative to the table, that no other writer uses."""
        return f"data-{uuid.uuid4().hex}"


def write_version(df: DataFrame, folder: str, version: str, parent: dict | None = None) -> dict:
    """A new version of a table, named ``version``, beside the others; a name is never given twice.

    Rows go to a folder of their own and are seen once the version is published; with ``parent``, the version that the rows
    were made from, a version that another writer has published since is a ``Conflict``.
    """
    table = Versions(df.sparkSession, folder)
    before = parent or table.head()
    names = (before or {}).get("names", {})
    if version in names:
        raise ValueError(f"a version {version} exists in {folder}")
    at = table.new_folder()
    df.write.mode("error").parquet(f"{table.folder}/{at}")
    return table.publish(before, name=version, path=at, schema=df.schema.json(), names=names | {version: at})


def write_first(df: DataFrame, folder: str, version: str) -> dict:
    """A version that is written once: where its name is there already, it stays."""
    before = Versions(df.sparkSession, folder).head()
    return before if before and version in before["names"] else write_version(df, folder, version, before)


def current(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The last version published, or the one of a name; its folder alone is read."""
    table = Versions(spark, folder)
    head = table.head()
    if head is None:
        raise ValueError(f"no version in {folder}")
    if version is None:
        return spark.read.schema(StructType.fromJson(json.loads(head["schema"]))).parquet(f"{table.folder}/{head['path']}")
    return spark.read.parquet(f"{table.folder}/{head['names'][version]}")
