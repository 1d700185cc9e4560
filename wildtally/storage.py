"""Files through the Hadoop file system that holds them, and intermediate rows in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only a local session may do without, and gets a temporary one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="wildtally-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = f"file://{own}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


class Files:
    """Files and folders by URI, on whatever file system Spark reads them from.

    Something new is written beside its place (`.new`), what is there is moved aside (`.old`), the new moved in, and only
    then is the old deleted. So at any moment one of them is whole, and `recover` puts an old one back that a crash left
    aside.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):  # noqa: ANN202
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def exists(self, path: str) -> bool:
        store, where = self._at(path)
        return store.exists(where)

    def names(self, folder: str) -> list[str]:
        store, where = self._at(folder)
        return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []

    def delete(self, path: str) -> None:
        store, where = self._at(path)
        store.delete(where, True)

    def move(self, path: str, to: str) -> None:
        store, where = self._at(path)
        if not store.rename(where, self._at(to)[1]):
            raise OSError(f"{path} can't be moved to {to}")

    def recover(self, path: str) -> None:
        if not self.exists(path) and self.exists(f"{path}.old"):
            self.move(f"{path}.old", path)

    def put(self, new: str, path: str) -> None:
        """Moves `new` to `path`, in place of what is there."""
        if self.exists(path):
            self.delete(f"{path}.old")
            self.move(path, f"{path}.old")
        self.move(new, path)
        self.delete(f"{path}.old")

    def write(self, path: str, parts: Iterable[str]) -> None:
        """A text file from its parts, of which one at a time is held."""
        self.recover(path)
        store, where = self._at(f"{path}.new")
        out = store.create(where, True)
        try:
            for part in parts:
                out.write(bytearray(part.encode()))
        finally:
            out.close()
        self.put(f"{path}.new", path)

    def write_json(self, path: str, value: object) -> None:
        self.write(path, [json.dumps(value, indent=2, default=str) + "\n"])

    def text(self, path: str) -> str:
        self.recover(path)
        store, where = self._at(path)
        file = store.open(where)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(file)).decode()
        finally:
            file.close()


def located(path: str) -> str:
    """A URI: that given, or that of a path on this machine."""
    return path.rstrip("/") if "://" in path else f"file://{os.path.abspath(path)}"


#: Tables in the shared folder that nobody has removed; the driver deletes them when it ends, as lazy results may read them till then.
_LEFT: dict[str, Files] = {}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    Files(spark).delete(path)
    _LEFT.pop(path, None)


@atexit.register
def sweep() -> None:
    """Deletes the tables that are left."""
    while _LEFT:
        path, files = _LEFT.popitem()
        try:
            files.delete(path)
        except Exception:  # the session's JVM is gone
            _LEFT.clear()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, held as a table in the shared folder: a lost executor costs no recomputation of what came before.

    A table, because a checkpoint keeps the size its plan guessed, and guesses for joins multiply over rounds.
    """
    return stored(df, "cut")[0]


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """The rows written as a table in the shared folder, and its path."""
    path = fresh_path(df.sparkSession, tag)
    _LEFT[path] = Files(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
