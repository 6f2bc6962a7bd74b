"""One commit for several tables, and numbered versions of a table.

A writer of several tables puts what belongs together into folders of its own and then
writes a manifest that names them; the manifest appears by one rename, and readers
follow manifests only. So a failure between two tables shows neither, and an epoch that
is written again replaces what its first attempt wrote. A versioned table takes a number
by the same rename, which only one of two writers can win; the other takes the next
number. Renames go through Hadoop's file system, for any shared folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFESTS = "_manifests"


class Folder:
    """A shared folder through Hadoop's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        """Names in ``folder`` that are no temporary files."""
        where = self._path(folder)
        if not self._fs.exists(where):
            return []
        found = [status.getPath().getName() for status in self._fs.listStatus(where)]
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str, replace: bool) -> bool:
        """Writes a small file so that it appears whole, by one rename. Without
        ``replace``, false where the name is taken."""
        folder, _, last = name.rpartition("/")
        self._fs.mkdirs(self._path(folder))
        temporary = self._path(f"{folder}/_{last}-{uuid.uuid4().hex}")
        stream = self._fs.create(temporary, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), self.spark._jsc.hadoopConfiguration())
        option = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE if replace else option.NONE
        try:
            context.rename(context.makeQualified(temporary), context.makeQualified(self._path(name)), options)
            return True
        except Exception as e:  # noqa: BLE001 - a lost race is a result, anything else is raised
            if "FileAlreadyExistsException" in str(e) and not replace:
                self._fs.delete(temporary, False)
                return False
            raise


def write_epoch(spark: SparkSession, root: str, epoch: int, tables: dict[str, DataFrame], notes: dict | None = None) -> None:
    """Writes the tables of an epoch, then its manifest, with a few ``notes``. Written again,
    the epoch is replaced."""
    attempt = "a" + uuid.uuid4().hex[:12]
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}/epoch={epoch}/attempt={attempt}")
    Folder(spark, root).put(f"{_MANIFESTS}/{epoch:020d}", json.dumps({"epoch": epoch, "attempt": attempt, "tables": sorted(tables), "notes": notes or {}}), replace=True)


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """The committed epochs, in order: a few words each."""
    folder = Folder(spark, root)
    return [json.loads(folder.read(f"{_MANIFESTS}/{name}")) for name in folder.names(_MANIFESTS)]


def read_epochs(spark: SparkSession, root: str, name: str, since: int = 0) -> DataFrame:
    """The table ``name`` over all committed epochs (from ``since`` on), with ``epoch``."""
    paths = [f"{root}/{name}/epoch={m['epoch']}/attempt={m['attempt']}" for m in manifests(spark, root) if name in m["tables"] and m["epoch"] >= since]
    if not paths:
        raise FileNotFoundError(f"no committed epoch of {name} in {root}")
    return spark.read.option("basePath", f"{root}/{name}").parquet(*paths).drop("attempt")


def append_version(row: DataFrame, root: str) -> int:
    """Adds a row to a versioned table and returns its number, from 1. The row is written
    first; then its number is taken: the next one for as long as others take it first."""
    spark, attempt = row.sparkSession, "a" + uuid.uuid4().hex[:12]
    row.write.parquet(f"{root}/rows/attempt={attempt}")
    folder = Folder(spark, root)
    while True:
        taken = folder.names("versions")
        number = int(taken[-1]) + 1 if taken else 1
        if folder.put(f"versions/{number:010d}", attempt, replace=False):
            return number


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """The rows of a versioned table, each with its ``version_number``."""
    folder = Folder(spark, root)
    numbers = {folder.read(f"versions/{n}"): int(n) for n in folder.names("versions")}
    if not numbers:
        raise FileNotFoundError(f"no version in {root}")
    rows = spark.read.option("basePath", f"{root}/rows").parquet(*[f"{root}/rows/attempt={a}" for a in numbers])
    taken = spark.createDataFrame(list(numbers.items()), "attempt string, version_number bigint")
    return rows.withColumn("attempt", F.col("attempt").cast("string")).join(taken, "attempt").drop("attempt")
