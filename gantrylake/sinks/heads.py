"""Tables made of folders: one small file says which folders count, and is replaced in one step.

Data is written to folders of its own first. A commit then writes the next numbered list of folders under a
name that must not exist yet. Whoever reads takes the last list, so a writer that dies before its commit changes
nothing, and of two writers at once the second starts its step over from the first one's list. Folders that
the last two lists do not name are dropped after a commit, so a reader that began before it can finish.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_heads"
#: Commits that may be overtaken by another writer before this one gives up.
ATTEMPTS = 20


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str:
    system, where = file_system(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole under a name that is still free; False if somebody took the name."""
    system, where = file_system(spark, path)
    _, draft = file_system(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # never over an existing file
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(where), options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


class Heads:
    """The lists of one table: from a name (a month, a batch) to a folder below the table's root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _numbers(self) -> list[int]:
        system, where = file_system(self.spark, f"{self.root}/{FOLDER}")
        if not system.exists(where):
            return []
        names = [status.getPath().getName() for status in system.listStatus(where)]
        return sorted(int(name) for name in names if re.fullmatch(r"\d{12}", name))

    def _path(self, number: int) -> str:
        return f"{self.root}/{FOLDER}/{number:012d}"

    def _list(self, number: int) -> dict[str, str]:
        return json.loads(read_text(self.spark, self._path(number)))

    def read(self) -> dict[str, str] | None:
        """The folders that count, None where nothing was ever committed."""
        numbers = self._numbers()
        return self._list(numbers[-1]) if numbers else None

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def commit(self, change: Callable[[dict[str, str]], dict[str, str]]) -> dict[str, str]:
        """Replace the list by what ``change`` makes of it, in one step."""
        for _ in range(ATTEMPTS):
            numbers = self._numbers()
            last = numbers[-1] if numbers else 0
            before = self._list(last) if numbers else {}
            after = change(dict(before))
            if after == before and numbers:
                return after
            if create_once(self.spark, self._path(last + 1), json.dumps(after, sort_keys=True)):
                self._tidy(numbers, set(before.values()) | set(after.values()))
                return after
        raise RuntimeError(f"other writers were faster {ATTEMPTS} times")

    def _tidy(self, older: list[int], named: set[str]) -> None:
        """Drop lists before the last two, and the folders that only they name."""
        for number in older[:-1]:
            for folder in set(self._list(number).values()) - named:
                self._drop(folder)
            self._drop(f"{FOLDER}/{number:012d}")

    def _drop(self, folder: str) -> None:
        system, where = file_system(self.spark, self.path(folder))
        system.delete(where, True)


def new_version() -> str:
    return uuid.uuid4().hex


class Log(Heads):
    """Appended rows. Entries are merged into one when there are many, so the number of folders stays bounded."""

    #: Entries that are held before they are merged.
    MOST = 64

    def append(self, rows: DataFrame) -> None:
        name = new_version()
        rows.write.parquet(self.path(name))
        if len(self.commit(lambda held: held | {name: name})) > self.MOST:
            self.merge(rows.schema)

    def rows(self, schema: T.StructType) -> DataFrame:
        return self._rows(self.read() or {}, schema)

    def _rows(self, held: dict[str, str], schema: T.StructType) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*map(self.path, held.values()))

    def merge(self, schema: T.StructType) -> None:
        """Write all rows to one folder and put it in the place of the entries that held them."""
        held, name = self.read() or {}, new_version()
        self._rows(held, schema).coalesce(1).write.parquet(self.path(name))

        def merged(now: dict[str, str]) -> dict[str, str]:
            if not held.items() <= now.items():  # somebody else has merged
                return now
            return {one: folder for one, folder in now.items() if one not in held} | {name: name}

        if name not in self.commit(merged):
            self._drop(name)
