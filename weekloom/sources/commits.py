"""Small commit files: numbered JSON entries that appear whole and only once.

Who writes entry N first has it; a second writer of N is told so and takes the next number.
Tables of whatever size lie elsewhere; an entry names them, so a broken write that was never
committed is not read.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, where, where.getFileSystem(conf)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless it is there; whether this call wrote it.

    The text is written under another name first and given its name in one step that fails if
    the name is taken: a hard link on a local file system, else a rename without overwriting.
    """
    jvm, conf, target, fs = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(*(unquote(urlparse(fs.makeQualified(p).toUri().toString()).path) for p in (staged, target)))
        else:
            _renamed(jvm, conf, fs.makeQualified(staged), fs.makeQualified(target))
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(staged, False)


def _renamed(jvm, conf, staged, target) -> None:
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
    options[0] = rename.NONE
    try:
        context.rename(staged, target, options)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise FileExistsError(str(target)) from e
        raise


class CommitLog:
    """Entries 1, 2, … in one folder; readers see finished entries only."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        """Numbers of all entries, ascending: the names in one folder listing."""
        _, _, where, fs = _hadoop(self.spark, self.folder)
        if not fs.exists(where):
            return []
        names = (str(f.getPath().getName()) for f in fs.listStatus(where))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        _, _, where, fs = _hadoop(self.spark, self._path(number))
        stream = fs.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def last(self) -> tuple[int, dict | None]:
        """(number, entry) of the newest; (0, None) of an empty log."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def entries(self) -> list[dict]:
        return [self.read(n) for n in self.numbers()]

    def put(self, number: int, entry: dict) -> bool:
        return put_if_absent(self.spark, self._path(number), json.dumps(entry, sort_keys=True))

    def append(self, entry: dict | Callable[[int], dict], known: int | None = None) -> int:
        """Add under the next free number, trying on while others take it."""
        number = (self.numbers() or [0])[-1] if known is None else known
        while True:
            number += 1
            if self.put(number, entry(number) if callable(entry) else entry):
                return number
