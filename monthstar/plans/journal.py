"""The steps of a month that have ended, so that a run which failed can go on."""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import fields, is_dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from monthstar.sinks import remove
from monthstar.sources.files import LOADING, join_path
from monthstar.sources.versions import hadoop_path
from monthstar.specs.model import Family

JOURNAL = "journal"


class Journal:
    """Marks under ``loading/journal``, one file for each step that has ended.

    A mark holds what the step measured and the print of what it was made from;
    a step whose print is another now is run again. Marks belong to one month:
    staging tables hold one month at a time, so a run of another month, or one
    that does not resume, drops them all.
    """

    def __init__(self, spark: SparkSession, root: str, year: int, month: int, resume: bool):
        self._spark = spark
        self._folder = join_path(root, LOADING, JOURNAL)
        self._month = f"{int(year)}-{int(month):02d}"
        if not resume or self._read("month") != self._month:
            self.drop()
            self._write("month", self._month)

    def once(self, step: str, made_from: str, run: Callable[[], object]) -> object:
        """What a step measured: told by its mark, or by running it now."""
        mark = self._read(step)
        if mark is not None and mark["made_from"] == made_from:
            return mark["measured"]
        measured = run()
        self._write(step, {"made_from": made_from, "measured": measured})
        return measured

    def drop(self) -> None:
        remove(self._spark, self._folder)

    def _read(self, name: str):
        where, system = hadoop_path(self._spark, f"{self._folder}/{name}.json")
        if not system.exists(where):
            return None
        stream = system.open(where)
        try:
            text = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:  # a driver lost while it wrote the mark: the step counts as not ended
            return None

    def _write(self, name: str, value) -> None:
        where, system = hadoop_path(self._spark, f"{self._folder}/{name}.json")
        stream = system.create(where, True)
        try:
            stream.write(json.dumps(value).encode("utf-8"))
        finally:
            stream.close()


def made_from(*parts) -> str:
    """One print of specifications, settings and other prints."""
    return hashlib.sha256(json.dumps([_described(part) for part in parts]).encode("utf-8")).hexdigest()


def raw_files(spark: SparkSession, root: str, families: Iterable[Family], year: int, month: int) -> list[list]:
    """Path, length and time of change of a month's raw files; nothing is read."""
    found = []
    for pattern in sorted({family.glob(year, month) for family in families}):
        where, system = hadoop_path(spark, join_path(root, pattern))
        for status in system.globStatus(where) or ():
            for file in system.listStatus(status.getPath()) if status.isDirectory() else [status]:
                found.append([file.getPath().toString(), file.getLen(), file.getModificationTime()])
    return sorted(found)


def _described(value):
    """A value as JSON that is the same in every process; functions by name, constants and what they close over."""
    if is_dataclass(value):
        return [type(value).__name__, *([f.name, _described(getattr(value, f.name))] for f in fields(value))]
    if isinstance(value, (tuple, list)):
        return [_described(v) for v in value]
    if isinstance(value, T.DataType):
        return value.json()
    if isinstance(value, functools.partial):
        return ["partial", _described(value.func), _described(value.args), _described(sorted(value.keywords.items()))]
    if callable(value):
        code = getattr(value, "__code__", None)
        kept = [cell.cell_contents for cell in getattr(value, "__closure__", None) or ()]
        constants = [repr(c) for c in code.co_consts if not hasattr(c, "co_code")] if code else []
        return [value.__module__, value.__qualname__, constants, _described(kept)]
    return value if isinstance(value, (str, int, float, bool, type(None))) else repr(value)
