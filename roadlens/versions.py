"""Numbered versions of a dataset: lists of files under a commit log, with one winner where two write at once.

A version is a Parquet list of its rows and an entry of the log that names it. The entry
is written aside and renamed to its number, which fails where that number is taken: a
writer that started from an older version gets an error and changes nothing. Lists are
never changed, so that readers of any version are undisturbed until ``clean`` removes
what no kept version names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import _file

LOG, LISTS = "log", "lists"


class Conflict(RuntimeError):
    """Another version was committed since the one that a change was made from."""


@dataclass
class Dataset:
    spark: SparkSession
    path: str
    key: str = "path"

    def _entry(self, number: int) -> str:
        return f"{self.path}/{LOG}/{number:012d}.json"

    def versions(self) -> list[int]:
        """The numbers that are there, ascending."""
        store, where = _file(self.spark, f"{self.path}/{LOG}")
        names = [s.getPath().getName() for s in store.listStatus(where)] if store.exists(where) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def about(self, number: int) -> dict:
        """What the log says of a version: number, parent, list, rows, time, message, facts."""
        text = self.spark.read.text(self._entry(number), wholetext=True).first()
        return json.loads(text["value"])

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, by default the latest."""
        number = self.latest() if number is None else number
        if number is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return self.spark.read.parquet(f"{self.path}/{LISTS}/{self.about(number)['list']}")

    def commit(self, rows: DataFrame, parent: int | None = None, message: str = "", facts: dict | None = None) -> int:
        """Writes ``rows`` as the version after ``parent`` (None: the first one) and returns its number.

        Raises ``Conflict`` where another writer has committed that number; what was
        written for this one is then removed.
        """
        number, name = (0 if parent is None else parent + 1), uuid.uuid4().hex
        if parent is not None and parent not in self.versions():
            raise ValueError(f"no version {parent}")
        folder = f"{self.path}/{LISTS}/{name}"
        rows.write.parquet(folder)
        entry = {"number": number, "parent": parent, "list": name, "rows": self.spark.read.parquet(folder).count(), "time": datetime.now(UTC).isoformat(), "message": message, "facts": facts or {}}
        if not self._publish(json.dumps(entry), number, name):
            store, where = _file(self.spark, folder)
            store.delete(where, True)
            raise Conflict(f"version {number} was committed by another writer")
        return number

    def _publish(self, text: str, number: int, name: str) -> bool:
        """Writes the entry aside and renames it to its number, if that is free."""
        store, log = _file(self.spark, f"{self.path}/{LOG}")
        store.mkdirs(log)
        _, aside = _file(self.spark, f"{self.path}/{LOG}/.{name}")
        out = store.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        _, target = _file(self.spark, self._entry(number))
        options = self.spark._jvm.org.apache.hadoop.fs
        context = options.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else options.Path(f"file://{self._entry(number)}").toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(options.Options.Rename, 0)
        try:
            context.rename(aside, target, none)  # without OVERWRITE it fails where the target is
            return True
        except Exception as e:
            if store.exists(aside):
                store.delete(aside, False)
            if "FileAlreadyExists" in str(e) or store.exists(target):
                return False
            raise

    def changed(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """(key, change): what is added or removed from one list to the other; a dry run of a commit, or the difference of two versions."""
        old, new = before.select(self.key).distinct(), after.select(self.key).distinct()
        added, gone = new.join(old, self.key, "left_anti"), old.join(new, self.key, "left_anti")
        return added.select(self.key, F.lit("added").alias("change")).unionByName(gone.select(self.key, F.lit("removed").alias("change")))

    def remove(self, lost: DataFrame, parent: int, message: str = "", dry_run: bool = False) -> DataFrame:
        """Commits ``parent`` without the rows of ``lost``, by key, and returns what changes; with ``dry_run`` nothing is written."""
        old = self.read(parent)
        rest = old.join(lost.select(self.key).distinct(), self.key, "left_anti")
        if dry_run:
            return self.changed(old, rest)
        return self.changed(old, self.read(self.commit(rest, parent, message)))

    def clean(self, keep: int = 10) -> list[str]:
        """Removes log entries but the last ``keep``, and lists that no entry names; the names of those lists."""
        if keep < 1:
            raise ValueError("at least one version stays")
        every = self.versions()
        for number in every[:-keep]:
            store, where = _file(self.spark, self._entry(number))
            store.delete(where, False)
        used = {self.about(n)["list"] for n in every[-keep:]}
        store, lists = _file(self.spark, f"{self.path}/{LISTS}")
        found = [s.getPath().getName() for s in store.listStatus(lists)] if store.exists(lists) else []
        unused = sorted(set(found) - used)
        for name in unused:
            store.delete(_file(self.spark, f"{self.path}/{LISTS}/{name}")[1], True)
        return unused
