"""Versions of a table (L1, L4, L7): new folders, and a small commit that makes them the table.

A table is the folders that its newest commit names.  A load writes its rows to new
folders first and commits them last, so one that fails half-way leaves the table as it
was, and a reader stays with the folders it was given.  A commit removes what only
commits before the last one name: a reader that began before a commit can end on its
own version, up to the commit after that.  Two writers that commit at once do not mix:
the second one's commit is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from lumbung.sources.paths import age_in_hours, child_names, delete, path_exists, put_text, read_text

#: folders of loads that failed are removed by a later commit once they are this old
ORPHAN_HOURS = 48.0


class CommitConflict(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class Commit:
    """``parts`` maps the name of each part of the table to its folder."""

    number: int
    parts: Mapping[str, str]


@dataclass(frozen=True)
class VersionLog:
    spark: SparkSession
    table: str  # the table's folder

    @property
    def _commits(self) -> str:
        return f"{self.table}/_commits"

    def _numbers(self) -> list[int]:
        if not path_exists(self.spark, self._commits):
            return []
        return sorted(int(name) for name in child_names(self.spark, self._commits) if name.isdigit())

    def _read(self, number: int) -> Commit:
        return Commit(number, json.loads(read_text(self.spark, f"{self._commits}/{number:012d}")))

    def current(self) -> Commit | None:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else None

    def folder(self, name: str) -> str:
        return f"{self.table}/_versions/{name}"

    def new_folder(self) -> str:
        """The name of a folder that belongs to no commit yet."""
        return f"v-{uuid.uuid4().hex}"

    def commit(self, parts: Mapping[str, str], after: Commit | None) -> Commit:
        """Make ``parts`` the table, unless something else was committed after ``after``."""
        number = after.number + 1 if after else 1
        if not put_text(self.spark, f"{self._commits}/{number:012d}", json.dumps(dict(parts), sort_keys=True)):
            raise CommitConflict(f"{self.table} was changed by another writer")
        self._clean(number, parts)
        return Commit(number, parts)

    def _clean(self, newest: int, parts: Mapping[str, str]) -> None:
        kept = set(parts.values())
        expired = []
        for number in self._numbers():
            if number >= newest - 1:
                kept |= set(self._read(number).parts.values())
            else:
                expired.append(number)
        gone = {folder for number in expired for folder in self._read(number).parts.values()} - kept
        if path_exists(self.spark, f"{self.table}/_versions"):
            for name in set(child_names(self.spark, f"{self.table}/_versions")) - kept:
                if name in gone or age_in_hours(self.spark, self.folder(name)) > ORPHAN_HOURS:
                    delete(self.spark, self.folder(name))
        for number in expired:
            delete(self.spark, f"{self._commits}/{number:012d}")
