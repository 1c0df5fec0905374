"""Stored states of reports (Q1-Q8, Q12, Q13): a report reads the states of all batches, and no event."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lumbung.operators.report_state import merged_state, partial_state
from lumbung.sources.versions import VersionLog


@dataclass(frozen=True)
class ReportStates:
    """The states of a report's batches, below one folder.

    Adding a batch again replaces its state.  A load that fails leaves the states as they
    were; readers end on the states they began with (see ``VersionLog``).
    """

    spark: SparkSession
    folder: str
    keys: Sequence[str]
    measure: str | None = None

    @property
    def _log(self) -> VersionLog:
        return VersionLog(self.spark, self.folder)

    def batch_ids(self) -> list[str]:
        commit = self._log.current()
        return sorted(commit.parts) if commit else []

    def add(self, batch_id: str, rows: DataFrame) -> None:
        """Keep the state of a batch; its rows are read once."""
        log = self._log
        before = log.current()
        parts = dict(before.parts) if before else {}
        old = parts.pop(batch_id, None)
        if old is not None and old in parts.values():
            raise ValueError(f"{batch_id} was merged with other batches and cannot be replaced any more")
        folder = log.new_folder()
        partial_state(rows, self.keys, self.measure).write.parquet(log.folder(folder))
        log.commit({**parts, batch_id: folder}, before)

    def merged(self) -> DataFrame | None:
        """The state of all batches, or ``None`` before the first one."""
        commit = self._log.current()
        return merged_state(self._read(sorted(set(commit.parts.values()))), self.keys) if commit else None

    def compact(self, keep: Sequence[str] = ()) -> None:
        """Merge the states of all batches but ``keep`` into one, so that a report reads few files.

        The merged batches stay known by name, but none of them can be added again.
        """
        log = self._log
        before = log.current()
        if before is None:
            return
        merged = {batch: folder for batch, folder in before.parts.items() if batch not in keep}
        shared = set(merged.values()) & {before.parts[batch] for batch in keep if batch in before.parts}
        if shared:
            raise ValueError(f"batches to keep were merged already: {sorted(set(keep))}")
        if len(set(merged.values())) < 2:
            return
        folder = log.new_folder()
        merged_state(self._read(sorted(set(merged.values()))), self.keys).write.parquet(log.folder(folder))
        log.commit({**before.parts, **dict.fromkeys(merged, folder)}, before)

    def _read(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*(self._log.folder(name) for name in folders))
