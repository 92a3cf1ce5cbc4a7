"""What is kept of a stored table beside it, one folder for each batch of rows.

A stored table may have thousands of partitions of a date, so what is derived from it is laid out by batch alone and follows
the amount of data, not the number of dates. In each batch's folder a list names the partitions it was derived from, and is written
last: a batch is kept whole, as its partitions are now, or is derived again. Compactions take partitions away from batches;
a batch that is written again drops what is kept of it first.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from skyledger.sources.folders import Folders

#: The list of partitions; Spark reads no file of such a name.
_PARTS = "_partitions"


class BatchMirror:
    def __init__(self, files: Folders, source: str, partitions: tuple[str, ...], target: str) -> None:
        self.files, self.source, self.target = files, source, target
        self.pattern = "/".join(f"{p}=*" for p in partitions)

    def stored(self) -> dict[str, set[str]]:
        """The partitions of the table, by the folder name of their batch."""
        found: dict[str, set[str]] = {}
        for path in self.files.glob(f"{self.source}/{self.pattern}"):
            found.setdefault(path.rsplit("/", 1)[1], set()).add(path.removeprefix(f"{self.source}/"))
        return found

    def kept(self) -> dict[str, set[str]]:
        """The same of what is kept; a batch that is not whole has none."""
        return {
            folder.rsplit("/", 1)[1]: set(self.files.read_lines(f"{folder}/{_PARTS}")) if self.files.exists(f"{folder}/{_PARTS}") else set()
            for folder in batch_folders(self.files, self.target)
        }

    def refresh(self, derive: Callable[[list[str]], None]) -> int:
        """Have ``derive`` write the batches, given by name, that changed; returns how many partitions are new."""
        stored, kept = self.stored(), self.kept()
        for gone in kept.keys() - stored.keys():
            self.files.delete(f"{self.target}/{gone}")
        changed = sorted(batch for batch, parts in stored.items() if parts != kept.get(batch))
        if changed:
            for batch in changed:
                self.files.delete(f"{self.target}/{batch}")
            derive([batch_name(batch) for batch in changed])
            for batch in changed:
                self.files.write_lines(f"{self.target}/{batch}/{_PARTS}", sorted(stored[batch]))
        return sum(len(stored[batch] - kept.get(batch, set())) for batch in changed)


def batch_folders(files: Folders, target: str) -> list[str]:
    return [folder for folder in files.children(target) if "ingest_batch=" in folder]


def batch_name(folder: str) -> str:
    return unquote(folder.rsplit("ingest_batch=", 1)[1])
