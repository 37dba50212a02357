"""Folders of batches and the pointers that make one of them visible.

Below one root::

    batch=<id>/attempt=<uuid>/...            what one attempt to build a batch has written
    published/<number>,<id>,<attempt>        one empty file per publication, written last

An attempt never writes where another one has written, so a batch that failed half-way, or whose
driver died, is simply built again under its id. The pointer is a file without content, so it is
there or it is not, on a file system as on an object store; its name says everything. Readers
follow the pointer with the highest number. An attempt that fails later adds no pointer and so
takes nothing away.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Attempt:
    """One attempt to build a batch, and where its tables are."""

    batch_id: str
    attempt: str
    path: str

    def table(self, name: str) -> str:
        return f"{self.path}/tables/{name}"

    def source(self, name: str) -> str:
        return f"{self.path}/sources/{name}"

    @property
    def marks(self) -> str:
        return f"{self.path}/marks"


@dataclass(frozen=True, order=True)
class Publication:
    number: int
    batch_id: str
    attempt: str


class BatchStore:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        path = self._hadoop.Path(self.root)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join((self.root, *parts)))

    def _names(self, *parts: str) -> list[str]:
        folder = self._path(*parts)
        if not self._files.exists(folder):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(folder)]

    def _attempt(self, batch_id: str, attempt: str) -> Attempt:
        return Attempt(batch_id, attempt, f"{self.root}/batch={quote(batch_id, safe='')}/attempt={attempt}")

    def begin(self, batch_id: str) -> Attempt:
        """A new attempt, in a folder nobody has written to."""
        return self._attempt(batch_id, uuid.uuid4().hex)

    def publications(self) -> list[Publication]:
        """All pointers, the newest last; one per published batch, so bounded by the batches."""
        found = []
        for name in self._names("published"):
            parts = name.split(",")
            if len(parts) == 3 and parts[0].isdigit():
                found.append(Publication(int(parts[0]), unquote(parts[1]), parts[2]))
        return sorted(found)

    def published(self, batch_id: str | None = None) -> Attempt | None:
        """The newest publication, of one batch or of all."""
        found = [p for p in self.publications() if batch_id in (None, p.batch_id)]
        return self._attempt(found[-1].batch_id, found[-1].attempt) if found else None

    def publish(self, attempt: Attempt) -> None:
        """Make an attempt what readers see. Publishing it again changes nothing."""
        held = self.publications()
        if any(p.attempt == attempt.attempt for p in held):
            return
        number = held[-1].number + 1 if held else 1
        name = f"{number:012d},{quote(attempt.batch_id, safe='')},{attempt.attempt}"
        self._files.create(self._path("published", name), False).close()

    def discard(self, attempt: Attempt) -> None:
        """Remove an attempt that was not published."""
        if any(p.attempt == attempt.attempt for p in self.publications()):
            raise ValueError(f"attempt {attempt.attempt} of {attempt.batch_id} is published")
        self._files.delete(self._hadoop.Path(attempt.path), True)

    def expire(self, keep: int) -> list[Publication]:
        """Remove all but the ``keep`` newest publications, pointer first, with their snapshots.

        A batch published more than once counts by its newest publication; the ones before it
        go as well. Attempts without a pointer stay, as one of them may be under way.
        """
        if keep < 1:
            raise ValueError("at least one publication must stay")
        held = self.publications()
        newest = {p.batch_id: p for p in held}
        staying = set(sorted(newest.values())[-keep:])
        gone = [p for p in held if p not in staying]
        for p in gone:
            name = f"{p.number:012d},{quote(p.batch_id, safe='')},{p.attempt}"
            self._files.delete(self._path("published", name), False)
            self._files.delete(self._hadoop.Path(self._attempt(p.batch_id, p.attempt).path), True)
        return gone
