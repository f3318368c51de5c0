"""Small files beside tables, on any file system that Spark reads: current-version markers and a ledger of runs.

Both rest on one operation each that the file system does as a whole:

* ``Versions``: a folder whose data is replaced as a whole. Every version is a folder of its own; an empty marker file
  named after it makes it current. Readers take the highest marker, so they see the old version or the new one, and
  a run that is killed at any point leaves the old one current or the new one complete.
* ``Ledger``: appends to one folder, in numbered commits. A run writes its rows to a hidden folder, then claims the next
  number by a file that only one run can create; a run that loses the number compares with the new state and
  tries again. Claimed rows are moved into the folder file by file; a run that was killed meanwhile is finished by whoever
  comes next, as each move is done once at most.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


class Folder:
    """Calls to the file system of one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what the folder (or a folder in it) holds, in order."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name)))

    def is_folder(self, name: str) -> bool:
        return self.fs.getFileStatus(self.at(name)).isDirectory()

    def modified(self, name: str) -> float:
        """Seconds since 1970."""
        return self.fs.getFileStatus(self.at(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def touch(self, name: str) -> None:
        self.fs.create(self.at(name), False).close()

    def text(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_once(self, name: str, text: str) -> bool:
        """Create a complete file unless one of that name exists; False if it does.

        The file is written aside and then takes its name by a rename that does not replace (HDFS and its like), or by
        a hard link on a local file system.
        """
        folder, _, own = name.rpartition("/")
        aside = f"{folder}/.{own}-{uuid.uuid4().hex}"
        out = self.fs.create(self.at(aside), False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.getScheme() != "file":
            if not self.exists(name) and self.fs.rename(self.at(aside), self.at(name)):
                return True
            self.delete(aside)
            return False
        try:
            os.link(self.at(aside).toUri().getPath(), self.at(name).toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            self.delete(aside)

    def move_all(self, source: str) -> None:
        """Move every file below ``source`` to the same place below this folder; files moved before are left alone."""
        for name in self.names(source):
            if name.startswith(("_", ".")):
                continue
            if self.is_folder(f"{source}/{name}"):
                self.fs.mkdirs(self.at(name))
                Folder(self.spark, f"{self.path}/{name}")._take(f"{self.path}/{source}/{name}")
            else:
                self._move(self.at(f"{source}/{name}"), self.at(name))

    def _take(self, source: str) -> None:
        other = Folder(self.spark, source)
        for name in other.names():
            if other.is_folder(name):
                self.fs.mkdirs(self.at(name))
                Folder(self.spark, f"{self.path}/{name}")._take(f"{source}/{name}")
            else:
                self._move(other.at(name), self.at(name))

    def _move(self, source, target) -> None:
        if not self.fs.exists(target):
            self.fs.rename(source, target)  # false if another run moved it meanwhile
        if not self.fs.exists(target):
            raise OSError(f"cannot move {source} to {target}")


MARKERS = "_current"


class Versions:
    """A folder with one current version: ``data-<number>-<id>`` folders and ``_current/<number>-<id>`` markers."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def published(self) -> list[str]:
        return [n for n in self.folder.names(MARKERS) if not n.startswith(".")]

    def current(self) -> str | None:
        """The path to read; ``None`` for a folder without versions (its own files are the data)."""
        known = self.published()
        return f"{self.folder.path}/data-{known[-1]}" if known else None

    def fresh(self) -> str:
        """The name of a version after all others."""
        last = max((int(n.split("-")[0]) for n in self.published()), default=0)
        return f"{last + 1:010d}-{uuid.uuid4().hex}"

    def place(self, name: str) -> str:
        return f"{self.folder.path}/data-{name}"

    def publish(self, name: str) -> None:
        """Make a completely written version current."""
        self.folder.touch(f"{MARKERS}/{name}")

    def clean(self, keep: int = 1, grace_seconds: float = 3600) -> None:
        """Delete versions that ``keep`` others and ``grace_seconds`` separate from the current one, what killed runs
        left before them, and the files that were there before versions.

        A reader may thus go on with the version it resolved for the grace time at least. Data goes before its marker,
        so a killed clean-up is repeated by the next.
        """
        known, latest = self.published(), time.time() - grace_seconds
        since = [self.folder.modified(f"{MARKERS}/{n}") for n in known]
        old = {n for n, replaced in zip(known[: -(keep + 1)], since[1:]) if replaced <= latest}
        kept = [n for n in known if n not in old]
        if len(known) > keep and since[0] <= latest:
            first = f"data-{kept[0].split('-')[0]}"
            for name in self.folder.names():
                unnamed = name.startswith("data-") and name[5:] not in known and name < first and self.folder.modified(name) <= latest
                if unnamed or not name.startswith(("_", ".", "data-")):
                    self.folder.delete(name)
        for name in sorted(old):
            self.folder.delete(f"data-{name}")
            self.folder.delete(f"{MARKERS}/{name}")


LEDGER, STAGED = "_ledger", "_staged"


@dataclass(frozen=True)
class Commit:
    """One committed run."""

    version: int
    run_id: str
    rows: int  # -1 if they were not counted


class Ledger:
    """The commits of an appended folder, numbered from 1."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def commits(self) -> list[Commit]:
        names = [n for n in self.folder.names(LEDGER) if n.isdigit()]
        return [Commit(int(n), **json.loads(self.folder.text(f"{LEDGER}/{n}"))) for n in names]

    def staged(self, run_id: str) -> str:
        """Where a run writes its rows before it commits them (hidden from readers of the folder)."""
        return f"{self.folder.path}/{STAGED}/{run_id}"

    def drop(self, run_id: str) -> None:
        self.folder.delete(f"{STAGED}/{run_id}")

    def claim(self, commit: Commit) -> bool:
        """Commit a run as the given version; False if another run has that version."""
        self.folder.fs.mkdirs(self.folder.at(LEDGER))
        return self.folder.put_once(f"{LEDGER}/{commit.version:010d}", json.dumps({"run_id": commit.run_id, "rows": commit.rows}))

    def publish(self, commit: Commit) -> None:
        """Move a committed run's rows to where readers see them."""
        if self.folder.exists(f"{STAGED}/{commit.run_id}"):
            self.folder.move_all(f"{STAGED}/{commit.run_id}")
            self.drop(commit.run_id)

    def settle(self) -> list[Commit]:
        """All commits, those of runs that were killed before publishing finished first."""
        known = self.commits()
        waiting = set(self.folder.names(STAGED))
        for commit in known:
            if commit.run_id in waiting:
                self.publish(commit)
        return known
