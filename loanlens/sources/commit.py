"""Whole folders replaced together: staged writes with one commit.

Spark commits one table at a time, so a job that writes several tables, or replaces some folders of one, can
die in between and leave old next to new. Here everything is first written under ``root/_staged/<run>`` in the layout
it will have under ``root``. The commit is one small file, ``root/_commit.json``, made visible by a rename; it
names the staged folder and the earlier files that go. Only then are files moved and removed, and whoever
comes next finishes that after a crash (:func:`recover`):

* before the commit file is there, ``root`` is as it was, and the staged folder is rubbish;
* from then on, the new files count: moving what is still staged and removing what is listed can be repeated at any point.

A folder that is new under ``root`` is moved as a whole, others file by file. Only file names pass through the driver.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

RECORD = "_commit.json"
STAGED = "_staged"
STALE_HOURS = 24 * 7  # of a staged folder that no commit names


class Folder:
    """Files under ``root`` in whatever file system it is in; paths are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def children(self, name: str = "") -> list[tuple[str, bool, int]]:
        """``(name, is a folder, last change in ms)`` of what is in a folder; nothing when it is not there."""
        if not self.exists(name):
            return []
        return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in self.fs.listStatus(self.path(name))]

    def files(self, name: str) -> list[str]:
        """All files below a folder."""
        out = []
        for child, is_folder, _ in self.children(name):
            at = f"{name}/{child}" if name else child
            out += self.files(at) if is_folder else [at]
        return out

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def move(self, src: str, dst: str) -> None:
        if not self.fs.rename(self.path(src), self.path(dst)):
            raise OSError(f"cannot move {self.root}/{src} to {self.root}/{dst}")

    def read_text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _is_marker(name: str) -> bool:
    return name == "_SUCCESS" or name.startswith("_temporary")


def _move_tree(folder: Folder, src: str, dst: str) -> None:
    """What is under ``src`` to ``dst``, beside what is there; a file of the same name is replaced."""
    for name, is_folder, _ in folder.children(src):
        if _is_marker(name):
            continue
        a, b = f"{src}/{name}", f"{dst}/{name}" if dst else name
        if is_folder and folder.exists(b):
            _move_tree(folder, a, b)
            continue
        if folder.exists(b):
            folder.remove(b)
        elif dst and not folder.exists(dst):
            folder.fs.mkdirs(folder.path(dst))
        folder.move(a, b)


def recover(spark: SparkSession, root: str) -> bool:
    """Finish a commit that was begun under ``root``; True when there was one. Safe to repeat."""
    folder = Folder(spark, root)
    if not folder.exists(RECORD):
        return False
    record = json.loads(folder.read_text(RECORD))
    _move_tree(folder, record["staged"], "")
    for name in record["remove"]:
        folder.remove(name)
    folder.remove(record["staged"])
    folder.remove(RECORD)
    return True


class StagedWrite:
    """One set of folders under ``root``, written aside and then committed together."""

    def __init__(self, spark: SparkSession, root: str):
        recover(spark, root)
        self.spark, self.store = spark, Folder(spark, root)
        self.run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # in order of time
        self.staged = f"{STAGED}/{self.run}"

    def folder(self, name: str = "") -> str:
        """Where to write what will be ``root/name``."""
        return f"{self.store.root}/{self.staged}/{name}".rstrip("/")

    def commit(self, replaced: list[str]) -> None:
        """Make everything staged visible in place of what the folders ``replaced`` (names under ``root``) hold now."""
        self.store.fs.mkdirs(self.store.path(self.staged))  # also where nothing was written: the replaced folders go
        earlier = [f for name in replaced for f in self.store.files(name)]
        self._drop_stale()
        self.store.write_text(f"{self.staged}.json", json.dumps({"staged": self.staged, "remove": earlier}))
        if self.store.exists(RECORD):
            self.store.remove(f"{self.staged}.json")
            raise RuntimeError(f"another commit is under way in {self.store.root}")
        self.store.move(f"{self.staged}.json", RECORD)
        recover(self.spark, self.store.root)

    def _drop_stale(self) -> None:
        limit = time.time() * 1000 - STALE_HOURS * 3_600_000
        for name, _, changed in self.store.children(STAGED):
            if changed < limit and name != self.run:
                self.store.remove(f"{STAGED}/{name}")
