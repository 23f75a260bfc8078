"""Several datasets changed together: all of them, or none.

New content is written beside the targets first. A publication then moves what it replaces aside and the new
content in its place, folder by folder, by a list that it has written before. If a move fails, what was moved goes
back; if the process dies, the list stays, and ``recover`` moves back what it names. Once the list is gone the new
content stands. Each move is one rename on the driver; no row is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tillroll.scratch import hadoop_path, remove

_FOLDER, _LIST = "_publish-", "moves.json"


class Publication:
    """Content for targets below ``base``, on one file system. ``folder`` takes what is to be published."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.folder = f"{base.rstrip('/')}/{_FOLDER}{uuid.uuid4().hex}"
        self._moves: list[tuple[str | None, str, str, bool]] = []

    def _add(self, source: str | None, target: str) -> None:
        former = f"{self.folder}/former/{len(self._moves)}"
        self._moves.append((source, target, former, _exists(self.spark, target)))

    def replace(self, source: str, target: str) -> None:
        """The folder ``source`` is to become ``target``, whatever that holds so far."""
        self._add(source, target)

    def remove(self, target: str) -> None:
        """``target`` is to go, if there is one."""
        self._add(None, target)

    def commit(self) -> None:
        file_system = hadoop_path(self.spark, self.folder)[1]
        for _, target, former, _ in self._moves:
            for path in (target, former):
                file_system.mkdirs(hadoop_path(self.spark, path)[0].getParent())
        _write(self.spark, f"{self.folder}/{_LIST}", json.dumps(self._moves))
        try:
            for source, target, former, replaces in self._moves:
                self._move(source, target, former, replaces)
        except BaseException:
            _undo(self.spark, self._moves)
            remove(self.spark, self.folder)
            raise
        remove(self.spark, f"{self.folder}/{_LIST}")  # from here on nothing goes back
        remove(self.spark, self.folder)

    def _move(self, source: str | None, target: str, former: str, replaces: bool) -> None:
        if replaces:
            _rename(self.spark, target, former)
        if source is not None:
            _rename(self.spark, source, target)


@contextmanager
def publication(spark: SparkSession, base: str) -> Iterator[Publication]:
    """Publish at the end of the block what was added within; of a block that fails nothing is published."""
    recover(spark, base)
    found = Publication(spark, base)
    try:
        yield found
    except BaseException:
        remove(spark, found.folder)
        raise
    found.commit()


def recover(spark: SparkSession, base: str) -> int:
    """Undo what dead runs left half published below ``base``; returns the number of such runs.

    Not to be called while another run publishes there.
    """
    path, file_system = hadoop_path(spark, base)
    if not file_system.exists(path):
        return 0
    undone = 0
    for entry in file_system.listStatus(path):
        if not entry.getPath().getName().startswith(_FOLDER):
            continue
        folder = entry.getPath().toString()
        if _exists(spark, f"{folder}/{_LIST}"):
            _undo(spark, json.loads(_read(spark, f"{folder}/{_LIST}")))
            undone += 1
        remove(spark, folder)
    return undone


def _undo(spark: SparkSession, moves: list) -> None:
    """Each target as it was: former content comes back, new content goes. May break off and be done again."""
    for source, target, former, replaces in reversed(moves):
        if replaces:
            if _exists(spark, former):
                remove(spark, target)
                _rename(spark, former, target)
        elif source is not None and not _exists(spark, source):
            remove(spark, target)


def _exists(spark: SparkSession, path: str) -> bool:
    found, file_system = hadoop_path(spark, path)
    return file_system.exists(found)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    path, file_system = hadoop_path(spark, source)
    if not file_system.rename(path, hadoop_path(spark, target)[0]):
        raise OSError(f"{source} cannot be moved to {target}")


def _write(spark: SparkSession, path: str, text: str) -> None:
    """The whole text under its name at once: the list is either there or not."""
    found, file_system = hadoop_path(spark, f"{path}.new")
    file_system.mkdirs(found.getParent())
    stream = file_system.create(found, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    _rename(spark, f"{path}.new", path)


def _read(spark: SparkSession, path: str) -> str:
    found, file_system = hadoop_path(spark, path)
    stream = file_system.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
