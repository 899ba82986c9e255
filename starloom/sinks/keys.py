"""Blocks of surrogate keys, reserved before they are used.

Two loads that add members at the same time would both number from the same largest key.
A key log keeps the high-water mark of each key as small numbered files; a load moves the mark by as many
keys as it needs and then numbers its rows in the block that it got.  The next file is put in place only if
it is absent, in one step, so of two loads that move a mark at the same time one succeeds and the other
reads the new mark and tries again.  A load that dies leaves a gap, and no key is given twice.

One step needs a file system that renames or links without overwriting: local files and HDFS do,
plain object stores do not.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


class KeyLog:
    """High-water marks below ``folder``, a folder per key and a file per move."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _last(self, name: str) -> tuple[int, int | None]:
        """The number of the last move, 0 before the first, and the mark it set."""
        path = self._path(name)
        files = self._files(path)
        if not files.exists(path):
            return 0, None
        moves = [s.getPath().getName() for s in files.listStatus(path)]
        move = max((int(m) for m in moves if m.isdigit()), default=0)
        if not move:
            return 0, None
        stream = files.open(self._path(name, f"{move:020d}"))
        try:
            return move, int(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _put(self, name: str, move: int, mark: int) -> bool:
        """Put the file of a move in place, whole, unless another load has made that move."""
        draft, final = self._path(name, f"_{uuid.uuid4().hex}"), self._path(name, f"{move:020d}")
        files = self._files(final)
        out = files.create(draft, False)
        out.write(bytearray(str(mark).encode()))
        out.close()
        if files.getScheme() != "file":
            done = files.rename(draft, final)
            if not done:
                files.delete(draft, False)
            return done
        here, there = (unquote(urlparse(p.toUri().toString()).path) for p in (draft, final))
        try:
            os.link(here, there)  # a local rename would overwrite
            return True
        except FileExistsError:
            return False
        finally:
            files.delete(draft, False)

    def mark(self, name: str) -> int | None:
        """The largest key that was given away; None before the first move."""
        return self._last(name)[1]

    def reserve(self, name: str, count: int, start: Callable[[], int] = lambda: 0) -> int:
        """Move the mark of ``name`` by ``count`` keys; the block begins after the number returned.

        ``start`` tells the largest key in use; it is asked before the first move only.
        """
        while True:
            move, mark = self._last(name)
            mark = start() if mark is None else mark
            if count <= 0 or self._put(name, move + 1, mark + count):
                return mark

    def block(self, name: str) -> Callable[[int, DataFrame], int]:
        """``reserve`` in the form that ``assign_keys`` takes: number of rows, and a frame with the largest key in use."""
        return lambda count, largest: self.reserve(name, count, lambda: largest.first()[0])
