"""Small logs that tables keep about themselves: numbered JSON lines, folded now and then.

A line is a file of its own that appears whole or not at all, so writing one line switches every
reader over at once, and needs no Spark job. Folding sums the lines so far up in one head file;
readers open the newest head and the lines written under it, however long the log has run. One
writer at a time owns a log."""

import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import SparkSession

FOLD = 50  # lines after which a log is worth folding

Line = dict[str, Any]


class SharedFiles:
    """Small files on whatever file system the cluster uses, through the driver's Hadoop client."""

    def __init__(self, spark: SparkSession) -> None:
        # Looked up once: every name of a package takes a call to the JVM
        fs = spark._jvm.org.apache.hadoop.fs
        self._path, self._context = fs.Path, fs.FileContext
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._conf = spark._jsc.hadoopConfiguration()
        rename = getattr(fs, "Options$Rename")
        self._over = spark.sparkContext._gateway.new_array(rename, 1)
        self._over[0] = rename.OVERWRITE

    def names(self, folder: str) -> list[str]:
        """The names in one folder, none where there is no folder."""
        path = self._path(folder)
        system = path.getFileSystem(self._conf)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def write(self, path: str, text: str) -> None:
        """Write a file aside and rename it, over one of that name if there is any."""
        target = self._path(path)
        aside = self._path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
        system = target.getFileSystem(self._conf)
        out = system.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not system.exists(target) and system.rename(aside, target):
            return
        self._context.getFileContext(target.toUri(), self._conf).rename(aside, target, self._over)

    def read(self, path: str) -> str:
        target = self._path(path)
        stream = target.getFileSystem(self._conf).open(target)
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        target = self._path(path)
        target.getFileSystem(self._conf).delete(target, True)


def delete_path(spark: SparkSession, path: str) -> None:
    SharedFiles(spark).delete(path)


class LineLog:
    """Lines by number, and a head for those that were folded.

    A line's file names the head it was written under. Once a newer head stands, the lines it took
    in count no more, whether their files are deleted yet or not; a line of a folded number that is
    written again stands beside the head, under its name."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.files = SharedFiles(spark)
        self.path = path

    def listing(self) -> tuple[int, int | None, dict[int, str]]:
        """The number of the head (0 without one), the last number it took in, and the files of
        the lines under it. Names only: nothing is opened."""
        names = [n for n in self.files.names(self.path) if n.endswith(".json")]
        heads = [n for n in names if n.startswith("head-")]
        head, last = 0, None
        if heads:
            head, last = map(int, max(heads).removesuffix(".json").split("-")[1:])
        mark = f"-{head:012d}.json"
        lines = {int(n.split("-")[1]): n for n in names if n.startswith("line-") and n.endswith(mark)}
        return head, last, lines

    def last(self) -> int | None:
        """The highest number written."""
        _, folded, lines = self.listing()
        return max([*lines, *([] if folded is None else [folded])], default=None)

    def write(self, number: int, line: Mapping[str, Any]) -> int:
        """Write or replace a line; returns how many lines stand beside the head now."""
        head, _, lines = self.listing()
        return self._put(number, line, head, lines)

    def append(self, line: Mapping[str, Any]) -> int:
        """Write a line under the next number; returns how many stand beside the head now."""
        head, folded, lines = self.listing()
        last = max([*lines, *([] if folded is None else [folded])], default=-1)
        return self._put(last + 1, line, head, lines)

    def _put(self, number: int, line: Mapping[str, Any], head: int, lines: Mapping[int, str]) -> int:
        self.files.write(f"{self.path}/line-{number:020d}-{head:012d}.json", json.dumps(line))
        return len({*lines, number})

    def read(self) -> tuple[Line, dict[int, Line]]:
        """The head ({} without one) and the lines beside it, in order of their numbers."""
        head, last, lines = self.listing()
        text = "{}" if last is None else self.files.read(f"{self.path}/{head_name(head, last)}")
        found = {n: json.loads(self.files.read(f"{self.path}/{lines[n]}")) for n in sorted(lines)}
        return json.loads(text), found

    def fold(self, merged: Callable[[Line, dict[int, Line]], Line]) -> None:
        """Replace the head and its lines by the head that `merged` makes of them."""
        number, last, lines = self.listing()
        if not lines:
            return
        head = merged(*self.read())
        upper = max([*lines, *([] if last is None else [last])])
        self.files.write(f"{self.path}/{head_name(number + 1, upper)}", json.dumps(head))
        for name in lines.values():
            self.files.delete(f"{self.path}/{name}")
        if last is not None:
            self.files.delete(f"{self.path}/{head_name(number, last)}")


def head_name(number: int, last: int) -> str:
    return f"head-{number:012d}-{last:020d}.json"
