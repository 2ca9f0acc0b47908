"""Files that grow in place, as a stream of lines: spark.readStream.format("tail").load("/folder/*.log").

An offset names, for each file, the bytes that were read and a fingerprint of the file's first bytes, so that a file that
was cut off or replaced begins anew, and one that was renamed goes on where it stopped. A batch ends at a line's end; a
last line without one waits until it is whole. Each trigger takes a bounded number of bytes from each file, cut into
parts that executors read by themselves, so a large file is read in parallel. (The first trigger after a start takes all
there is, as the source learns where it stands only then.) A row has its file and byte offset: the
place of the evidence. Files are reached through Arrow's file systems, by a path or a URI that all nodes can open.

Defined results: an empty line is a row of no bytes; a line ends with a line feed, and a carriage return before it goes;
a line longer than max_bytes is taken whole once it is complete; a missing folder, and a file that vanishes before its
last batch was read, give no rows. A file that is cut off and grows beyond its old length with the same first bytes
between two triggers can't be told from one that only grew.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import zlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that tell a file from another, bytes of a file in a trigger, of a part, and of a look back for a line's end.
HEAD, MOST, PART, BACK = 256, 256 << 20, 16 << 20, 1 << 20
SCHEMA = "path string, position long, value binary"


def _opened(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)


def _read(fs, path: str, start: int, size: int) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read_at(max(0, min(size, f.size() - start)), start) if start < f.size() else b""


def _fingerprint(fs, path: str, size: int) -> int:
    return zlib.crc32(_read(fs, path, 0, size))


class Part(InputPartition):
    """Lines that begin in [start, stop) of a file; its batch ends at end."""

    def __init__(self, path: str, start: int, stop: int, begin: int, end: int, head: int, mark: int):
        self.path, self.start, self.stop, self.begin, self.end, self.head, self.mark = path, start, stop, begin, end, head, mark


class TailReader(DataSourceStreamReader):
    def __init__(self, pattern: str, most: int, part: int):
        self.pattern, self.most, self.part = pattern, most, part

    #: What the last offset says of each file: bytes read, and length and fingerprint of its head; None until that is known.
    last: dict[str, list[int]] | None = None

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def _found(self) -> dict[str, int]:
        from pyarrow.fs import FileSelector, FileType

        fs, pattern = _opened(self.pattern)
        folder, name = posixpath.split(pattern)
        found = fs.get_file_info(FileSelector(folder, allow_not_found=True))
        return {i.path: i.size for i in found if i.type == FileType.File and fnmatch.fnmatch(posixpath.basename(i.path), name)}

    def _last_end(self, fs, path: str, start: int, size: int) -> int:
        """Where the last whole line before size ends, from start on."""
        at = size
        while at > start:
            low = max(start, at - BACK)
            end = _read(fs, path, low, at - low).rfind(b"\n")
            if end >= 0:
                return low + end + 1
            at = low
        return start

    def _next_end(self, fs, path: str, start: int, size: int) -> int:
        """Where the first line from start on ends; start if it isn't whole."""
        at = start
        while at < size:
            end = _read(fs, path, at, min(BACK, size - at)).find(b"\n")
            if end >= 0:
                return at + end + 1
            at += BACK
        return start

    def _begin(self, fs, path: str, before: dict[str, list[int]], found: dict[str, int]) -> int:
        """Where a file goes on: after what was read of it, under this name or, if another file has taken its place, under a former one."""

        def holds(name: str, known: list[int]) -> bool:
            return found.get(name, -1) >= known[0] and _fingerprint(fs, name, known[1]) == known[2]

        if path in before and holds(path, before[path]):
            return before[path][0]
        return next((k[0] for name, k in before.items() if name != path and k[0] and holds(path, k) and not holds(name, k)), 0)

    def latestOffset(self) -> dict:
        """Of each file that is there: [end of its last whole line, head, fingerprint, where the batch begins], the last -1 while that is unknown."""
        fs, _ = _opened(self.pattern)
        found, now = self._found(), {}
        for path, size in sorted(found.items()):
            begin = -1 if self.last is None else self._begin(fs, path, self.last, found)
            start = max(0, begin)
            end = self._last_end(fs, path, start, size if begin < 0 else min(size, start + self.most))
            if end == start and size - start > self.most:
                end = self._next_end(fs, path, start, size)
            head = min(HEAD, end)
            mark = _fingerprint(fs, path, head)
            old = (self.last or {}).get(path)
            now[path] = old if old and old[:3] == [end, head, mark] else [end, head, mark, begin]
        self.last = now
        return {"files": json.dumps(now, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        fs, _ = _opened(self.pattern)
        before, now = json.loads(start["files"]), json.loads(end["files"])
        found = self._found() if any(k[3] < 0 for k in now.values()) else {}
        self.last, out = now, []
        for path, (stop, head, mark, begin) in sorted(now.items()):
            if before.get(path) == now[path]:
                continue
            low = self._begin(fs, path, before, found) if begin < 0 else begin
            out += [Part(path, a, min(a + self.part, stop), low, stop, head, mark) for a in range(low, stop, self.part)]
        return out

    def read(self, p: Part) -> Iterator[tuple]:
        fs, _ = _opened(self.pattern)
        path = p.path
        try:
            if _fingerprint(fs, path, p.head) != p.mark:
                raise FileNotFoundError(path)
        except FileNotFoundError:  # renamed since, or gone
            path = next((q for q in self._found() if _fingerprint(fs, q, p.head) == p.mark), None)
            if path is None:
                return
        # a line belongs to the part in which it begins: the one that a part begins within belongs to the part before
        at = p.start if p.start == p.begin else self._next_end(fs, path, p.start - 1, p.end)
        while at < p.stop:
            chunk = _read(fs, path, at, min(max(BACK, p.stop - at), p.end - at))
            cut = chunk.rfind(b"\n") + 1
            if not cut:
                cut = self._next_end(fs, path, at, p.end) - at
                chunk = _read(fs, path, at, cut)
            position = at
            for line in chunk[:cut].split(b"\n")[:-1]:
                if position >= p.stop:
                    return
                yield p.path, position, line.removesuffix(b"\r")
                position += len(line) + 1
            at = position


class TailSource(DataSource):
    """Options: path (a folder and a pattern of file names), max_bytes of a file in a trigger, part_bytes of a task."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], int(self.options.get("max_bytes", MOST)), int(self.options.get("part_bytes", PART)))


def tail(spark: SparkSession, path: str, max_bytes: int = MOST, part_bytes: int = PART):
    """A stream (path, position, value) of the lines of files that grow."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail").option("max_bytes", max_bytes).option("part_bytes", part_bytes).load(path)
