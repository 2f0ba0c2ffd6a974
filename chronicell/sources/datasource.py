"""A Spark data source for binary log files: one partition for each file in batches, offsets (file, position) in streams.

    spark.dataSource.register(ChangeLogSource)
    spark.read.format("change_log").load("/logs")
    spark.readStream.format("change_log").option("startFile", "binlog.000007").option("startPosition", 4).load("hdfs://nn/logs")

Paths may be of any file system that Arrow opens (local, HDFS, S3). Files are taken in the order of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from chronicell.sources.binlog import RAW_SCHEMA

_FIELDS = [c.split()[0] for c in RAW_SCHEMA.split(", ") if not c.startswith("rows")] + ["rows"]


class LogPart(InputPartition):
    def __init__(self, path: str, name: str, start: int, stop: int | None):
        super().__init__(path)
        self.path, self.name, self.start, self.stop = path, name, start, stop


def _open(path: str):
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return where.open_input_file(inner)


def _files(path: str) -> list[tuple[str, str]]:
    """(name, path) of the logs in a folder, in order; a path that is a file is one log."""
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    found = where.get_file_info(inner)
    infos = [found] if found.is_file else where.get_file_info(fs.FileSelector(inner))
    prefix = path.split("://")[0] + "://" if "://" in path else ""
    logs = [i for i in infos if i.is_file and not i.base_name.startswith((".", "_")) and not i.base_name.endswith(".index")]
    return sorted((i.base_name, prefix + i.path) for i in logs)


def _read(part: LogPart) -> Iterator[tuple]:
    from chronicell.sources.logfile import read_events

    with _open(part.path) as file:
        for event in read_events(file, part.name, part.start, part.stop):
            yield tuple(event.get(f) for f in _FIELDS)


class ChangeLogSource(DataSource):
    """Options: path; startFile and startPosition, where events up to the position of the file are left out."""

    @classmethod
    def name(cls) -> str:
        return "change_log"

    def schema(self) -> str:
        return RAW_SCHEMA

    def _start(self) -> tuple[str, int]:
        return self.options.get("startfile", ""), int(self.options.get("startposition", "4"))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._start())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], self._start())


class _Reader(DataSourceReader):
    def __init__(self, path: str, start: tuple[str, int]):
        self.path, self.start = path, start

    def partitions(self) -> list[LogPart]:
        file, position = self.start
        return [LogPart(path, name, position if name == file else 4, None) for name, path in _files(self.path) if name >= file]

    def read(self, partition: LogPart) -> Iterator[tuple]:
        return _read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, start: tuple[str, int]):
        self.path, self.start = path, start
        self.end: tuple[str, int] = start

    def initialOffset(self) -> dict:
        return {"file": self.start[0], "position": self.start[1]}

    def latestOffset(self) -> dict:
        """The last whole event of the last file; only the headers of what is new are read."""
        from chronicell.sources.logfile import last_boundary

        files = _files(self.path)
        if files and files[-1][0] >= self.end[0]:
            name, path = files[-1]
            with _open(path) as file:
                self.end = (name, last_boundary(file, self.end[1] if name == self.end[0] else 4))
        return {"file": self.end[0], "position": self.end[1]}

    def partitions(self, start: dict, end: dict) -> list[LogPart]:
        a, b = ((o["file"], o["position"]) for o in (start, end))
        self.end = max(self.end, b)
        return [LogPart(path, name, a[1] if name == a[0] else 4, b[1] if name == b[0] else None) for name, path in _files(self.path) if a[0] <= name <= b[0]]

    def read(self, partition: LogPart) -> Iterator[tuple]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        pass
