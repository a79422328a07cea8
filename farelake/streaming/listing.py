"""A streaming source of trip files as they are listed: its offsets hold path, modification time and length of every file.

The file sources of Spark remember names, so a file that is published again under its name is not new to them. Here a file
whose time or length has changed is new, and a run also starts when a file has gone. Only names travel through the stream.
An offset holds the listing of the load calendar's files, a few per month, and a batch is the difference of two offsets, so a
batch that is repeated after a failure is the same.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.normalize import FILE_PATTERN

# The source runs in Python processes of its own, where the package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "trip_file_changes"


def list_paths(root: str, pattern: str) -> dict[str, list[int]]:
    """{path: [modification time in ns, length]} of the files below a folder; hidden files and other names are left out."""
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", root))
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True))
    return {info.path: [info.mtime_ns or 0, info.size or 0] for info in found
            if info.type == fs.FileType.File and re.search(pattern, info.path) and info.base_name[0] not in "._"}


class _Changed(InputPartition):
    def __init__(self, rows: list[tuple]):
        super().__init__(0)
        self.rows = rows


class FileChangesReader(DataSourceStreamReader):
    def __init__(self, root: str, pattern: str):
        self.root, self.pattern = root, pattern

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return list_paths(self.root, self.pattern)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Changed([(path, *about) for path, about in sorted(end.items()) if start.get(path) != about])]

    def read(self, partition: _Changed) -> Iterator[tuple]:
        yield from partition.rows


class FileChanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, modified_ns long, length long"

    def streamReader(self, schema) -> FileChangesReader:
        return FileChangesReader(self.options["path"], self.options.get("pattern", FILE_PATTERN))
