"""A Spark data source for JSON arrays of flat objects, read in byte ranges.

Spark's own reader takes such a file whole in one task, as only a parser that has seen the
beginning knows where records stand.  Records without nested objects can be found from any
byte: inside a JSON string every quote is escaped, so a brace within a text never begins
something that parses as an object with a key.  A record belongs to the range that its brace
lies in.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "json_objects"
RANGE_BYTES = 8 << 20
#: A record whose end is not found within this many bytes behind its range fails the task.
LONGEST_RECORD = 64 << 20

_RECORD = re.compile(rb'\{(?:[^"{}]|"(?:[^"\\]|\\.)*")*\}', re.S)
_READ = 1 << 20


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int

    def __hash__(self) -> int:
        return hash((self.path, self.begin))


def _opened(path: str):
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file or of the files below a folder; names that begin with _ or . are not data."""
    from pyarrow import fs

    system, inner = _opened(path)
    info = system.get_file_info(inner)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    scheme = path.split("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    return sorted((scheme + f.path, f.size) for f in found if f.type == fs.FileType.File and f.size and f.base_name[0] not in "_.")


def records(read, begin: int, end: int, size: int) -> Iterator[dict]:
    """Objects whose brace lies in [begin, end); read(at, n) gives the file's bytes."""
    held, base = b"", begin  # held[0] is the file's byte `base`
    at, upto = 0, begin
    while True:
        brace = held.find(b"{", at)
        if brace < 0:
            if base + len(held) >= min(end, size):
                return
            base, held, at = base + len(held), b"", 0
        elif base + brace >= end:
            return
        else:
            found = _RECORD.match(held, brace)
            if found:
                try:
                    value = json.loads(found.group())
                except ValueError:
                    value = None
                if value:
                    yield value
                    at = found.end()
                else:
                    at = brace + 1
                continue
            if held.find(b"{", brace + 1) >= 0 and base + len(held) >= size:
                at = brace + 1
                continue
            if base + len(held) >= size:
                return
            if len(held) - brace > LONGEST_RECORD:
                raise ValueError(f"no end of the record at byte {base + brace}")
            base, held, at = base + brace, held[brace:], 0
        upto = base + len(held)
        held += read(upto, max(_READ, len(held)))


def _typed(value, kind: T.DataType):
    """The value as the field's type, or None where it is of another kind."""
    if value is None or isinstance(value, (list, dict)):
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(value, bool) or isinstance(value, str):
        return None
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return int(value) if float(value).is_integer() else None
    return float(value)


class ObjectReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        return [Range(path, at, min(at + self.bytes, size)) for path, size in _files(self.path) for at in range(0, size, self.bytes)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.path:
            return
        folders = dict(p.split("=", 1) for p in part.path.split("/")[:-1] if "=" in p)
        system, inner = _opened(part.path)
        with system.open_input_file(inner) as file:
            size = file.size()

            def some(at: int, n: int) -> bytes:
                return file.read_at(min(n, size - at), at) if at < size else b""

            for value in records(some, part.begin, part.end, size):
                yield tuple(_typed(value.get(f.name, folders.get(f.name)), f.dataType) for f in self.schema.fields)


class JsonObjects(DataSource):
    """Options: path, rangebytes.  The schema is the caller's; fields named like a ``key=value``
    folder of a file's path take its value where the record has none."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise ValueError("name the fields to read: .schema(...)")

    def reader(self, schema: T.StructType) -> ObjectReader:
        return ObjectReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_objects(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per object of the array(s) in a file, or in all files below a folder.

    Ranges of ``range_bytes`` are read by as many tasks.  Fields that are missing or of another
    type are NULL; what does not parse as an object is passed over; empty objects give no row.
    """
    spark.dataSource.register(JsonObjects)
    return spark.read.format(NAME).schema(schema).option("path", path).option("rangebytes", range_bytes).load()
