"""Connectors of published files as Spark data sources, batch and stream.

Every connector gives the same rows, ``source_id, page, place, record``: the file, the place of
a record in it from 1, and the record as JSON, which ``conform`` or ``from_json`` types. What
differs is how a page is read (``records``). Pages are planned as one partition each, lines
files as ranges of bytes; a filter on the page or place is pushed into the plan. As a stream,
pages are taken in the order of their names, and the offset is the last one taken: pages do
not change once they are there.

    register(spark)
    spark.read.format("paged_json").option("source_id", "votes").load("/shared/votes")

Paths are those that pyarrow opens on all machines. A page that is no JSON fails its task;
broken lines of a lines file come as records with the text under ``_malformed``.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from .readers import RECORD_FIELDS

#: Bytes of a lines file in one partition.
RANGE = 16 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


@dataclass
class Piece(InputPartition):
    page: str
    start: int
    stop: int


class Connector(DataSource):
    """What all connectors share. A subclass names its format, the end of its files' names,
    and how a page becomes records."""

    ending = ".json"
    by_range = False

    @classmethod
    def records(cls, page: object) -> Iterator[object]:
        raise NotImplementedError

    def schema(self) -> str:
        return "source_id string, page string, place bigint, record string"

    def reader(self, schema) -> Reader:
        return Reader(type(self), dict(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(type(self), dict(self.options))

    @classmethod
    def pages(cls, path: str) -> list[tuple[str, int]]:
        """Names and sizes of the pages of a folder, in the order of their names."""
        fs, root = _open(path)
        found = fs.get_file_info(pafs.FileSelector(root))
        return sorted((i.base_name, i.size) for i in found if i.type == pafs.FileType.File and i.base_name.endswith(cls.ending) and i.base_name[0] not in "._")

    @classmethod
    def pieces(cls, pages: list[tuple[str, int]]) -> list[Piece]:
        step = RANGE if cls.by_range else 1 << 62
        return [Piece(name, at, min(size, at + step)) for name, size in pages for at in range(0, max(1, size), step)]

    @classmethod
    def rows(cls, options: dict, piece: Piece) -> Iterator[tuple]:
        fs, root = _open(options["path"])
        with fs.open_input_file(f"{root}/{piece.page}") as f:
            page = json.loads(f.read())
        for k, record in enumerate(cls.records(page)):
            yield options.get("source_id"), piece.page, k + 1, json.dumps(record, ensure_ascii=False, sort_keys=True)


class PagedJson(Connector):
    """``paged_json``: the objects of an array, of the list under a known field, else of the
    first list with one; else the document."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    @classmethod
    def records(cls, page: object) -> Iterator[object]:
        lists = [page] if isinstance(page, list) else []
        if isinstance(page, dict):
            lists = [page[f] for f in RECORD_FIELDS if isinstance(page.get(f), list)][:1]
            lists = lists or [v for v in page.values() if isinstance(v, list) and any(isinstance(x, dict) for x in v)][:1] or [[page]]
        return (x for found in lists for x in found if isinstance(x, dict))


class StatCube(Connector):
    """``stat_cube``: the cells of a cube in JSON-stat form, each with the codes of its
    dimensions; a cell that is not there or null gives no record."""

    @classmethod
    def name(cls) -> str:
        return "stat_cube"

    @classmethod
    def records(cls, page: dict) -> Iterator[object]:
        codes = []
        for dimension, size in zip(page["id"], page["size"], strict=True):
            index = page["dimension"][dimension]["category"].get("index", range(size))
            codes.append(sorted(index, key=index.get) if isinstance(index, dict) else list(index))
        values = page["value"]
        for flat, value in sorted((int(k), v) for k, v in values.items()) if isinstance(values, dict) else enumerate(values):
            if value is None:
                continue
            cell, rest = {}, flat
            for dimension, own in zip(reversed(page["id"]), reversed(codes), strict=True):
                rest, at = divmod(rest, len(own))
                cell[dimension] = own[at]
            yield cell | {"value": value}


class JsonLines(Connector):
    """``json_lines``: one record a line, read in ranges of bytes. A line belongs to the range
    that it begins in; its place is the byte that it begins at, plus 1."""

    ending, by_range = ".jsonl", True

    @classmethod
    def name(cls) -> str:
        return "json_lines"

    @classmethod
    def rows(cls, options: dict, piece: Piece) -> Iterator[tuple]:
        fs, root = _open(options["path"])
        with io.BufferedReader(fs.open_input_file(f"{root}/{piece.page}")) as f:
            at = max(0, piece.start - 1)
            f.seek(at)
            if piece.start:  # the line that the byte before belongs to is not ours
                at += len(f.readline())
            while at < piece.stop and (line := f.readline()):
                text = line.decode("utf-8", "replace").strip()
                if text:
                    try:
                        record = json.loads(text)
                    except ValueError:
                        record = {"_malformed": text}
                    yield options.get("source_id"), piece.page, at + 1, json.dumps(record, ensure_ascii=False, sort_keys=True)
                at += len(line)


CONNECTORS = (PagedJson, StatCube, JsonLines)


class Reader(DataSourceReader):
    def __init__(self, kind: type[Connector], options: dict):
        self.kind, self.options, self.tests = kind, options, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of the page or the place are done here, all others by Spark."""
        for f in filters:
            known = isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute in (("page",), ("place",))
            if known:
                self.tests.append(f)
            else:
                yield f

    def _passes(self, column: str, value: object) -> bool:
        own = [f for f in self.tests if f.attribute == (column,)]
        return all(_holds(f, value) for f in own)

    def partitions(self) -> list[InputPartition]:
        pages = [p for p in self.kind.pages(self.options["path"]) if self._passes("page", p[0])]
        return self.kind.pieces(pages) or [Piece("", 0, 0)]

    def read(self, piece: Piece) -> Iterator[tuple]:
        if piece.page:
            yield from (row for row in self.kind.rows(self.options, piece) if self._passes("place", row[2]))


def _holds(f: Filter, value) -> bool:
    if isinstance(f, In):
        return value in f.value
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
        return value > f.value or (isinstance(f, GreaterThanOrEqual) and value == f.value)
    return value < f.value or (isinstance(f, LessThanOrEqual) and value == f.value)


class StreamReader(DataSourceStreamReader):
    def __init__(self, kind: type[Connector], options: dict):
        self.kind, self.options = kind, options

    def initialOffset(self) -> dict:
        return {"page": ""}

    def latestOffset(self) -> dict:
        pages = self.kind.pages(self.options["path"])
        return {"page": pages[-1][0] if pages else ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        new = [p for p in self.kind.pages(self.options["path"]) if start["page"] < p[0] <= end["page"]]
        return self.kind.pieces(new)

    def read(self, piece: Piece) -> Iterator[tuple]:
        yield from self.kind.rows(self.options, piece)


def register(spark: SparkSession) -> None:
    """Makes the connectors known to a session, filters included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for kind in CONNECTORS:
        spark.dataSource.register(kind)


def land(path: str, files: Iterable[tuple[str, str]]) -> None:
    """Writes pages under their names, each whole by one rename."""
    fs, root = _open(path)
    fs.create_dir(root, recursive=True)
    for name, text in files:
        with fs.open_output_stream(f"{root}/.{name}") as f:
            f.write(text.encode())
        fs.move(f"{root}/.{name}", f"{root}/{name}")
