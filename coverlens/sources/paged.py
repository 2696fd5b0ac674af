"""A landed feed of pages that name each other: every page tells the token of the next.

A page is the folder page=<token> with one or more text files.  Its first line is a header, a JSON object
with the token of the ``next`` page (or null); the others are records, one JSON object a line.  The chain starts at
the page ``first``.  A page that has not landed yet ends it for now, and so does a token that came before.

Data source ``paged_feed`` reads it in batch or as a stream, whose offset is the token of the last page read.  Planning
reads headers only; pages are read by tasks.  Nothing here opens a network connection but the file system's own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from coverlens import schemas as S

NAME, FIRST = "paged_feed", "first"


class Pages:
    """The page folders below a path of any file system that Arrow knows."""

    def __init__(self, path: str, first: str) -> None:
        self.path, self.first = path.rstrip("/"), first

    def _files(self, token: str) -> tuple[pafs.FileSystem, list[str]]:
        system, root = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        found = system.get_file_info(pafs.FileSelector(f"{root}/page={token}", allow_not_found=True))
        names = sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", ".")))
        return system, names

    def next(self, token: str | None) -> str | None:
        """The token after a page, the first one for None; None where the chain ends for now."""
        if token is None:
            following = self.first
        else:
            system, names = self._files(token)
            if not names:
                return None
            with system.open_input_stream(names[0], buffer_size=4096) as stream:
                head = b""
                while b"\n" not in head and (more := stream.read(4096)):
                    head += more
            following = json.loads(head.split(b"\n", 1)[0]).get("next")
        return following if following and self._files(following)[1] else None

    def chain(self, after: str | None, seen: set[str], limit: int | None = None) -> list[str]:
        """Tokens of the pages after one, in order; ``seen`` ends the chain and grows with it."""
        out: list[str] = []
        while limit is None or len(out) < limit:
            after = self.next(after)
            if after is None or after in seen:
                break
            seen.add(after)
            out.append(after)
        return out

    def records(self, token: str) -> Iterator[dict]:
        """Records of a page; a line that is no JSON object counts as one without any field."""
        system, names = self._files(token)
        header = True
        for name in names:
            with system.open_input_stream(name) as stream, pa.PythonFile(stream, mode="r") as file:
                rest = b""
                while True:
                    block = file.read(1 << 20)
                    lines = (rest + block).split(b"\n")
                    rest = lines.pop() if block else b""
                    for line in lines:
                        if header:
                            header = False
                        elif line.strip():
                            yield _record(line)
                    if not block:
                        break


def _record(line: bytes) -> dict:
    try:
        found = json.loads(line)
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


class Page(InputPartition):
    def __init__(self, token: str) -> None:
        super().__init__(token)
        self.token = token


def _rows(pages: Pages, schema: T.StructType, page: Page | None, batch_rows: int = 5_000) -> Iterator[pa.RecordBatch]:
    if page is None:  # Spark reads one partition of a source that has none
        return
    types = pa.schema([(name, pa.string()) for name in schema.names])
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
    rows: list[dict] = []
    for record in pages.records(page.token):
        rows.append({name: text(record.get(name)) for name in schema.names})
        if len(rows) == batch_rows:
            yield pa.RecordBatch.from_pylist(rows, types)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, types)


class PagedReader(DataSourceReader):
    def __init__(self, pages: Pages, schema: T.StructType) -> None:
        self.pages, self.schema = pages, schema

    def partitions(self) -> list[InputPartition]:
        return [Page(token) for token in self.pages.chain(None, set())]

    def read(self, partition: Page | None) -> Iterator[pa.RecordBatch]:
        return _rows(self.pages, self.schema, partition)


class PagedStreamReader(DataSourceStreamReader):
    """Offsets: {"after": token of the last page read, or null}."""

    def __init__(self, pages: Pages, schema: T.StructType, pages_per_batch: int | None) -> None:
        self.pages, self.schema, self.limit = pages, schema, pages_per_batch
        self.order: list[str] = []   # pages known so far, in order
        self.seen: set[str] = set()
        self.read_to = 0             # of them planned by Spark

    def initialOffset(self) -> dict:
        return {"after": None}

    def latestOffset(self) -> dict:
        self.order += self.pages.chain(self.order[-1] if self.order else None, self.seen)
        end = len(self.order) if self.limit is None else min(len(self.order), self.read_to + self.limit)
        return {"after": self.order[end - 1] if end else None}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["after"] not in self.seen:  # a restarted query plans what it planned before
            self.order += self.pages.chain(self.order[-1] if self.order else None, self.seen)
        place = {token: i + 1 for i, token in enumerate(self.order)}
        first, self.read_to = place.get(start["after"], 0), place[end["after"]] if end["after"] else 0
        return [Page(token) for token in self.order[first:self.read_to]]

    def read(self, partition: Page | None) -> Iterator[pa.RecordBatch]:
        return _rows(self.pages, self.schema, partition)

    def commit(self, end: dict) -> None:
        pass


class PagedFeed(DataSource):
    """Options: path; first (token of the first page); pagesPerBatch (streams).  Fields are read as strings."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return S.FEED

    def _pages(self) -> Pages:
        return Pages(self.options["path"], self.options.get("first", FIRST))

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(self._pages(), schema)

    def streamReader(self, schema: T.StructType) -> PagedStreamReader:
        limit = self.options.get("pagesperbatch", self.options.get("pagesPerBatch"))
        return PagedStreamReader(self._pages(), schema, int(limit) if limit else None)


def _as_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.names])


def read_pages(spark: SparkSession, path: str, schema: T.StructType = S.FEED, first: str = FIRST) -> DataFrame:
    """The records of all pages of the chain that have landed."""
    spark.dataSource.register(PagedFeed)
    rows = spark.read.format(NAME).schema(_as_strings(schema)).option("first", first).load(path)
    return S.conform(rows, schema)


def stream_pages(spark: SparkSession, path: str, schema: T.StructType = S.FEED, first: str = FIRST,
                 pages_per_batch: int | None = None) -> DataFrame:
    """The same as a stream that goes on from the last page read."""
    spark.dataSource.register(PagedFeed)
    reader = spark.readStream.format(NAME).schema(_as_strings(schema)).option("first", first)
    if pages_per_batch:
        reader = reader.option("pagesPerBatch", str(pages_per_batch))
    return S.conform(reader.load(path), schema)
