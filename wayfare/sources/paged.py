"""A batch source of paged documents, one partition for each run of pages.

The transport is a picklable function (url, parameters) -> list of JSON objects, so that
tests need no network; paging ends with the first short page."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

PAGE_SIZE = 3000
GUARD = 100_000

Fetch = Callable[[str, dict[str, str]], list[dict]]


class RunawaySource(RuntimeError):
    """A source that goes on past the guard."""


def read_pages(url: str, fetch: Fetch, first: int, step: int, size: int = PAGE_SIZE, guard: int = GUARD) -> Iterator[tuple[int, str]]:
    """(offset, document) of pages first, first + step, ... until one is short."""
    page = first
    while True:
        offset = page * size
        if offset > guard:
            raise RunawaySource(f"{url} goes on past {guard} documents")
        rows = fetch(url, {"$top": str(size), "$skip": str(offset), "$orderby": "UpdateTime", "$format": "JSON"})
        for k, row in enumerate(rows):
            yield offset + k, json.dumps(row, ensure_ascii=False)
        if len(rows) < size:
            return
        page += step


def paged_documents(spark: SparkSession, url: str, fetch: Fetch, readers: int = 4, size: int = PAGE_SIZE, guard: int = GUARD) -> DataFrame:
    """(offset, document) of all pages, read by so many tasks in turns; in no order."""

    def read(batches):
        import pandas as pd

        for batch in batches:
            for first in batch["id"]:
                rows = list(read_pages(url, fetch, int(first), readers, size, guard))
                yield pd.DataFrame(rows, columns=["offset", "document"])

    return spark.range(readers).repartition(readers, "id").mapInPandas(read, "offset long, document string")


class _Pages(InputPartition):
    def __init__(self, first: int, last: int | None, step: int):
        self.first, self.last, self.step = first, last, step


class _PagedReader(DataSourceReader):
    """Reads a service page by page. Comparisons of the offset with a number leave out pages; in a
    schema without offset, equalities of fields go to the service as $filter. Spark applies all
    of them again, so a service that passes over $filter gives the same rows."""

    def __init__(self, schema: StructType, options: dict[str, str], fetch: Fetch):
        self.names = [f.name for f in schema.fields]
        self.url, self.fetch = options["path"], fetch
        self.size, self.readers = int(options.get("pagesize", PAGE_SIZE)), int(options.get("readers", 4))
        self.guard = int(options.get("guard", GUARD))
        self.low, self.high, self.asked = 0, None, []
        self.by_offset = "offset" in self.names

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name, value = ".".join(getattr(f, "attribute", ())), getattr(f, "value", None)
            if name == "offset" and isinstance(value, int):
                if isinstance(f, GreaterThan | GreaterThanOrEqual | EqualTo):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, LessThan | LessThanOrEqual | EqualTo):
                    end = value + (not isinstance(f, LessThan))
                    self.high = end if self.high is None else min(self.high, end)
            # The service counts only what it is asked for: with offsets in play it is asked for all.
            elif isinstance(f, EqualTo) and isinstance(value, str | int) and not self.by_offset:
                quoted = "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value).lower()
                self.asked.append(f"{name.replace('.', '/')} eq {quoted}")
            yield f

    def partitions(self) -> list[InputPartition]:
        first, last = self.low // self.size, None if self.high is None else (self.high - 1) // self.size
        return [_Pages(first + k, last, self.readers) for k in range(self.readers) if last is None or first + k <= last] or [_Pages(0, -1, 1)]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        page = partition.first
        while partition.last is None or page <= partition.last:
            offset = page * self.size
            if offset > self.guard:
                raise RunawaySource(f"{self.url} goes on past {self.guard} documents")
            asked = {"$filter": " and ".join(self.asked)} if self.asked else {}
            rows = self.fetch(self.url, {"$top": str(self.size), "$skip": str(offset), "$orderby": "UpdateTime", "$format": "JSON", **asked})
            for k, row in enumerate(rows):
                known = {**row, "document": json.dumps(row, ensure_ascii=False), "offset": offset + k}
                yield tuple(known.get(name) for name in self.names)
            if len(rows) < self.size:
                return
            page += partition.step


def register_paged(spark: SparkSession, name: str, fetch: Fetch) -> None:
    """Let spark.read.format(name).load(url) read a paged service through fetch. Options: readers
    (tasks), pageSize, guard. The schema is offset and document, or, given by .schema(...), any
    of these and the documents' own fields. Where the schema has no offset, equalities of
    fields go to the service; where it has one, which counts all documents, they don't."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "offset long, document string"

        def reader(self, schema: StructType) -> DataSourceReader:
            return _PagedReader(schema, {k.lower(): v for k, v in self.options.items()}, fetch)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Paged)
