"""A paginated service as a Spark data source: in batch all pages, as a stream the page number is the offset.

`folder` holds page_<n>.json files (arrays of objects with id, date, name, agency, url), as a fetching provider leaves
them; the first page that is missing or empty ends the scan. Register with spark.dataSource.register(PagedComments).
The source opens pages as local files, as a mounted folder offers them; read_pages() reads any file system.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

FIELDS = ("id", "date", "name", "agency", "url")


def load_page(folder: str, page: int) -> list[tuple]:
    path = os.path.join(folder, f"page_{page}.json")
    if not os.path.exists(path):
        return []
    with open(path, encoding="utf-8") as f:
        return [(page, *(str(row.get(k) or "") for k in FIELDS)) for row in json.load(f)]


#: A file of fewer bytes may be an empty page, which only its content tells.
SMALL = 64


def page_run(folder: str, start: int) -> range:
    """The pages from `start` up to the first that is missing or empty. One listing; only tiny files are opened."""
    sizes = {e.name: e.stat().st_size for e in os.scandir(folder)} if os.path.isdir(folder) else {}
    page = start
    while (size := sizes.get(f"page_{page}.json")) is not None and (size >= SMALL or load_page(folder, page)):
        page += 1
    return range(start, page)


def read_pages(spark: SparkSession, folder: str, start: int = 1) -> DataFrame:
    """The same rows through Spark's own reader, for folders of any file system: page files are listed and parsed on the cluster."""
    raw = spark.read.text(f"{folder}/page_*.json", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"page_(\d+)\.json$", 1).cast("int").alias("page"), "value")
    pages = raw.select("page", F.from_json("value", f"array<struct<{','.join(f'{f}:string' for f in FIELDS)}>>").alias("rows")).where((F.size("rows") > 0) & (F.col("page") >= start))
    # The run ends before the smallest page whose predecessor is there and which is not, or which is the start itself.
    numbers = pages.select("page").unionByName(spark.range(start - 1, start).select(F.col("id").cast("int").alias("page")))
    after = numbers.select((F.col("page") + 1).alias("page")).join(pages.select("page"), "page", "left_anti").agg(F.min("page").alias("_end"))
    kept = pages.join(F.broadcast(after), F.col("page") < F.col("_end"))
    return kept.select("page", F.explode("rows").alias("r")).select("page", *[F.coalesce(f"r.{f}", F.lit("")).alias(f) for f in FIELDS])


class _Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.start = options["folder"], int(options.get("startPage", "1"))

    def partitions(self):
        return [_Page(n) for n in page_run(self.folder, self.start)] or [_Page(self.start)]

    def read(self, partition):
        yield from load_page(self.folder, partition.number)


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.folder, self.start = options["folder"], int(options.get("startPage", "1"))

    def initialOffset(self):
        return {"page": self.start}

    def read(self, start):
        rows = load_page(self.folder, start["page"])
        return iter(rows), {"page": start["page"] + bool(rows)}

    def readBetweenOffsets(self, start, end):
        for page in range(start["page"], end["page"]):
            yield from load_page(self.folder, page)


class PagedComments(DataSource):
    """Name: paged_comments. Options: folder, startPage (default 1)."""

    @classmethod
    def name(cls):
        return "paged_comments"

    def schema(self):
        return "page int, " + ", ".join(f"{f} string" for f in FIELDS)

    def reader(self, schema):
        return _Reader(self.options)

    def simpleStreamReader(self, schema):
        return _Stream(self.options)
