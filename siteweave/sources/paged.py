"""A data source of paged replies of a feature service, as a folder of landed pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Pages are files of this name; the number is the page's.
PAGE = re.compile(r"page-(\d+)\.json")
SCHEMA = "page long, objectid long, attributes string, x double, y double, more boolean"


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


class Page(InputPartition):
    def __init__(self, number: int, name: str) -> None:
        self.number, self.name = number, name


def landed(path: str) -> list[Page]:
    """The pages of a folder by number: one small entry each, no content."""
    from pyarrow import fs

    system, root = _files(_uri(path))
    names = [f.base_name for f in system.get_file_info(fs.FileSelector(root))]
    pages = [Page(int(m[1]), n) for n in names if (m := PAGE.fullmatch(n))]
    return sorted(pages, key=lambda p: p.number)


def read_page(path: str, page: Page) -> Iterator[tuple]:
    """The rows of one page; a reply that holds an error, although it was delivered, is one here. A page without features gives a
    row without an object id, so that its number and whether more follow are known."""
    system, root = _files(_uri(path))
    with system.open_input_stream(f"{root.rstrip('/')}/{page.name}") as f:
        reply = json.loads(f.read().decode())
    if not isinstance(reply, dict) or "error" in reply:
        raise ValueError(f"page {page.number} holds an error: {str(reply)[:200]}")
    more = bool(reply.get("exceededTransferLimit"))
    rows = reply.get("features") or []
    if not rows:
        yield (page.number, None, None, None, None, more)
    for row in rows:
        told, place = row.get("attributes") or {}, row.get("geometry") or {}
        number = lambda v: None if v is None else float(v)
        key = next((v for k, v in told.items() if k.lower() == "objectid"), None)
        yield (page.number, None if key is None else int(key), json.dumps(told, ensure_ascii=False), number(place.get("x")), number(place.get("y")), more)


class PagedFeatures(DataSource):
    """Format "paged_features", option path: each page is a partition; as a stream, pages that have come since the last batch."""

    @classmethod
    def name(cls) -> str:
        return "paged_features"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options["path"])


class _Batch(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return landed(self.path) or [Page(-1, "")]

    def read(self, partition: Page) -> Iterator[tuple]:
        return read_page(self.path, partition) if partition.name else iter(())


class _Stream(DataSourceStreamReader):
    """The offset is the number of the next page in an unbroken row of them: a page that comes late is waited for."""

    def __init__(self, path: str) -> None:
        self.path = path

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        there, n = {p.number for p in landed(self.path)}, 0
        while n in there:
            n += 1
        return {"page": n}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [p for p in landed(self.path) if start["page"] <= p.number < end["page"]]

    def read(self, partition: Page) -> Iterator[tuple]:
        return read_page(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


def paged_features(spark: SparkSession, path: str) -> DataFrame:
    """(page, objectid, attributes, x, y, more) of a folder's pages."""
    spark.dataSource.register(PagedFeatures)
    return spark.read.format("paged_features").option("path", path).load()


def stream_features(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream, which resumes at the first page not read."""
    spark.dataSource.register(PagedFeatures)
    return spark.readStream.format("paged_features").option("path", path).load()


def page_faults(features: DataFrame) -> DataFrame:
    """(page, fault) of pages out of order. They are numbered from 0 without a gap and ordered by object id: `missing` for a page whose
    follower isn't there although more follow, `after_the_end` for one that comes although none should, `overlap` where a page's ids
    don't lie above those of the page before, `unordered` where an id stands twice in its page. No rows: the landing is whole."""
    pages = features.groupBy("page").agg(F.min("objectid").alias("low"), F.max("objectid").alias("high"), F.bool_or("more").alias("more"), F.count("objectid").alias("n"), F.count_distinct("objectid").alias("different"))
    before = pages.select((F.col("page") + 1).alias("page"), F.col("high").alias("b_high"), F.col("more").alias("b_more"))
    met = pages.withColumn("_here", F.lit(True)).join(before, "page", "full")
    here = F.coalesce("_here", F.lit(False))
    fault = F.array_compact(F.array(
        F.when(~here & F.col("b_more"), "missing"), F.when(here & F.col("b_more").isNull() & (F.col("page") > 0), "missing"),
        F.when(here & ~F.col("b_more"), "after_the_end"), F.when(here & (F.col("low") <= F.col("b_high")), "overlap"), F.when(F.col("n") > F.col("different"), "unordered"),
    ))
    return met.select("page", F.explode(fault).alias("fault"))


def inspections_of(features: DataFrame) -> DataFrame:
    """(gid, rlat, rlon, fecha, evaluador) of a service's features, as load_inspections() gives them."""
    from siteweave.functions.text import global_id
    from siteweave.sources.readers import local_date

    told = F.from_json("attributes", "globalid string, fecha_inspeccion string, nombre_evaluador string")
    rows = features.where("attributes is not null").withColumn("_a", told)
    return rows.select(global_id(F.col("_a.globalid")).alias("gid"), F.col("y").alias("rlat"), F.col("x").alias("rlon"), F.date_format(local_date(F.col("_a.fecha_inspeccion")), "yyyy-MM-dd").alias("fecha"), F.col("_a.nombre_evaluador").alias("evaluador"))
