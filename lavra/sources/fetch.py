"""Live fetching as a Python data source: (url, attempt, channel, status, content_type, body).

``spark.read.format("lavra_fetch").option("urls", "\\n".join(...)).load()`` after ``register(spark)``; larger sets go
through :func:`fetched`, which fetches where the rows are. Certificates are always verified, attempts are bounded, and
an error is a row without a status, not a failed task.
"""

from __future__ import annotations

import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lavra.sources.html import read_page

SCHEMA = "url string, attempt int, channel string, status int, content_type string, body binary"


def fetch(url: str, attempts: int = 2, timeout: float = 20.0, pages: bool = False) -> Iterator[tuple]:
    """Rows of the attempts at one address, ending with the first below 400 that is a PDF, or (``pages``) anything."""
    for n in range(1, attempts + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                status, kind, body = r.status, r.headers.get("Content-Type"), r.read()
        except Exception as e:  # network errors are data here
            yield url, n, "requests", getattr(e, "code", None), None, None
            continue
        yield url, n, "requests", status, kind, body
        if status < 400 and (pages or body[:4] == b"%PDF" or "application/pdf" in (kind or "").lower()):
            return


def browse(url: str, timeout: float = 20.0) -> Iterator[tuple]:
    """The row of one attempt through a browser's own requests; without a browser library a row without a status."""
    try:
        from playwright.sync_api import sync_playwright

        with sync_playwright() as p:
            browser = p.chromium.launch()
            r = browser.new_context().request.get(url, timeout=timeout * 1000)
            row = url, 1, "browser", r.status, r.headers.get("content-type"), r.body()
            browser.close()
    except Exception:  # errors are data here
        row = url, 1, "browser", None, None, None
    yield row


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.attempts, self.timeout, self.parts = int(options.get("attempts", 2)), float(options.get("timeout", 20)), int(options.get("partitions", 8))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.urls[i :: self.parts]) for i in range(min(self.parts, len(self.urls)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for u in partition.value:
            yield from fetch(u, self.attempts, self.timeout)


class FetchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lavra_fetch"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FetchSource)


def fetched(urls: DataFrame, url: str = "url", attempts: int = 2, timeout: float = 20.0, pages: bool = False, channel: str = "requests") -> DataFrame:
    """The responses for the addresses of a column, fetched partition by partition, by plain requests or a browser."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([r for u in b[url] for r in (browse(u, timeout) if channel == "browser" else fetch(u, attempts, timeout, pages))], columns=["url", "attempt", "channel", "status", "content_type", "body"])

    return urls.select(url).mapInPandas(run, SCHEMA)


def opened(addresses: DataFrame, responses: DataFrame) -> DataFrame:
    """(url, ok, page_url, title, body, html, anchors): each address with the page of its first response below 400.

    ``ok`` is false where there is none; a search ends there (see ``discovery.stop_rule``). The page's address is the
    asked one: where a response was redirected, its final address isn't recorded.
    """
    good = responses.where(F.col("status") < 400).groupBy("url").agg(F.min_by("body", F.struct("attempt", "channel")).alias("body"))
    p = addresses.select("url").distinct().join(good, "url", "left").withColumn("html", F.decode("body", "UTF-8")).withColumn("p", read_page("html"))
    return p.select("url", F.col("body").isNotNull().alias("ok"), F.col("url").alias("page_url"), "p.title", F.col("p.text").alias("body"), "html", "p.anchors")
