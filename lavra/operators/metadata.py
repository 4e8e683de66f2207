"""The metadata row of a record page: title, section and labelled fields in the 16 columns of a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions import text
from lavra.schemas import RECORD_FIELDS
from lavra.sources.html import page_title, read_page

# Fixed value: the source that a record names unless told otherwise.
SOURCE = "BDTD"


def metadata_rows(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = (), source: str = SOURCE) -> DataFrame:
    """(``keep``…, the 16 fields of a record) of every page: one reading of each, no shuffle.

    A null page has its address, id and source and nothing else. Multi-line values keep their first line, and an empty
    value takes the next line whatever it says, as on the catalogue's pages. Other columns of ``pages`` are ignored.
    """
    p = pages.select(*keep, F.col(url).alias("record_url"), read_page(html).alias("p"))
    p = p.select(*keep, "record_url", text.normalize_space(page_title(F.col("p.titles"), F.col("p.text"))).alias("title"), text.body_lines("p.text").alias("lines"))
    p = p.withColumn("lines", text.section(F.col("lines")))
    p = p.withColumn("pairs", text.labelled_pairs(F.col("lines")))
    own = {"record_id": text.record_id("record_url"), "source": F.lit(source), "record_url": F.col("record_url"), "title": F.col("title")}
    return p.select(*keep, *(own.get(c, text.field_of(F.col("pairs"), text.LABELS.get(c, []))).alias(c) for c in RECORD_FIELDS))


def inspected(pages: DataFrame, url: str = "url", html: str = "html", letters: int = 5000) -> DataFrame:
    """(url, title, body) of pages for a look at them: the page's title and the first ``letters`` of its visible lines."""
    p = pages.select(F.col(url).alias("url"), read_page(html).alias("p"))
    return p.select("url", "p.title", F.substring(F.array_join(text.body_lines("p.text"), "\n"), 1, letters).alias("body"))
