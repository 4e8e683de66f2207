"""Link discovery: first occurrences, stop rules and limits over recorded pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions.urls import resolve

RECORD_PATH = "/vufind/Record/"


def record_links(links: DataFrame, href: str, site: str, path: str = RECORD_PATH) -> DataFrame:
    """Links whose address holds ``path`` (case counts), resolved against the site; null and empty ones go."""
    return links.where((F.col(href) != "") & F.contains(F.col(href), F.lit(path))).withColumn("url", resolve(F.lit(site), href))


def first_occurrences(links: DataFrame, url: str, order: list[str]) -> DataFrame:
    """Each address once, with the row that comes first in ``order``; ties beyond ``order`` are equal rows.

    An aggregate, not a window: copies of a popular address meet as partial minima, never as rows of one task.
    """
    rest = [c for c in links.columns if c != url and c not in order]
    row = F.struct(*order, *rest)
    return links.groupBy(url).agg(F.min(row).alias("_first")).select(url, "_first.*")


def stop_rule(links: DataFrame, pages: DataFrame, search: list[str], url: str = "url") -> DataFrame:
    """(``search``…, page_no, n_found, n_new, n_total, kept): pages until the first that failed or brought nothing new.

    ``links`` has (search…, page_no, pos, url); ``pages`` (search…, page_no, ok). ``n_total`` runs over the pages of a
    search. New links are those of a page that no earlier page of the search has.
    """
    once = links.groupBy(*search, "page_no", url).agg(F.min("pos").alias("pos"))
    first = once.groupBy(*search, url).agg(F.min("page_no").alias("first"))
    per = once.join(first, [*search, url]).groupBy(*search, "page_no").agg(F.count("*").alias("n_found"), F.count_if(F.col("page_no") == F.col("first")).alias("n_new"))
    p = pages.join(per, [*search, "page_no"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_found", "n_new")})
    stop = p.where(~F.col("ok") | (F.col("n_new") == 0)).groupBy(*search).agg(F.min("page_no").alias("stop"))
    total = F.sum("n_new").over(Window.partitionBy(*search).orderBy("page_no"))
    out = p.join(stop, search, "left").withColumn("n_total", total)
    return out.select(*search, "page_no", "n_found", "n_new", "n_total", (F.col("stop").isNull() | (F.col("page_no") < F.col("stop"))).alias("kept"))


def limited(links: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in order; 0 gives none. Each partition sends its own first ``n`` at most."""
    return links.orderBy(*order).limit(max(n, 0))
