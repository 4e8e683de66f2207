"""Candidate addresses of a page: collected, scored, each once, ranked and cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions.rules import score_a, score_b

TRIED = 15


def candidates_a(links: DataFrame, page: str, url: str = "url") -> DataFrame:
    """(page, url, score) with a score above 0, each address once; equal scores by address."""
    scored = links.withColumn("score", score_a(F.col(url))).where("score > 0")
    return scored.groupBy(page, url).agg(F.max("score").alias("score"))


def candidates_b(links: DataFrame, page: str, url: str = "url", text: str = "text", order: tuple[str, ...] = ("src", "pos")) -> DataFrame:
    """(page, url, score, first): best score of each address and where it first was accepted.

    ``order`` says what comes first: links (src 0) before addresses in the HTML (src 1).
    """
    scored = links.withColumn("score", score_b(F.col(url), F.col(text))).where("score > 0")
    return scored.groupBy(page, url).agg(F.max("score").alias("score"), F.min(F.struct(*order)).alias("first"))


def ranked(candidates: DataFrame, page: str, then: list[str], tried: int | None = None) -> DataFrame:
    """Candidates with their rank in the page by score, then ``then``; at most ``tried`` of a page (cut before the shuffle)."""
    rank = F.row_number().over(Window.partitionBy(page).orderBy(F.desc("score"), *then))
    out = candidates.withColumn("rank", rank)
    return out if tried is None else out.where(F.col("rank") <= tried)
