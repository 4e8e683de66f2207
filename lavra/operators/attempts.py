"""Folds over recorded attempts: retries, channels, addresses and strategies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.rules import TERMINAL

# The ways to fetch a file, in the order in which they're tried.
CHANNELS = ("requests", "browser")


def first_accepted(attempts: DataFrame, key: list[str], order: str, accepted: Column, most: int, keep: list[str]) -> DataFrame:
    """(key…, n_attempts, ok, keep…): the first accepted attempt among the first ``most``; nulls where none was."""
    tried = attempts.where(F.col(order) <= most)
    best = F.min(F.when(accepted, F.struct(order, *keep))).alias("_b")
    n = F.coalesce(F.min(F.when(accepted, F.col(order))), F.max(order)).cast("bigint").alias("n_attempts")
    return tried.groupBy(*key).agg(best, n).select(*key, "n_attempts", F.col("_b").isNotNull().alias("ok"), *(F.col(f"_b.{c}").alias(c) for c in keep))


def by_channel(responses: DataFrame, key: list[str], accepted: Column, channels: list[str], keep: list[str]) -> DataFrame:
    """(key…, channel, keep…): an accepted response of the first channel in ``channels`` that has one."""
    place = reduce(lambda c, x: c.when(F.col("channel") == x[1], x[0]), enumerate(channels[1:], 1), F.when(F.col("channel") == channels[0], 0))
    got = responses.where(accepted).groupBy(*key).agg(F.min(F.struct(place.alias("_p"), "attempt", "channel", *keep)).alias("_b"))
    return got.select(*key, "_b.channel", *(F.col(f"_b.{c}").alias(c) for c in keep))


def terminal_or_last(attempts: DataFrame, key: list[str], order: str, success: str = "success", reason: str = "reason", keep: list[str] | None = None) -> DataFrame:
    """(key…, order, success, reason, keep…): the first attempt that succeeds or may not be repeated, else the last.

    An aggregate of two structs, so the attempts of one record never meet in one task. Equal numbers are settled by
    the other columns.
    """
    keep = keep or []
    terminal = F.coalesce(F.col(success), F.lit(False)) | F.coalesce(F.col(reason).isin(TERMINAL), F.lit(False))
    row = F.struct(order, success, reason, *keep)
    agg = attempts.groupBy(*key).agg(F.min(F.when(terminal, row)).alias("_t"), F.max(row).alias("_l"))
    return agg.select(*key, F.coalesce("_t", "_l").alias("_r")).select(*key, "_r.*")


def result(success: Column, reason: Column, source_url: Column, pdf_url: Column, path: Column) -> Column:
    """The five-field result of a repository page."""
    return F.struct(success.alias("success"), reason.cast("string").alias("reason"), source_url.cast("string").alias("source_url"), pdf_url.cast("string").alias("pdf_url"), path.cast("string").alias("path"))
