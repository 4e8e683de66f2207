"""Manifest, failures and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key, the last in ``order``; an aggregate, so a key of many rows is no single task."""
    rest = [c for c in records.columns if c != key and c not in order]
    return records.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_r")).select(key, "_r.*").select(*records.columns)


def keep_first(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key, the first in ``order``."""
    rest = [c for c in records.columns if c != key and c not in order]
    return records.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r")).select(key, "_r.*").select(*records.columns)


def record_key(record_id: Column | str, file_name: Column | str) -> Column:
    """The record's id, or the stem of its file where it has none."""
    own = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.coalesce(F.nullif(own, F.lit("")), F.regexp_replace(F.substring_index(file_name, "/", -1), r"\.[^.]*$", ""))


def not_yet_fetched(records: DataFrame, existing: DataFrame, key: str = "record_id") -> DataFrame:
    """Records without an output; an anti-join against the listing of outputs."""
    return records.join(existing.select(key).distinct(), key, "left_anti")


def build_manifest(records: DataFrame, existing: DataFrame, chosen: DataFrame) -> DataFrame:
    """(record_id, status, reason, source_url, pdf_url, pdf_path), one row for each record.

    ``records`` has (record_id, urls); ``existing`` (record_id, pdf_path) of outputs; ``chosen`` the terminal or last
    attempt (record_id, success, reason, source_url, pdf_url, path). Outputs win over everything, records without an
    address fail with ``no_access_url``, records without an attempt with ``pdf_not_found``; failures keep only the
    source.
    """
    m = records.join(existing.groupBy("record_id").agg(F.min("pdf_path").alias("old")), "record_id", "left").join(chosen, "record_id", "left")
    there, none = F.col("old").isNotNull(), F.coalesce(F.size("urls"), F.lit(0)) <= 0
    done = F.coalesce("success", F.lit(False))
    status = F.when(there, "already_exists").when(~none & done, "downloaded").otherwise("failed")
    reason = F.when(there, None).when(none, "no_access_url").when(done, F.col("reason")).otherwise(F.coalesce("reason", F.lit("pdf_not_found")))
    return m.select(
        "record_id", status.alias("status"), reason.cast("string").alias("reason"),
        F.when(~there & ~none, F.coalesce("source_url", F.try_element_at("urls", F.lit(-1)))).alias("source_url"),
        F.when(status == "downloaded", F.col("pdf_url")).alias("pdf_url"),
        F.when(there, F.col("old")).when(status == "downloaded", F.col("path")).alias("pdf_path"),
    )


def failures(manifest: DataFrame) -> DataFrame:
    return manifest.where("status = 'failed'")


def run_summary(manifest: DataFrame) -> DataFrame:
    """One row (downloaded_now, already_existing, failures, total_pdfs); zeros for an empty manifest."""
    down, there = F.count_if(F.col("status") == "downloaded"), F.count_if(F.col("status") == "already_exists")
    return manifest.agg(down.alias("downloaded_now"), there.alias("already_existing"), F.count_if(F.col("status") == "failed").alias("failures"), (down + there).alias("total_pdfs"))


def extraction_summary(pages: DataFrame, ok: str) -> DataFrame:
    """One row (succeeded, errors); a null ``ok`` is an error."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return pages.agg(F.count_if(good).alias("succeeded"), F.count_if(~good).alias("errors"))
