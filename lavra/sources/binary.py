"""PDF payloads: listing, probing and idempotent writing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lavra.functions.urls import is_pdf


def list_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, pdf_path, length) of ``*.pdf`` in a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("record_id"), F.col("path").alias("pdf_path"), "length")


def count_pdfs(spark: SparkSession, folder: str) -> int:
    return list_pdfs(spark, folder).count()


def valid_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, pdf_path, valid): whether each file begins as a PDF."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("record_id"), F.col("path").alias("pdf_path"), is_pdf("content", strict=True).alias("valid"))


def write_pdfs(payloads: DataFrame, folder: str) -> None:
    """Writes (record_id, content) as ``<record_id>.pdf`` in a folder that all executors share: a path or an address
    of any file system that Arrow reaches (local, HDFS, object stores).

    Tasks may run twice: each writes beside the target and moves, and keeps a file that already begins as a PDF.
    """

    def part(rows: Iterator[Row]) -> None:
        at, base = fs.FileSystem.from_uri(folder)
        at.create_dir(base, recursive=True)
        for r in rows:
            target = f"{base}/{r['record_id']}.pdf"
            if at.get_file_info(target).type == fs.FileType.File:
                with at.open_input_stream(target) as f:
                    if f.read(4) == b"%PDF":
                        continue
            beside = f"{base}/.{uuid.uuid4().hex}.part"
            try:
                with at.open_output_stream(beside) as f:
                    f.write(bytes(r["content"]))
                at.move(beside, target)
            except BaseException:
                if at.get_file_info(beside).type == fs.FileType.File:
                    at.delete_file(beside)
                raise

    payloads.select("record_id", "content").foreachPartition(part)
