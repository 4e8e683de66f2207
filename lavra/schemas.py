"""Schemas of the project's tables and of the intermediate ones."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a record and of a manifest row.
RECORD_FIELDS = ("record_id", "source", "record_url", "title", "year", "author", "advisor", "document_type", "access_type", "language", "institution", "graduate_program", "department", "country", "access_url", "abstract")
MANIFEST_FIELDS = ("record_id", "status", "reason", "source_url", "pdf_url", "pdf_path")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


RECORD = T.StructType(_strings(*RECORD_FIELDS))
MANIFEST = T.StructType(_strings(*MANIFEST_FIELDS))
ENVELOPE = T.StructType([*_strings("source", "query", "search_type", "collected_at"), T.StructField("total_collected", T.IntegerType()), T.StructField("record_urls", T.ArrayType(T.StringType()))])
RESULT = T.StructType([T.StructField("success", T.BooleanType()), *_strings("reason", "source_url", "pdf_url", "path")])
BUNDLES = "_embedded struct<bundles: array<struct<uuid: string, name: string>>>"
BITSTREAMS = "_embedded struct<bitstreams: array<struct<uuid: string, name: string>>>"
