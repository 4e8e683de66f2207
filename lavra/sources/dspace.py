"""Recorded replies of a repository's REST interface: item, bundles, bitstreams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.schemas import BITSTREAMS, BUNDLES

# Fixed value: how an address names an item.
ITEM_UUID = r"/items/([0-9a-fA-F-]{36})"


def item_uuid(url: Column | str) -> Column:
    """The item's id in an address, null where it names none."""
    return F.nullif(F.regexp_extract(url, ITEM_UUID, 1), F.lit(""))


def original_bundles(replies: DataFrame, key: str, reply: str) -> DataFrame:
    """(``key``, pos, bundle) of bundles named ORIGINAL that have an id; unreadable replies give none."""
    items = replies.select(key, F.posexplode(F.from_json(reply, BUNDLES)["_embedded"]["bundles"]).alias("pos", "b"))
    return items.where((F.upper("b.name") == "ORIGINAL") & F.col("b.uuid").isNotNull()).select(key, "pos", F.col("b.uuid").alias("bundle"))


def pdf_bitstreams(replies: DataFrame, key: list[str], reply: str) -> DataFrame:
    """(key…, file_pos, bitstream) of files that end in .pdf and have an id."""
    items = replies.select(*key, F.posexplode(F.from_json(reply, BITSTREAMS)["_embedded"]["bitstreams"]).alias("file_pos", "f"))
    return items.where(F.lower("f.name").endswith(".pdf") & F.col("f.uuid").isNotNull()).select(*key, "file_pos", F.col("f.uuid").alias("bitstream"))


def first_file(files: DataFrame, key: str) -> DataFrame:
    """(``key``, bitstream): the first file by bundle and place."""
    return files.groupBy(key).agg(F.min(F.struct("pos", "file_pos", "bitstream")).alias("m")).select(key, "m.bitstream")
