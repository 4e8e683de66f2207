"""Layers of the stored data behind Raw: standardised, normalised, deduplicated, anonymised.

Their meaning is this library's own; only their names are given.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import body_lines, normalize_space
from lavra.sources.html import read_page
from lavra.operators.manifest import last_wins
from lavra.schemas import RECORD_FIELDS

# The folders of the layers.
LAYERS = ("raw/metadata", "raw/metadata/records", "raw/pdf", "raw/manifests", "staging", "processed/01_standardized", "processed/02_normalized", "processed/03_deduplicated", "processed/04_anonymized", "curated/pretraining", "curated/finetuning", "curated/rag", "curated/benchmark")
EMAIL = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"
CPF = r"\b\d{3}\.?\d{3}\.?\d{3}-\d{2}\b"
PHONE = r"(?:\+?55 ?)?\(?\b\d{2}\)?[ -]?9?\d{4}-\d{4}\b"


def layer(root: str, name: str) -> str:
    """The path of a layer; writers create it."""
    if name not in LAYERS:
        raise ValueError(f"no layer {name}")
    return f"{root.rstrip('/')}/{name}"


def create_layout(spark: SparkSession, root: str) -> DataFrame:
    """(layer, there) after all folders of the layers were made; those that are there stay as they are.

    Works on any file system that Spark reaches.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for name in LAYERS:
        path = jvm.org.apache.hadoop.fs.Path(layer(root, name))
        at = path.getFileSystem(conf)
        rows.append((name, bool(at.mkdirs(path) and at.getFileStatus(path).isDirectory())))
    return spark.createDataFrame(rows, "layer string, there boolean")


@F.pandas_udf(T.StringType())
def composed(texts: pd.Series) -> pd.Series:
    """Unicode's composed form."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def standardised(records: DataFrame) -> DataFrame:
    """Blank fields null, the year a number (null where it is none or out of 1500 to 2100)."""
    out = records.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) if c in RECORD_FIELDS else F.col(c) for c in records.columns])
    year = F.regexp_extract("year", r"^\s*(\d{4})\s*$", 1).try_cast("int")
    return out.withColumn("year", F.when(year.between(1500, 2100), year))


def normalised(records: DataFrame, fields: tuple[str, ...] = RECORD_FIELDS) -> DataFrame:
    """Text fields in Unicode's composed form with single blanks."""
    kinds = dict(records.dtypes)
    return records.select(*[normalize_space(composed(c)).alias(c) if c in fields and kinds[c] == "string" else F.col(c) for c in records.columns])


def deduplicated(records: DataFrame, order: list[str]) -> DataFrame:
    """The last collection of each record."""
    return last_wins(records, "record_id", order)


def anonymised(records: DataFrame, fields: tuple[str, ...] = ("abstract",)) -> DataFrame:
    """E-mail addresses, taxpayer and telephone numbers replaced by their kind."""
    out = {}
    for c in fields:
        x = F.regexp_replace(c, EMAIL, "[EMAIL]")
        x = F.regexp_replace(x, CPF, "[CPF]")
        out[c] = F.regexp_replace(x, PHONE, "[FONE]")
    return records.withColumns(out)


def extracted(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(``key``, text): the visible text of HTML pages, a line for each line with content; null pages stay null."""
    return pages.select(key, F.array_join(body_lines(read_page(html)["text"]), "\n").alias("text"))


def distinct_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, ``text``, n): each text once, whatever its white space and case, under its least key; null and blank texts go.

    Only hashes and keys are grouped, so a text that a third of the rows repeat meets as partial minima; the text is
    joined back on the key, which is unique.
    """
    plain = F.lower(normalize_space(text))
    first = docs.select(key, F.sha2(plain, 256).alias("h")).where("h IS NOT NULL").groupBy("h").agg(F.min(key).alias(key), F.count("*").alias("n"))
    return docs.join(first, key).select(key, text, "n")


def pretraining(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 200) -> DataFrame:
    """(``key``, ``text``): each distinct text of ``least`` characters or more, with single blanks."""
    d = distinct_texts(docs, key, text).select(key, normalize_space(text).alias(text))
    return d.where(F.length(text) >= least)


def finetuning(records: DataFrame, key: str = "row_no", ask: str = "title", answer: str = "abstract") -> DataFrame:
    """(``key``, messages array<struct<role, content>>) of records that have both fields."""
    q, a = normalize_space(ask), normalize_space(answer)
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return records.select(key, q.alias("q"), a.alias("a")).where("q IS NOT NULL AND a IS NOT NULL").select(key, F.array(turn("user", F.col("q")), turn("assistant", F.col("a"))).alias("messages"))


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 1000, overlap: int = 200) -> DataFrame:
    """(``key``, chunk_no, chunk): texts with single blanks cut into pieces of ``size`` characters that share ``overlap``.

    The last piece ends with the text; a text no longer than ``size`` is one piece; null and blank texts give none.
    """
    d = docs.select(key, normalize_space(text).alias("t")).where("t IS NOT NULL")
    step = size - overlap
    at = d.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.ceil(F.greatest(F.length("t") - size, F.lit(0)) / step).cast("int"))))
    return at.select(key, "chunk_no", F.substring("t", F.col("chunk_no") * step + 1, F.lit(size)).alias("chunk"))


def held_out(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = 5) -> DataFrame:
    """(``key``, ``text``, n): the distinct texts of about ``share`` in a hundred, told by the hash of the text.

    Copies of a text fall on the same side, so nothing held out stands in the rest.
    """
    d = distinct_texts(docs, key, text)
    return d.where(F.conv(F.substring(F.md5(F.lower(normalize_space(text))), 1, 6), 16, 10).cast("bigint") % 100 < share)
