"""Encoding of a corpus with a public byte-level tokenizer: each distinct word is encoded once.

1. Pre-tokens of every text (``regexp_extract_all``, in the JVM), in text order.
2. A block of documents becomes one row: the block's distinct pre-tokens, and each document as positions in that
   list. This is the exploded (document, position, word) relation, aggregated before any shuffle: a word that stands
   a million times in a block travels once.
3. The blocks' words are exploded, made distinct over the corpus (global shuffle on the word) and each is encoded
   once by byte-pair merging.
4. The ids are joined back to the blocks' words on the word (by broadcast for the bounded number of words that stand
   in more than one in twenty blocks), the blocks' words are brought together again on the block, and every document
   is put together from its positions.

The folder of the tokenizers must be there on every executor.

Decoding joins the token-byte table (:func:`token_bytes`, :func:`decode`).
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.blocks import join_words, often
from lavra.session import table, written

TOKENIZERS = os.environ.get("LAVRA_TOKENIZERS", "/opt/tokenizers")
# Fixed value: how the tokenizers of this family cut a text before merging.
PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_CHARS = 4_000_000  # a block ends after so many characters, or with the Arrow batch


def tokenizer_file(name: str, folder: str = TOKENIZERS) -> str:
    return f"{folder}/{name}.tiktoken"


def rank_table(name: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(tokenizer_file(name, folder), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def word_encoder(name: str, folder: str):
    """Encodes one pre-token by byte-pair merging."""
    import tiktoken

    ranks = rank_table(name, folder)
    return tiktoken.Encoding(name, pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of documents."""
    import uuid

    schema = pa.schema([("block", pa.string()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("codes", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))])
    for b in batches:
        docs, texts = b.column(0), b.column(1)
        chars = np.cumsum(np.asarray(b.column(2).fill_null(0), dtype=np.int64))
        at = 0
        while at < len(docs):
            end = max(at + 1, int(np.searchsorted(chars, (chars[at - 1] if at else 0) + BLOCK_CHARS, side="right")))
            part = texts.slice(at, end - at)
            sizes = pc.fill_null(pc.list_value_length(part), 0).cast(pa.int32())
            coded = pc.dictionary_encode(part.flatten())
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex])] + [_one(x) for x in (docs.slice(at, end - at), sizes, coded.indices.cast(pa.int32()), coded.dictionary)],
                schema=schema,
            )
            at = end


def _one(values: pa.Array) -> pa.ListArray:
    """The values as the single list of a column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _assembled(key: str, counts: bool):
    """Documents put together from the ids of their block's words."""
    out = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()) if counts else ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                docs, sizes, codes, ids = (b.column(i)[row].values for i in range(4))
                sizes, codes = np.asarray(sizes), np.asarray(codes)
                lengths = np.asarray(pc.list_value_length(ids), dtype=np.int64) if len(ids) else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum(lengths[codes])])
                bounds = ends[np.concatenate([[0], np.cumsum(sizes)])]
                if counts:
                    yield pa.RecordBatch.from_arrays([docs, pa.array(np.diff(bounds))], schema=out)
                else:
                    flat = ids.take(pa.array(codes)).flatten().cast(pa.int32()) if len(codes) else pa.array([], pa.int32())
                    yield pa.RecordBatch.from_arrays([docs, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)], schema=out)

    return run


def _coded(docs: DataFrame, key: str, text: str, tokenizer: str, folder: str) -> DataFrame:
    """Blocks with their documents, positions and, place by place, the ids of the block's words."""
    cut = docs.select(F.col(key).cast("bigint").alias("k"), F.expr(f"regexp_extract_all({text}, r'{PATTERN.replace(chr(39), chr(92) + 'x27')}', 0)").alias("w"), F.length(text).alias("n"))
    blocks = written(cut.mapInArrow(_blocks, "block string, docs array<bigint>, sizes array<int>, codes array<int>, words array<string>"), "blocks")
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    lexicon = written(words.groupBy("word").agg(F.count("*").alias("blocks")), "lexicon")
    hot = often(lexicon, "word", blocks.count())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = word_encoder(tokenizer, folder)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([one(w) for w in b.column(0).to_pylist()], pa.list_(pa.int32()))], names=["word", "ids"])

    coded = lexicon.select("word").mapInArrow(encode, "word string, ids array<int>")
    back = join_words(words, coded, "word", hot).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("ids"))
    return blocks.join(back, "block", "left").select("docs", "sizes", "codes", F.coalesce(F.col("ids.ids"), F.array().cast("array<array<int>>")).alias("ids"))


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(``key bigint``, ``ids array<int>``) of every document, without special tokens.

    Empty and null texts get the empty list. Strings of special tokens in a text are ordinary text. Rows with the same
    key each give a row; other columns are ignored. A block's collected words are bounded by its characters
    (``BLOCK_CHARS`` or one document), so no group grows with the corpus.
    """
    coded = _coded(docs, key, text, tokenizer, folder)
    return coded.mapInArrow(_assembled(key, False), f"{key} bigint, ids array<int>")


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(``key bigint``, ``n_tokens bigint``) of every document, by the same way; 0 for empty and null texts."""
    return _coded(docs, key, text, tokenizer, folder).mapInArrow(_assembled(key, True), f"{key} bigint, n_tokens bigint")


def token_bytes(spark: SparkSession, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(``id int``, ``bytes binary``): the token-byte table, some 50,000 rows."""
    return spark.createDataFrame([(i, bytearray(b)) for b, i in rank_table(tokenizer, folder).items()], "id int, bytes binary")


def decode(encoded: DataFrame, tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(``key``, ``text``) of encoded documents; the empty list gives the empty text.

    ``key`` must be unique. The ids are exploded with their positions and joined with the token-byte table, whose
    size the tokenizer bounds (Spark broadcasts it where it is below its threshold).
    """
    flat = encoded.select(key, F.posexplode("ids").alias("place", "id")).join(tokens, "id")
    parts = flat.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", F.hex("bytes").alias("h")))).alias("p"))
    text = F.decode(F.unhex(F.array_join(F.col("p.h"), "")), "UTF-8")
    return encoded.select(key).join(parts, key, "left").select(key, F.coalesce(text, F.lit("")).alias("text"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: (doc_id, n_ids, same)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = written(encode_corpus(docs), "ids")
    back = decode(ids, token_bytes(spark)).withColumnRenamed("text", "again")
    return docs.join(back, "doc_id").join(ids, "doc_id").select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), (F.coalesce("text", F.lit("")) == F.col("again")).alias("same"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text from its ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(written(encode_corpus(docs), "ids"), token_bytes(spark))


def queries() -> dict:
    return {"p8_ids": p8_ids, "p8_round_trip": p8_round_trip, "p8_decoded": p8_decoded}


def oracle_sql() -> dict[str, str]:
    return {"p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
