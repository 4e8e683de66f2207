"""Joins of the words of blocks with a table of words, where some words stand in nearly every block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 20


def often(counts: DataFrame, word: str, blocks: int, n: str = "blocks") -> DataFrame:
    """(``word``) of those that stand in more than one in ``SHARE`` of all blocks.

    A block's distinct words are bounded by its characters, so these are at most ``SHARE`` times a block's words,
    whatever the corpus: they may be broadcast. Of any other word a join meets one in ``SHARE`` rows at most.
    """
    return counts.where(F.col(n) * SHARE > blocks).select(word)


def join_words(words: DataFrame, table: DataFrame, word: str, hot: DataFrame) -> DataFrame:
    """The inner join of ``words`` (a row for each block and word) with ``table`` (a row for each word).

    ``hot`` is of :func:`often`: its words meet their rows by broadcast, only the rest is shuffled.
    """
    hot = hot.select(word)
    by_hand = words.join(F.broadcast(table.join(hot, word)), word)
    return by_hand.unionByName(words.join(F.broadcast(hot), word, "left_anti").join(table, word))
