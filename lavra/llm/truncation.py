"""Texts that were cut off: lengths at which a source cuts, and endings that are no endings.

1. Discrete length hazards: for every source and measure (characters, bytes), texts that end at a length over texts
   that reach it, by window functions over the table of distinct lengths.
2. Every hazard is tested against the median hazard of its neighbours (Poisson upper tail); the Benjamini-Hochberg
   procedure over all tests bounds the false discoveries. What remains are the lengths at which a source cuts.
3. Endings: how often a pair of words ends a sentence, and which keywords are whole, is counted over the inner text of
   all documents. At a significant length a missing final stop is enough. Elsewhere a text without one is cut off where
   it ends within markup, a bracket, an unknown word, a pair that hardly ever ends a sentence, or a keyword never seen
   whole: a transfer that broke off at any place. Each row says which of the two it is (``kind``).
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.llm.canonical import ACCENTED, PLAIN
from lavra.session import spread, table, written

NEIGHBOURS = 20  # lengths on either side that a hazard is compared with
DISCOVERY = 0.01  # false discovery rate
LIFT = 10.0  # least ratio to the neighbours' hazard
PEAK = 2.0  # least ratio to the mean hazard of the two lengths on either side; a cut is a point, not a hill; other cuts don't count
ENDS = 0.02  # least share of a word pair's places that end a sentence, for it to be an ending
BEGIN = 8  # letters by which the beginnings of longer keywords are sought
# Headings of keyword lists, without accents.
KEYWORDS = r"(?:palavras?[- ]?chaves?|key ?words?|palabras? claves?|mots?[- ]cles?|parole chiave|descritores|unitermos|index terms)\s*[:.\-–]"


def _headed(c: str) -> F.Column:
    """Whether a heading of a keyword list may be there: a plain search for a part that each heading has."""
    return reduce(lambda a, b: a | b, [F.col(c).contains(x) for x in ("chave", "key", "clave", "-cle", " cle", "parole chiave", "descritores", "unitermos", "index terms")])


@F.pandas_udf(T.DoubleType())
def poisson_tail(n: pd.Series, mean: pd.Series) -> pd.Series:
    """P(X >= n) for a Poisson variable, by its series in logarithms."""

    def one(k: float, m: float) -> float:
        if k <= 0:
            return 1.0
        m = max(m, 1e-9)
        if k <= m:  # no excess; the test is one-sided
            return 0.5
        log = k * math.log(m) - m - math.lgamma(k + 1)
        total, term, i = 1.0, 1.0, k
        while term > 1e-12 * total and i < k + 10_000:
            i += 1
            term *= m / i
            total += term
        return min(1.0, math.exp(log) * total)

    return pd.Series([one(float(a), float(b)) for a, b in zip(n, mean)])


def _points(lengths: pd.DataFrame) -> pd.DataFrame:
    """Of one source's significant lengths those that stand out from the lengths beside them, the strongest first; what is kept isn't held against those beside it."""
    kept: set[int] = set()
    for x in lengths.sort_values(["hazard", "length"], ascending=[False, True]).itertuples():
        near = [y["hazard"] for y in x.close if y["length"] != x.length and y["length"] not in kept]
        out = sum(1 for y in x.close if y["length"] in kept)
        if x.hazard >= PEAK * sum(near) / max(1, 4 - out):
            kept.add(x.length)
    return lengths[lengths["length"].isin(kept)].drop(columns="close")


def cut_lengths(lengths: DataFrame) -> DataFrame:
    """(``source``, ``measure``, ``length``, ``n``, ``hazard``, ``around``, ``p``) of significant lengths.

    ``lengths`` has (source, measure, length, n): counted before any window, so a source that holds a third of the
    rows is as many rows here as it has distinct lengths.
    """
    own = Window.partitionBy("source", "measure")
    h = lengths.withColumn("risk", F.sum("n").over(own.orderBy(F.desc("length")))).withColumn("hazard", F.col("n") / F.col("risk"))
    near = own.orderBy("length").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    h = h.withColumn("around", F.percentile("hazard", F.lit(0.5)).over(near))
    close = own.orderBy("length").rangeBetween(-2, 2)
    h = h.withColumn("close", F.collect_list(F.struct("length", "hazard")).over(close))
    h = h.withColumn("p", poisson_tail("n", F.col("around") * F.col("risk")))
    tests = h.groupBy().agg(F.count("*").alias("tests"))
    few = h.where(f"p <= {DISCOVERY}")  # the procedure can only keep these
    # ranks by order of magnitude, so that no task ranks all tests
    few = few.withColumn("size", F.greatest(F.floor(4 * F.log10(F.greatest("p", F.lit(1e-300)))), F.lit(-1200)))
    below = few.groupBy("size").agg(F.count("*").alias("c")).withColumn("below", F.sum("c").over(Window.orderBy("size")) - F.col("c"))  # 1200 rows at most
    ranked = few.withColumn("own", F.row_number().over(Window.partitionBy("size").orderBy("p"))).join(below.select("size", "below"), "size")
    ranked = ranked.withColumn("rank", F.col("own") + F.col("below")).crossJoin(F.broadcast(tests))
    last = ranked.where(f"p <= rank / tests * {DISCOVERY}").groupBy().agg(F.max("rank").alias("last"))
    kept = ranked.crossJoin(F.broadcast(last)).where(f"rank <= last AND hazard >= {LIFT} * around AND n >= 5")  # one row each
    kept = kept.select("source", "measure", F.col("length").cast("int").alias("length"), "n", "hazard", "around", "p", "close")
    return kept.groupBy("source", "measure").applyInPandas(_points, "source string, measure string, length int, n bigint, hazard double, around double, p double")


def _texts(records: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Key, source, lengths as stored and the plain text: no tags, lower case without accents, digits as 0."""
    t = records.where(F.col(text).rlike(r"(?U)\S")).select(F.col(key).alias("k"), F.coalesce(source, F.lit("")).alias("source"), F.col(text).alias("raw"))
    t = t.withColumn("t", F.when(~F.col("raw").contains("<"), F.col("raw")).otherwise(F.regexp_replace("raw", r"(?i)</?[a-z][a-z0-9]{0,9}(?: [^<>]{0,200})?/?>", " ")))
    t = t.withColumn("t", F.when(~F.col("t").contains("&"), F.col("t")).otherwise(F.regexp_replace("t", r"(?i)&(?:[a-z]{2,8}|#\d{1,6});", " e ")))
    t = t.withColumn("t", F.trim(F.regexp_replace(F.translate(F.lower("t"), ACCENTED, PLAIN), r"(?U)\s+", " ")))
    t = t.withColumn("t", F.regexp_replace("t", r"\d+", "0"))
    return t.select("k", "source", F.length("raw").alias("chars"), F.octet_length("raw").alias("bytes"), "t")


STOP = r"[.!?][)\]”“\"'’»]*$"
BROKEN = r"(?:&[a-z#0]*|<[/a-z]*|[(\[“«,:;\-–])$"
DOTS = r"\s*(?:\.{2,}|…)[)\]”\"'’»]*$"


def _core(token: F.Column) -> F.Column:
    """A token without signs around it."""
    return F.regexp_replace(token, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def endings(texts: DataFrame) -> DataFrame:
    """``texts`` with ``open``: whether the text ends where no text ends; null with a final stop.

    Needs (k, source, chars, bytes, t); see the module's description for the rules.
    """
    t = texts.withColumn("bare", F.when(F.col("t").rlike(r"[.…][)\]”\"'’»]*$"), F.regexp_replace("t", DOTS, "")).otherwise(F.col("t")))
    stopped = F.col("t").rlike(STOP) & ~F.col("t").rlike(DOTS)
    # the keyword list, if the text ends in one
    tail = F.regexp_extract("bare", rf"{KEYWORDS}((?:(?!{KEYWORDS})[^.!?])*)$", 1)
    loose = t.where(~stopped).withColumn("tail", F.when(_headed("t"), F.trim(tail)).otherwise(""))
    loose = loose.withColumn("item", F.when(F.col("tail") != "", F.trim(F.substring_index("tail", ";", -1))))
    toks = F.split("bare", " ")
    loose = loose.withColumn("a", F.when(F.size(toks) > 1, _core(F.try_element_at(toks, F.lit(-2)))).otherwise("")).withColumn("b", _core(F.try_element_at(toks, F.lit(-1))))
    loose = written(loose.select("k", "source", "chars", "bytes", F.col("bare").rlike(BROKEN).alias("broken"), "item", "a", "b"), "loose")

    # word pairs inside all texts: how often one stands, and ends a sentence
    prose = F.when(_headed("t"), F.regexp_replace("bare", rf"{KEYWORDS}.*$", "")).otherwise(F.col("bare"))
    body = t.select(F.split(prose, " ").alias("w")).where(F.size("w") > 2)
    pairs = body.select(F.explode(F.arrays_zip(F.expr("slice(w, 1, size(w) - 2)").alias("x"), F.expr("slice(w, 2, size(w) - 2)").alias("y"))).alias("p")).select("p.x", "p.y")
    grams = pairs.groupBy("x", "y").agg(F.count("*").alias("n"))  # raw tokens first: few, and aggregated before the shuffle
    ends = F.col("y").rlike(r"[.!?][)\]”\"'’»]*$") | F.col("y").rlike(r"[)”\"’»]$")
    grams = grams.select(_core(F.col("x")).alias("a"), _core(F.col("y")).alias("b"), "n", F.when(ends, F.col("n")).otherwise(0).alias("e"))
    seen = written(grams.groupBy("a", "b").agg(F.sum("n").alias("n2"), F.sum("e").alias("e2")), "pairs")
    words = seen.groupBy("b").agg(F.sum("n2").alias("n1"), F.sum("e2").alias("e1"))

    # keywords that stand whole: followed by another one, or by the final stop
    lists = t.where(_headed("t")).select("t", F.regexp_extract("t", rf"{KEYWORDS}([^.!?]*)(?:\.|$)", 1).alias("l"), F.col("t").rlike(rf"{KEYWORDS}[^.!?]*\.").alias("ended")).where("l <> ''")
    whole = lists.select(F.explode(F.expr("transform(slice(split(l, ';'), 1, size(split(l, ';')) - IF(ended, 0, 1)), i -> trim(i))")).alias("item")).where("length(item) > 1").groupBy("item").agg(F.count("*").alias("n0"))

    seen_items = written(whole, "keywords")
    # the beginning of a longer keyword: short ones among all beginnings, longer ones by their first letters
    asked = loose.where("length(item) > 0").select("item").distinct()
    begins = seen_items.select(F.explode(F.expr(f"transform(sequence(1, least(length(item) - 1, {BEGIN})), i -> substring(item, 1, i))")).alias("item")).distinct()
    early = asked.where(f"length(item) <= {BEGIN}").join(begins.hint("merge"), "item")  # larger than Spark thinks: no broadcast
    late = asked.where(f"length(item) > {BEGIN}").withColumn("head", F.substring("item", 1, BEGIN))
    longer = seen_items.where(f"length(item) > {BEGIN}").select(F.substring("item", 1, BEGIN).alias("head"), F.col("item").alias("full"))
    late = late.join(longer, "head").where("full <> item AND startswith(full, item)").select("item").distinct()
    items = asked.join(seen_items, "item", "left").join(early.unionByName(late).withColumn("begun", F.lit(True)), "item", "left")

    of_pairs = loose.join(seen.hint("merge"), ["a", "b"], "left").join(words.hint("merge"), ["b"], "left")  # so are word pairs in memory
    # only texts that end in a keyword list meet the keywords
    judged = of_pairs.where("item IS NOT NULL AND item <> ''").join(items, "item", "left")
    judged = judged.unionByName(of_pairs.where("item IS NULL OR item = ''").withColumns({"n0": F.lit(None).cast("bigint"), "begun": F.lit(None).cast("boolean")}))
    share = F.coalesce(F.col("e2") / F.col("n2"), F.when(F.coalesce("e1", F.lit(0)) >= 3, F.col("e1") / F.col("n1")).otherwise(0.0))
    is_open = F.when(F.col("broken"), True).when(F.col("item").isNotNull(), F.col("n0").isNull() & (F.coalesce("begun", F.lit(False)) | (F.coalesce("n1", F.lit(0)) < 3))).otherwise(share < ENDS)
    return judged.select("k", "source", "chars", "bytes", is_open.alias("open"))


def truncated(records: DataFrame, key: str = "row_no", text: str = "abstract", source: str = "source") -> DataFrame:
    """(``key``, ``source``, ``kind``, ``chars``) of the texts that were cut off.

    ``kind`` is ``length`` where the text has a length at which its source cuts and no final stop, and ``ending`` where
    its ending alone tells (a transfer that broke off anywhere).

    Null and blank texts are never cut off; a text with a final stop neither, nor a whole last sentence that lacks
    its stop or ends in dots. A null source counts as the empty one. Repeated keys each give their row; other columns
    are ignored. All texts are read whole.
    """
    texts = written(_texts(records, key, text, source), "texts")
    stack = texts.selectExpr("source", "stack(2, 'chars', chars, 'bytes', bytes) AS (measure, length)")
    cuts = written(cut_lengths(stack.groupBy("source", "measure", "length").agg(F.count("*").alias("n"))).select("source", "measure", "length"), "cuts")
    loose = endings(texts)
    chars = cuts.where("measure = 'chars'").select("source", F.col("length").alias("chars"), F.lit(True).alias("cut_c"))
    octets = cuts.where("measure = 'bytes'").select("source", F.col("length").alias("bytes"), F.lit(True).alias("cut_b"))
    found = loose.join(chars, ["source", "chars"], "left").join(octets, ["source", "bytes"], "left")
    at_length = F.coalesce("cut_c", F.lit(False)) | F.coalesce("cut_b", F.lit(False))
    return found.where(F.col("open") | at_length).select(F.col("k").alias(key), "source", F.when(at_length, "length").otherwise("ending").alias("kind"), "chars")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(spread(table(spark, sf_dir, "records").select("row_no", "source", "abstract"))).select("row_no")


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, n_texts, n_cut, rate) of every source."""
    records = table(spark, sf_dir, "records").select("row_no", "source", "abstract")
    cut = truncated(spread(records)).groupBy("source").agg(F.count("*").alias("n_cut"))
    n = records.where(F.col("abstract").rlike(r"(?U)\S")).groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n_texts"))
    return n.join(cut, "source", "left").select("source", "n_texts", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), (F.coalesce("n_cut", F.lit(0)) / F.col("n_texts")).alias("rate"))


def p6_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_no, source, kind, chars) of every text that was cut off, by what tells it."""
    return truncated(spread(table(spark, sf_dir, "records").select("row_no", "source", "abstract")))


def queries() -> dict:
    return {"p6_found": p6_found, "p6_rates": p6_rates, "p6_cuts": p6_cuts}


def oracle_sql() -> dict[str, str]:
    return {}
