"""Mixing sources to target shares of the total size by entropy balancing.

Each document of source s with t tokens gets the rate ``min(most_s, exp(lambda_s * t / mean_s))``: of all rates that
meet the token constraints and the caps, the ones nearest to "every document once" in relative entropy. The
multipliers solve the convex dual by Newton steps, kept inside a bracket; a step is one distributed aggregation over
the exact histogram (source, tokens, documents), and only one row per source reaches the driver. Rates become
copies by systematic rounding along the sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lavra.llm.encoding import count_tokens
from lavra.session import spread, table, written

BUCKET = 5000  # documents of one source that are rounded together


def document_sizes(docs: DataFrame, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, source, n_tokens) of every document; ``doc_id`` is unique."""
    sizes = count_tokens(docs.select("doc_id", "text"), tokenizer=tokenizer)
    return docs.select("doc_id", "source").join(sizes, "doc_id")


def solve(sizes: DataFrame, targets: DataFrame, total: float | None = None, steps: int = 60, close: float = 1e-7) -> DataFrame:
    """(source, target_share, max_repeats, goal, tokens, n_docs, mean, lam) of every source with a target.

    ``total`` is the size wanted in tokens; by default the largest that all shares and caps allow. A source without
    tokens or with a share of 0 takes no part in that bound, and its documents get the rate 0. Shares are scaled
    to sum to 1. ``targets`` is a small table by nature, one row per source; a source named twice there is an error,
    and so is a size that the steps don't come near (a hundred times ``close``).
    """
    spark = sizes.sparkSession
    hist = written(sizes.where("n_tokens > 0").groupBy("source", "n_tokens").agg(F.count("*").alias("docs")), "histogram")
    have = hist.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("docs")).alias("tokens"), F.sum("docs").alias("n_docs"))
    wanted = targets.join(have, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("n_docs", F.lit(0)).alias("n_docs")).collect()
    if len({r["source"] for r in wanted}) < len(wanted):
        raise ValueError("a source has two targets")
    shares = sum(r["target_share"] or 0 for r in wanted) or 1.0
    live = [r for r in wanted if r["tokens"] > 0 and (r["target_share"] or 0) > 0 and (r["max_repeats"] or 0) > 0]
    most = min((r["max_repeats"] * r["tokens"] * shares / r["target_share"] for r in live), default=0.0)
    total = most if total is None else total
    state = {}
    for r in live:
        goal = total * r["target_share"] / shares
        state[r["source"]] = {"goal": goal, "cap": r["max_repeats"], "tokens": r["tokens"], "mean": r["tokens"] / r["n_docs"], "lam": 0.0, "lo": None, "hi": None, "off": math.inf, "done": False}
        if goal >= r["max_repeats"] * r["tokens"] * (1 - 1e-9):  # every document at its cap
            state[r["source"]] |= {"lam": math.inf, "done": True}
    kinds = "source string, lam double, mean double, cap double"
    for _ in range(steps):
        open_ = [(s, x["lam"], x["mean"], float(x["cap"])) for s, x in state.items() if not x["done"]]
        if not open_:
            break
        now = hist.join(F.broadcast(spark.createDataFrame(open_, kinds)), "source")
        u = F.col("n_tokens") / F.col("mean")
        rate = F.least(F.exp(F.least(F.col("lam") * u, F.lit(50.0))), "cap")
        got = now.groupBy("source").agg(F.sum(F.col("docs") * F.col("n_tokens") * rate).alias("size"), F.sum(F.when(rate < F.col("cap"), F.col("docs") * F.col("n_tokens") * u * rate).otherwise(0)).alias("slope")).collect()
        for g in got:
            x = state[g["source"]]
            gap = x["goal"] - g["size"]
            x["off"] = abs(gap) / x["goal"]
            if abs(gap) <= close * x["goal"]:
                x["done"] = True
                continue
            x["lo" if gap > 0 else "hi"] = x["lam"]
            step = x["lam"] + gap / g["slope"] if g["slope"] > 0 else None
            lo, hi = x["lo"], x["hi"]
            if step is None or (lo is not None and step <= lo) or (hi is not None and step >= hi) or abs(step - x["lam"]) > 5:
                step = (lo + hi) / 2 if lo is not None and hi is not None else x["lam"] + (1.0 if gap > 0 else -1.0)
            x["lam"] = step
    if left := sorted(s for s, x in state.items() if not x["done"] and x["off"] > 100 * close):
        raise ValueError(f"no multipliers found within {steps} steps for {left}")
    rows = [(r["source"], float(r["target_share"] or 0) / shares, int(r["max_repeats"] or 0), float(x["goal"]) if x else 0.0, int(r["tokens"]), int(r["n_docs"]), float(x["mean"]) if x else 0.0, float(x["lam"]) if x else None) for r in wanted for x in [state.get(r["source"])]]
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int, goal double, tokens bigint, n_docs bigint, mean double, lam double")


def mixture(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, rate, copies int) of every document.

    Documents without a target, source or token get the rate 0 and no copy. ``copies`` is the rate rounded up or
    down, never above the source's cap: along the sizes, inside buckets of some ``BUCKET`` documents of one source,
    so that a bucket's copies differ by less than one from its rates and no source is one task.
    """
    d = sizes.join(F.broadcast(plan.select("source", "max_repeats", "n_docs", "mean", "lam")), "source", "left")
    rate = F.when(F.col("lam").isNull() | (F.col("n_tokens") <= 0), 0.0).when(F.col("lam") == math.inf, F.col("max_repeats").cast("double")).otherwise(F.least(F.exp(F.least(F.col("lam") * F.col("n_tokens") / F.col("mean"), F.lit(50.0))), F.col("max_repeats").cast("double")))
    d = d.withColumn("rate", rate).withColumn("floor", F.floor("rate")).withColumn("part", F.col("rate") - F.col("floor"))
    bucket = F.pmod(F.xxhash64("doc_id"), F.greatest(F.ceil(F.coalesce("n_docs", F.lit(0)) / BUCKET), F.lit(1)))
    d = d.withColumn("bucket", F.when(F.col("lam").isNull(), F.pmod(F.xxhash64("doc_id"), F.lit(1024))).otherwise(bucket))
    along = Window.partitionBy("source", "bucket").orderBy("n_tokens", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    start = F.pmod(F.xxhash64("source", "bucket"), F.lit(1000)) / 1000
    upto = F.sum("part").over(along) + start
    extra = F.floor(upto + 1e-9) - F.floor(upto - F.col("part") + 1e-9)
    copies = F.least(F.col("floor") + F.when(F.col("part") > 0, extra).otherwise(0), F.coalesce("max_repeats", F.lit(0)))
    return d.select("doc_id", "source", "n_tokens", "rate", F.greatest(copies, F.lit(0)).cast("int").alias("copies"))


def shares(mixed: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, mixed_tokens, most_copies) of every source; null targets: none."""
    by = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    total = by.groupBy().agg(F.sum("mixed_tokens").alias("total"))
    out = by.join(plan.select("source", "target_share"), "source", "full").crossJoin(F.broadcast(total))
    return out.select("source", "target_share", (F.coalesce("mixed_tokens", F.lit(0)) / F.nullif("total", F.lit(0))).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    sizes = written(document_sizes(docs), "sizes")
    plan = solve(sizes, table(spark, sf_dir, "mix_targets"))
    return mixture(sizes, plan), plan


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(*_mixed(spark, sf_dir))


def queries() -> dict:
    return {"p9_mixture": p9_mixture, "p9_shares": p9_shares}


def oracle_sql() -> dict[str, str]:
    return {}
