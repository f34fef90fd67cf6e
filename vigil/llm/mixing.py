"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.common import text_of, written

TOKEN = r"[^\x20\x09-\x0D]+"


def apportion(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Integer seats by the highest quotients weight / (2 s + 1), none above its cap.

    The seats won at a quotient of at least d are floor(weight / (2 d) + 1/2).
    The smallest such d whose total does not pass `seats` is found by bisection;
    what is left goes one by one to the highest next quotients, ties to the
    earlier entry. If caps leave too little room, all are filled.
    """
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    caps = np.where(weights > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def won(d: float) -> np.ndarray:
        return np.minimum(np.floor(np.minimum(weights / (2 * d) + 0.5, 9e18)).astype(np.int64), caps)

    low, high = 0.0, float(weights.max()) * 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if won(middle).sum() > seats:
            low = middle
        else:
            high = middle
    got = won(high * (1 + 1e-12))  # seats at a tie are given below
    while (left := seats - int(got.sum())) > 0:
        quotient = np.where(got < caps, weights / (2 * got + 1), -1.0)
        for i in np.argsort(-quotient, kind="stable")[:left]:
            if quotient[i] >= 0:
                got[i] += 1
    return got


def drawn(seed: int, *parts: str) -> Column:
    """A number from 0 below 2**60 that the seed and the columns decide, the same in any engine with md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def with_targets(sources: DataFrame, ceiling: int = 3) -> DataFrame:
    """sources (source, source_size) with weight and target.

    Weights are 1, 2, 3 repeating over the sources by code point, null last.
    A target stops at `ceiling` times its source's size and the excess is shared
    anew: in order of ceiling / weight the sources that stop come first, so
    running sums tell where that ends. Windows over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long")).withColumn(
        "most", F.col("source_size") * ceiling
    )
    order = [(F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    sums = ranked.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))).alias("rest"),
        F.sum("weight").over(after).alias("weights"),
    ).withColumn("full", F.col("most") * F.col("weights") <= F.col("weight") * F.col("rest"))
    shared = sums.select(
        "*",
        F.max(F.when(~F.col("full"), F.col("rest"))).over(everything).alias("open_rest"),
        F.max(F.when(~F.col("full"), F.col("weights"))).over(everything).alias("open_weights"),
    )
    return shared.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("full"), F.col("most").cast("double"))
        .otherwise((F.col("weight") * F.col("open_rest")).cast("double") / F.col("open_weights").cast("double"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = 8,
    ceiling: int = 3,
    shard_rows: int = 2000,
    seed: int = 42,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken.

    A source's documents are dealt by hash to shards of about `shard_rows` rows
    and laid end to end in seeded order; the line is cut into blocks of `block`
    words. Blocks go to sources, then to a source's shards, by highest quotients
    (`apportion`). A shard's quota takes its blocks in full passes, the rest as
    a run of blocks from a seeded place. A hot source only has more shards.
    Null text and text without words have size 0 and are taken 0 times; a null
    source is a source. Rows that repeat an id lie next to each other in the
    line and are treated alike up to order. An empty table gives no rows.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(TOKEN)).cast("long").alias("size"),
    )
    sized = written(sized, "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = with_targets(totals.select("source", "source_size"), ceiling)
    counted = totals.select(F.col("source").alias("s"), "n_docs")
    sources = written(
        targets.join(counted, F.col("source").eqNullSafe(F.col("s"))).select(
            "source", "source_size", "weight", "target", F.ceil(F.col("n_docs") / shard_rows).alias("n_shards")
        ),
        "sources",
    )
    named = sources.withColumnRenamed("source", "s")
    dealt = written(
        sized.join(named, F.col("source").eqNullSafe(F.col("s")))
        .select("doc_id", "source", "size", drawn(seed, "doc_id").alias("place"), "n_shards")
        .withColumn("shard", F.pmod(drawn(seed + 1, "doc_id"), "n_shards"))
        .drop("n_shards"),
        "dealt",
    )
    shards = (
        dealt.groupBy("source", "shard")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("n_blocks", F.ceil(F.col("shard_size") / block))
    )
    room = shards.groupBy(F.col("source").alias("s")).agg(F.sum("n_blocks").alias("n_blocks"))

    def source_quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last", kind="stable")
        total = int(pdf["source_size"].sum())
        pdf["blocks"] = apportion(pdf["target"], math.floor(total / block + 0.5), pdf["n_blocks"] * ceiling)
        return pdf[["source", "blocks"]]

    quotas = (
        sources.join(room, F.col("source").eqNullSafe(F.col("s")))
        .select(F.lit(0).alias("all"), "source", "source_size", "target", "n_blocks")
        .groupBy("all")
        .applyInPandas(source_quotas, "source string, blocks long")
    )

    def shard_quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        pdf["quota"] = apportion(pdf["shard_size"], int(pdf["blocks"].iloc[0]), pdf["n_blocks"] * ceiling)
        return pdf[["source", "shard", "shard_size", "n_blocks", "quota"]]

    quotas = (
        shards.join(quotas.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .groupBy("source")
        .applyInPandas(shard_quotas, "source string, shard long, shard_size long, n_blocks long, quota long")
        .join(named.drop("weight", "n_shards"), F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("source").alias("s"), F.col("shard").alias("k"), "shard_size", "n_blocks", "quota", "source_size", "target")
    )
    line = Window.partitionBy("source", "shard").orderBy("place", "doc_id")
    laid = dealt.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    passes = F.when(F.col("n_blocks") > 0, F.floor(F.col("quota") / F.col("n_blocks"))).otherwise(0).cast("long")
    first = F.when(F.col("n_blocks") > 0, F.pmod(drawn(seed + 2, "source", "shard"), "n_blocks")).otherwise(0)
    chosen = (
        laid.join(quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("k")))
        .withColumn("passes", passes)
        .withColumn("first", first)
        .withColumn("last", F.col("first") + F.col("quota") - F.col("passes") * F.col("n_blocks"))
    )
    start = F.col("end") - F.col("size")

    def shared(a, b):
        return F.greatest(F.lit(0), F.least("end", b) - F.greatest(start, a))

    run = shared(F.col("first") * block, F.col("last") * block)
    wrapped = shared(F.lit(0), (F.col("last") - F.col("n_blocks")) * block)
    return chosen.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("passes") + run + wrapped).cast("long").alias("taken")
    )
