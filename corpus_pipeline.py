"""A corpus pipeline: documents without toxic ones and copies, mixed by source and packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents. Empty tables, nulls, empty texts, repeated
rows and further columns are handled as the stages' operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm.common import package_on_workers, written
from vigil.llm.exact_dedup import drop_exact_copies
from vigil.llm.mixing import mix_sources
from vigil.llm.near_dedup import drop_near_copies
from vigil.llm.packing import pack_documents
from vigil.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model trained on the labelled rows."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts: the longest, then the smallest id."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document repeats for each whole pass over its words.

    A row comes once for each time the mix takes at least half its words anew:
    round(taken / size) times. A document without words stays once.
    """
    mix = mix_sources(docs)
    times = F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int")
    taken = mix.groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max(times).alias("times")).where("times > 0")
    rows = docs.select(F.struct("*").alias("row"))
    repeated = rows.join(taken, F.col("row.doc_id").eqNullSafe(F.col("mixed_id"))).select(
        "row", F.explode(F.sequence(F.lit(1), F.col("times")))
    )
    return repeated.select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither the toxicity model nor tokens.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    package_on_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
