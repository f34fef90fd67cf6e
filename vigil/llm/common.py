"""Helpers the operators share: written tables, hashing in numpy, components of a graph."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

U64 = np.uint64
#: A set of ids is broadcast up to this many rows (8 bytes each); beyond, both sides are shuffled.
BROADCAST_ROWS = 400_000
BASE = 0x9E3779B97F4A7C15 | 1


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session without that setting gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="vigil-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def package_on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, if it is there and not installed."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    package_on_workers(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def by_ids(rows: DataFrame, column: str, ids: DataFrame, how: str) -> DataFrame:
    """Left semi or left anti join of rows with a written table of one column of ids; null equals null."""
    keys = ids.toDF("id of the other side")
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return rows.join(keys, rows[column].eqNullSafe(keys["id of the other side"]), how)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes to doubles in (0, 1]."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


def components(edges: DataFrame, vertices: DataFrame, partitions: int | None = None) -> DataFrame:
    """(v, component): for each vertex the smallest vertex reachable through edges (a, b).

    vertices has a column v; vertices without edges are their own component.
    Each round takes the smallest label among the neighbours, then the label of
    that label; both are joins and combining aggregates, written to the shared
    folder. The number of rounds grows with the logarithm of the longest path.
    """
    both = written(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("low"))
        # the label's own vertex learns of the smaller one, too
        roots = hooked.groupBy(F.col("label").alias("v")).agg(F.min("low").alias("root"))
        step = written(
            hooked.join(roots.select(F.col("v").alias("label"), "root"), "label", "left")
            .select("v", F.col("label").alias("old"), F.least("low", "root").alias("low")),
            "labels",
        )
        jumped = step.join(step.select(F.col("v").alias("low"), F.col("low").alias("next")), "low", "left")
        new = written(jumped.select("v", "old", F.least("low", "next").alias("label")), "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("v", "label")
        if not changed:
            break
    return vertices.select("v").join(labels, "v", "left").select("v", F.coalesce("label", "v").alias("component"))
