"""Exact dedup by a tree merge of sorted digest runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.common import by_ids, shuffle_partitions, text_of, written

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_of(text), BLANKS, "")


def merge_runs(rows: DataFrame, fan: int = 8) -> DataFrame:
    """One row per digest: (digest, proof, n_bytes, n, best), merged from one run per partition.

    rows has digest, proof, n_bytes, best. Each partition first makes a run of
    its own, a row per digest. In round r the runs whose numbers differ in
    their r-th digit to the base `fan` exchange: each gives its partner the
    digests that have the partner's digit, and what arrives is merged by sorted
    aggregation to one row per digest, keeping the best row. After
    log_fan(partitions) rounds a digest lies in one run only; no run is ever
    larger than its share of the digests. Rows count as equal only if a second
    hash and the length agree with the digest at every level (verification).
    """
    rounds = max(1, math.ceil(math.log(max(2, shuffle_partitions(rows.sparkSession)), fan)))
    h = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    run = rows.select("*", F.lit(1).cast("long").alias("n"), F.pmod(F.spark_partition_id(), F.lit(fan**rounds)).cast("long").alias("run"))
    for r in range(rounds):
        size = fan ** (r + 1)
        run = (
            run.withColumn("slot", F.pmod(h, F.lit(size)))
            .withColumn("run", F.floor(F.col("run") / fan))
            .groupBy("slot", "run", "digest", "proof", "n_bytes")
            .agg(F.sum("n").alias("n"), F.max("best").alias("best"))
        )
    return run.select("digest", "proof", "n_bytes", "n", "best")


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fan: int = 8) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after deleting blanks; null counts as empty,
    so null, empty and blank texts are one group. Of equal texts the row with
    the most code points in the original text stays, then the smallest id (a
    null id loses to any other), then one of the rows that repeat an id.
    Other columns are not read; an empty table gives an empty result.
    """
    normal = F.encode(normalised("text"), "UTF-8")
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length(text_of("text")).alias("n_chars"),
        normal.alias("normal"),
    )
    rows = written(
        marked.select(
            "doc_id",
            "row",
            F.unhex(F.sha2("normal", 256)).alias("digest"),
            F.xxhash64("normal").alias("proof"),
            F.length("normal").alias("n_bytes"),
            F.struct(F.col("n_chars"), (-F.col("doc_id")).alias("negative_id"), (-F.col("row")).alias("negative_row")).alias("best"),
        ),
        "digests",
    )
    groups = merge_runs(rows.select("digest", "proof", "n_bytes", "best"), fan)
    key = ["digest", "proof", "n_bytes"]
    return rows.drop("best").join(groups, key).select(
        "doc_id",
        (-F.col("best.negative_id")).alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == -F.col("best.negative_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; a row repeated with its id and text stays once."""
    groups = written(exact_groups(docs, id_col=id_col, text_col=text_col), "groups")
    repeated = written(groups.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "repeated")
    gone = written(by_ids(groups.where("NOT kept"), "doc_id", repeated, "left_anti").select("doc_id"), "gone")
    single = by_ids(by_ids(docs, id_col, gone, "left_anti"), id_col, repeated, "left_anti")
    if repeated.limit(1).count() == 0:
        return single
    # rows whose id does not tell them apart: by id and digest, of equal ones the longest
    rows = by_ids(docs, id_col, repeated, "left_semi").select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("doc_id"),
        F.sha2(F.encode(normalised(text_col), "UTF-8"), 256).alias("text_sha256"),
        F.length(text_of(text_col)).alias("n_chars"),
    )
    kept = groups.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256"))
    of_text = Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("n_chars"))
    first = (
        rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_sha256") == F.col("kept_sha256")), "left_semi")
        .withColumn("number", F.row_number().over(of_text))
        .where("number = 1")
    )
    return single.unionByName(first.select("row.*"))
