"""Packing documents into token sequences by best-two-fit over counts of lengths."""

from __future__ import annotations

import base64
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from vigil.llm.common import text_of, written

END_ID = 2
# Fixed value: the vocabulary's only special token.
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary as ranks. Gives the ids of byte_bpe_50k.json (a test compares them), faster."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cut_pieces(docs: DataFrame, *, id_col: str, text_col: str, capacity: int, vocabulary: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and END_ID, cut from the end into pieces of `capacity`."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoder(vocabulary)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encoding.encode(text, allowed_special="all"), END_ID], "<u4")
                begin, end = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while begin < len(ids):
                    out.append((doc_id, piece, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())))
                    piece, begin, end = piece + 1, end, end + capacity
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return texts.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_two_fit(counts: dict[int, int], capacity: int, replace: bool = True) -> list[tuple[list[int], int]]:
    """Bins for counts[length] documents of each length, as (lengths, number of such bins).

    A bin starts with the longest document left and is filled greedily, each
    time with the longest that fits. If a gap is left, its smallest document is
    replaced by the two unpacked documents that fill the expanded gap best, if
    they fill more (not at all without `replace`). Equal bins are made at once, as often as the counts allow,
    which uses up at least one length or brings it below what the bin needs; so
    the number of different bins depends on the capacity, not on the documents.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    sizes = np.arange(capacity + 1)
    bins = []
    while left.any():
        taken: Counter[int] = Counter()
        free = left.copy()

        def longest(most: int) -> int:
            fits = np.flatnonzero(free[1 : most + 1])
            return int(fits[-1]) + 1 if fits.size else 0

        gap, chosen = capacity, []
        while gap and (length := longest(gap)):
            chosen.append(length)
            free[length] -= 1
            gap -= length
        if replace and gap and chosen:
            smallest = min(chosen)
            room = gap + smallest
            below = np.maximum.accumulate(np.where(free > 0, sizes, 0))  # the longest left of at most each length
            first = np.flatnonzero(free[: room + 1])
            second = below[np.minimum(room - first, first)]
            alone = (second == first) & (free[first] < 2)
            second[alone] = below[np.maximum(first[alone] - 1, 0)]
            second[second == 0] = -capacity
            if first.size:
                best = int(np.argmax(first + second))
                if first[best] + second[best] > smallest:
                    chosen.remove(smallest)
                    chosen += [int(first[best]), int(second[best])]
        taken.update(chosen)
        times = min(int(left[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            left[length] -= times * n
        bins.append((sorted(chosen, reverse=True), times))
    return bins


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    vocabulary: str | None = None,
    group_rows: int = 50_000,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each row of docs is a document: the ids of its text (null: empty), then
    END_ID; one longer than `capacity` is cut into pieces of that length, the
    first shorter. Only the number of pieces of each length, `capacity` numbers
    at most, reach the driver, which plans bins with `best_two_fit`; few lengths
    can pack better without replacement, so the plan of fewer bins is taken. Pieces are
    then numbered within their length, in hashed groups of about `group_rows`,
    and take the places the plan has for their number. Repeated rows are packed
    each; a null id stays null; an empty table gives no rows.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = written(cut_pieces(docs, id_col=id_col, text_col=text_col, capacity=capacity, vocabulary=path), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places: dict[int, list[tuple[int, int, int]]] = {}  # by length: from this number on, sequence - number, offset
    used: Counter[int] = Counter()
    sequence = 0
    plans = [best_two_fit(counts, capacity, replace) for replace in (True, False)]
    for lengths, times in min(plans, key=lambda bins: sum(times for _, times in bins)):
        offset = 0
        for length in lengths:
            places.setdefault(length, []).append((used[length], sequence - used[length], offset))
            used[length] += times
            offset += length
        sequence += times
    plan = {length: np.array(rows, np.int64).T for length, rows in places.items()}

    groups = max(1, math.ceil(max(counts.values(), default=1) / group_rows))
    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("length", "deal").count().select(
        "length", "deal", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("length", "deal").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        dealt.withColumn("number", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "deal"])
        .withColumn("number", F.col("number") + F.col("first"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            batch["sequence_id"], batch["offset"] = 0, 0
            for length, rows in batch.groupby("length").groups.items():
                first, shift, offset = plan[length]
                number = batch.loc[rows, "number"].to_numpy()
                slot = np.searchsorted(first, number, side="right") - 1
                batch.loc[rows, "sequence_id"] = number + shift[slot]
                batch.loc[rows, "offset"] = offset[slot]
            yield batch.drop(columns="number")

    return numbered.mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
