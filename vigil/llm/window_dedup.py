"""Substring dedup by difference-cover anchors: words of passages that occur anywhere else, too.

Of a document's places, modulo PERIOD, only those in COVER are hashed. Any two
places have a common shift below PERIOD that brings both into the cover, so two
equal windows share the hash of the words at that shift: their anchor. Anchors
that occur once end there; around the others, windows are extended to their
whole length and compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import BASE, U64, by_ids, mix, package_on_workers, text_of, written
from vigil.llm.substring_dedup import _powers, squeezed, unsqueezed

#: Each difference modulo 21 is one of two of these five places (a perfect difference set).
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
#: Text bytes in a group of documents, and roughly of hashes, that a task holds at a time.
GROUP_BYTES = 16_000_000
#: Hashes a task of the first pass gathers before it sends them.
HELD = 2_000_000

HASH = np.dtype([("bucket", "<i4"), ("hash", "<u8"), ("twice", "?")])
WINDOW = np.dtype([("low", "<u8"), ("high", "<u4"), ("twice", "?")])
SPAN = "array<struct<start:bigint,end:bigint>>"


def covered_places(n_words: int, gram: int) -> np.ndarray:
    """Places of a document's anchors: those in the cover that `gram` words follow."""
    places = (np.arange(0, max(0, n_words - gram + 1), PERIOD)[:, None] + np.array(COVER)).ravel()
    return places[places <= n_words - gram]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def run_hashes(words: np.ndarray, at: np.ndarray, length: int, salt: int) -> np.ndarray:
    """A hash of the `length` words from each place: a polynomial of their hashes, by differences of prefix sums."""
    with np.errstate(over="ignore"):
        powers, inverses = _powers((BASE + 2 * salt) & (2**64 - 1), len(words) + 1)
        sums = np.concatenate(([U64(0)], np.cumsum(mix(words + U64(salt)) * powers[: len(words)])))
        return mix((sums[at + length] - sums[at]) * inverses[at])


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], marked, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def _words(text: str) -> list[bytes]:
    return text.encode().split()  # at blanks and the control characters from tab to carriage return


def _dealt(target: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Rows by target, each target's packed; within it rows keep their order."""
    order = np.argsort(target, kind="stable")
    target, rows = target[order], rows[order]
    at = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.zeros(0, int)
    return target[at].tolist(), [squeezed(rows[i:j]) for i, j in zip(at, [*at[1:], len(rows)])]


def repeated_windows(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35
) -> DataFrame:
    """Per row: doc_id, n_words, spans (array of (start, end) in words), kept_sha256.

    spans are the maximal runs of words covered by windows of `window` words whose
    sequence starts anywhere else, in the same document or another. kept_sha256
    is the digest of the other words, joined by one space.

    1. Texts with the same words are one class, decided by a digest; if it has
       several rows, all its windows are repeated. One text of each goes on.
    2. Each text's anchors, hashes of `window` - PERIOD + 1 words at the cover's
       places, go to groups by hash, once per group of documents, and come back
       if another group has them or this one has them twice.
    3. Around these, each window that holds one is extended to its whole length
       and its 96-bit hash sent, again once per group of documents.
    4. Windows that come back as repeated are marked in their documents.

    A passage that most documents have is sent once by each group of documents
    (GROUP_BYTES of text), so no key gets a row per document.

    Words are what is between blanks and the control characters from tab to
    carriage return, unchanged. Null, empty and shorter texts have no spans. A
    very long text is one document of its group. Rows with null ids count like
    others; a row repeated with its text is a copy. Other columns are not read;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    package_on_workers(spark)
    gram = window - PERIOD + 1
    if gram < 1:
        raise ValueError(f"windows have at least {PERIOD} words")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "row_key", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"))
    )

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [_words(t) for t in batch["text"]]
            joined = [b" ".join(w) for w in words]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "row_key": batch["row_key"],
                    "digest": [hashlib.sha256(j).hexdigest() for j in joined],
                    "n_words": [len(w) for w in words],
                    "n_bytes": [len(j) for j in joined],
                }
            )

    rows = written(texts.mapInPandas(digests, "doc_id long, row_key string, digest string, n_words long, n_bytes long"), "window-texts")
    classes = rows.where(F.col("n_words") >= window).groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id"))
    classes = written(classes.where("rows > 1"), "window-classes")  # joined anew, so that a hot digest can be split
    further = ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    placed = written(
        rows.join(classes, "digest", "left").select(
            *rows.columns, F.col("rows").isNotNull().alias("copied"), (F.col("rows").isNotNull() & further).alias("dropped")
        ),
        "window-texts",
    )
    dropped = written(placed.where("dropped").select("row_key").distinct(), "window-copies")
    size = placed.where("NOT dropped").agg(F.sum("n_bytes")).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    single = by_ids(texts.where(F.octet_length("text") >= 2 * window - 1), "row_key", dropped, "left_anti").select(
        F.pmod(F.xxhash64("row_key"), F.lit(groups)).alias("bucket"), "row_key", "text"
    )
    done = written(_marked(single, groups, window, gram), "window-spans")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return placed.join(done, "row_key", "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copied"), all_of_it).otherwise(F.coalesce("spans", F.array().cast(SPAN))).alias("spans"),
        F.when(F.col("copied"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
    )


def _marked(single: DataFrame, groups: int, window: int, gram: int) -> DataFrame:
    """(row_key, spans, kept_sha256) of the texts in `single` (bucket, row_key, text) that have repeated windows."""

    def send_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        n = 0

        def packed() -> pd.DataFrame:
            found = np.concatenate(held)
            found = found[np.lexsort((found["hash"], found["bucket"]))]
            new = np.concatenate(([True], (found["hash"][1:] != found["hash"][:-1]) | (found["bucket"][1:] != found["bucket"][:-1])))
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(found)))
            found = found[first]
            found["twice"] |= times > 1
            target, data = _dealt((found["hash"] % U64(groups)).astype(np.int64), found)
            return pd.DataFrame({"target": target, "data": data})

        for batch in batches:
            for bucket, text in zip(batch["bucket"], batch["text"]):
                words = word_hashes(_words(text))
                part = np.zeros(len(at := covered_places(len(words), gram)), HASH)
                part["bucket"], part["hash"] = bucket, run_hashes(words, at, gram, 0)
                held.append(part)
                n += len(part)
                if n > HELD:
                    yield packed()
                    held, n = [], 0
        if n:
            yield packed()

    def answer_anchors(group: pd.DataFrame) -> pd.DataFrame:
        found = np.concatenate([unsqueezed(d, HASH) for d in group["data"]])
        found = found[np.lexsort((found["bucket"], found["hash"]))]
        new = np.concatenate(([True], found["hash"][1:] != found["hash"][:-1]))
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        entries = np.diff(np.append(first, len(found)))
        again = (entries > 1) | np.logical_or.reduceat(found["twice"], first)
        keep = again[number]
        keep[1:] &= new[1:] | (found["bucket"][1:] != found["bucket"][:-1])
        bucket, data = _dealt(found["bucket"][keep], found["hash"][keep].astype(np.dtype([("hash", "<u8")])))
        return pd.DataFrame({"bucket": bucket, "data": data})

    anchors = single.select("bucket", "text").mapInPandas(send_anchors, "target long, data binary")
    repeated = written(anchors.groupBy("target").applyInPandas(answer_anchors, "bucket long, data binary"), "window-anchors")

    def send_windows(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = np.sort(np.concatenate([np.zeros(0, U64), *(unsqueezed(d, np.dtype([("hash", "<u8")]))["hash"] for d in answers["data"])]))
        held = [np.zeros(0, WINDOW)]
        for text in group.drop_duplicates("row_key")["text"] if len(known) else ():
            words = word_hashes(_words(text))
            at = covered_places(len(words), gram)
            hashes = run_hashes(words, at, gram, 0)
            at = at[known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes]
            if len(words) >= window and len(at):
                held.append(_windows(words, _extended(at, len(words), window, gram), window))
        found = np.concatenate(held)
        found = found[np.lexsort((found["high"], found["low"]))]
        first = np.flatnonzero(_new(found))
        again = np.diff(np.append(first, len(found))) > 1
        found = found[first]
        found["twice"] = again
        target, data = _dealt((found["low"] % U64(groups)).astype(np.int64), found)
        return pd.DataFrame({"target": target, "bucket": np.full(len(target), group["bucket"].iloc[0] if len(group) else 0), "data": data})

    def answer_windows(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unsqueezed(d, WINDOW) for d in group["data"]]
        found = np.concatenate(parts)
        whose = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.lexsort((found["high"], found["low"]))
        found, whose = found[order], whose[order]
        new = _new(found)
        first = np.flatnonzero(new)
        again = (np.diff(np.append(first, len(found))) > 1) | np.logical_or.reduceat(found["twice"], first)
        keep = again[np.cumsum(new) - 1]
        part, data = _dealt(whose[keep], found[keep])
        return pd.DataFrame({"bucket": group["bucket"].to_numpy()[part], "data": data})

    by_bucket = single.groupBy("bucket")
    windows = by_bucket.cogroup(repeated.groupBy("bucket")).applyInPandas(send_windows, "target long, bucket long, data binary")
    found = written(windows.groupBy("target").applyInPandas(answer_windows, "bucket long, data binary"), "window-hashes")

    def mark(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(answers) and len(group):
            known = np.concatenate([unsqueezed(d, WINDOW) for d in answers["data"]])
            known = known[np.argsort(known["low"], kind="stable")]
            group = group.drop_duplicates("row_key")
            for key, text in zip(group["row_key"], group["text"]):
                words = _words(text)
                if len(words) < window:
                    continue
                hashes = _windows(word_hashes(words), np.arange(len(words) - window + 1), window)
                at = np.flatnonzero(_among(hashes, known))
                if not len(at):
                    continue
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + window, -1)
                covered = np.cumsum(marks)[:-1] > 0
                starts, ends = runs(covered)
                kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
                spans = [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends)]
                out.append((key, spans, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["row_key", "spans", "kept_sha256"])

    marked = by_bucket.cogroup(found.groupBy("bucket"))
    return marked.applyInPandas(mark, f"row_key string, spans {SPAN}, kept_sha256 string")


def _new(windows: np.ndarray) -> np.ndarray:
    """Where sorted windows differ from the one before."""
    differs = (windows["low"][1:] != windows["low"][:-1]) | (windows["high"][1:] != windows["high"][:-1])
    return np.concatenate((np.ones(min(1, len(windows)), bool), differs))


def _windows(words: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    out = np.zeros(len(at), WINDOW)
    out["low"], out["high"] = run_hashes(words, at, window, 1), run_hashes(words, at, window, 2) >> U64(32)
    return out


def _extended(at: np.ndarray, n_words: int, window: int, gram: int) -> np.ndarray:
    """Starts of all windows of a document that hold one of the anchors at the given places."""
    marks = np.zeros(n_words + 2, np.int64)
    np.add.at(marks, np.maximum(0, at - (window - gram)), 1)
    np.add.at(marks, np.minimum(at, n_words - window) + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[: n_words - window + 1] > 0)


def _among(windows: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which windows are among the known ones, which are sorted by their low part."""
    out = np.zeros(len(windows), bool)
    at = np.searchsorted(known["low"], windows["low"])
    left = np.arange(len(windows))
    while len(left):  # past other windows with the same low part, if any
        left = left[at[left] < len(known)]
        left = left[known["low"][at[left]] == windows["low"][left]]
        same = known["high"][at[left]] == windows["high"][left]
        out[left[same]] = True
        left = left[~same]
        at[left] += 1
    return out
