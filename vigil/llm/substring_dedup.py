"""Suffix-array dedup: bytes of passages that an earlier document has, too.

Equal passages are brought together by anchors: of the GRAM-byte strings within
each window the one with the smallest hash, which equal windows choose alike.
The surroundings of an anchor that several documents have are cut to what two of
them share and sorted by their suffixes (`suffix_groups`), so that equal windows
show next to each other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import BASE, U64, by_ids, mix, text_of, written
from vigil.llm.suffix_groups import suffix_array

#: Documents with an anchor from which on its windows are compared by their hashes, each by itself.
HOT = 4000
#: Text bytes in a group of documents or, roughly, of anchors that one task holds at a time.
GROUP_BYTES = 8_000_000
#: Bytes hashed at a time; places in them fit into 16 bits.
SEGMENT = 1 << 16
#: Symbols sorted at a time, unless one anchor's surroundings are more.
SORTED_AT_ONCE = 200_000

INTERVAL = np.dtype([("key", "<i8"), ("start", "<i8"), ("end", "<i8")])
HOT_WINDOW = np.dtype([("low", "<u8"), ("high", "<u8"), ("key", "<i8"), ("doc", "<i8"), ("at", "<i8")])


def surroundings(reach: int) -> np.dtype:
    """An anchor with up to `reach` bytes on either side, nearest first."""
    sides = [("left", "u1", (reach,)), ("right", "u1", (reach,))]
    return np.dtype([("anchor", "<u8"), ("key", "<i8"), ("doc", "<i8"), ("at", "<i8"), ("n_left", "u1"), ("n_right", "u1"), *sides])


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate(([U64(1)], np.full(n - 1, b, U64)))) for b in (base, pow(base, -1, 1 << 64)))


@lru_cache(maxsize=4)
def _byte_numbers(salt: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) + U64(1000 * salt))


def gram_hashes(raw: np.ndarray, gram: int, salt: int = 0) -> np.ndarray:
    """A hash of the `gram` bytes from each place on (gram - 1 places fewer): differences of prefix sums.

    raw has at most SEGMENT bytes.
    """
    powers, inverse = _powers(BASE + 2 * salt, SEGMENT)
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, U64)
        np.cumsum(_byte_numbers(salt)[raw] * powers[: len(raw)], out=total[1:])
        sums = (total[gram:] - total[:-gram]) * inverse[: len(raw) - gram + 1]
        sums ^= sums >> U64(32)
        sums *= U64(0xD6E8FEB86659FD93)
        return sums ^ (sums >> U64(32))


def segments(n: int, window: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of n bytes, of at most SEGMENT each, that together hold each window."""
    for start in range(0, max(n - window + 1, 0), SEGMENT - window + 1):
        yield start, min(n, start + SEGMENT)


def anchors(raw: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order, and hashes (48 bits), of the grams with the smallest hash (the first of equal ones) of some window."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for start, end in segments(len(raw), window):
        # the hash above the place: the smallest of a run has the smallest hash, and of equal ones the first place
        low = gram_hashes(raw[start:end], gram) >> U64(16) << U64(16)
        low |= np.arange(len(low), dtype=U64)
        width, wanted = 1, window - gram + 1
        while width < wanted:
            step = min(width, wanted - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        low = low[np.concatenate(([True], low[1:] != low[:-1]))]
        places.append((low & U64(0xFFFF)).astype(np.int64) + start)
        hashes.append(low >> U64(16))
    if len(places) == 2:
        return places[1], hashes[1]
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of a matrix of bytes."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(rows), U64)
        for column in rows.T:
            total = mix(total * U64(BASE) + column.astype(U64) + U64(1))
    return total


def _numbers(*keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the distinct combinations of keys."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _shared(group: np.ndarray, side: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per row of side: the longest prefix it has in common with another row of its group (rows hold n bytes)."""
    reach = side.shape[1]
    spelled = np.where(np.arange(reach) < n[:, None], side.astype(">u2") + 1, 0).astype(">u2")
    order = np.lexsort((np.ascontiguousarray(spelled).view(f"S{2 * reach}")[:, 0], group))
    a, b = order[:-1], order[1:]
    same = (spelled[a] == spelled[b]) & (spelled[a] > 0)
    common = np.where(group[a] == group[b], np.cumprod(same, axis=1).sum(axis=1), 0)
    out = np.zeros(len(group), np.int64)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def lowest_by_window(texts: list[np.ndarray], first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, lowest): for each run of `window` symbols the smallest `first` of the texts that have it.

    All texts are sorted as one with ends between them; runs that are equal are
    neighbours among its suffixes.
    """
    lengths = np.array([len(t) for t in texts])
    begins = np.cumsum(lengths + 1) - lengths - 1
    joined = np.zeros(int(lengths.sum()) + len(texts), np.int64)
    for begin, text in zip(begins, texts):
        joined[begin : begin + len(text)] = text
    order = np.array(suffix_array(joined.tolist()))
    which = np.searchsorted(begins, order, side="right") - 1
    start = order - begins[which]
    fits = start + window <= lengths[which]
    order, which, start = order[fits], which[fits], start[fits]
    if not len(order):
        return which, start, first[which]
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in range(window):
        symbols = joined[order + k]
        new[1:] |= symbols[1:] != symbols[:-1]
    return which, start, np.minimum.reduceat(first[which], np.flatnonzero(new))[np.cumsum(new) - 1]


def covered(found: np.ndarray, window: int, gram: int) -> np.ndarray:
    """INTERVALs of the windows around anchors that a document with a smaller number has, too."""
    reach = window - gram
    need = reach  # bytes of a window outside its anchor
    _, anchor = np.unique(found["anchor"], return_inverse=True)
    sides = _row_hashes(np.concatenate((found["left"], found["right"], found["n_left"][:, None], found["n_right"][:, None]), axis=1))
    context = _numbers(sides, anchor)
    n = context.max() + 1
    first = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(first, context, found["doc"])
    sample = np.empty(n, np.int64)
    sample[context] = np.arange(len(found))
    out = []

    def intervals(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        part = np.empty(len(rows), INTERVAL)
        part["key"], part["start"], part["end"] = found["key"][rows], start, end
        out.append(part)

    # a document that is not the first with the same surroundings has all its windows in common with that
    late = np.flatnonzero((found["doc"] > first[context]) & (found["n_left"].astype(int) + found["n_right"] >= need))
    at = found["at"][late]
    intervals(late, at - found["n_left"][late], at + gram + found["n_right"][late])

    group = anchor[sample]
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(several):
        row, group, first = sample[several], group[several], first[several]
        left = _shared(group, found["left"][row], found["n_left"][row])
        right = _shared(group, found["right"][row], found["n_right"][row])
        enough = left + right >= need
        row, group, first, left, right = row[enough], group[enough], first[enough], left[enough], right[enough]
    else:
        row = several
    if len(row):
        places = np.arange(reach)
        cut_left = np.where(places < left[:, None], found["left"][row], 0)
        cut_right = np.where(places < right[:, None], found["right"][row], 0)
        parts = np.concatenate((cut_left, cut_right, left[:, None], right[:, None]), axis=1)
        piece = _numbers(_row_hashes(parts), group)
        m = piece.max() + 1
        of_piece = np.empty(m, np.int64)
        of_piece[piece] = np.arange(len(row))
        earliest = np.full(m, np.iinfo(np.int64).max)
        np.minimum.at(earliest, piece, first)
        # windows of each piece with the first document that has them, pieces of an anchor together
        pieces_of = np.bincount(group[of_piece])[group[of_piece]]
        width = (left + right)[of_piece]
        # an anchor's only piece: all its windows are the first document's
        only = np.flatnonzero(pieces_of == 1)
        n_starts = width[only] - need + 1
        starts = np.arange(n_starts.sum()) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
        found_windows = [(np.repeat(only, n_starts), starts, np.repeat(earliest[only], n_starts))]
        several = np.flatnonzero(pieces_of > 1)
        by_anchor = several[np.argsort(group[of_piece][several], kind="stable")]
        sizes = width[by_anchor] + 2
        anchors_of = group[of_piece][by_anchor]
        begin = 0
        ends = np.flatnonzero(np.concatenate((anchors_of[1:] != anchors_of[:-1], [True]))) + 1 if len(several) else []
        total = np.concatenate(([0], np.cumsum(sizes)))
        for k, end in enumerate(ends):
            last = k == len(ends) - 1
            if not last and total[ends[k + 1]] - total[begin] <= SORTED_AT_ONCE:
                continue
            pieces = by_anchor[begin:end]
            rows = of_piece[pieces]
            texts = [
                np.concatenate((cut_left[r, : left[r]][::-1] + 1, [300 + group[r]], cut_right[r, : right[r]] + 1)) for r in rows
            ]
            which, start, lowest = lowest_by_window(texts, earliest[pieces], need + 1)
            found_windows.append((pieces[which], start, lowest))
            begin = end
        which, start, lowest = (np.concatenate(x) for x in zip(*found_windows))
        # each context against the windows of its piece
        order = np.argsort(which, kind="stable")
        which, start, lowest = which[order], start[order], lowest[order]
        n_windows = np.bincount(which, minlength=m)
        offset = np.cumsum(n_windows) - n_windows
        contexts = np.repeat(np.arange(len(row)), n_windows[piece])
        place = np.arange(len(contexts)) - np.repeat(np.cumsum(n_windows[piece]) - n_windows[piece], n_windows[piece])
        window_no = offset[piece[contexts]] + place
        hit = lowest[window_no] < first[contexts]
        contexts, window_no = contexts[hit], window_no[hit]
        # of such a context its first document is left; the others are covered already
        own = np.flatnonzero(found["doc"] == _first_of(found, context))
        by_context = np.argsort(context[own], kind="stable")
        own = own[by_context]
        n_own = np.bincount(context[own], minlength=n)
        own_at = np.cumsum(n_own) - n_own
        numbers = context[row[contexts]]
        repeat = n_own[numbers]
        who = np.repeat(np.arange(len(contexts)), repeat)
        rows = own[np.repeat(own_at[numbers], repeat) + np.arange(len(who)) - np.repeat(np.cumsum(repeat) - repeat, repeat)]
        begins = found["at"][rows] - left[contexts[who]] + start[window_no[who]]
        intervals(rows, begins, begins + window)
    return merged(np.concatenate(out))


def _first_of(found: np.ndarray, context: np.ndarray) -> np.ndarray:
    first = np.full(context.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, context, found["doc"])
    return first[context]


def merged(intervals: np.ndarray) -> np.ndarray:
    """Intervals of each key without overlaps; ones that touch are one."""
    if not len(intervals):
        return intervals
    intervals = intervals[np.lexsort((intervals["start"], intervals["key"]))]
    key, start = intervals["key"], intervals["start"]
    first_of_key = np.concatenate(([True], key[1:] != key[:-1]))
    # running maximum of the ends within a key: numbers of keys times a span keep keys apart
    span = int(intervals["end"].max()) + 1
    number = np.cumsum(first_of_key) - 1
    reach = np.maximum.accumulate(number * span + intervals["end"]) - number * span
    new = first_of_key.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    out = np.empty(len(at), INTERVAL)
    out["key"], out["start"] = key[at], start[at]
    out["end"] = reach[np.concatenate((at[1:] - 1, [len(key) - 1]))]
    return out


def hot_covered(found: np.ndarray, window: int) -> np.ndarray:
    """INTERVALs of the windows, known by 128 bits of hash, that a document with a smaller number has, too."""
    number = _numbers(found["low"], found["high"])
    first = np.full(number.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, number, found["doc"])
    late = found[found["doc"] > first[number]]
    out = np.empty(len(late), INTERVAL)
    out["key"], out["start"], out["end"] = late["key"], late["at"], late["at"] + window
    return merged(out)


def squeezed(rows: np.ndarray) -> bytes:
    """Rows of a structured array, one field after the other, compressed: half of what the shuffle makes of them."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names))


def unsqueezed(data: bytes, kind: np.dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    rows, at = np.empty(len(raw) // kind.itemsize, kind), 0
    for name in kind.names:
        field = kind[name]
        size = field.itemsize * len(rows)
        rows[name] = np.frombuffer(raw[at : at + size], field.base).reshape(len(rows), *field.shape)
        at += size
    return rows


def _packed(column: str, number: np.ndarray, data: np.ndarray, to_bytes: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> pd.DataFrame:
    """A row per distinct number with the bytes of its part of data."""
    order = np.argsort(number, kind="stable")
    number, data = number[order], data[order]
    at = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else np.zeros(0, int)
    parts = [to_bytes(data[a:b]) for a, b in zip(at, [*at[1:], len(data)])]
    return pd.DataFrame({column: number[at], "data": parts})


def _bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8"), np.uint8)


def repeated_spans(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 20
) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (array of (start, end) in UTF-8 bytes), kept_sha256.

    spans are the maximal runs of bytes covered by `window`-byte strings that
    also start in a document with a smaller id; kept_sha256 is the digest of the
    bytes outside them. Equal texts are decided by their digests first: all but
    the smallest id's are covered whole. The other documents send their anchors'
    hashes, in packed rows, to be counted; groups of documents get back which of
    theirs are repeated and send these anchors' surroundings, which are compared
    anchor by anchor (`covered`). Anchors in more than HOT documents send their
    windows' hashes instead, which spread over all tasks. No group grows with
    the input: there are the more groups the more bytes.

    Null, empty and shorter texts have no spans. Rows without an id have none
    and cover nothing. Rows with one id do not cover each other; a row repeated
    with its text has the same spans. Other columns are not read; an empty
    table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "row_key", F.xxhash64("doc_id", "text")
    )
    raw = F.encode("text", "UTF-8")
    base = written(
        texts.select("doc_id", "row_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("digest")), "texts"
    )
    firsts = written(base.groupBy("digest").agg(F.min("doc_id").alias("first_id")), "firsts")  # joined anew, so that a hot digest can be split
    placed = written(
        base.join(firsts, "digest").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))), "texts"
    )
    copies = written(placed.where("copy").select("row_key").distinct(), "copies")
    size = placed.where("NOT copy").agg(F.sum("n_bytes")).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    single = by_ids(texts.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= window)), "row_key", copies, "left_anti")
    reach = window - gram
    context = surroundings(reach)
    entry = np.dtype([("bucket", "<u4"), ("hash", "u1", (6,))])

    def send_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        buckets: list[np.ndarray] = []
        n = 0

        def packed() -> pd.DataFrame:
            hashes, bucket = np.concatenate(held), np.concatenate(buckets)
            order = np.lexsort((bucket, hashes % U64(groups)))
            hashes, bucket = hashes[order], bucket[order]
            data = np.empty(len(hashes), entry)
            data["bucket"] = bucket
            data["hash"] = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            return _packed("target", (hashes % U64(groups)).astype(np.int64), data)

        for batch in batches:
            for key, text in zip(batch["row_key"], batch["text"]):
                own = np.unique(anchors(_bytes_of(text), window, gram)[1])
                held.append(own)
                buckets.append(np.full(len(own), key % groups, np.uint32))
                n += len(own)
                if n > 1_000_000:
                    yield packed()
                    held, buckets, n = [], [], 0
        if n:
            yield packed()

    def count(group: pd.DataFrame) -> pd.DataFrame:
        data = np.concatenate([np.frombuffer(d, entry) for d in group["data"]])
        hashes = np.zeros((len(data), 8), np.uint8)
        hashes[:, :6] = data["hash"]
        hashes = hashes.view("<u8")[:, 0]
        order = np.lexsort((data["bucket"], hashes))
        hashes, bucket = hashes[order], data["bucket"][order]
        new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        times = np.diff(np.append(np.flatnonzero(new), len(hashes)))[np.cumsum(new) - 1]
        new[1:] |= bucket[1:] != bucket[:-1]
        keep = new & (times > 1)
        # 48 bits of hash and whether the anchor is hot
        return _packed("bucket", bucket[keep].astype(np.int64), hashes[keep] * U64(2) + (times[keep] > HOT))

    repeated = (
        single.select("row_key", "text")
        .mapInPandas(send_anchors, "target long, data binary")
        .groupBy("target")
        .applyInPandas(count, "bucket long, data binary")
    )
    bucket_of = F.pmod("row_key", F.lit(groups)).alias("bucket")

    def send_surroundings(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = np.sort(np.concatenate([np.zeros(0, U64), *(np.frombuffer(d, "<u8") for d in answers["data"])]))
        known_hash, known_hot = known >> U64(1), (known & U64(1)).astype(bool)
        near, hot = [np.zeros(0, context)], [np.zeros(0, HOT_WINDOW)]
        for key, doc, text in zip(group["row_key"], group["doc_id"], group["text"]):
            if not len(known):
                break
            raw = _bytes_of(text)
            at, hashes = anchors(raw, window, gram)
            where = np.minimum(np.searchsorted(known_hash, hashes), len(known) - 1)
            among = known_hash[where] == hashes
            at, hashes, where = at[among], hashes[among], where[among]
            is_hot = known_hot[where]
            if is_hot.any():
                begins = np.unique(np.concatenate([np.arange(max(0, p - reach), min(p, len(raw) - window) + 1) for p in at[is_hot]]))
                for start, end in segments(len(raw), window):
                    own = begins[(begins >= start) & (begins <= end - window)]
                    part = np.empty(len(own), HOT_WINDOW)
                    for name, salt in (("low", 1), ("high", 2)):
                        part[name] = gram_hashes(raw[start:end], window, salt)[own - start]
                    part["key"], part["doc"], part["at"] = key, doc, own
                    hot.append(part)
                at, hashes = at[~is_hot], hashes[~is_hot]
            part = np.empty(len(at), context)
            padded = np.concatenate((np.zeros(reach, np.uint8), raw, np.zeros(reach, np.uint8)))
            part["anchor"], part["key"], part["doc"], part["at"] = hashes, key, doc, at
            part["n_left"], part["n_right"] = np.minimum(at, reach), np.minimum(len(raw) - at - gram, reach)
            part["left"] = padded[at[:, None] + np.arange(reach)[::-1]]
            part["right"] = padded[at[:, None] + reach + gram + np.arange(reach)]
            near.append(part)
        near_all, hot_all = np.concatenate(near), np.concatenate(hot)
        out = [
            _packed("target", (near_all["anchor"] % U64(groups)).astype(np.int64), near_all, squeezed).assign(hot=False),
            _packed("target", (hot_all["low"] % U64(groups)).astype(np.int64), hot_all, squeezed).assign(hot=True),
        ]
        return pd.concat(out)[["target", "hot", "data"]]

    sent = (
        single.select(bucket_of, "row_key", "doc_id", "text")
        .groupBy("bucket")
        .cogroup(repeated.groupBy("bucket"))
        .applyInPandas(send_surroundings, "target long, hot boolean, data binary")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros(0, INTERVAL)]
        for is_hot, kind, find in ((False, context, lambda x: covered(x, window, gram)), (True, HOT_WINDOW, lambda x: hot_covered(x, window))):
            data = [unsqueezed(d, kind) for d in group.loc[group["hot"] == is_hot, "data"]]
            if data:
                out.append(find(np.concatenate(data)))
        spans = merged(np.concatenate(out))
        return _packed("bucket", spans["key"] % groups, spans)

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        spans = merged(np.concatenate([np.frombuffer(d, INTERVAL) for d in group["data"]]))
        return pd.DataFrame({"bucket": group["bucket"][:1], "data": [spans.tobytes()]})

    compared = sent.groupBy("target").applyInPandas(compare, "bucket long, data binary")
    spans = written(compared.groupBy("bucket").applyInPandas(gather, "bucket long, data binary"), "spans")

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                yield pd.DataFrame({"row_key": np.unique(np.frombuffer(data, INTERVAL)["key"])})

    touched = written(spans.select("data").mapInPandas(keys, "row_key long"), "touched")
    cut_texts = by_ids(single.select(bucket_of, "row_key", "text"), "row_key", touched, "left_semi")

    def cut(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        all_spans = merged(np.concatenate([np.zeros(0, INTERVAL), *(np.frombuffer(d, INTERVAL) for d in found["data"])]))
        out = []
        for key, text in zip(group["row_key"], group["text"]):
            a, b = np.searchsorted(all_spans["key"], [key, key + 1] if key < np.iinfo(np.int64).max else [key, key], side="left")
            own = all_spans[a:b]
            raw = text.encode("utf-8")
            kept, at = hashlib.sha256(), 0
            for start, end in zip(own["start"], own["end"]):
                kept.update(raw[at:start])
                at = end
            kept.update(raw[at:])
            out.append((key, [{"start": int(s), "end": int(e)} for s, e in zip(own["start"], own["end"])], kept.hexdigest()))
        return pd.DataFrame(out, columns=["row_key", "spans", "kept_sha256"])

    kind = "array<struct<start:bigint,end:bigint>>"
    done = (
        cut_texts.groupBy("bucket")
        .cogroup(spans.groupBy("bucket"))
        .applyInPandas(cut, f"row_key long, spans {kind}, kept_sha256 string")
        .dropDuplicates(["row_key"])
    )
    whole = F.col("copy") & (F.col("n_bytes") >= window)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return placed.join(done, "row_key", "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, all_of_it).otherwise(F.coalesce("spans", F.array().cast(kind))).alias("spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
    )
