"""Cross-tokenizer alignment: groups of tokens with common ends, and how often two tokens meet corpus-wide.

Texts go to groups of documents by hash. There a text is cut before each space
that follows a visible character; both tokenizers end a token at such a cut, so
equal parts are tokenized and aligned once per group, in numpy over all parts.

Pairs of linked tokens are dealt to shards by hash. Each shard has a minimal
perfect hash of its distinct pairs; the groups' counts become dense vectors
indexed by it, which are added up as a tree. In a second pass each group gets the
counts of its own pairs and aligns its documents again.
"""

from __future__ import annotations

import base64
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import U64, mix, package_on_workers, text_of, written
from vigil.llm.minimal_hash import build, in_order, verified_places
from vigil.llm.substring_dedup import squeezed, unsqueezed

#: Text bytes in a group of documents.
GROUP_BYTES = 5_000_000
#: Shards of pairs; both vocabularies' sizes bound the pairs of one.
SHARDS = 256
#: Groups of documents whose pairs or counts one task puts together.
FAN = 128

# Fixed value: how the second vocabulary writes a space.
SPACE = "▁"
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_BLANK_SPACE = re.compile(r"\s ")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

PAIR_COUNT = np.dtype([("pair", "<i8"), ("links", "<i8")])
ANSWER = np.dtype([("pair", "<i8"), ("links", "<i8"), ("best", "?")])


class Tokenizers:
    """Byte-level ranks (A) and a sentence-piece model (B), with the bytes of each token."""

    def __init__(self, ranks: str, pieces: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.size_b = self.b.vocab_size()
        self.bytes_a = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.bytes_a[rank] = token
        names = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(n)) else n.replace(SPACE, " ").encode() for n in names]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id(SPACE)
        # no token goes on with a space after a visible character, and blanks stay as they are
        self.separable = (
            not any(SPACE in n.lstrip(SPACE) for n in names)
            and [self.bytes_b[i] for i in self.b.encode("  a  b\n ")] != []
            and b"".join(self.bytes_b[i] for i in self.b.encode("  a  b\n ")) == b"   a  b\n "
        )
        # a token's text in a group: followed by another, the last of the first side, the last of the group
        shown_a, shown_b = ([str(i).encode() for i in range(n)] for n in (len(self.bytes_a), self.size_b))
        self.shown_a = [np.array([s + mark for s in shown_a], object) for mark in (b",", b"|")]
        self.shown_b = [np.array([s + mark for s in shown_b], object) for mark in (b",", b";")]

    def parts(self, text: str) -> list[str]:
        """The text with a space before it, cut where both tokenizers end a token; each part without its first space."""
        if not self.separable:
            return [text]
        if text[0] != " " and not _BLANK_SPACE.search(text):
            return text.split(" ")
        return [p[1:] for p in _BEFORE_SPACE.split(" " + text)]

    def encode(self, parts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Of either side all parts' ids and how many each part has, each part with its first space."""
        # one after the other, parts are read as by themselves where they end visibly; the others apart
        if self.separable:
            visible = np.fromiter((p != "" and not p[-1].isspace() for p in parts), bool, len(parts))
        else:
            visible = np.zeros(len(parts), bool)
        together = [p for p, v in zip(parts, visible.tolist()) if v]
        a = [self.a.encode_ordinary(" " + p) if not v else [] for p, v in zip(parts, visible.tolist())]
        n_a = np.fromiter(map(len, a), np.int64, len(a))
        flat_a = np.fromiter(chain.from_iterable(a), np.int64, int(n_a.sum()))
        if together:
            ids = np.array(self.a.encode_ordinary(" " + " ".join(together)), np.int64)
            sizes = np.fromiter((len(p.encode()) + 1 for p in together), np.int64, len(together))
            stops = np.searchsorted(np.cumsum(self.lengths_a[ids]), np.cumsum(sizes)) + 1
            n_a[visible] = np.diff(stops, prepend=0)
            both = np.concatenate((ids, flat_a))
            begins = np.empty(len(parts), np.int64)
            begins[visible] = stops - n_a[visible]
            begins[~visible] = len(ids) + np.cumsum(n_a[~visible]) - n_a[~visible]
            flat_a = both[np.arange(len(both)) + np.repeat(begins - (np.cumsum(n_a) - n_a), n_a)]
        # the model adds the first space itself, but not to an empty text
        b = [ids if p else [self.space] for p, ids in zip(parts, self.b.encode(parts, num_threads=1))]
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        return (flat_a, n_a), (np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum())), n_b)


@lru_cache(maxsize=2)
def tokenizers(ranks: str, pieces: str) -> Tokenizers:
    return Tokenizers(ranks, pieces)


@dataclass
class Alignment:
    """Distinct parts: tokens, groups and links of each, and the links' pairs one part after the other."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    #: groups as text, each followed by ";"
    shown: list[bytes]


def _counts(whose: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(whose, minlength=n).astype(np.int64)


def align(parts: list[str], own: Tokenizers, show: bool) -> Alignment:
    """Align the tokens of each part; a part whose tokens' bytes are not its own is not `good` and has none."""
    encoded = own.encode(parts)
    good = np.ones(len(parts), bool)
    raw = "".join([" " + p for p in parts]).encode()
    for (flat, n), table in zip(encoded, (own.bytes_a, own.bytes_b)):
        if b"".join(map(table.__getitem__, flat.tolist())) != raw:
            stops = np.cumsum(n).tolist()
            spoken = (b"".join(map(table.__getitem__, flat[i:j].tolist())) for i, j in zip([0, *stops], stops))
            good &= np.fromiter((t == b" " + p.encode() for t, p in zip(spoken, parts)), bool, len(parts))
    ids, whose, ends = [], [], []
    for (flat, n), lengths in zip(encoded, (own.lengths_a, own.lengths_b)):
        of_part = np.repeat(np.arange(len(parts)), n)
        if not good.all():
            flat, of_part = flat[good[of_part]], of_part[good[of_part]]
        ids.append(flat)
        whose.append(of_part)
        ends.append(np.cumsum(lengths[flat]))  # both sides have the same bytes, so places agree over all parts
    (a, b), (whose_a, whose_b), (ends_a, ends_b) = ids, whose, ends
    starts_a, starts_b = (np.concatenate(([0], e[:-1])) if len(e) else e for e in ends)
    cut = np.intersect1d(ends_a, ends_b, assume_unique=True)
    first = np.searchsorted(ends_b, starts_a, side="right")
    overlaps = np.searchsorted(starts_b, ends_a, side="left") - first
    link_a = np.repeat(np.arange(len(a)), overlaps)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(overlaps) - overlaps, overlaps) + np.repeat(first, overlaps)
    pairs = a[link_a] * own.size_b + b[link_b]
    n_parts = len(parts)
    out = Alignment(
        good,
        _counts(whose_a, n_parts),
        _counts(whose_b, n_parts),
        _counts(whose_a[np.searchsorted(ends_a, cut)], n_parts),
        _counts(whose_a[link_a], n_parts),
        pairs,
        [],
    )
    if show:
        group_a, group_b = (np.searchsorted(cut, e, side="left") for e in ends)
        last_a, last_b = (np.isin(e, cut, assume_unique=True) for e in ends)
        texts = np.concatenate((np.where(last_a, own.shown_a[1][a], own.shown_a[0][a]), np.where(last_b, own.shown_b[1][b], own.shown_b[0][b])))
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, np.concatenate((group_a, group_b))))
        texts = texts[order].tolist()
        stops = np.cumsum(out.n_a + out.n_b).tolist()
        out.shown = [b"".join(texts[i:j]) for i, j in zip([0, *stops], stops)]
    return out


def _documents(texts: pd.Series, own: Tokenizers) -> tuple[list[str], list[np.ndarray]]:
    """The distinct parts of all texts, and each text's parts by number; an empty text has none."""
    number: defaultdict[str, int] = defaultdict(count().__next__)
    of_texts = [np.array(list(map(number.__getitem__, own.parts(t))) if t else [], np.int64) for t in texts]
    return list(number), of_texts


def _summed_links(pairs: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Distinct pairs in order with the sums of their times."""
    if not len(pairs):
        return np.zeros(0, PAIR_COUNT)
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    at = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    out = np.empty(len(at), PAIR_COUNT)
    out["pair"], out["links"] = pairs[at], np.add.reduceat(times, at)
    return out


def _concatenated(data: pd.Series, kind: np.dtype) -> np.ndarray:
    return np.concatenate([unsqueezed(d, kind) for d in data])


@dataclass(frozen=True)
class LinkCounts:
    """Texts by group of documents, and per group and shard its linked pairs with their corpus-wide counts."""

    texts: DataFrame
    #: (bucket, data): ANSWER rows
    answers: DataFrame
    #: (shard, function, pairs, links): hash function, pairs and counts by place
    shards: DataFrame


def count_links(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, pieces: str | None = None
) -> LinkCounts:
    """How many links hold each pair of tokens linked, over all texts.

    Each group of documents (about GROUP_BYTES of text, by hash of id and text)
    sends its distinct pairs with their counts once, in SHARDS packed rows.
    Rounds of FAN groups put a shard's distinct pairs together, from which its
    hash function is built; further rounds make the counts dense vectors by
    place and add them up. The most a task holds is FAN such vectors, whose
    length the vocabularies bound. Of all pairs, only the highest count of each
    second token reaches the driver: as many numbers as that vocabulary has ids.
    """
    spark = docs.sparkSession
    package_on_workers(spark)
    paths = (ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pieces or public_tokenizers.path("piece_bpe_32k.model"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    texts = texts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))

    def send_pairs(group: pd.DataFrame) -> pd.DataFrame:
        own = tokenizers(*paths)
        parts, of_texts = _documents(group["text"], own)
        found = align(parts, own, show=False)
        valid = [p for p in of_texts if found.good[p].all()]
        times = np.bincount(np.concatenate([np.zeros(0, np.int64), *valid]), minlength=len(parts)).astype(np.int64)
        links = _summed_links(found.pairs, np.repeat(times, found.n_links))
        links = links[links["links"] > 0]
        shard = (mix(links["pair"].astype(U64)) % U64(SHARDS)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        ends = np.cumsum(np.bincount(shard, minlength=SHARDS))
        runs = [links[order[i:j]] for i, j in zip([0, *ends[:-1]], ends)]
        rows = [(group["bucket"].iloc[0], k, squeezed(r)) for k, r in enumerate(runs) if len(r)]
        return pd.DataFrame(rows, columns=["bucket", "shard", "data"])

    runs = written(texts.groupBy("bucket").applyInPandas(send_pairs, "bucket long, shard int, data binary"), "linked-pairs")

    only_pair = np.dtype([("pair", "<i8")])

    def distinct(group: pd.DataFrame) -> pd.DataFrame:
        pairs = np.unique(np.concatenate([unsqueezed(d, PAIR_COUNT if whole else only_pair)["pair"] for d, whole in zip(group["data"], group["whole"])]))
        data = squeezed(pairs.astype(only_pair))
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1] // FAN, "shard": group["shard"].iloc[:1], "data": [data], "whole": [False]})

    known = runs.withColumn("whole", F.lit(True))
    left = groups
    while True:
        known = written(
            known.groupBy("shard", F.floor(F.col("bucket") / FAN).alias("part")).applyInPandas(distinct, "bucket long, shard int, data binary, whole boolean"),
            "distinct-pairs",
        )
        left = (left - 1) // FAN + 1
        if left == 1:
            break

    def functions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [unsqueezed(d, only_pair)["pair"] for d in batch["data"]]
            made = [build(k) for k in keys]
            ordered = [squeezed(in_order(f, k).astype(only_pair)) for f, k in zip(made, keys)]
            yield pd.DataFrame({"shard": batch["shard"], "function": made, "pairs": ordered})

    hashed = written(known.mapInPandas(functions, "shard int, function binary, pairs binary"), "pair-hash")

    parts = (groups - 1) // FAN + 1
    part = F.floor(F.col("bucket") / FAN).alias("part")

    def every_part(rows: DataFrame) -> DataFrame:
        return rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def count_part(group: pd.DataFrame, hash_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"shard": [], "part": [], "links": []})
        function, keys = hash_rows["function"].iloc[0], unsqueezed(hash_rows["pairs"].iloc[0], only_pair)["pair"]
        total = np.zeros(len(keys), np.int64)
        for data in group["data"]:
            run = unsqueezed(data, PAIR_COUNT)
            total[verified_places(function, keys, run["pair"])] += run["links"]
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "part": [int(group["bucket"].iloc[0]) // FAN], "links": [_dense(total)]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(map(_undense, group["links"]))
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "part": group["part"].iloc[:1] // FAN, "links": [_dense(total)]})

    schema = "shard int, part long, links binary"
    by_part = runs.select("bucket", "shard", "data", part).groupBy("shard", "part")
    counts = written(by_part.cogroup(every_part(hashed).groupBy("shard", "part")).applyInPandas(count_part, schema), "link-counts")
    left = parts
    while left > 1:
        counts = written(counts.groupBy("shard", F.floor(F.col("part") / FAN).alias("next")).applyInPandas(add, schema), "link-counts")
        left = (left - 1) // FAN + 1
    shards = written(hashed.join(counts.select("shard", "links"), "shard"), "link-counts")

    size_b = tokenizers(*paths).size_b

    def highest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        most = np.zeros(size_b, np.int64)
        for batch in batches:
            for pairs, links in zip(batch["pairs"], batch["links"]):
                np.maximum.at(most, unsqueezed(pairs, only_pair)["pair"] % size_b, _undense(links))
        ids = np.flatnonzero(most)
        yield pd.DataFrame({"id": ids, "links": most[ids]})

    best = np.zeros(size_b, np.int64)
    for row in shards.mapInPandas(highest, "id long, links long").groupBy("id").agg(F.max("links").alias("links")).collect():
        best[row["id"]] = row["links"]

    def answer(group: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"bucket": [], "data": []})
        function, keys = shard["function"].iloc[0], unsqueezed(shard["pairs"].iloc[0], only_pair)["pair"]
        links = _undense(shard["links"].iloc[0])
        out = []
        for data in group["data"]:
            pairs = unsqueezed(data, PAIR_COUNT)["pair"]
            rows = np.empty(len(pairs), ANSWER)
            rows["pair"], rows["links"] = pairs, links[verified_places(function, keys, pairs)]
            rows["best"] = rows["links"] == best[pairs % size_b]
            out.append(squeezed(rows))
        return pd.DataFrame({"bucket": group["bucket"], "data": out})

    answers = by_part.cogroup(every_part(shards).groupBy("shard", "part")).applyInPandas(answer, "bucket long, data binary")
    return LinkCounts(texts, answers, shards)


def _dense(counts: np.ndarray) -> bytes:
    return squeezed(counts.astype(np.dtype([("n", "<i8")])))


def _undense(data: bytes) -> np.ndarray:
    return unsqueezed(data, np.dtype([("n", "<i8")]))["n"]


def pair_table(counts: LinkCounts, *, pieces: str | None = None) -> DataFrame:
    """(a, b, links): the linked pairs of ids with their counts."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=pieces or public_tokenizers.path("piece_bpe_32k.model")).vocab_size()

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pairs, links in zip(batch["pairs"], batch["links"]):
                pair = unsqueezed(pairs, np.dtype([("pair", "<i8")]))["pair"]
                yield pd.DataFrame({"a": pair // size_b, "b": pair % size_b, "links": _undense(links)})

    return counts.shards.mapInPandas(unpacked, "a int, b int, links long")


def align_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, pieces: str | None = None
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A text with a space before it is read by both tokenizers without special
    tokens. groups holds the ids between common ends, `a1,a2|b1;a3|b2,b3`;
    links are pairs of tokens that share bytes; n_best counts those whose pair
    is linked as often corpus-wide as any of its second id; count_sum adds up
    all links' counts. The pairs of each group of documents come back to it
    with their counts, and its documents are aligned again.

    Null and empty texts, and texts that a tokenizer does not give back byte by
    byte, have zeros and empty groups, and no part in the counts. A very long
    text is one document of its group. A null id stays null; repeated rows
    count each; other columns are not read; an empty table gives no rows.
    """
    counts = count_links(docs, id_col=id_col, text_col=text_col, ranks=ranks, pieces=pieces)
    paths = (ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pieces or public_tokenizers.path("piece_bpe_32k.model"))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def look_up(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = tokenizers(*paths)
        parts, of_texts = _documents(group["text"], own)
        found = align(parts, own, show=True)
        known = np.concatenate([np.zeros(0, ANSWER), *(unsqueezed(d, ANSWER) for d in answers["data"])])
        known = known[np.argsort(known["pair"], kind="stable")]
        # pairs of parts only texts without tokens have are not among the answers, nor looked at
        at = np.minimum(np.searchsorted(known["pair"], found.pairs), max(len(known) - 1, 0))
        here = known["pair"][at] == found.pairs if len(known) else np.zeros(len(found.pairs), bool)
        links, best = (np.where(here, known[f][at], 0) if len(known) else np.zeros(len(at), np.int64) for f in ("links", "best"))
        stops = np.cumsum(found.n_links)

        def per_part(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate(([0], np.cumsum(values)))
            return upto[stops] - upto[stops - found.n_links]

        complete = per_part(here.astype(np.int64)) == found.n_links
        columns = np.stack([found.n_a, found.n_b, found.n_groups, found.n_links, per_part(best), per_part(links)], axis=1)
        out, groups = np.zeros((len(group), len(names)), np.int64), []
        for i, of_text in enumerate(of_texts):
            if len(of_text) and found.good[of_text].all():
                if not complete[of_text].all():
                    raise ValueError("a pair has no count: the input changed between passes")
                out[i] = columns[of_text].sum(axis=0)
                groups.append(b"".join([found.shown[p] for p in of_text.tolist()])[:-1])
            else:
                groups.append(b"")
        frame = pd.DataFrame(out, columns=names).assign(groups=groups)
        frame.insert(0, "doc_id", group["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
        return frame

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", groups binary"
    by_bucket = counts.texts.groupBy("bucket")
    aligned = by_bucket.cogroup(counts.answers.groupBy("bucket")).applyInPandas(look_up, schema)
    return aligned.withColumn("groups", F.col("groups").cast("string"))
