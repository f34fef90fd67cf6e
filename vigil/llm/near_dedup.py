"""Near-duplicates by probability Jaccard: ProbMinHash signatures, banding, verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import BASE, U64, by_ids, components, mix, text_of, uniform, written

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=U64))


def shingles(texts: list[str], words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count), ordered, for the distinct runs of `words` words of each text.

    Words are what lies between blanks, in lower case. A text of fewer words is
    one shingle, one without words has none.
    """
    joined = " ".join(t.lower() for t in texts).encode("utf-8", "surrogatepass")
    raw = np.frombuffer(joined + b" ", np.uint8)
    blank = _BLANK[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    nothing = np.zeros(0, U64)
    if not len(starts):
        return np.zeros(0, np.int64), nothing, np.zeros(0, np.int64)
    # a word's hash: its bytes' numbers times powers of BASE, from prefix sums; powers of its start divided out
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate(([U64(1)], np.full(int((ends - starts).max()), BASE, U64))))
        lengths = ends - starts
        inside = np.flatnonzero(~blank)
        place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        total = np.concatenate(([U64(0)], np.cumsum(_BYTE[raw[inside]] * powers[place], dtype=U64)))
        upto = np.cumsum(lengths)
        hashes = mix(total[upto] - total[upto - lengths])
    sizes = np.array([len(t.lower().encode("utf-8", "surrogatepass")) + 1 for t in texts])
    first_byte = np.cumsum(sizes) - sizes
    owner = np.searchsorted(first_byte, starts, side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts))
    width = np.minimum(n_words, words)[owner]
    number = np.arange(len(owner)) - (np.cumsum(n_words) - n_words)[owner]
    begins = np.flatnonzero(number <= n_words[owner] - width)
    with np.errstate(over="ignore"):
        value = np.zeros(len(begins), U64)
        for k in range(words):
            at = np.minimum(begins + k, len(hashes) - 1)
            value = np.where(k < width[begins], mix(value * U64(BASE) + hashes[at]), value)
    whose = owner[begins]
    order = np.lexsort((value, whose))
    whose, value = whose[order], value[order]
    new = np.ones(len(whose), bool)
    new[1:] = (whose[1:] != whose[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return whose[at], value[at], np.diff(np.append(at, len(whose)))


def prob_min_hash(whose: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """n x registers signatures: two agree in a register with the probability Jaccard of their weighted elements.

    Each element sends arrivals of a Poisson process with its weight as rate to
    random registers, the same for the same element in any set; a register
    keeps the element of its earliest arrival. Gaps are exponential. An element
    stops as soon as its next arrival is later than every register of its set,
    so most stop after their first. Elements of all sets go on round by round.
    """
    earliest = np.full(n * registers, np.inf)
    signature = np.zeros(n * registers, U64)
    live = np.arange(len(whose))
    time = np.zeros(len(whose))
    turn = 0
    while live.size:
        turn += 1
        with np.errstate(over="ignore"):
            seed = mix(element[live] + U64(BASE) * U64(2 * turn))
            where = mix(seed + U64(BASE))
        time[live] -= np.log(uniform(seed)) / weight[live]
        register = whose[live] * registers + ((where >> U64(32)) % U64(registers)).astype(np.int64)
        arrival = time[live]
        better = arrival < earliest[register]
        register, arrival, who = register[better], arrival[better], live[better]
        order = np.lexsort((element[who], arrival, register))
        register, arrival, who = register[order], arrival[order], who[order]
        first = np.ones(len(register), bool)
        first[1:] = register[1:] != register[:-1]
        earliest[register[first]] = arrival[first]
        signature[register[first]] = element[who[first]]
        latest = earliest.reshape(n, registers).max(axis=1)
        live = live[time[live] < latest[whose[live]]]
    return signature.reshape(n, registers)


def probability_jaccard(elements_a: np.ndarray, weights_a: np.ndarray, elements_b: np.ndarray, weights_b: np.ndarray) -> float:
    """Sum over common elements d of 1 / sum over e of max(a[e] / a[d], b[e] / b[d]); elements are sorted."""
    if not len(elements_a) or not len(elements_b):
        return 0.0
    _, i, j = np.intersect1d(elements_a, elements_b, assume_unique=True, return_indices=True)
    a, b = weights_a[i].astype(float), weights_b[j].astype(float)
    only_a, only_b = weights_a.sum() - a.sum(), weights_b.sum() - b.sum()
    if not (np.any(weights_a != 1) or np.any(weights_b != 1)):
        return len(i) / (len(elements_a) + len(elements_b) - len(i))
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    below_b = np.cumsum(b)  # with a smaller ratio or the same the second set's share counts, above the first's
    above_a = a.sum() - np.cumsum(a)
    return float(np.sum(1 / ((above_a + only_a) / a + (below_b + only_b) / b)))


def chunks(sizes: list[int], most: int, room: int) -> Iterator[slice]:
    """Slices of at most `most` texts and, unless one is larger, `room` characters."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and (i - begin == most or held + size > room):
            yield slice(begin, i)
            begin, held = i, 0
        held += size
    if sizes:
        yield slice(begin, len(sizes))


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per row and band of a signature; band b has every registers / bands-th register from b on."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), (len(signature), bands)).copy()
        for r in range(signature.shape[1] // bands):
            key = mix(key * U64(BASE) + signature[:, r * bands : (r + 1) * bands])
    return key.view(np.int64)


def _class_keys(whose: np.ndarray, element: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each text's bag of shingles."""
    with np.errstate(over="ignore"):
        part = mix(element ^ mix(count.astype(U64)))
        total = np.concatenate(([U64(0)], np.cumsum(part, dtype=U64)))
        sizes = np.bincount(whose, minlength=n)
        last = np.cumsum(sizes)
        return mix(total[last] - total[last - sizes] + sizes.astype(U64) * U64(BASE)).view(np.int64)


def near_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    threshold: float = 0.8,
    bands: int = 32,
    rows_per_band: int = 6,
    star_rounds: int = 2,
    sketch_registers: int = 768,
    block_rows: int = 512,
) -> DataFrame:
    """Per row: doc_id, class_id, group_id, group_size, kept.

    Texts with the same bag of shingles are one class. Classes link when the
    probability Jaccard of their shingles, weighted by count, is at least
    `threshold`; candidates are classes that agree in all registers of a band
    (a pair at 0.8 is missed in all bands once in 15,000 times), each verified
    on the whole bags. group_id is the smallest id reachable by links.

    A bucket's classes are first compared with centres only (`_by_stars`), and
    buckets within one component are done. Members of the others are compared
    pair by pair by longer sketches inside tasks (`_alike`); what agrees there
    and still is of several components is verified, so no link between
    components is lost to the shortcut.

    Null, empty and blank texts and rows without an id link with nothing: null
    class_id, group_id their own id. Rows that repeat an id and text are one
    class; an id repeated with other texts belongs to several classes and gets
    each one's group. Other columns are not read; an empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece in chunks([len(t) for t in batch["text"]], 128, 400_000):
                part = batch.iloc[piece]
                whose, element, count = shingles(list(part["text"]), words)
                there = np.unique(whose)
                signature = prob_min_hash(np.searchsorted(there, whose), element, count.astype(float), len(there), bands * rows_per_band)
                frame = pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy()[there],
                        "class": _class_keys(whose, element, count, len(part))[there],
                        "band": pd.Series(list(band_keys(signature, bands)), dtype=object),
                    }
                )
                yield frame

    signed = written(
        texts.where("doc_id IS NOT NULL").mapInPandas(sign, "doc_id long, class long, band array<long>"), "signatures"
    )
    classes = written(signed.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size")), "classes")
    spread = (
        signed.join(classes.withColumnRenamed("class_id", "doc_id").select("doc_id", "class"), ["doc_id", "class"])
        .dropDuplicates(["class"])
        .select("class", "band")
    )
    banded = written(spread, "bands")
    members = _members(banded.select("class", F.explode("band").alias("bucket")))
    bags = written(_bags(texts, members.select("class").distinct(), classes, words), "bags")
    apart = members.select(F.col("class").alias("v"), F.col("class").alias("component")).distinct()
    links, open_members = _by_stars(members, apart, bags, threshold, star_rounds)
    if open_members.limit(1).count():
        alike = written(_alike(open_members, banded, bags, threshold, sketch_registers, block_rows), "pairs")
        links = links.unionByName(written(_verified(alike, bags, threshold), "links"))
    groups = written(components(links, classes.select(F.col("class").alias("v"))), "components")
    named = groups.join(classes.withColumnRenamed("class", "v"), "v")
    totals = named.groupBy("component").agg(F.min("class_id").alias("group_id"), F.sum("size").alias("group_size"))
    known = named.join(totals, "component").select(F.col("v").alias("class"), "class_id", "group_id", "group_size")
    found = signed.select("doc_id", "class").join(known, "class").select("doc_id", "class_id", "group_id", "group_size")
    alone = texts.where(F.col("doc_id").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.col("doc_id").alias("group_id"), F.lit(1).cast("long").alias("group_size")
    )
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("group_id"), F.lit(True)))


def _members(buckets: DataFrame) -> DataFrame:
    """(bucket, class, degree) for buckets of several classes; degree: how many others the class meets in all."""
    # what is known of buckets is written before it meets their rows: a join of two shuffles can split a hot bucket
    shared = written(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    met = written(buckets.join(shared, "bucket"), "members")
    degrees = met.groupBy("class").agg(F.sum(F.col("n") - 1).alias("degree"))
    return written(met.drop("n").join(degrees, "class"), "members")


def _by_stars(
    members: DataFrame, reached: DataFrame, bags: DataFrame, threshold: float, rounds: int
) -> tuple[DataFrame, DataFrame]:
    """Links found with the centres of buckets, and the members of buckets that still span several components.

    In each round a bucket's centre is the member with the highest degree, in
    later rounds one outside the component of the last centre; it is compared
    with the bucket's members of other components.
    """
    links = None
    left = _open(members, reached)
    for turn in range(rounds):
        if left.limit(1).count() == 0:
            break
        best = F.max_by(F.struct("class", "component"), F.struct("degree", "class"))
        centres = written(left.groupBy("bucket").agg(best.alias("centre")), "centres")
        if turn:
            outside = left.join(centres, "bucket").where(F.col("component") != F.col("centre.component"))
            centres = written(outside.groupBy("bucket").agg(best.alias("centre")), "centres")
        pairs = (
            left.join(centres, "bucket")
            .where(F.col("component") != F.col("centre.component"))
            .select(F.least("class", "centre.class").alias("a"), F.greatest("class", "centre.class").alias("b"))
            .distinct()
        )
        found = written(_verified(pairs, bags, threshold), "links")
        links = found if links is None else links.unionByName(found)
        before = reached.select(F.col("v").alias("a"), F.col("component").alias("b"))
        reached = components(links.unionByName(before), members.select(F.col("class").alias("v")).distinct())
        left = _open(members, written(reached, "reached"))
    return links if links is not None else bags.sparkSession.createDataFrame([], "a long, b long"), left


def _open(members: DataFrame, reached: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that span several."""
    with_component = written(members.join(reached.select(F.col("v").alias("class"), "component"), "class"), "members")
    several = (
        with_component.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    return written(with_component.join(written(several, "buckets"), "bucket"), "members")


def _alike(
    members: DataFrame, banded: DataFrame, bags: DataFrame, threshold: float, registers: int, block_rows: int
) -> DataFrame:
    """Pairs of a bucket's classes, of different components, whose sketches are alike.

    A sketch is a byte of each of many registers. Two at the threshold agree in
    fewer places than 4.5 standard deviations below it once in 300,000 times.
    Members of a bucket are compared within a task, `block_rows` at a time: a
    larger bucket is dealt by hash to blocks, each pair of which is a unit of
    its own. Only pairs that may be links leave the task, each from the first
    band its two classes agree in.
    """
    least = registers * (threshold - 4.5 * (threshold * (1 - threshold) / registers) ** 0.5)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece in chunks([len(e) for e in batch["elements"]], 64, 400_000):
                part = batch.iloc[piece]
                element = [np.frombuffer(e, "<u8") for e in part["elements"]]
                count = np.concatenate([np.frombuffer(c, "<u4") for c in part["counts"]]).astype(float)
                whose = np.repeat(np.arange(len(part)), [len(e) for e in element])
                signature = prob_min_hash(whose, mix(np.concatenate(element)), count, len(part), registers)
                rows = (signature >> U64(56)).astype(np.uint8)
                yield pd.DataFrame({"class": part["class"].to_numpy(), "sketch": [row.tobytes() for row in rows]})

    wanted = written(members.select("class").distinct(), "wanted")
    drawn = bags.join(wanted, "class", "left_semi").mapInPandas(sketch, "class long, sketch binary")
    sketches = written(drawn.join(banded, "class"), "sketches")
    blocks = written(members.groupBy("bucket").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")), "blocks")
    dealt = members.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    units = dealt.select(
        "bucket", "class", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("bucket", "class", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    keys = ["bucket", "i", "j"]

    def compare(unit: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(unit["sketch"]), np.uint8).reshape(len(unit), registers)
        names, component, own = (unit[c].to_numpy() for c in ("class", "component", "own"))
        bands = np.stack(unit["band"].to_list())
        bucket = unit["bucket"].iloc[0]
        within = unit["i"].iloc[0] == unit["j"].iloc[0]
        pairs = []
        for k in range(len(unit) - 1):
            others = component[k + 1 :] != component[k]
            if not within:
                others &= own[k + 1 :] != own[k]
            others = np.flatnonzero(others) + k + 1
            near = others[(rows[others] == rows[k]).sum(axis=1) >= least]
            agree = bands[near] == bands[k]
            near = near[bands[k][agree.argmax(axis=1)] == bucket]
            pairs += [(min(names[k], names[o]), max(names[k], names[o])) for o in near]
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    def compare_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, part in batch.groupby(keys, sort=False):
                if held and tuple(held[0][keys].iloc[0]) != tuple(part[keys].iloc[0]):
                    yield compare(pd.concat(held))
                    held = []
                held.append(part)
        if held:
            yield compare(pd.concat(held))

    return (
        units.join(sketches, "class")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(compare_units, "a long, b long")
        .distinct()
    )


def _bags(texts: DataFrame, wanted: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(class, elements, counts) of the wanted classes, read again from their texts."""
    ids = written(classes.join(wanted, "class").select(F.col("class_id").alias("doc_id")).distinct(), "wanted")

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece in chunks([len(t) for t in batch["text"]], 128, 400_000):
                part = batch.iloc[piece]
                whose, element, count = shingles(list(part["text"]), words)
                last = np.cumsum(np.bincount(whose, minlength=len(part)))
                cut = lambda x, kind: [p.astype(kind).tobytes() for p in np.split(x, last[:-1])]
                yield pd.DataFrame(
                    {
                        "class": _class_keys(whose, element, count, len(part)),
                        "elements": cut(element, "<u8"),
                        "counts": cut(count, "<u4"),
                    }
                )

    bags = by_ids(texts, "doc_id", ids, "left_semi").mapInPandas(bag, "class long, elements binary, counts binary")
    return bags.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def _verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose probability Jaccard is at least the threshold."""
    pairs = written(pairs, "pairs")
    left = bags.select(F.col("class").alias("a"), F.col("elements").alias("elements_a"), F.col("counts").alias("counts_a"))
    right = bags.select(F.col("class").alias("b"), F.col("elements").alias("elements_b"), F.col("counts").alias("counts_b"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = [
                probability_jaccard(
                    np.frombuffer(ea, "<u8"), np.frombuffer(ca, "<u4"), np.frombuffer(eb, "<u8"), np.frombuffer(cb, "<u4")
                )
                >= threshold
                for ea, ca, eb, cb in zip(batch["elements_a"], batch["counts_a"], batch["elements_b"], batch["counts_b"])
            ]
            yield batch.loc[np.array(near, bool), ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(verify, "a long, b long")


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with their columns: of each group the one with the smallest id.

    An id that repeats with other texts stays if it does with one of them.
    """
    groups = near_groups(docs, id_col=id_col, text_col=text_col)
    gone = groups.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept").select("doc_id")
    return by_ids(docs, id_col, written(gone, "gone"), "left_anti")
