"""Embedding near-dedup: tiles compared along principal axes with early stops."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import components, written

#: Room for rounding in the early stops; the final comparison has none.
SLACK = 1e-9


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Axes of the unit vectors' second moments as columns, largest first.

    Summed over all rows: per partition one width x width matrix, added up row by
    row, so `width` rows reach the driver whatever the input's size.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                units = _units(_matrix(batch["vector"], width))
                total += units.T @ units
        yield pd.DataFrame({"axis": np.arange(width), "moments": list(total)})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"axis": group["axis"][:1], "moments": [np.sum(np.stack(group["moments"]), axis=0)]})

    rows = (
        vectors.select("vector")
        .mapInPandas(moments, "axis int, moments array<double>")
        .groupBy("axis")
        .applyInPandas(add, "axis int, moments array<double>")
        .collect()
    )
    matrix = np.array([r["moments"] for r in sorted(rows)]) if rows else np.zeros((width, width))
    return np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1].copy()


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _units(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # squares of very large or small components
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of x and j of y, unit vectors on principal axes, with x[i] . y[j] >= threshold.

    Products are added `step` axes at a time. By Cauchy-Schwarz the rest of a
    product is at most the product of the two suffix norms; a pair whose sum
    plus that stays below the threshold is given up.
    """
    width = x.shape[1]
    tails_x = np.sqrt(np.maximum(0, np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]))
    tails_y = np.sqrt(np.maximum(0, np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]))

    def tail(tails: np.ndarray, at: int) -> np.ndarray:
        return tails[:, at] if at < width else np.zeros(len(tails))

    done = min(step, width)
    sums = x[:, :done] @ y[:, :done].T
    i, j = np.nonzero(sums + np.outer(tail(tails_x, done), tail(tails_y, done)) >= threshold - SLACK)
    sums = sums[i, j]
    while done < width and i.size:
        more = min(done + step, width)
        sums = sums + np.einsum("ij,ij->i", x[i, done:more], y[j, done:more])
        done = more
        go = sums + tail(tails_x, done)[i] * tail(tails_y, done)[j] >= threshold - SLACK
        i, j, sums = i[go], j[go], sums[go]
    return i, j


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """As few of the edges as hold the same components."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (up := parent.setdefault(v, v)) != v:
            parent[v] = parent[up]
            v = parent[v]
        return v

    kept = []
    for v, w in zip(a.tolist(), b.tolist()):
        p, q = root(v), root(w)
        if p != q:
            parent[p] = q
            kept.append((v, w))
    return kept


def embedding_groups(
    rows: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    tile_rows: int = 1024,
    box_axes: int = 8,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal, not null, and their cosine in
    double precision is at least `threshold` (above 0). Equal vectors of a label
    are one class, compared once. Classes are dealt by range of label and first
    principal axis into tiles of at most `tile_rows`; two tiles of a label are
    compared unless the boxes around their leading `box_axes` coordinates lie
    farther apart than linked vectors can. A comparison returns link counts and
    a spanning forest, not its pairs, so a dense group yields no more rows than
    it has members per comparison.

    Vectors that are null, empty, zero or hold null or non-finite components,
    rows without a label and rows without an id link with nothing: n_links 0,
    component_id their own id. Rows that repeat an id count as different
    vectors. Other columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    fit = F.col("vector").isNotNull() & (F.size("vector") > 0)
    fit &= F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit &= F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    named = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label")
    ).withColumn("fit", F.coalesce(fit, F.lit(False)))
    spelled = F.array_join(F.transform("vector", lambda x: x.cast("string")), ",")
    keyed = named.withColumn("key", F.when(F.col("fit"), F.sha2(F.concat_ws(":", F.col("label").cast("string"), spelled), 256)))
    classes = written(
        keyed.where("fit")
        .groupBy("key")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("first_id"), F.count("*").alias("size"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    members = keyed.select("vec_id", "key")
    width = classes.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return members.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    axes = principal_axes(classes, width)

    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            matrix = _matrix(batch["vector"], width)
            yield pd.DataFrame(
                {
                    "class": batch["class"],
                    "size": batch["size"],
                    "part": batch["part"],
                    "lead": (_units(matrix) @ axes[:, :1])[:, 0] if len(batch) else [],
                    "vector": batch["vector"],
                }
            )

    turned = classes.select(
        "class", "size", F.concat_ws(":", F.size("vector").cast("string"), F.col("label").cast("string")).alias("part"), "vector"
    ).mapInPandas(rotate, "class long, size long, part string, lead double, vector array<double>")
    per_part = max(1, math.ceil(classes.count() / (8 * tile_rows)))

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for batch in batches:
            held = pd.concat([held, batch]) if len(held) else batch
            while len(held):
                same = (held["part"] == held["part"].iloc[0]).to_numpy()
                n = min(tile_rows, len(held) if same.all() else int(same.argmin()))
                if n == len(held) < tile_rows:
                    break
                yield _tile_row(held.iloc[:n], width, axes, box_axes)
                held = held.iloc[n:]
        if len(held):
            yield _tile_row(held, width, axes, box_axes)

    tiles = written(
        turned.repartitionByRange(per_part, "part", "lead")
        .sortWithinPartitions("part", "lead")
        .mapInPandas(tile, "part string, low array<double>, high array<double>, classes binary, sizes binary, vectors binary")
        .withColumn("tile", F.monotonically_increasing_id()),
        "tiles",
    )
    far = 2 - 2 * threshold + SLACK
    left = tiles.select("part", *[F.col(c).alias(f"{c}_a") for c in ("tile", "low", "high")])
    right = tiles.select("part", *[F.col(c).alias(f"{c}_b") for c in ("tile", "low", "high")])
    gaps = F.aggregate(
        F.arrays_zip("low_a", "high_a", "low_b", "high_b"),
        F.lit(0.0),
        lambda acc, box: acc
        + F.pow(F.greatest(F.lit(0.0), box["low_a"] - box["high_b"], box["low_b"] - box["high_a"]), 2),
    )
    pairs = left.join(right, "part").where((F.col("tile_a") <= F.col("tile_b")) & (gaps <= far)).select("tile_a", "tile_b")
    payload = ("classes", "sizes", "vectors")
    joined = pairs.join(tiles.select(F.col("tile").alias("tile_a"), *[F.col(c).alias(f"{c}_a") for c in payload]), "tile_a").join(
        tiles.select(F.col("tile").alias("tile_b"), *[F.col(c).alias(f"{c}_b") for c in payload]), "tile_b"
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        row = group.iloc[0]
        ids_a, size_a, x = _unpack(row["classes_a"], row["sizes_a"], row["vectors_a"], width)
        ids_b, size_b, y = _unpack(row["classes_b"], row["sizes_b"], row["vectors_b"], width)
        units_x, units_y = _units(x), _units(y)
        i, j = linked_pairs(units_x @ axes, units_y @ axes, threshold)
        if row["tile_a"] == row["tile_b"]:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", units_x[i], units_y[j]) >= threshold if i.size else np.zeros(0, bool)
        i, j = i[exact], j[exact]
        n_a = np.bincount(i, weights=size_b[j], minlength=len(ids_a)).astype(np.int64)
        n_b = np.bincount(j, weights=size_a[i], minlength=len(ids_b)).astype(np.int64)
        out = [(int(v), None, int(n)) for ids, ns in ((ids_a, n_a), (ids_b, n_b)) for v, n in zip(ids, ns) if n]
        out += [(v, w, 0) for v, w in _forest(ids_a[i], ids_b[j])]
        frame = pd.DataFrame(out, columns=["a", "b", "n"], dtype="object")
        return frame.astype({"a": "Int64", "b": "Int64", "n": "Int64"})

    found = written(joined.groupBy("tile_a", "tile_b").applyInPandas(compare, "a long, b long, n long"), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    reached = written(
        components(found.where("b IS NOT NULL").select("a", "b"), classes.select(F.col("class").alias("v"))), "components"
    )
    firsts = reached.join(classes.select(F.col("class").alias("v"), "first_id"), "v")
    smallest = firsts.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = (
        classes.select("key", "class", "size")
        .join(firsts.select(F.col("v").alias("class"), "component"), "class")
        .join(smallest, "component")
        .join(links, "class", "left")
        .select("key", "component_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    )
    return members.join(known, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )


def _tile_row(rows: pd.DataFrame, width: int, axes: np.ndarray, box_axes: int) -> pd.DataFrame:
    matrix = _matrix(rows["vector"], width)
    lead = _units(matrix) @ axes[:, :box_axes]
    return pd.DataFrame(
        {
            "part": [rows["part"].iloc[0]],
            "low": [lead.min(axis=0)],
            "high": [lead.max(axis=0)],
            "classes": [rows["class"].to_numpy(np.int64).tobytes()],
            "sizes": [rows["size"].to_numpy(np.int64).tobytes()],
            "vectors": [matrix.tobytes()],
        }
    )


def _unpack(classes: bytes, sizes: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(classes, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(vectors).reshape(-1, width)
