"""Near copies among embeddings: cells by spherical k-means, cosine products inside them.

Cells are split by k-means until they are small enough. A vector lives in the cell of its
nearest centroid. It also visits cells of a lower number whose border (the plane halfway
between two centroids) is so near that a linked vector may lie beyond it. So every pair is
compared in one cell: that where the one lives that was dealt the lower number when their
ways parted. Cells are cut into blocks of rows, and pairs of blocks are multiplied in tasks
of their own. Equal vectors are one vector with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.llm.components import components
from cratewise.llm.tables import ROW, numbered, thinned
from cratewise.session import stored

THRESHOLD = 0.95
# How far beyond a border linked vectors are looked for, in standard deviations of the
# distance by which a pair at the threshold parts along a random direction.
REACH = 3.0
# A cell of more rows is split, unless that saves less than a third of its products.
CELL_ROWS = 4096
BLOCK_ROWS = 8192
FANOUT = 256
# Rows that a centroid is fitted on, and bytes of all sampled rows of one pass.
SAMPLE_ROWS = 32
SAMPLE_BYTES = 32 << 20
ROUNDS = 10
WORTH = 0.7

_STATE = "uid bigint, v binary, copies bigint, cell bigint, home boolean, parent bigint"


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Packed vectors of one length as unit rows in double precision."""
    data = b"".join(column.to_pylist())
    out = np.frombuffer(data, kind).astype(np.float64).reshape(len(column), -1)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _pack(kind: type) -> Callable:
    """Packed vectors; null for those that link with nothing."""

    def one(values) -> bytes | None:
        if not values or None in values:
            return None
        x = np.array(values, kind) + kind(0)  # no negative zeros
        return x.tobytes() if np.isfinite(x).all() and x.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            flat, lengths = lists.flatten(), np.diff(lists.offsets.to_numpy())
            if not lists.null_count and not flat.null_count and len(set(lengths)) == 1 and lengths[0]:
                x = flat.to_numpy().reshape(len(lists), -1) + kind(0)
                good = np.isfinite(x).all(axis=1) & x.any(axis=1)
                packed = [row.tobytes() if ok else None for row, ok in zip(x, good)]
            else:
                packed = [one(values) for values in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(packed, pa.binary())], names=["vec_id", "v"]
            )

    return run


def spherical_k_means(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` unit centroids at most, fitted to unit rows ``x``."""
    centroids = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(ROUNDS):
        near = x @ centroids.T
        home = near.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        # A centroid without rows takes the row that fits worst.
        empty = np.flatnonzero(~sums.any(axis=1))
        worst = np.argsort(near.max(axis=1), kind="stable")[: len(empty)]
        sums[empty[: len(worst)]] = x[worst]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return np.unique(centroids, axis=0)


def dealt(x: np.ndarray, centroids: np.ndarray, home: np.ndarray, margin: float):
    """(row, centroid, whether the row lives there) for every cell a row lives in or visits.

    Rows that live in the split cell visit cells of a lower number than their new home, others
    all cells in reach.
    """
    near = x @ centroids.T
    best = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    # Distance to the plane between the nearest centroid and each other one.
    gap = near[np.arange(len(x)), best][:, None] - near
    reached = gap <= (margin + 1e-9) * apart[best] + 1e-12
    numbers = np.arange(len(centroids))
    reached &= ~home[:, None] | (numbers <= best[:, None])
    row, cell = np.nonzero(reached)
    return row, cell, home[row] & (cell == best[row])


def _split(hot, kind: type, margin: Callable[[int], float]) -> Callable:
    """Rows of the cells of ``hot`` (cell: first new number, centroids) in their new cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            for cell in np.unique(cells).tolist():
                first, centroids = hot.value[cell]
                part = batch.take(np.flatnonzero(cells == cell))
                x = _matrix(part.column("v"), kind)
                home = part.column("home").to_numpy(zero_copy_only=False)
                row, new, lives = dealt(x, centroids, home, margin(x.shape[1]))
                moved = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[moved.column(name) for name in ("uid", "v", "copies")],
                        pa.array(first + new, pa.int64()),
                        pa.array(lives),
                        pa.array(np.full(len(row), cell)),
                    ],
                    names=["uid", "v", "copies", "cell", "home", "parent"],
                )

    return run


def _sizes(rows: DataFrame, *by: str) -> DataFrame:
    homes = F.sum(F.col("home").cast("bigint")).alias("homes")
    return rows.groupBy(*by).agg(homes, F.count(F.lit(1)).alias("n"))


def _fitted(rows: DataFrame, hot: list, kind: type, cell_rows: int, most: int) -> dict:
    """Centroids of each cell of ``hot``, fitted to a sample of the rows that live there."""
    wanted = {r["cell"]: min(most, max(2, math.ceil(2 * r["homes"] / cell_rows))) for r in hot}
    living = rows.where(F.col("cell").isin(list(wanted)) & F.col("home")).select("cell", "uid", "v")
    order = F.xxhash64("uid")
    sample = thinned(living, ["cell"], order, SAMPLE_ROWS * max(wanted.values()))
    sample = sample.withColumn("place", order).drop("uid").toArrow()
    cells = sample.column("cell").to_numpy()
    places = sample.column("place").to_numpy()
    found = {}
    for cell, k in wanted.items():
        mine = np.flatnonzero(cells == cell)
        mine = mine[np.argsort(places[mine], kind="stable")][: SAMPLE_ROWS * k]
        vectors = sample.column("v").take(pa.array(mine)).combine_chunks()
        found[cell] = spherical_k_means(_matrix(vectors, kind), k)
    return found


def _cells(rows: DataFrame, kind: type, threshold: float, reach: float | None, cell_rows: int):
    """``rows`` dealt to cells, small ones or such as no split makes cheaper."""
    spark = rows.sparkSession
    sine = math.sqrt(1 - threshold**2)
    margin = lambda n: sine if reach is None else sine * min(1.0, reach / math.sqrt(n))
    unit = np.dtype(kind).itemsize
    settled, number = [], 0
    while True:
        crowded = _sizes(rows, "cell").where((F.col("homes") > cell_rows) & (F.col("homes") > 1))
        crowded = crowded.where(~F.col("cell").isin(settled))
        # As many cells at once as a bounded sample can tell apart, the largest first.
        first = crowded.orderBy(F.desc("homes"), "cell").limit(FANOUT).collect()
        if not first:
            return rows
        bytes_of = lambda cells: rows.where(F.col("cell").isin(cells)).agg(
            F.max(F.octet_length("v"))
        ).first()[0]
        width = bytes_of([r["cell"] for r in first])
        total = max(2, SAMPLE_BYTES // (3 * SAMPLE_ROWS * width))
        most = min(FANOUT, total)
        k = min(most, math.ceil(2 * first[0]["homes"] / cell_rows) + 1)
        hot = first[: max(1, total // max(k, 2))]
        fitted, table = _fitted(rows, hot, kind, cell_rows, most), {}
        for row in hot:
            table[row["cell"]] = (number, fitted[row["cell"]])
            number += len(fitted[row["cell"]])
        names = [row["cell"] for row in hot]
        known = spark.sparkContext.broadcast(table)
        split = stored(
            rows.where(F.col("cell").isin(names)).mapInArrow(_split(known, kind, margin), _STATE)
        )
        cost = _sizes(split, "parent", "cell").groupBy("parent").agg(
            F.sum(F.col("homes").cast("double") * F.col("n")).alias("cost")
        )
        after = {r["parent"]: r["cost"] for r in cost.collect()}
        idle = [r["cell"] for r in hot if after[r["cell"]] > WORTH * r["homes"] * r["n"]]
        settled += idle
        moved = [x for x in names if x not in idle]
        if moved:
            left = rows.where(~F.col("cell").isin(moved))
            rows = left.unionByName(split.where(F.col("parent").isin(moved)))


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[list, list]:
    """Pairs of (left, right) ids that connect what ``linked`` connects, few per id."""
    if np.count_nonzero(linked) <= 2 * (len(left) + len(right)):
        i, j = np.nonzero(linked)
        return [left[i]], [right[j]]
    turned = np.ascontiguousarray(linked.T)
    new_i, new_j = linked.any(axis=1), linked.any(axis=0)
    a, b = [], []
    while new_i.any():
        root = int(new_i.argmax())
        edge = np.array([root])
        new_i[root] = False
        while len(edge):
            found = np.flatnonzero(linked[edge].any(axis=0) & new_j)
            new_j[found] = False
            a.append(np.full(len(found), left[root]))
            b.append(right[found])
            edge = np.flatnonzero(turned[found].any(axis=0) & new_i) if len(found) else found
            new_i[edge] = False
            a.append(np.full(len(edge), left[root]))
            b.append(left[edge])
    return a, b


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    out = np.zeros((len(x), len(y)), bool)
    for at in range(0, len(x), 512):
        np.greater_equal(x[at : at + 512] @ y.T, threshold, out=out[at : at + 512])
    return out


def _compare(kind: type, threshold: float) -> Callable:
    """Links between two blocks of a cell: weights per vector, and pairs that connect them."""

    def run(table: pa.Table) -> pa.Table:
        uid, copies = table.column("uid").to_numpy(), table.column("copies").to_numpy()
        home, side = (table.column(x).to_numpy() for x in ("home", "side"))
        x = _matrix(table.column("v").combine_chunks(), kind)
        own = bool((side == 2).all())
        i = np.flatnonzero(side != 1)
        j = i if own else np.flatnonzero(side == 1)
        linked = _linked(x[i], x[j], threshold)
        # Two visitors meet where one of them lives.
        linked[np.ix_(~home[i], ~home[j])] = False
        if own:
            np.fill_diagonal(linked, False)
        a, b = _forest(linked, uid[i], uid[j])
        ids, sums = [uid[i]], [linked @ copies[j]]
        if not own:
            ids.append(uid[j])
            sums.append(copies[i] @ linked)
        ids, sums = np.concatenate(ids), np.concatenate(sums)
        ids, sums = ids[sums > 0], sums[sums > 0]
        a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b))
        other = np.concatenate([np.zeros(len(ids), np.int64), b])
        return pa.table(
            {
                "a": np.concatenate([ids, a]),
                "b": pa.array(other, mask=np.arange(len(other)) < len(ids)),
                "n": np.concatenate([sums, np.zeros(len(a), np.int64)]),
            }
        )

    return run


def _links(rows: DataFrame, kind: type, threshold: float, block_rows: int) -> DataFrame:
    """(a, null, weight of its links here) and (a, b, 0) for pairs that connect."""
    sizes = _sizes(rows, "cell").select("cell", F.ceil(F.col("n") / block_rows).alias("blocks"))
    # Few: a cell of several blocks has more than BLOCK_ROWS rows. AQE picks the join.
    cut = stored(sizes.where("blocks > 1"))
    rows = rows.join(cut, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("uid"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    tasks = rows.select(
        "cell",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2)
        .otherwise((F.col("own") > F.col("other")).cast("int"))
        .alias("side"),
        "uid",
        "copies",
        "home",
        "v",
    )
    return tasks.groupBy("cell", "i", "j").applyInArrow(
        _compare(kind, threshold), "a bigint, b bigint, n bigint"
    )


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    reach: float | None = REACH,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``vectors`` (integer vec_id, embedding: array of float or double).

    ``n_links``: other rows with a cosine of ``threshold`` or more; ``component_id``: the
    least vec_id reached by links, its own included; ``kept``: whether it is its own. Cosines
    are computed in double precision, and none below the threshold links. With ``reach`` None
    no pair can be missed; else pairs are missed that part by more than ``reach`` standard
    deviations across a border between cells.

    A vector that is null, empty, zero, or holds a null or non-finite component links with
    nothing, nor do vectors of different lengths. Rows of one vec_id are rows of their own; a
    missing vec_id is larger than all others, and equals itself in ``kept``. No rows give none.
    """
    element = vectors.schema["embedding"].dataType.elementType
    kind = np.float64 if isinstance(element, T.DoubleType) else np.float32
    as_array = F.col("embedding").cast("array<double>" if kind is np.float64 else "array<float>")
    packed = vectors.select("vec_id", as_array.alias("embedding")).mapInArrow(
        _pack(kind), "vec_id bigint, v binary"
    )
    rows = stored(numbered(packed))
    digest = F.unhex(F.sha2("v", 256))
    distinct = stored(
        rows.where("v is not null")
        .groupBy("v")
        .agg(F.min(ROW).alias("uid"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    )
    start = distinct.select(
        "uid",
        "v",
        "copies",
        (-F.octet_length("v")).cast("bigint").alias("cell"),
        F.lit(True).alias("home"),
        F.lit(None).cast("bigint").alias("parent"),
    )
    cells = _cells(start, kind, threshold, reach, cell_rows)
    found = stored(_links(cells, kind, threshold, block_rows))
    counts = found.where("b is null").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n"))
    classes = components(found.where("b is not null").select("a", "b"))
    known = (
        distinct.select("uid", digest.alias("digest"), "copies", "least")
        .join(counts, "uid", "left")
        .join(classes.withColumnRenamed("node", "uid"), "uid", "left")
    )
    known = stored(
        known.select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "uid").alias("root"),
            "least",
        )
    )
    # One row per class, stored so that Spark may cut a large class in the join.
    least = stored(known.groupBy("root").agg(F.min("least").alias("component_id")))
    known = stored(known.drop("least").join(least, "root").drop("root"))
    alone = F.concat(F.lit("row "), F.col(ROW).cast("string")).cast("binary")
    joined = rows.select("vec_id", F.coalesce(digest, alone).alias("digest"), F.isnull("v").alias("alone"))
    joined = joined.join(known, "digest", "left")
    component = F.when(F.col("alone"), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
