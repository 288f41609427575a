"""Near-duplicate embeddings by randomly rotated binary codes (operator 1).

Each unit vector is rotated by a random rotation and reduced to the signs of its components, with one
stored factor: the inner product of the rotated vector and its normalised sign vector. The inner product
of two vectors is then estimated, without bias, from the signs of one and the rotated other, and the
factor bounds the error. Only pairs whose bound reaches the threshold are computed again, exactly.

Vectors are dealt to cells around pivots. Each is a member of its nearest cell and visits those cells in
which a vector as near as the threshold may be (in data of many dimensions: is likely to be); a cell is a grid of blocks, so a hot one is spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import components, stored
from asiento.operators.joins import heavy_key_join

THRESHOLD = 0.9
#: Vectors per pivot aimed at, and the most pivots: a bounded sample, sent to all tasks.
PER_PIVOT, MOST_PIVOTS = 500, 2048
#: Standard deviations of a link's spread between two cells that the visits of both its vectors cover. In data of
#: up to REACH^2 effective dimensions that is more than the largest spread there is, and no link is lost.
REACH = 3.0
#: Vectors, and bytes of them, that the effective dimension is measured on.
SPREAD_SAMPLE, SPREAD_BYTES = 4096, 16 << 20
#: Standard deviations of the estimate's error that a pair may be off and still be computed exactly.
CONFIDENCE = 5.0
#: Vectors of one side of a block.
BLOCK = 2048


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def codes(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs (+1, -1) of the rotated vectors and the factor <rotated, signs / sqrt(dim)> of each."""
    rotated = units @ turn
    signs = np.where(rotated >= 0, 1.0, -1.0)
    return signs, np.abs(rotated).sum(axis=1) / np.sqrt(units.shape[1])


def near_pairs(
    x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD, confidence: float = CONFIDENCE
) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of rows of ``x`` and ``y`` with cosine >= threshold.

    <signs of y, rotated x> / (sqrt(dim) * factor) estimates the cosine c; its error is
    sqrt(1 - factor^2) / factor * sqrt(1 - c^2) times the cosine of two random directions, at most 1 and of
    deviation 1 / sqrt(dim - 1). A pair is computed again if its estimate may come from c >= threshold.
    """
    ux, uy = unit(x), unit(y)
    dim = x.shape[1]
    turn = rotation(dim)
    signs, factor = codes(uy, turn)
    spread = min(1.0, confidence / np.sqrt(max(dim - 1, 1)))
    slack = np.sqrt(np.maximum(0, 1 - factor**2)) / factor * np.sqrt(max(0.0, 1 - threshold**2)) * spread
    least = (threshold - slack - 1e-6) * factor * np.sqrt(dim)
    estimate = (ux @ turn).astype(np.float32) @ signs.T.astype(np.float32)
    i, j = np.nonzero(estimate >= least.astype(np.float32)[None, :])
    keep = np.zeros(len(i), dtype=bool)
    for first in range(0, len(i), 1 << 16):
        part = slice(first, first + (1 << 16))
        keep[part] = np.einsum("ij,ij->i", ux[i[part]], uy[j[part]]) >= threshold
    return i[keep], j[keep]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index each of n nodes reaches by the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def effective_dimension(units: np.ndarray) -> float:
    """Participation ratio of the spectrum: the number of directions that unit vectors spread over."""
    squares = np.linalg.svd(units - units.mean(axis=0), compute_uv=False) ** 2
    return float(squares.sum() ** 2 / (squares**2).sum()) if squares.any() else 1.0


def visit_share(dimension: float, reach: float, threshold: float) -> float:
    """How far beyond its own pivot p a vector visits the cell of q, as a share of |p - q|.

    For linked x and y at home with p and q, (x.p - x.q) + (y.q - y.p) = (x - y).(p - q): two terms >= 0, the
    smaller one at most half of |x - y| |p - q| <= sqrt(2 (1 - threshold)) |p - q|. That is sure; over many
    dimensions the cosine of x - y and p - q has a deviation of 1 / sqrt(dimension) only.
    """
    return min(1.0, reach / np.sqrt(dimension)) * np.sqrt((1 - threshold) / 2)


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    reach: float = REACH,
    per_pivot: int = PER_PIVOT,
    most_pivots: int = MOST_PIVOTS,
    block: int = BLOCK,
) -> DataFrame:
    """``id_column, n_links, component_id, kept`` for every row.

    ``n_links`` counts the other vectors with cosine >= ``threshold``; ``component_id`` is the smallest id
    reachable by links, itself included; ``kept`` is id = component. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, vectors of different lengths not with each
    other. Equal vectors are compared once, for all their copies. A row with a null id has a null
    component and is not kept, but counts as a vector. Rows that share an id each get a row. Labels and
    further columns are ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    usable = F.coalesce(
        (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    # -0.0 and 0.0 are one component; the digest names equal vectors.
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0))))
    rows = rows.withColumn("key", F.xxhash64(F.to_json("v")))
    rows = stored(rows.select("id", "key", F.col("v").isNotNull().alias("ok"), "v"), "rows")
    classes = rows.filter("ok").groupBy("key", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "key", "v", "rep", "copies"), "classes")
    found = []
    for (dim,) in classes.select(F.size("v")).distinct().collect():  # one or a few lengths
        found.append(_links(classes.filter(F.size("v") == dim), dim, threshold, reach, per_pivot, most_pivots, block))
    if not found:
        links = spark.createDataFrame([], "node long, n long, least long")
    else:
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
    links = stored(links, "links")
    sums = links.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(links.filter("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    placed = (
        classes.select("node", "key", "v", "rep", "copies")
        .join(sums, "node", "left")
        .join(roots, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    results = placed.join(least, "component").select("key", "v", "n", "copies", "component_id")
    # A vector may be a third of all rows; such vectors are joined by broadcast.
    weights = classes.select("key", "v", F.col("copies").alias("n"))
    linked = heavy_key_join(rows.filter("ok").select("id", "key", "v"), results, ["key", "v"], weights)
    linked = linked.select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    result = linked.unionByName(alone).withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return result.select(F.col("id").alias(id_column), "n_links", "component_id", kept.alias("kept"))


def _links(
    classes: DataFrame, dim: int, threshold: float, reach: float, per_pivot: int, most_pivots: int, block: int
) -> DataFrame:
    """``node, n, least``: links of distinct vectors of one length, by cell and block; ``n`` weighs copies."""
    total = classes.count()
    wanted = int(min(most_pivots, max(1, total // per_pivot)))
    looked = max(wanted, min(SPREAD_SAMPLE, SPREAD_BYTES // (8 * dim)))
    share = F.pmod(F.xxhash64("key", F.lit("pivot")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.5 * looked / total))
    sample = classes.filter(share).select("v").limit(looked).toPandas()  # a bounded number of vectors
    if not len(sample):
        sample = classes.select("v").limit(1).toPandas()
    sampled = unit(np.stack(sample["v"].map(np.asarray)))
    pivots, further = sampled[:wanted], visit_share(effective_dimension(sampled), reach, threshold)

    def assign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            nearness = unit(_matrix(part.column("v"))) @ pivots.T
            home = nearness.argmax(axis=1)
            gaps = np.sqrt(np.maximum(0, 2 - 2 * pivots[home] @ pivots.T))
            i, cell = np.nonzero(nearness >= nearness.max(axis=1, keepdims=True) - further * gaps - 1e-9)
            cells = [c.tolist() for c in np.split(cell, np.searchsorted(i, np.arange(1, part.num_rows)))]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(home, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                ["node", "copies", "v", "home", "cells"],
            )

    dealt = classes.select("node", "copies", "v").mapInArrow(
        lambda batches: (out for batch in batches for out in assign(batch)),
        "node long, copies long, v array<double>, home int, cells array<int>",
    )
    dealt = stored(dealt, "cells")
    members = dealt.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / block).cast("int").alias("rows"))
    visitors = dealt.select(F.explode("cells").alias("cell")).groupBy("cell")
    visitors = visitors.agg(F.ceil(F.count("*") / block).cast("int").alias("columns"))
    # One row for each pivot, at most `most_pivots`.
    grid = F.broadcast(members.join(visitors, "cell", "left").select("cell", "rows", F.coalesce("columns", F.lit(1)).alias("columns")))
    spread = F.xxhash64("node")
    visit = dealt.withColumn("cell", F.explode("cells")).join(grid, "cell").select(
        "cell",
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        F.pmod(spread, F.col("columns")).cast("int").alias("column"),
        F.lit(0).alias("member"), "node", "copies", "home", "v", F.lit(None).cast("array<int>").alias("cells"),
    )
    stay = dealt.withColumn("cell", F.col("home")).join(grid, "cell").select(
        "cell",
        F.pmod(spread, F.col("rows")).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"),
        F.lit(1).alias("member"), "node", "copies", "home", "v", "cells",
    )

    def compare(key, table):
        cell = key[0].as_py()
        member = table["member"].to_numpy() == 1
        home, node, copies = (table[c].to_numpy() for c in ("home", "node", "copies"))
        v = _matrix(table["v"].combine_chunks())
        visitor = ~member
        if not member.any() or not visitor.any():
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "least": pa.array([], pa.int64())})
        ni, nj = node[visitor], node[member]
        i, j = near_pairs(v[visitor], v[member], threshold)
        different = ni[i] != nj[j]
        i, j = i[different], j[different]
        # A pair is met in the cells of both its members if each visits the other's; within one cell, twice.
        hi = home[visitor][i]
        lists = table["cells"].filter(pa.array(member)).combine_chunks()
        owner = np.repeat(np.arange(len(nj)), np.diff(lists.offsets.to_numpy()))
        visits = np.zeros((len(nj), len(pivots)), dtype=bool)
        visits[owner, lists.flatten().to_numpy()] = True
        once = np.where(hi == cell, ni[i] < nj[j], ~(visits[j, hi] & (hi < cell)))
        nodes = np.concatenate([ni, nj])
        ci, cj = copies[visitor], copies[member]
        n = np.concatenate([
            np.bincount(i[once], cj[j[once]], len(ni)), np.bincount(j[once], ci[i[once]], len(nj))
        ]).astype(np.int64)
        label = _local_components(len(nodes), i, j + len(ni))
        touched = np.zeros(len(nodes), dtype=bool)
        touched[i] = touched[j + len(ni)] = True
        return pa.table({"node": nodes[touched], "n": n[touched], "least": nodes[label][touched]})

    grouped = visit.unionByName(stay).groupBy("cell", "row", "column")
    return grouped.applyInArrow(compare, "node long, n long, least long")
