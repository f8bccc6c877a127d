"""Near-duplicate embeddings through an inverted multi-index.

Vectors are compared within their label by cosine. The two halves of the unit vectors have a
codebook each, and the pairs of codes are the cells of a product grid; every vector is listed in
its cell. A query visits the cells by multi-sequence traversal, nearest first: the codes of
each half are sorted by their distance bound, and pairs of codes are taken from a heap. The
bound of a cell is how far the query's halves are from the regions of its codes; once it
exceeds the radius that belongs to the similarity, no further cell can hold a link, so the
traversal reaches a recall of 1. ``target_recall`` below 1 shrinks the radius in proportion
and visits fewer cells.

The codebooks are fitted by k-means on the driver, on at most ``SAMPLE_ROWS`` vectors chosen by a
hash; every vector is indexed. The number of codes grows with the number of vectors, so that a
cell stays near ``CELL_ROWS`` per label: finer cells save comparisons, which are cheap, and
cost visits, which are rows. Large cells are cut into blocks, and blocks of queries
meet blocks of the cell; links are counted where they are found and travel as sums and as the
spanning edges of a block, never as all pairs.

Equal vectors of a label form a class that is compared once; its members are linked with each
other. Vectors that are null, zero, or hold null or non-finite components, and vectors
without a label, link with nothing. Vectors of different length do not link. Repeated rows are
vectors each for itself. A null id counts as a vector and is never a component id, unless
there is no other. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.components import connected

COSINE = 0.98
CELL_ROWS = 256
MAX_CODES = 256
SAMPLE_ROWS = 20_000
ROUNDS = 12
INDEX_BLOCK, QUERY_BLOCK = 2048, 2048
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest component is divided out first, against overflow."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    found = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    return np.maximum(found, 0)


def fit_codes(points: np.ndarray, codes: int, seed: int = 5) -> np.ndarray:
    """k-means; at most as many codes as there are different points."""
    points = np.unique(points, axis=0)
    random = np.random.default_rng(seed)
    centres = points[random.choice(len(points), min(codes, len(points)), replace=False)]
    for _ in range(ROUNDS):
        nearest = squared_distances(points, centres).argmin(1)
        for code in range(len(centres)):
            own = points[nearest == code]
            if len(own):
                centres[code] = own.mean(0)
    return np.unique(centres, axis=0)


def region_bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, bounds): each point's nearest code, and how far it is at least from the points
    whose nearest code is another: the distance to the plane between the two codes."""
    squares = squared_distances(points, centres)
    code = squares.argmin(1)
    between = np.sqrt(squared_distances(centres, centres))[code]
    gap = squares - squares[np.arange(len(points)), code][:, None]
    bounds = np.divide(gap, 2 * between, out=np.zeros_like(gap), where=between > 0)
    return code, np.maximum(bounds - SLACK, 0)


def visit(first: np.ndarray, second: np.ndarray, radius: float) -> Iterator[tuple[int, int]]:
    """The cells of one query by multi-sequence traversal, while they are in the radius."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")

    def bound(i: int, j: int) -> float:
        return first[one[i]] ** 2 + second[two[j]] ** 2

    heap, seen = [(bound(0, 0), 0, 0)], {(0, 0)}
    while heap:
        reached, i, j = heapq.heappop(heap)
        if reached > radius**2 + SLACK:
            return
        yield int(one[i]), int(two[j])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(one) and b < len(two) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (bound(a, b), a, b))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _cells(codebooks: dict[int, tuple[np.ndarray, np.ndarray]], radius: float, visits: bool):
    """Rows (node, label, embedding) with the cell they are in, or each they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)])
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                points = unit(_matrix(own.column(2), size))
                one, two = codebooks[int(size)]
                half = size // 2
                code_one, bound_one = region_bounds(points[:, :half], one)
                code_two, bound_two = region_bounds(points[:, half:], two)
                rows, cells = np.arange(len(points)), code_one * len(two) + code_two
                if visits:
                    found = [
                        (i, a * len(two) + b)
                        for i in range(len(points))
                        for a, b in visit(bound_one[i], bound_two[i], radius)
                    ]
                    rows, cells = np.array(found, np.int64).reshape(-1, 2).T
                taken = own.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(np.full(len(rows), size, np.int32)),
                     pa.array(cells.astype(np.int64))],
                    names=[*taken.schema.names, "size", "cell"],
                )

    return run


FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])


def _linked(cosine: float):
    """What a block of queries finds in a block of a cell."""

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return FOUND.empty_table()
        size = queries.column("size")[0].as_py()
        asked, listed = (t.column("node").to_numpy() for t in (queries, index))
        one, two = (unit(_matrix(t.column("embedding"), size)) for t in (queries, index))
        linked = (one @ two.T >= cosine) & (asked[:, None] != listed[None, :])
        rows, columns = linked.any(1), linked.any(0)
        linked = linked[np.ix_(rows, columns)]
        asked, listed = asked[rows], listed[columns]
        copies = index.column("copies").to_numpy()[columns]
        counts = linked @ copies
        to_asked, to_listed = asked.copy(), listed.copy()
        while len(asked):  # the smallest node that the block connects each node with
            best = np.where(linked, to_listed[None, :], np.iinfo(np.int64).max).min(1)
            now_asked = np.minimum(to_asked, best)
            best = np.where(linked, now_asked[:, None], np.iinfo(np.int64).max).min(0)
            now_listed = np.minimum(to_listed, best)
            if (now_asked == to_asked).all() and (now_listed == to_listed).all():
                break
            to_asked, to_listed = now_asked, now_listed
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([asked, listed])),
             pa.array(np.concatenate([counts, np.zeros(len(listed), np.int64)])),
             pa.array(np.concatenate([to_asked, to_listed]))],
            schema=FOUND,
        )

    return run


def _usable():
    vector = F.col("embedding")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.col("label").isNotNull() & vector.isNotNull() & F.coalesce(fine, F.lit(False))
        & F.exists(vector, lambda x: x != 0)
    )


def similar_vectors(
    df: DataFrame,
    cosine: float = COSINE,
    target_recall: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cell_rows: int = CELL_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    if not 0 < target_recall <= 1 or not 0 < cosine <= 1:
        raise ValueError("0 < target_recall <= 1 and 0 < cosine <= 1")
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(F.col(vector_col), lambda x: x.cast("double") + 0.0).alias("embedding"),
        F.col(label_col).cast("string").alias("label"),
    )
    usable = rows.filter(_usable()).withColumn("node", F.xxhash64("label", "embedding"))
    named = stored(usable.select("vec_id", "node", "label", "embedding"))
    classes = stored(named.groupBy("node").agg(
        F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"),
    ))
    codebooks = _codebooks(classes, cell_rows, sample_rows)
    radius = math.sqrt(2 - 2 * cosine) * target_recall
    columns = classes.select("node", "label", "embedding", "copies")
    schema = "node long, label string, embedding array<double>, copies long, size int, cell long"
    index = columns.mapInArrow(_cells(codebooks, radius, False), schema)
    queries = columns.mapInArrow(_cells(codebooks, radius, True), schema)
    cell = ["label", "size", "cell"]
    sizes = index.groupBy(*cell).agg(F.count(F.lit(1)).alias("listed")).join(
        queries.groupBy(*cell).agg(F.count(F.lit(1)).alias("asked")), cell
    ).select(
        *cell, F.ceil(F.col("listed") / INDEX_BLOCK).cast("int").alias("index_blocks"),
        F.ceil(F.col("asked") / QUERY_BLOCK).cast("int").alias("query_blocks"),
    )

    def dealt(frame: DataFrame, own: str, others: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        placed = frame.join(sizes, cell)
        other = F.explode(F.sequence(F.lit(0), F.col(f"{others}_blocks") - 1))
        block = F.pmod(F.xxhash64("node", F.lit(1)), F.col(f"{own}_blocks")).cast("int")
        return placed.select(
            *cell, "node", "embedding", "copies", block.alias(f"{own}_block"),
            other.alias(f"{others}_block"),
        )

    key = [*cell, "query_block", "index_block"]
    found = stored(
        dealt(queries, "query", "index").groupBy(*key)
        .cogroup(dealt(index, "index", "query").groupBy(*key))
        .applyInArrow(_linked(cosine), "node long, links long, to long")
    )
    components = connected(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = classes.select("node", "copies", "least").join(components, "node", "left").select(
        "node", "copies", "least", F.coalesce("component", "node").alias("component")
    )
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = grouped.join(smallest, "component").join(counted, "node", "left").select(
        "node", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    linked = named.select("vec_id", "node").join(answers, "node").select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.filter(~_usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def _codebooks(classes: DataFrame, cell_rows: int, sample_rows: int):
    """Per length of vector, a codebook for each half, from a bounded sample."""
    counts = classes.groupBy(F.size("embedding").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("label").alias("labels")
    ).collect()  # a row per length of vector
    found = {}
    for size, n, labels in counts:
        share = F.lit(min(1.0, sample_rows / n) * (1 << 30))
        own = classes.filter(F.size("embedding") == size).filter(
            F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 30)) <= share
        ).select("node", "embedding").limit(2 * sample_rows)
        sample = sorted((r["node"], r["embedding"]) for r in own.toLocalIterator())
        points = unit(np.array([e for _, e in sample] or [[1.0] * size]))
        codes = min(MAX_CODES, max(1, round(math.sqrt(n / max(1, labels) / cell_rows))))
        half = size // 2
        found[size] = fit_codes(points[:, :half], codes), fit_codes(points[:, half:], codes)
    return found
