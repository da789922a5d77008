"""Near-duplicate vectors by PCA-ordered tiled comparison, exact to the threshold.

Equal vectors of a label are one vector with a multiplicity. Vectors are turned
into principal axes, dealt by label and leading coordinate into blocks, and
blocks are compared in tiles. In a tile the products of the leading dimensions
are summed first; what the rest can add is at most the product of the two
suffix norms, so a pair is dropped as soon as its cosine cannot reach the
threshold. Pairs that are left are measured in double precision on the given
components.

A tile returns counts of links and a spanning forest of its links, never the
links themselves, so large groups of near copies cost no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.components import connected_components, spanning_forest
from presslake.session import materialize

BLOCK_ROWS = 1024
BINS = 3  # per threshold distance, along the leading axis
STEPS = (8, 16, 32)  # leading dimensions after which pairs are dropped
SLACK = 1e-5  # what single precision may lose in a bound
DENSE = 0.1  # share of a tile's pairs below which they are followed one by one


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """Principal axes of all unit vectors: sums of products are added per task,
    so what comes to the driver is ``dims`` squared numbers."""

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"]
        )

    parts = vectors.select("vector").mapInArrow(run, "i int, row array<double>")
    sums = parts.groupBy("i").agg(*[F.sum(F.col("row")[j]).alias(f"s{j}") for j in range(dims)])
    rows = {row[0]: row[1:] for row in sums.collect()}  # dims rows of dims numbers
    scatter = np.array([rows[i] for i in range(dims)])
    return np.linalg.eigh(scatter)[1][:, ::-1].copy()


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _packed(rows: DataFrame, dims: int) -> DataFrame:
    """A row per block: its nodes, their multiplicities and their components as bytes."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        vectors = _matrix(table.column("vector").combine_chunks(), dims)
        return pa.table(
            {
                "block": table.column("block").slice(0, 1),
                "n": pa.array([len(vectors)], pa.int32()),
                "nodes": pa.array([table.column("node").to_numpy().astype("<i8").tobytes()], pa.binary()),
                "times": pa.array([table.column("times").to_numpy().astype("<i8").tobytes()], pa.binary()),
                "data": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
            }
        )

    schema = "block string, n int, nodes binary, times binary, data binary"
    return rows.select("block", "node", "times", "vector").groupBy("block").applyInArrow(run, schema)


class _Block:
    def __init__(self, nodes: bytes, times: bytes, data: bytes, dims: int, axes: np.ndarray):
        self.nodes = np.frombuffer(nodes, "<i8")
        self.times = np.frombuffer(times, "<i8")
        self.vectors = np.frombuffer(data, "<f8").reshape(-1, dims)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        turned = (self.vectors / self.norms[:, None]) @ axes
        self.turned = np.ascontiguousarray(turned, np.float32)
        squares = np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1]
        self.rest = np.sqrt(np.concatenate([squares, np.zeros((len(turned), 1))], axis=1)).astype(np.float32)


def linked_pairs(a: _Block, b: _Block, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` of all pairs whose cosine reaches the threshold."""
    dims = a.turned.shape[1]
    steps = [d for d in STEPS if d < dims]
    bound = threshold - SLACK
    start = steps[0] if steps else dims
    dots = a.turned[:, :start] @ b.turned[:, :start].T
    able = dots + a.rest[:, start, None] * b.rest[None, :, start] >= bound
    if same:
        able &= np.tri(len(a.nodes), k=-1, dtype=bool).T
    for before, after in zip(steps, steps[1:]):
        if not able.any():
            break
        if able.mean() < DENSE:
            start = before
            break
        dots += a.turned[:, before:after] @ b.turned[:, before:after].T
        able &= dots + a.rest[:, after, None] * b.rest[None, :, after] >= bound
        start = after
    i, j = np.nonzero(able)
    sums = dots[i, j]
    for before, after in zip([start, *[d for d in steps if d > start]], [*[d for d in steps if d > start], dims]):
        if before >= after or not len(i):
            break
        sums = sums + np.einsum("ij,ij->i", a.turned[i, before:after], b.turned[j, before:after])
        left = sums + a.rest[i, after] * b.rest[j, after] >= bound
        i, j, sums = i[left], j[left], sums[left]
    keep = np.zeros(len(i), bool)
    for s in range(0, len(i), 65_536):  # bounded memory however many pairs a tile links
        p, q = i[s : s + 65_536], j[s : s + 65_536]
        cosine = np.einsum("ij,ij->i", a.vectors[p], b.vectors[q]) / (a.norms[p] * b.norms[q])
        keep[s : s + 65_536] = cosine >= threshold
    return i[keep], j[keep]


def _compared(tiles: DataFrame, dims: int, axes: np.ndarray, threshold: float) -> DataFrame:
    """Rows (node, links, joined): links counts other vectors; joined is a forest edge or null."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (
                    _Block(*[batch.column(f"{k}_{side}")[row].as_py() for k in ("nodes", "times", "data")], dims, axes)
                    for side in "ab"
                )
                same = batch.column("a")[row].as_py() == batch.column("b")[row].as_py()
                i, j = linked_pairs(left, right, same, threshold)
                counts: dict[int, int] = {}
                links_a = np.bincount(i, right.times[j], len(left.nodes)).astype(np.int64)
                links_b = np.bincount(j, left.times[i], len(right.nodes)).astype(np.int64)
                for block, links in ((left, links_a), (right, links_b)):
                    for k in np.flatnonzero(links):
                        node = int(block.nodes[k])
                        counts[node] = counts.get(node, 0) + int(links[k])
                joined = dict(spanning_forest(zip(left.nodes[i].tolist(), right.nodes[j].tolist())))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counts), pa.int64()),
                        pa.array(list(counts.values()), pa.int64()),
                        pa.array([joined.get(node) for node in counts], pa.int64()),
                    ],
                    ["node", "links", "joined"],
                )

    return tiles.mapInArrow(run, "node bigint, links bigint, joined bigint")


def _scaled(vector: Column) -> Column:
    """``vector`` times a power of two, so that its largest component is near 1 and no
    square overflows or vanishes; cosines do not change. In two steps, as a power
    for the least numbers would overflow."""

    def by_largest(power: Column) -> Column:
        half = F.floor(power / 2)
        first, second = F.pow(F.lit(2.0), -half), F.pow(F.lit(2.0), half - power)
        return F.transform(vector, lambda x: x * first * second)

    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    return F.element_at(F.transform(F.array(F.floor(F.log2(largest))), by_largest), 1)


def link_vectors(
    embeddings: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors of equal, non-null label link if their cosine is ``threshold`` or
    more (positive). ``n_links`` counts the other vectors linked directly,
    ``component_id`` is the least id reachable by links, and ``kept`` says that
    it is the vector's own. Vectors that are null, empty, zero, or hold null or
    non-finite components, and those without a label, link with nothing. Rows
    with equal ids are vectors of their own; a null id never becomes a component
    id unless the component has no other. Vectors of different lengths do not
    link. Only the three named columns are read; no rows give no rows.
    """
    rows = embeddings.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).withColumn("usable", _usable(F.col("vector")) & F.col("label").isNotNull())
    rows = rows.withColumn("vector", F.when(F.col("usable"), _scaled(F.col("vector"))))
    good = rows.filter("usable")
    lengths = sorted(r[0] for r in good.select(F.size("vector")).distinct().collect())
    # Equal vectors become one before the shuffle; a node is a number of a written table.
    classes = good.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("times"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = []
    for dims in lengths:
        own = classes.filter(F.size("vector") == dims)
        found.append(_links_of_length(own, dims, threshold, block_rows))
    counts, edges = None, None
    for part in found:
        stored = materialize(part, "links")
        counts = stored if counts is None else counts.unionByName(stored)
    if counts is None:
        counts = classes.select("node", F.lit(0).cast("bigint").alias("links"), F.lit(None).cast("bigint").alias("joined")).limit(0)
    edges = counts.filter("joined IS NOT NULL").select(F.col("node").alias("a"), F.col("joined").alias("b"))
    linked = counts.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(edges)
    named = materialize(
        classes.join(components, "node", "left").join(linked, "node", "left").select(
            "label", "vector", "times", "least", "links", F.coalesce("component", "node").alias("component")
        ),
        "classes",
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = materialize(
        named.join(least, "component").select(
            F.xxhash64("label", "vector").alias("place"), "label", "vector", "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        ),
        "result",
    )
    keyed = good.select("id", F.xxhash64("label", "vector").alias("place"), "label", "vector")
    same = (
        (keyed["place"] == whole["place"]) & (keyed["label"] == whole["label"]) & (keyed["vector"] == whole["vector"])
    )
    judged = keyed.join(whole, same).select(keyed["id"], "n_links", "component_id")
    alone = rows.filter("NOT usable").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return judged.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _links_of_length(classes: DataFrame, dims: int, threshold: float, block_rows: int) -> DataFrame:
    axes = _axes(classes, dims)
    width = float(np.sqrt(max(2 - 2 * threshold, 1e-6)))  # unit vectors that link are no farther apart
    lead = axes[:, 0].tolist()
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    along = F.aggregate(
        F.zip_with("vector", F.array(*[F.lit(v) for v in lead]), lambda x, v: x * v),
        F.lit(0.0), lambda s, x: s + x,
    )
    placed = classes.withColumn("bin", F.floor(along / length * BINS / width).cast("int"))
    sizes = placed.groupBy("label", "bin").agg(F.count("*").alias("m"))
    # A bin of many rows is dealt over several blocks.
    cells = materialize(
        sizes.select(
            "label", "bin", F.ceil(F.col("m") / F.lit(block_rows)).cast("int").alias("blocks")
        ),
        "cells",
    )
    # A label may hold any character; its hexadecimal form parts from the rest.
    plain = F.hex(F.col("label").cast("string"))
    name = F.concat_ws("/", plain, "bin", F.pmod(F.xxhash64("vector"), F.col("blocks")))
    blocks = materialize(
        _packed(
            placed.join(cells, ["label", "bin"]).select(name.alias("block"), "node", "times", "vector"), dims
        ),
        "blocks",
    )
    # Blocks to compare: those of one label whose bins are near enough to hold a link.
    keys = blocks.select(
        "block", F.split("block", "/")[0].alias("label"), F.split("block", "/")[1].cast("int").alias("bin")
    )
    near = keys.select(
        F.col("block").alias("b"), "label",
        F.explode(F.sequence(F.col("bin") - (BINS + 1), F.col("bin") + (BINS + 1))).alias("bin"),
    )
    pairs = keys.withColumnRenamed("block", "a").join(near, ["label", "bin"]).filter("a <= b").select("a", "b")

    def side(key: str) -> DataFrame:
        return blocks.select(
            F.col("block").alias(key), *[F.col(k).alias(f"{k}_{key}") for k in ("nodes", "times", "data")]
        )

    tiles = pairs.join(side("a"), "a").join(side("b"), "b")
    return _compared(tiles, dims, axes, threshold)
