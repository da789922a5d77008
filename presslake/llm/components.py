"""Connected components of a large graph as joins over written tables.

Each round every node points to a neighbour (or itself), and the edges are
redrawn between the nodes pointed to. In even rounds the neighbour with the
least id is taken, which settles stars and dense groups at once, in odd rounds
the one with the least hash, which shortens any chain by a constant factor in
expectation. Before a round the edges of each task are reduced to a spanning
forest. At the end the pointers are followed back, from the smallest graph to
the first. No node's neighbours are ever gathered.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.words import tidy
from presslake.session import materialize


def spanning_forest(edges) -> list[tuple]:
    """Edges (node, least node of its tree) that connect what ``edges`` connects."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != x:
            parent[x], x = top, parent[x]
        return top

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        if ra != rb:
            low, high = (ra, rb) if ra < rb else (rb, ra)
            parent[low] = low
            parent[high] = low
    return [(x, root(x)) for x in parent if root(x) != x]


def _reduced(edges: DataFrame) -> DataFrame:
    def run(batches):
        pairs = (
            pair
            for batch in batches
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        )
        forest = spanning_forest(pairs)
        for i in range(0, len(forest), 10_000):
            some = forest[i : i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in some], pa.int64()), pa.array([e[1] for e in some], pa.int64())],
                ["a", "b"],
            )

    return edges.mapInArrow(tidy(run), "a bigint, b bigint")


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (``a``, ``b``, bigint).

    ``component`` is some node of the component. Loops, repeated edges and edges
    with a null end are ignored; no edges give no rows.
    """
    def cleaned(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b")

    work = materialize(_reduced(cleaned(edges)), "edges")
    pointers: list[DataFrame] = []
    turn = 0
    while not work.isEmpty():
        both = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if turn % 2 == 0:
            target = F.least(F.col("a"), F.min("b"))
        else:
            place = F.xxhash64(F.lit(turn), F.col("b"))
            own = F.xxhash64(F.lit(turn), F.col("a"))
            target = F.when(F.min(place) < own, F.min_by("b", place)).otherwise(F.col("a"))
        points = materialize(both.groupBy("a").agg(target.alias("p")), "points")
        pointers.append(points)
        to_a, to_b = (
            points.select(F.col("a").alias(side), F.col("p").alias(f"p{side}")) for side in ("a", "b")
        )
        redrawn = work.join(to_a, "a").join(to_b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        work = materialize(_reduced(cleaned(redrawn)), "edges")
        turn += 1
    if not pointers:
        return work.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = pointers.pop().select(F.col("a").alias("node"), F.col("p").alias("component"))
    while pointers:
        points = pointers.pop().select(F.col("a").alias("first"), "p")
        found = points.join(found, points["p"] == found["node"], "left").select(
            F.col("first").alias("node"), F.coalesce("component", "p").alias("component")
        )
        if pointers:
            found = materialize(found, "followed")
    return found
