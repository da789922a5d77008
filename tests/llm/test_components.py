import random

from presslake.llm.components import connected_components, spanning_forest


def plain(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = {}
    for x in parent:
        groups.setdefault(root(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def grouped(rows):
    groups = {}
    for node, component in rows:
        groups.setdefault(component, set()).add(node)
    return sorted(map(sorted, groups.values()))


def test_components_of_chains_stars_loops_and_repeats(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in rng.sample(range(400, 600), 80)]
    noise = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    edges = chain + star + noise + [(7, 7), (None, 3), (3, None), (8, 9), (9, 8), (8, 9)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    got = [tuple(r) for r in connected_components(frame).collect()]
    assert grouped(got) == plain(edges)
    assert len({node for node, _ in got}) == len(got)


def test_many_partitions_take_several_rounds(spark):
    # Every edge alone in its task: the forest of a task shortens nothing.
    edges = [(i, i + 1) for i in range(40)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(40)
    assert grouped(tuple(r) for r in connected_components(frame).collect()) == [list(range(41))]


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_a_forest_connects_what_its_edges_connect():
    edges = [(3, 1), (1, 2), (5, 4), (4, 5), (2, 3)]
    assert sorted(spanning_forest(edges)) == [(2, 1), (3, 1), (5, 4)]
