"""Round-based election equals sequential first-fit on random graphs."""

import random

from brieflow.operators.election import leader_election
from first_fit import first_fit_reference


def test_random_graphs(spark):
    rng = random.Random(5)
    node_rows, edge_rows, expected = [], [], {}
    for g in range(40):
        n = rng.randint(1, 25)
        base = g * 1000
        nodes = [base + i for i in range(n)]
        p = rng.choice([0.05, 0.15, 0.3])
        edges = {(a, b) for a in nodes for b in nodes if a < b and rng.random() < p}
        # a long ordered chain in some graphs
        if g % 7 == 0:
            edges |= {(nodes[i], nodes[i + 1]) for i in range(n - 1)}
        node_rows += [(x,) for x in nodes]
        edge_rows += list(edges)
        expected.update(first_fit_reference(nodes, lambda a, b, E=edges: (min(a, b), max(a, b)) in E))
    nd = spark.createDataFrame(node_rows, "node long")
    ed = spark.createDataFrame(edge_rows, "u long, v long")
    got = {r["node"]: r["leader"] for r in leader_election(nd, ed).collect()}
    assert got == expected
