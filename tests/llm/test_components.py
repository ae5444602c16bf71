import numpy as np
import pytest

from alvara.llm.components import components, forest


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 1), (None, 3)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 90)],
    [(90, i) for i in range(1, 90)], [(7, 3), (3, 9), (20, 30), (30, 20), (9, 7)],
])
def test_smallest_node_reachable(spark, links):
    root = {x: x for link in links if None not in link and link[0] != link[1] for x in link}
    for _ in root:
        for a, b in links:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == root


def test_forest_in_blocks():
    root = forest(6, np.array([5, 3]), np.array([4, 2]))
    root = forest(6, np.array([2]), np.array([5]), root)
    assert root.tolist() == [0, 1, 2, 2, 2, 2]
