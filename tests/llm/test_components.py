import random

import pytest

from millrace.llm.components import components

from cases import Union


def solved(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}")
    return {r["node"]: r["root"] for r in components(df).collect()}


def wanted(edges):
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    union = Union({n for e in real for n in e})
    for a, b in real:
        union.join(a, b)
    return {n: union.root(n) for n in union.parent}


@pytest.mark.parametrize(
    "edges",
    [
        [(k, k + 1) for k in range(60)],
        [(0, k) for k in range(1, 80)] + [(100, 101), (101, 100), (100, 101)],
        [(random.Random(k).randrange(200), random.Random(k + 999).randrange(200)) for k in range(150)],
        [(5, 5), (None, 3), (3, None), (-7, 9), (9, 2)],
    ],
)
def test_smallest_node_of_each_component(spark, edges):
    assert solved(spark, edges) == wanted(edges)


def test_text_nodes_and_no_edges(spark):
    assert solved(spark, [("b", "a"), ("b", "c")], "string") == {"a": "a", "b": "a", "c": "a"}
    assert solved(spark, []) == {}
    assert solved(spark, [(1, 1)]) == {}
