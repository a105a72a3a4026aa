"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """Columns ``a``, ``b`` in; ``node``, ``root`` out, where root is the smallest node of the component.

    Nodes may be of any ordered type. Only nodes of some edge between different nodes are returned; loops
    and null ends are ignored, an empty edge list gives an empty result. Each round moves every node's larger
    (then smaller) neighbours to the smallest one; the number of rounds grows with the logarithm of the size
    of a component. Minima are combined before the shuffle, and a hub's neighbours are met in a sort-merge
    join, whose partitions AQE can split. The driver sees one count and one checksum a round.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    whole = edges.where("a is not null and b is not null and a <> b")
    now = checkpointed(whole.select(lo, hi).distinct())
    before = _state(now)
    while before[0]:
        both = now.selectExpr("lo as u", "hi as v").unionAll(now.selectExpr("hi as u", "lo as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("m as lo", "v as hi").where("lo <> hi").distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").select("m", F.explode(F.array("lo", "hi")).alias("hi"))
        # A round makes no more edges than it was given.
        now = checkpointed(small.where("m <> hi").selectExpr("m as lo", "hi").distinct(), before[0])
        after = _state(now)
        if after == before:
            break
        before = after
    return now.selectExpr("hi as node", "lo as root").unionAll(now.selectExpr("lo as node", "lo as root").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
    return row[0], row[1]
