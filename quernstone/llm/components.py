"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum and an equi-join. The minimum combines inside each task first and is
dealt out apart from the join, so a hub that holds a third of all edges is split by adaptive execution.
Nothing about the graph reaches the driver but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import apart, forget, stored, stored_with


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = edges.join(apart(least, "u"), F.col("lo") == F.col("u"))
    return joined.select("hi", F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    joined = edges.join(apart(least, "u"), F.col("hi") == F.col("u"))
    moved = joined.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.toDF("hi", "lo")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of an edge that is not the smallest of its component.

    ``edges`` has two columns of integer ids; direction, repeats, loops and null ends do not matter. The
    component is its smallest node. Nodes that are missing in the result are their own component. No
    edges give no rows.
    """
    pairs = edges.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo"), F.col(a).isNull().alias("x"), F.col(b).isNull().alias("y"))
    marks = {"n": F.count("*"), "x": F.expr("bit_xor(xxhash64(hi, lo))")}
    now, mark = stored_with(pairs.filter("NOT x AND NOT y AND hi <> lo").select("hi", "lo").distinct(), "edges", **marks)
    while mark["n"]:
        large = stored(_large_star(now), "large-star")
        forget(now)
        before = mark
        now, mark = stored_with(_small_star(large), "small-star", **marks)
        forget(large)
        if before == mark:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
