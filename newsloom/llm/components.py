"""Connected components of an edge table by alternating large and small stars, all in joins.

The edges of a hub stay where they are and are told its least neighbour; no task meets them all.
"""

from pyspark.sql import functions as F

from newsloom.llm.work import hub_join, hub_size, written


def _written(df, name):
    return written(df, name)


def _told_least(rows, least, total):
    """Each (u, v) of ``rows`` as (v, least of u); a hub's rows stay where they are, see ``hub_join``."""
    least = written(least, "least")
    heavy = not least.filter(F.col("size") > hub_size(total)).isEmpty()
    joined = hub_join(rows, least, "u", "size", total) if heavy else rows.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")), least


def _large_star(edges, total):
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("size"))
    return _told_least(both.filter("v > u"), least, 2 * total)[0]


def _small_star(edges, total):
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    moved, least = _told_least(down, down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size")), total)
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges, left="u", right="v"):
    """(node, label): the least node of its component, for every node of the edges; no edges, no rows.

    An edge with a null end is left out. Each round is written to the shared folder, so neither its lineage nor its recovery grows.
    """
    edges = edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
    edges = _written(edges.filter("u != v").distinct(), "edges")
    seen = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        # written between the two stars, or the plan of the first would stand in the second many times
        large = _written(_large_star(edges, state[0]), "large")
        edges = _written(_small_star(large, state[0]).filter("u != v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
