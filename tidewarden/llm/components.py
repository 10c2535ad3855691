"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Columns id and class (the smallest id reached), for every id in edges (a, b).

    In each round every id points to its smallest neighbour, if that is smaller; pointers are followed
    to the roots by doubling, and the graph shrinks to one id per root with the edges between them.
    Minima are formed before the shuffle, so a hub is no hot task, and edges inside a class are read
    once. Each round's graph and pointers are written. An edge from an id to itself names it without
    linking it.
    """
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    graph = written(edges.select(*ordered).distinct(), "edges")
    rounds: list[DataFrame] = []
    while True:
        both = graph.select("a", "b").union(graph.select("b", "a"))
        up = written(both.groupBy(F.col("a").alias("id")).agg(
            F.least(F.col("a"), F.min("b")).alias("up")), "up")
        moved = True
        while moved:
            above = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
            up = written(up.join(above, "up").select("id", F.col("top").alias("up"),
                                                     (F.col("top") != F.col("up")).alias("moved")),
                         "up")
            moved = not up.filter("moved").isEmpty()
            up = up.select("id", "up")
        rounds.append(up)
        between = graph.filter("a <> b")
        for end in ("a", "b"):
            between = between.join(up.select(F.col("id").alias(end), F.col("up").alias(f"{end}_up")),
                                   end).drop(end).withColumnRenamed(f"{end}_up", end)
        graph = written(between.select(*ordered).filter("a <> b").distinct(), "edges")
        if graph.isEmpty():
            break
    classes = rounds.pop()
    while rounds:
        above = classes.select(F.col("id").alias("up"), F.col("up").alias("class"))
        classes = rounds.pop().join(above, "up", "left").select(
            "id", F.coalesce("class", "up").alias("up"))
    return classes.select("id", F.col("up").alias("class"))
