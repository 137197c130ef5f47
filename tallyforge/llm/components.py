"""Connected components of a link table by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import Scratch

#: Links that one file of a round takes.
FILE_LINKS = 1 << 18


def _large_star(links: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the least node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie each smaller neighbour of a node, and the node itself, to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame, scratch: Scratch, at_most: int | None = None) -> DataFrame:
    """``node``, ``component`` for every node of ``links`` (``a``, ``b``) but the least one of each component.

    Only minima per node and link rows are shuffled, never a whole component; a node with very many
    links is one side of a join that adaptive execution splits. Each round is written to the shared
    folder, in as many files as its links fill: no star has more links than there were before it. ``at_most``
    bounds the links given, if the caller knows a bound. No row for an empty table.
    """
    current = scratch.save(links.select("a", "b").where("a != b").distinct(), None if at_most is None else scratch.files(at_most, FILE_LINKS))
    mark = _mark(current)
    while True:
        following = scratch.save(_small_star(_large_star(current)), scratch.files(mark[0], FILE_LINKS))
        found = _mark(following)
        scratch.drop(current)
        current = following
        if found == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = found


def _mark(links: DataFrame) -> tuple:
    """Fingerprint of a set of links, to see whether a round changed anything."""
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
