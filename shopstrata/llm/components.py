"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import table

#: The smallest neighbours of up to so many ids are broadcast; those of more are joined by a shuffle.
BROADCAST_IDS = 250_000


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long), read several times. Returns (id, component) of all ids that are not the smallest of their component.

    Large-star and small-star steps in turn, each of them with map-side minima, until all links are stars: then each id is
    linked once, to the smallest it reaches. Links that are stars already are returned as they are. The rounds grow with the
    logarithm of the longest path. Each round's links are a table in the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    while True:
        ids, loose = _shape(edges)
        if not loose:
            break
        edges = table(_round(edges, ids <= BROADCAST_IDS), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _shape(edges: DataFrame) -> tuple[int, int]:
    """How many ids there are, and how many of them have several links to smaller ones, or links to smaller and to larger ones."""
    end = lambda id_, up: edges.select(F.col(id_).alias("id"), F.lit(up).alias("up"))
    ends = end("u", 1).unionByName(end("v", 0)).groupBy("id").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    loose = (F.col("up") > 0) & (F.col("n") > 1)
    return tuple(ends.agg(F.count("*"), F.count_if(loose)).first())


def _round(edges: DataFrame, few: bool) -> DataFrame:
    """few: the ids' smallest neighbours are broadcast."""
    large = _large(edges, few)
    return _small(large if few else large.distinct(), few)


def _large(edges: DataFrame, few: bool) -> DataFrame:
    """Each id's larger neighbours are linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return larger.join(F.broadcast(least) if few else least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame, few: bool) -> DataFrame:
    """Each id and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    both = edges.join(F.broadcast(least) if few else least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return both.where("u != v").distinct()
