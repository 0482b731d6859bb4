"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import durable, seen, side_of


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b: of any type with an order), stored; component is the smallest id of its component.

    Contraction: in each round every node moves to a neighbour or stays, links are renamed, and loops and
    repeats vanish. First it is the smallest neighbour, which takes a star around its smallest id in one round;
    then that with the smallest hash of the round, so that a chain shrinks by a constant factor whatever
    the order of its ids. The moves are put together at the end.
    """
    spark = links.sparkSession
    edges = durable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moves: list[DataFrame] = []
    while seen(edges):
        turn = len(moves)
        rank = lambda c, turn=turn: F.struct((F.xxhash64(F.lit(turn), c) if turn else c).alias("h"), c.alias("v"))
        ways = edges.union(edges.select("b", "a"))
        to = F.least(F.min(rank(F.col("b"))), F.first(rank(F.col("a"))))
        moves.append(durable(ways.groupBy("a").agg(to.alias("m")).select("a", F.col("m.v").alias("to"))))
        side = side_of(moves[-1])
        renamed = edges.join(side.select("a", F.col("to").alias("ta")), "a").join(side.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
        edges = durable(renamed.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a <> b").distinct())
    if not moves:
        return durable(spark.createDataFrame([], edges.select(F.col("a").alias("id"), F.col("a").alias("component")).schema))
    place = moves[0].select(F.col("a").alias("id"), F.col("to").alias("root"))
    for later in moves[1:]:
        place = place.join(side_of(later).withColumnRenamed("a", "root"), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    place = durable(place)
    least = place.groupBy("root").agg(F.min("id").alias("component"))
    return durable(place.join(least, "root").select("id", "component"))
