"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import shared_folder


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links(a, b)`` to ``(node, root)`` with root the smallest node reachable, for nodes that have a link.

    Large-star and small-star steps alternate: each node hands its larger, then its smaller, neighbours to its smallest
    one, so paths shrink by half and hubs never gather in one group (a minimum is folded before the shuffle and
    joined back). Each round is a checkpoint; the driver sees two numbers of it. Self-links and repeated links are
    harmless; an empty table gives an empty one. Null ends are dropped.
    """
    shared_folder(links.sparkSession)
    edges = (
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u is not null and v is not null and u <> v")
        .distinct()
        .checkpoint()
    )
    before = None
    for _ in range(rounds):
        edges = _small_star(_large_star(edges)).checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
