"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.staging import staged


def _symmetric(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = _symmetric(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a != b").unionByName(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes in ``links`` (``a``, ``b``).

    Stars are formed in turn until nothing changes, a number of rounds that
    grows with the logarithm of the longest chain. Each round is a written
    table, so a lost executor costs no more than its share of one round.
    """
    current = staged(links.where("a != b").select("a", "b").distinct(), name)

    def mark(table):
        """The number of links and a sum over them, equal only if nothing has changed."""
        return tuple(
            table.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
            ).first()
        )

    before = mark(current)
    while before[0]:
        current = staged(_small_star(_large_star(current).distinct()).distinct(), name)
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
