"""Connected components of a distributed edge list."""

from pyspark.sql import functions as F

from tripleweft.plans.joins import dealt_join
from tripleweft.scratch import Steps, write_and_read


def _checksum(edges):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], row["sum"]


def _large_star(edges, rows):
    """Every node's larger neighbours are hung on the smallest node it knows; `rows` is the number of edges."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    hung = dealt_join(both.where("b > a"), least, "a", rows=2 * rows).select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    return hung.where("a <> b").distinct()


def _small_star(edges, rows):
    """Every node and its smaller neighbours are hung on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = dealt_join(down, least, "a", rows=rows).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges, label="component"):
    """Rows (node, smallest node of its component) for every node of `edges` (a, b: two longs).

    Large-star and small-star alternate until the edges stay the same, which takes a number of rounds in the order of
    the squared logarithm of the nodes. Each round is written to the shared folder, so a lost executor costs a task and
    not the chain. Loops and null ends are ignored; an empty edge list gives no rows. A node with very many edges is
    pre-aggregated by `min`, and its side of the join may be split by adaptive execution, as the other side has one row.
    """
    spark, first, steps = edges.sparkSession, Steps("edges"), Steps("components")
    given = first.write(edges.select("a", "b").where("a <> b"))
    now = steps.write(_small_star(given, given.count()))
    first.drop(spark)
    state = _checksum(now)
    while state[0]:
        now = steps.write(_small_star(_large_star(now, state[0]), state[0]))
        after = _checksum(now)
        if after == state:
            break
        state = after
    now = write_and_read(now, "components")
    steps.drop(spark)
    # Small-star leaves stars: each node has one edge, to the smallest of its component.
    least = now.groupBy("a").agg(F.min("b").alias(label))
    return least.withColumnRenamed("a", "node").unionByName(now.select(F.col("b").alias("node"), F.col("b").alias(label)).distinct())
