"""Connected components of a pair table, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import forget, written

#: Rounds after which something must be wrong: each round at least halves the expected number of nodes.
MOST_ROUNDS = 100


def components(pairs: DataFrame) -> DataFrame:
    """(id, root): each id that occurs in ``pairs`` (columns a, b) with the smallest id of its component.

    Each round every node goes over to its neighbour (or itself) of least priority, a hash that changes with the round,
    and the pairs are rewritten to what their ends went over to. Aggregates combine before the shuffle, so a node with
    very many neighbours is no hot group. Rounds are written to the shared folder, which cuts the lineage; a round's tables go
    when the next one's are there.
    """
    pairs = written(pairs.where("a <> b").select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    roots = written(ids.withColumn("root", F.col("id")), "roots")
    for turn in range(MOST_ROUNDS):
        if pairs.isEmpty():
            break
        both = pairs.union(pairs.select("b", "a"))
        best = both.groupBy(F.col("a").alias("at")).agg(F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("p"), F.col("b").alias("to"))).alias("m"))
        own = F.xxhash64("at", F.lit(turn))
        hop = written(best.select("at", F.when(F.col("m.p") < own, F.col("m.to")).otherwise(F.col("at")).alias("to")), "hop")
        old_roots, old_pairs = roots, pairs
        roots = written(roots.join(hop, F.col("root") == F.col("at"), "left")
                        .select("id", F.coalesce("to", "root").alias("root")), "roots")
        to_a, to_b = hop.select(F.col("at").alias("a"), F.col("to").alias("na")), hop.select(F.col("at").alias("b"), F.col("to").alias("nb"))
        pairs = written(pairs.join(to_a, "a").join(to_b, "b").where("na <> nb")
                        .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(), "pairs")
        forget(old_roots, old_pairs, hop)
    else:
        raise RuntimeError("the contraction did not end")
    least = roots.groupBy("root").agg(F.min("id").alias("least"))
    return roots.join(least, "root").select("id", F.col("least").alias("root"))
