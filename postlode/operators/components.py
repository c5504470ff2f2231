"""Connected components over (a, b) edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.shared import drop_stored, stored, written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Rounds join each node to the smallest label around it and then let labels
    follow their own label, so paths halve; the count of changed labels is all
    that reaches the driver: joins are merge joins, as Spark takes what is
    stored for as small as its files. Every round is stored, and the one before is
    deleted.
    """
    both = [F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in ("ab", "ba")]
    with written() as first:
        edges = stored(edges.where("a <> b").select(F.inline(F.array(*both))).distinct(), "edges")
        state = stored(edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("root")), "state")
    before = first[1:]
    for _ in range(most_rounds):
        around = edges.join(state.hint("merge"), edges["y"] == state["node"]).groupBy("x").agg(F.min("root").alias("m"))
        # what a node sees is also told to the node that was its root
        seen = state.join(around.hint("merge"), state["node"] == around["x"]).select("node", "root", F.least("root", "m").alias("m"))
        told = [F.struct(F.col(c).alias("node"), "m") for c in ("node", "root")]
        hooks = seen.select(F.inline(F.array(*told))).groupBy("node").agg(F.min("m").alias("m"))
        with written() as paths:
            # written first, so that both sides of the next join are shuffled and Spark can split the rows of a label that many have
            hooked = stored(state.join(hooks.hint("merge"), "node", "left").select("node", "root", F.least("root", F.coalesce("m", "root")).alias("new")), "hooked")
            above = hooked.select(F.col("node").alias("up"), F.col("new").alias("top"))
            moved = stored(hooked.join(above.hint("merge"), F.col("new") == F.col("up"), "left").select("node", "root", F.least("new", F.coalesce("top", "new")).alias("new")), "moved")
        drop_stored(edges.sparkSession, [*before, *paths[:-1]])
        before = paths[-1:]
        state = moved.select("node", F.col("new").alias("root"))
        if moved.where("root <> new").isEmpty():
            drop_stored(edges.sparkSession, first[:1])
            return state.withColumnRenamed("root", "component")
    raise RuntimeError("labels still change")
