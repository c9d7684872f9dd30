"""Graph algorithms over arrows (columns from and to): cycles, inherited states, topological levels.

Each is a loop of joins that ends by itself; what a step needs of the one before is a table in the shared
folder.  Nothing is collected but whether a step found anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import discard, materialize

#: Steps after which what a loop has found is written into one table, so that plans stay small.
MERGE_STEPS = 16


def dealt(df: DataFrame) -> DataFrame:
    """To be joined by shuffle, however small Spark takes it to be: a broadcast goes through the driver, in each step of a loop."""
    return df.hint("merge")


def followed(chain: DataFrame) -> DataFrame:
    """Of nodes with one arrow in and one out (node, prev, next) the ends of their path, by doubling: node, prev, next, low.

    prev and next are the nearest nodes outside `chain`.  On a ring there is none; low is then its smallest node.
    """
    rows = materialize(chain.select("node", "prev", "next", F.col("node").alias("low")), "chain")
    for _ in range(max(1, rows.count()).bit_length()):
        after = rows.select(F.col("node").alias("next"), F.col("next").alias("_next"), F.col("low").alias("_low"))
        before = rows.select(F.col("node").alias("prev"), F.col("prev").alias("_prev"))
        step = rows.join(dealt(after), "next", "left").join(dealt(before), "prev", "left")
        step = step.select("node", F.coalesce("_prev", "prev").alias("prev"), F.coalesce("_next", "next").alias("next"), F.least("low", F.coalesce("_low", "low")).alias("low"), (F.col("_next").isNotNull() | F.col("_prev").isNotNull()).alias("moved"))
        older, rows = rows, materialize(step, "chain")
        discard(older)
        if not rows.where("moved").take(1):
            break
    return rows


def settled(arrows: DataFrame) -> DataFrame:
    """(node, component, cyclic) of one strongly connected component for each colour, by forward and backward colouring.

    Forward, the largest name that reaches a node is its colour; backward from the node of that name, what is
    reached within the colour is that node's component.
    """
    nodes = arrows.select(F.col("from").alias("node")).union(arrows.select("to")).distinct()
    colour = materialize(nodes.select("node", F.col("node").alias("colour"), F.lit(True).alias("fresh")), "colours")
    while True:
        sent = colour.where("fresh").join(dealt(arrows), F.col("node") == F.col("from")).groupBy(F.col("to").alias("node")).agg(F.max("colour").alias("_sent"))
        larger = F.coalesce(F.col("_sent") > F.col("colour"), F.lit(False))
        older, colour = colour, materialize(colour.join(dealt(sent), "node", "left").select("node", F.when(larger, F.col("_sent")).otherwise(F.col("colour")).alias("colour"), larger.alias("fresh")), "colours")
        discard(older)
        if not colour.where("fresh").take(1):
            break
    own = colour.select("node", "colour")
    inside = arrows.join(dealt(own.toDF("from", "_a")), "from").join(dealt(own.toDF("to", "_b")), "to").where("_a = _b").select("from", "to", F.col("_a").alias("colour"))
    inside = materialize(inside, "inside")
    frontier = materialize(own.where("node = colour"), "reached")
    reached, steps = frontier, 0
    while True:
        steps += 1
        back = inside.join(dealt(frontier.select(F.col("node").alias("to"), "colour")), ["to", "colour"]).select(F.col("from").alias("node"), "colour").distinct()
        frontier = materialize(back.join(dealt(reached.select("node")), "node", "left_anti"), "reached")
        if not frontier.take(1):
            break
        reached = reached.unionByName(frontier)
        if steps % MERGE_STEPS == 0:
            reached = materialize(reached, "reached")
    sizes = reached.groupBy("colour").agg(F.count("*").alias("_size"))
    loops = inside.where("`from` = `to`").select(F.col("from").alias("node"), F.lit(True).alias("_loop")).distinct()
    out = reached.join(dealt(sizes), "colour").join(dealt(loops), "node", "left")
    return materialize(out.select("node", F.col("colour").alias("component"), ((F.col("_size") > 1) | F.coalesce("_loop", F.lit(False))).alias("cyclic")), "settled")


def strongly_connected(arrows: DataFrame) -> DataFrame:
    """(node, component) of all nodes on cycles; component is the smallest node of those that reach each other.

    Paths of nodes with one arrow in and one out become one arrow, nodes that nothing leaves or enters go, and
    what is left is coloured.  A node of a path is on a cycle just where the path's ends are in one component.
    Steps grow with the logarithm of a path's or ring's length; only the cores that are left take a step for each
    arrow of their longest way.  Nothing grows with the square of a cycle.
    """
    left = materialize(arrows.where("`from` IS NOT NULL AND `to` IS NOT NULL").select("from", "to").distinct(), "arrows")
    paths, found = [], []
    while left.take(1):
        outs = left.groupBy(F.col("from").alias("node")).agg(F.count("*").alias("o"), F.min("to").alias("next"))
        ins = left.groupBy(F.col("to").alias("node")).agg(F.count("*").alias("i"), F.min("from").alias("prev"))
        inner = materialize(outs.join(dealt(ins), "node"), "inner")
        single = inner.where("o = 1 AND i = 1").select("node", "prev", "next")
        without = lambda df, names: df.join(dealt(names.toDF("from")), "from", "left_anti").join(dealt(names.toDF("to")), "to", "left_anti")
        older = left
        if single.take(1):
            ends = followed(single)
            names = ends.select("node")
            ring = ends.join(dealt(names.toDF("next")), "next", "left_semi")
            path = ends.join(dealt(names.toDF("next")), "next", "left_anti")
            found.append(ring.select("node", F.col("low").alias("component")))
            paths.append(path.select("node", "prev", "next"))
            short = path.select(F.col("prev").alias("from"), F.col("next").alias("to"))
            left = materialize(without(left, names).select("from", "to").unionByName(short).distinct(), "arrows")
        else:
            names = inner.select("node")
            trimmed = materialize(left.join(dealt(names.toDF("from")), "from", "left_semi").join(dealt(names.toDF("to")), "to", "left_semi").select("from", "to"), "arrows")
            if trimmed.count() == left.count():
                done = settled(left)
                found.append(done.where("cyclic").select("node", "component"))
                left = materialize(without(left, done.select("node")).select("from", "to"), "arrows")
                discard(trimmed)
            else:
                left = trimmed
        discard(older, inner)
    if not found:
        return arrows.select(F.col("from").alias("node"), F.col("from").alias("component")).where("false")
    known = materialize(reduce(lambda a, b: a.unionByName(b), found), "cycles")
    for path in reversed(paths):
        a, b = known.toDF("prev", "_a"), known.toDF("next", "_b")
        between = path.join(dealt(a), "prev").join(dealt(b), "next").where("_a = _b").select("node", F.col("_a").alias("component"))
        older, known = known, materialize(known.unionByName(between), "cycles")
        discard(older)
    lows = known.groupBy("component").agg(F.min("node").alias("low"))
    return known.join(dealt(lows), "component").select("node", F.col("low").alias("component"))


def inherited(arrows: DataFrame, own: DataFrame) -> DataFrame:
    """(node, bits): all bits that nodes above have (own: node, bits), carried along the arrows to a fixed point.

    A node sends on only what is new to it, so it is met at most once for each bit, whatever lies above it.
    """
    steps = materialize(arrows, "arrows")
    frontier, known, depth = own.where("bits > 0").select("node", "bits"), None, 0
    while True:
        depth += 1
        sent = frontier.join(steps, F.col("node") == F.col("from")).groupBy(F.col("to").alias("node")).agg(F.bit_or("bits").alias("bits"))
        if known is not None:
            sent = sent.join(known.withColumnRenamed("bits", "_known"), "node", "left").select("node", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_known", F.lit(0)))).alias("bits"))
        frontier = materialize(sent.where("bits > 0"), "inherited")
        if not frontier.take(1):
            return frontier if known is None else known
        known = frontier if known is None else known.unionByName(frontier).groupBy("node").agg(F.bit_or("bits").alias("bits"))
        if depth % MERGE_STEPS == 0:
            known = materialize(known, "inherited")


def levels(inner: DataFrame, nodes: DataFrame) -> DataFrame:
    """(root, node, level) by peeling: a node's level is the longest way from nodes without arrows in.

    inner: root, from, to, the arrows of each root's part; nodes: root, node.  Each node is expanded once, when the
    last arrow into it has arrived; nodes on cycles, and below them, never are and so have no row.
    """
    inner = materialize(inner.select("root", "from", "to"), "arrows")
    need = materialize(inner.groupBy("root", F.col("to").alias("node")).agg(F.count("*").alias("need")), "need")
    frontier = materialize(nodes.select("root", "node").join(need, ["root", "node"], "left_anti").withColumn("level", F.lit(0)), "levels")
    found, part, level = frontier, None, 0
    while frontier.take(1):
        level += 1
        got = frontier.join(inner, (inner["root"] == frontier["root"]) & (F.col("node") == F.col("from"))).groupBy(inner["root"], F.col("to").alias("node")).agg(F.count("*").alias("got"))
        if part is not None:
            got = got.unionByName(part).groupBy("root", "node").agg(F.sum("got").alias("got"))
        state = materialize(got.join(need, ["root", "node"]), "arrived")
        part = state.where("got < need").select("root", "node", "got")
        frontier = materialize(state.where("got = need").select("root", "node", F.lit(level).alias("level")), "levels")
        found = found.unionByName(frontier)
        if level % MERGE_STEPS == 0:
            found = materialize(found, "levels")
    return found
