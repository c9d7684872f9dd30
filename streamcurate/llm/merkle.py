"""Merkle manifest of a dataset by time-forward processing.

Each row is a leaf; per source, leaves ascend by doc_id and every `FAN` consecutive nodes become their
parent, until one, the subroot, remains.  Subroots, ordered by source, give the root likewise.

A node's label is the place of the last leaf below it, then its level, so children come before parents.  A
sweep takes nodes by label: each sends its digest to its parent's label in a priority queue, and a
parent takes its children's digests out when its turn comes.  Messages to nodes above a block of
FAN ** LEVELS nodes go through Spark's sorted shuffle, the external part of the queue; those inside a block
wait in a heap of at most FAN entries a level.  The reversed sweep takes nodes by falling label: each hands
its children the siblings on their way up, and leaves receive whole proofs.  One round of either sweep
settles LEVELS levels of all trees, so rounds grow with the logarithm of the rows, and no task holds more of a
tree than a block.

Defined cases: nulls are the field `-`; null doc_ids come first; rows with equal doc_id in a source stand
in the order of their leaves, equal rows being leaves of their own; a lone leaf is its subroot, a lone
subroot the root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, placed, scrap, table, whole_groups, whole_row
from .sharding import CRC_OF, CRC_TABLE

FAN = 3
#: Levels that one round settles; a block has FAN ** LEVELS nodes at most.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(*fields: Column) -> Column:
    """Hash of the fields' values, each with its length in bytes."""
    values = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def depth_of(n: int, fan: int) -> int:
    """Levels until one of n nodes remains."""
    depth = 0
    while fan**depth < n:
        depth += 1
    return depth


def risen(leaves: list[str], depth: int, fan: int) -> dict[tuple[int, int], str]:
    """(level, place) -> digest of all nodes of a block, by the forward sweep."""
    known: dict[tuple[int, int], str] = {}
    waiting: list[tuple[int, int, int, str]] = []

    def done(level: int, place: int, value: str):
        known[level, place] = value
        if level < depth:
            heapq.heappush(waiting, ((place // fan + 1) * fan ** (level + 1) - 1, level + 1, place, value))

    def take(last: float):
        while waiting and waiting[0][0] <= last:
            label, parts = waiting[0][:2], []
            while waiting and waiting[0][:2] == label:
                parts.append(heapq.heappop(waiting)[3])
            done(label[1], (label[0] + 1) // fan ** label[1] - 1, digest(*parts))

    for place, leaf in enumerate(leaves):
        done(0, place, leaf)
        take(place)
    take(float("inf"))
    return known


def sunk(known: dict[tuple[int, int], str], depth: int, fan: int, above):
    """(place, chain of (left, right, rest)) of the leaves of a block, by the reversed sweep; `above` is the top's chain."""
    waiting = [(1 - fan**depth, -depth, above)]
    while waiting:
        last, level, chain = heapq.heappop(waiting)
        level, end = -level, 1 - last
        place = end // fan**level - 1
        if not level:
            yield place, chain
            continue
        own = [p for p in range(place * fan, place * fan + fan) if (level - 1, p) in known]
        values = [known[level - 1, p] for p in own]
        for k, p in enumerate(own):
            heapq.heappush(waiting, (1 - (p + 1) * fan ** (level - 1), 1 - level, ("".join(values[:k]), "".join(values[k + 1 :]), chain)))


def chain_of(steps: list[dict]):
    chain = None
    for s in reversed(steps):
        chain = s["left"], s["right"], chain
    return chain


def proofs(chains: list) -> pa.Array:
    """Chains as an Arrow list of structs."""
    left, right, offsets = [], [], [0]
    for chain in chains:
        while chain:
            left.append(chain[0])
            right.append(chain[1])
            chain = chain[2]
        offsets.append(len(left))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"]))


def in_blocks(nodes: DataFrame, size: int, span: int) -> DataFrame:
    """Adds `block`: the place, over all trees, of the first leaf of the node's block."""
    return nodes.withColumn("block", F.col("tree") + F.floor(F.col("at") / F.lit(size)) * F.lit(size * span))


def climb(nodes: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """Rounds of the forward sweep: tables of tree, n, at, digest, from the given one to one node per tree."""
    size = fan**levels

    def run(batches):
        for part in whole_groups(batches, "block"):
            block, tree, n, at = (part.column(c).to_numpy() for c in ("block", "tree", "n", "at"))
            edges = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
            values = part.column("digest").to_pylist()
            tops = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                depth = levels if n[lo] > size else depth_of(int(n[lo]), fan)
                tops.append((int(tree[lo]), -(-int(n[lo]) // size), int(at[lo]) // size, risen(values[lo:hi], depth, fan)[depth, 0]))
            yield pa.RecordBatch.from_arrays([pa.array([t[c] for t in tops], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["tree", "n", "at", "digest"])

    rounds, span = [nodes], 1
    while True:
        dealt = in_blocks(rounds[-1].select("tree", "n", "at", "digest"), size, span).repartition("block").sortWithinPartitions("block", "at")
        rounds.append(materialize(dealt.mapInArrow(run, "tree long, n long, at long, digest string"), "nodes"))
        span *= size
        if not rounds[-1].where("n > 1").take(1):
            return rounds


def descend(rounds: list[DataFrame], heads: DataFrame, fan: int, levels: int) -> DataFrame:
    """The columns of the first round, with `proof`, and `top` of its tree, from heads (tree, proof, top) of the last round."""
    size = fan**levels
    carried = rounds[0].columns

    def sweep(keep: list[str]):
        def run(batches):
            for part in whole_groups(batches, "block"):
                block, at = part.column("block").to_numpy(), part.column("at").to_numpy()
                edges = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
                values, n, above, top = (part.column(c) for c in ("digest", "n", "proof", "top"))
                rows, chains, tops = [], [], []
                for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    # the head of a block comes first, then its nodes
                    count = n[lo + 1].as_py()
                    depth = levels if count > size else depth_of(count, fan)
                    known = risen(values.slice(lo + 1, hi - lo - 1).to_pylist(), depth, fan)
                    for place, chain in sunk(known, depth, fan, chain_of(above[lo].as_py())):
                        rows.append(lo + 1 + place)
                        chains.append(chain)
                        tops.append(top[lo].as_py())
                taken = part.select(keep).take(pa.array(rows, pa.int64())).combine_chunks()
                columns = [taken.column(c).combine_chunks() if taken.num_rows else pa.array([], part.schema.field(c).type) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, proofs(chains), pa.array(tops, pa.string())], [*keep, "proof", "top"])

        return run

    older = heads.select(F.col("tree").alias("block"), "proof", "top")
    for k in range(len(rounds) - 2, -1, -1):
        span = size**k
        nodes = in_blocks(rounds[k], size, span)
        keep = carried if k == 0 else ["tree", "n", "at", "digest"]
        nulls = [F.lit(None).cast(rounds[k].schema[c].dataType).alias(c) for c in keep if c != "at"]
        both = nodes.select(*keep, "block", F.lit(None).cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("top"))
        both = both.unionByName(older.select(*nulls, F.lit(-1).cast("long").alias("at"), "block", "proof", "top"))
        schema = both.drop("block").select(*keep, "proof", "top").schema
        found = both.repartition("block").sortWithinPartitions("block", "at").mapInArrow(sweep(keep), schema)
        if k:
            # a node of this round is the top of a block of the one below
            older = materialize(found.select((F.col("tree") + F.col("at") * F.lit(span)).alias("block"), "proof", "top"), "heads")
        else:
            return found
    raise AssertionError("rounds has the nodes and the tops at least")


def manifest(leaves: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """The columns of `leaves` (doc_id, source, leaf and others), with subroot, root and proof (in place of columns with these names).

    proof lists, from the leaf's level to the root, the digests of the siblings on the left and on the right.
    """
    # inside a struct other columns can't clash with those of the sweeps
    rows = leaves.select(whole_row(leaves.drop("leaf", "subroot", "root", "proof")).alias("row"), "source", "doc_id", F.col("leaf").alias("digest"))
    ranked = placed(rows, "source", "doc_id", "digest")
    rounds = climb(ranked.select("row", "digest", F.col("first").alias("tree"), "n", "at"), fan, levels)
    # of subroots the places in the order of sources are those of their first leaves
    tops = placed(rounds[-1].select(F.col("tree").alias("of"), "digest", F.lit(0).alias("all")), "all", "of")
    upper = climb(tops.select("of", "digest", F.col("first").alias("tree"), "n", "at"), fan, levels)
    last = upper[-1].first()
    heads = upper[-1].select("tree", F.expr(f"cast(array() as {PROOF})").alias("proof"), F.lit("").alias("top"))
    subroots = materialize(descend(upper, heads, fan, levels).select(F.col("of").alias("tree"), "proof", F.col("digest").alias("top")), "subroots")
    out = descend(rounds, subroots, fan, levels)
    out = materialize(out.select("row.*", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(last.digest if last else None).cast("string").alias("root"), "proof"), "manifest")
    scrap(ranked, tops, *rounds[1:], *upper[1:], subroots)
    return out


def folded(leaf: str = "leaf", proof: str = "proof") -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, F.col(leaf), lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def tampered_leaf() -> Column:
    """Leaves of the rows with an even CRC32 of their doc_id once all newlines are deleted from their text, else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.translate(F.col("text").cast("string"), "\n", "")
    return F.when(chosen & F.contains(F.col("text").cast("string"), F.lit("\n")), leaf_of(*map(F.col, FIELDS[:-1]), text))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    leaves = docs.select("doc_id", "source", leaf_of(*map(F.col, FIELDS)).alias("leaf"), tampered_leaf().alias("tampered"))
    rows = manifest(leaves).withColumn("shown", F.coalesce("tampered", "leaf")).withColumn("folded_root", folded("shown"))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql() -> str:
    leaf = lambda text: "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in (*(f"{c}::VARCHAR" for c in FIELDS[:-1]), text)) + ")"
    around = "string_agg(digest, '') OVER (PARTITION BY {0}level, pos // 3 ORDER BY pos ROWS BETWEEN {1})"
    sides = lambda by: f"coalesce({around.format(by, 'UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS l, coalesce({around.format(by, '1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS r"
    return f"""
WITH RECURSIVE {CRC_TABLE},
  p AS MATERIALIZED (SELECT rid, doc_id, source, leaf, shown, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT row_number() OVER () AS rid, doc_id, source, {leaf("text")} AS leaf, CASE WHEN {CRC_OF.format("doc_id::VARCHAR")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS shown FROM documents, crc)),
  up(level, source, pos, digest, n) AS (
    SELECT 0, source, pos, leaf, count(*) OVER (PARTITION BY source) FROM p
    UNION ALL SELECT level + 1, source, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM up WHERE n > 1 GROUP BY level, source, pos // 3),
  sub AS (SELECT level AS depth, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM up WHERE n = 1),
  top(level, pos, digest, n) AS (
    SELECT 0, pos, digest, count(*) OVER () FROM sub
    UNION ALL SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM top WHERE n > 1 GROUP BY level, pos // 3),
  near AS (SELECT level, source, pos, {sides("source, ")} FROM up WHERE n > 1),
  far AS (SELECT level, pos, {sides("")} FROM top WHERE n > 1),
  low(rid, source, level, pos, proof, digest) AS (
    SELECT rid, source, 0, pos, '', shown FROM p
    UNION ALL SELECT rid, low.source, low.level + 1, low.pos // 3, proof || l || r, sha256(l || digest || r) FROM low JOIN near ON near.source IS NOT DISTINCT FROM low.source AND near.level = low.level AND near.pos = low.pos),
  high(rid, level, pos, proof, digest) AS (
    SELECT rid, 0, sub.pos, proof, low.digest FROM low JOIN sub ON sub.source IS NOT DISTINCT FROM low.source AND depth = level
    UNION ALL SELECT rid, high.level + 1, high.pos // 3, proof || l || r, sha256(l || digest || r) FROM high JOIN far ON far.level = high.level AND far.pos = high.pos)
SELECT doc_id, leaf, sub.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256, high.digest AS folded_root, high.digest = root.digest AS verified
FROM p JOIN sub ON sub.source IS NOT DISTINCT FROM p.source JOIN (SELECT level, digest FROM top WHERE n = 1) root ON true JOIN high ON high.rid = p.rid AND high.level = root.level"""
