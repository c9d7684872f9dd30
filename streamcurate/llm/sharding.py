"""Sharding by a hierarchical weighted hash tree.

A tree has regions, these have racks, and racks have shards with weights; a node weighs what its
shards weigh.  A row descends from level to level: each child of the node it has reached draws
ln(u) / weight, u being a hash in (0, 1] of the row's id and the child's name, and the largest draw
wins.  A draw depends on one child alone, so a change of weights moves rows only between the changed
subtree and the others, and inside it only along the nodes that changed.

The law is `key`: doc_id and the shard count decide.  `tree_of` lays out the founding shards evenly; each
later one opens a region of its own, so it takes rows only into itself, whatever the count.  A shard added
inside a rack (`added`) shifts rows to its whole region and rack as well, and nowhere else.

Draws, sizes and checksums are built-in expressions; places in shards come from one range exchange,
so a hot shard or a doc_id that repeats without bound is dealt to many tasks.

Defined cases: a null text has no bytes (checksum 0); a null doc_id draws as an empty name; rows
with one doc_id share a shard; slots ascend by doc_id (null first), checksum and size, and rows equal in
all of these take any order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import placed, table

SHARDS = 40
REGIONS, RACKS = 5, 4
#: Bytes that a row takes beside its text.
ROW_BYTES = 16
LAW = "key"
#: Hex digits of a hash that make a draw: 52 bits, exact as a double.
DIGITS = 13

#: region name -> rack name -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def tree_of(shards: int = SHARDS, founded: int | None = None, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """The layout of so many shards of weight 1: the first `founded` evenly over regions and racks, later ones in regions of their own."""
    founded = shards if founded is None else min(founded, shards)
    tree: Tree = {}
    for shard in range(founded):
        region, rack = shard % regions, shard // regions % racks
        tree.setdefault(f"region{region}", {}).setdefault(f"region{region}/rack{rack}", {})[shard] = 1.0
    for shard in range(founded, shards):
        tree[f"grown{shard}"] = {f"grown{shard}/rack0": {shard: 1.0}}
    return tree


def added(tree: Tree, shard: int, weight: float = 1.0, region: str | None = None, rack: str | None = None) -> Tree:
    """A copy of the tree with one more shard: in a region of its own, or in the named region and rack."""
    region = region or f"grown{shard}"
    rack = rack or f"{region}/rack0"
    racks = {name: dict(own) for name, own in tree.get(region, {}).items()}
    racks.setdefault(rack, {})[shard] = weight
    return tree | {region: racks}


def children(tree: Tree) -> list[list[tuple[str, float, int]]]:
    """For each inner node, the root first, its children: name, weight, and the inner node or the shard that it is."""
    weigh = lambda racks: sum(sum(shards.values()) for shards in racks.values())
    nodes: list[list] = [[]]
    for region, racks in tree.items():
        nodes[0].append((region, weigh(racks), len(nodes)))
        own: list = []
        nodes.append(own)
        for rack, shards in racks.items():
            own.append((rack, sum(shards.values()), len(nodes)))
            nodes.append([(f"shard{shard}", weight, shard) for shard, weight in shards.items()])
    return nodes


def draw(doc_id: Column, name: Column, weight: Column) -> Column:
    digest = F.md5(F.concat_ws("@", F.coalesce(doc_id.cast("string"), F.lit("")), name))
    u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 1) / float(16**DIGITS)
    return F.ln(u) / weight


def shard_of(doc_id: Column, tree: Tree) -> Column:
    """The shard of a row: three levels of draws, children of weight 0 left out."""
    able = [[c for c in node if c[1] > 0] for node in children(tree)]
    if not able[0]:
        raise ValueError("the tree has no shard of positive weight")
    child = lambda c: F.struct(F.lit(c[0]).alias("name"), F.lit(float(c[1])).alias("weight"), F.lit(c[2]).alias("at"))
    none = child(("", 1.0, -1))
    nodes = F.array(*[F.array(*map(child, node)) if node else F.array(none) for node in able])
    at = F.lit(0)
    for _ in range(3):
        drawn = F.transform(F.element_at(nodes, at + 1), lambda c: F.struct(draw(doc_id, c["name"], c["weight"]).alias("draw"), c["name"].alias("name"), c["at"].alias("at")))
        at = F.array_max(drawn)["at"]
    return at


def assign(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard (null without a grown tree)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(doc_id, tree).alias("shard"),
        (shard_of(doc_id, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    out = placed(rows, "shard", "doc_id", "text_crc32", "size")
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("at").alias("slot"), "grown_shard")


def movement(assigned: DataFrame) -> DataFrame:
    """What the grown tree moves: shard, grown_shard, n_rows and n_bytes of the rows that change their shard."""
    return assigned.where("shard <> grown_shard").groupBy("shard", "grown_shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))


def query(spark, sf_dir):
    return assign(table(spark, sf_dir, "documents"), tree_of(SHARDS), tree_of(SHARDS + 1, SHARDS))


#: CRC32 in DuckDB: the table of single bytes, and the checksum of a text.
CRC_TABLE = "crc AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b)))"
CRC_OF = "xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode({})), '..'), lambda x: ('0x' || x)::BIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])))"


def oracle_sql() -> str:
    ctes = []
    for name, tree in (("now", tree_of(SHARDS)), ("then", tree_of(SHARDS + 1, SHARDS))):
        rows = ", ".join(f"({i}, '{c[0]}', {float(c[1])}, {c[2]})" for i, node in enumerate(children(tree)) for c in node)
        ctes.append(f"{name}_tree(node, name, weight, goal) AS (VALUES {rows})")
        older = "SELECT DISTINCT doc_id, 0 AS goal FROM documents"
        for level in range(3):
            drawn = f"ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '@' || name), 1, {DIGITS}))::BIGINT + 1) / {16**DIGITS}.0::DOUBLE) / weight"
            ctes.append(f"{name}_{level} AS (SELECT p.doc_id, arg_max(c.goal, {{'d': {drawn}, 'n': name}}) AS goal FROM ({older}) p JOIN {name}_tree c ON c.node = p.goal GROUP BY p.doc_id)")
            older = f"SELECT doc_id, goal FROM {name}_{level}"
    return f"""
WITH {CRC_TABLE}, {", ".join(ctes)},
  d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + {ROW_BYTES} AS size, {CRC_OF.format("coalesce(text, '')")}::BIGINT AS text_crc32 FROM documents, crc)
SELECT d.doc_id, size, text_crc32, '{LAW}' AS law, a.goal AS shard, row_number() OVER (PARTITION BY a.goal ORDER BY d.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, b.goal AS grown_shard
FROM d JOIN now_2 a ON a.doc_id IS NOT DISTINCT FROM d.doc_id JOIN then_2 b ON b.doc_id IS NOT DISTINCT FROM d.doc_id"""
