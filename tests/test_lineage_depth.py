"""Lineage deeper than the nine stages: cycles, traversals and closures have no bound on depth."""

import random

import pytest

from streamcurate.operators import lineage as ln

NAMES = "parent_type string, parent_id string, child_type string, child_id string"


def edges(spark, pairs):
    return spark.createDataFrame([("x", str(a), "x", str(b)) for a, b in pairs], NAMES)


def test_long_ring(spark):
    # a ring of 12 with ways in and out, one to a ring of 2, a chain of 11, a self-loop
    ring = [(i, (i + 1) % 12) for i in range(12)]
    others = [(100, 0), (5, 101), (101, 200), (200, 201), (201, 200), *((300 + i, 301 + i) for i in range(11)), (400, 400)]
    got = {r.node for r in ln.detect_cycles(edges(spark, ring + others)).collect()}
    assert got == {f"x/{i}" for i in [*range(12), 200, 201, 400]}


def test_ring_over_ranks(spark):
    kinds = ["validation", "integrity", "qc"]
    rows = [(kinds[i], "1", kinds[(i + 1) % 3], "1") for i in range(3)]
    assert {r.node for r in ln.detect_cycles(spark.createDataFrame(rows, NAMES)).collect()} == {f"{k}/1" for k in kinds}


def test_long_chain(spark):
    chain = edges(spark, [(i, i + 1) for i in range(18)])
    roots = spark.createDataFrame([("x/0",)], "root string")
    assert {(r.node, r.depth) for r in ln.traverse(roots, chain).collect()} == {(f"x/{i}", i) for i in range(19)}
    assert {(r.node, r.level) for r in ln.affected_closure(roots, chain).collect()} == {(f"x/{i}", i) for i in range(1, 19)}
    with pytest.raises(ValueError, match="cycle"):
        ln.affected_closure(roots, edges(spark, [(0, 1), (1, 2), (2, 1)]))


def reached(pairs, root, most=None):
    """Depths by breadth-first search."""
    depth, todo = {root: 0}, [root]
    while todo:
        a = todo.pop(0)
        for b in (y for x, y in pairs if x == a and (most is None or depth[a] < most)):
            if b not in depth:
                depth[b] = depth[a] + 1
                todo.append(b)
    return {(f"x/{root}", f"x/{b}", d) for b, d in depth.items()}


@pytest.mark.parametrize("most", [None, 0, 1, 4])
def test_walks(spark, most):
    # cycles, loops, diamonds of unequal sides, repeated edges, arrows from nodes no root reaches
    rng = random.Random(3)
    pairs = [(rng.randrange(30), rng.randrange(30)) for _ in range(40)]
    pairs += [(50, 51), (51, 52), (52, 50), (50, 53), (53, 54), (54, 55), (50, 55), (55, 55), (99, 55), (50, 51)]
    starts = [0, 1, 2, 3, 50, 52, 99, 1000]
    roots = spark.createDataFrame([(f"x/{i}",) for i in [*starts, 0]], "root string")
    for direction, way in (("down", pairs), ("up", [(b, a) for a, b in pairs])):
        got = [tuple(r) for r in ln.traverse(roots, edges(spark, pairs), direction, most).select("root", "node", "depth").collect()]
        assert sorted(got) == sorted(set().union(*(reached(way, i, most) for i in starts)))
    assert ln.traverse(roots.where("false"), edges(spark, pairs)).count() == 0


def test_a_level_holds_its_frontier(spark, monkeypatch, tmp_path):
    # a long chain of diamonds: each level has one or two nodes, and none that is done
    chain = [e for i in range(0, 30, 3) for e in ((i, i + 1), (i, i + 2), (i + 1, i + 3), (i + 2, i + 3))]
    monkeypatch.setattr(ln, "fresh_path", lambda spark, label: str(tmp_path / label))
    roots = spark.createDataFrame([("x/0",)], "root string")
    assert {tuple(r) for r in ln.traverse(roots, edges(spark, chain)).collect()} == reached(chain, 0)
    rows = [spark.read.parquet(str(p)).count() for p in (tmp_path / "walk").glob("depth=*")]
    assert len(rows) > 20 and max(rows) <= 2


def components(pairs):
    """Nodes on cycles and the smallest node of their component, by closures."""
    after = {}
    for a, b in pairs:
        after.setdefault(a, set()).add(b)
    reach = {}
    for a in {x for p in pairs for x in p}:
        seen, todo = set(), [a]
        while todo:
            for b in after.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        reach[a] = seen
    return {a: min(f"x/{b}" for b in reach[a] if a in reach[b]) for a in reach if a in reach[a]}


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(45)]
    # two rings that share a node, a way between rings, tails in and out, loops, a repeated edge
    pairs += [(100, 101), (101, 102), (102, 100), (102, 103), (103, 104), (104, 102), (104, 110), (110, 111), (111, 112), (112, 113), (113, 112), (90, 91), (91, 100), (113, 95), (95, 96), (97, 97), (97, 98), (100, 101)]
    got = {r.node: r.component for r in ln.cycle_components(edges(spark, pairs)).collect()}
    assert got == {f"x/{a}": low for a, low in components(pairs).items()}


def test_ring_of_ten_thousand(spark):
    n = 10_000
    ring = spark.range(n).selectExpr("'x' AS parent_type", "cast(id AS string) AS parent_id", "'x' AS child_type", f"cast((id + 1) % {n} AS string) AS child_id")
    found = ln.cycle_components(ring.union(edges(spark, [(77, "out"), ("out", "end"), ("in", 5), (9, 4000)])))
    assert found.groupBy("component").count().collect() == [("x/0", n)]


def test_states_pass_on(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (4, 2), (5, 4), (6, 7), (3, 8)]
    events = spark.createDataFrame([(1, "x", "1", "deprecated", "r"), (2, "x", "5", "invalid", "r"), (3, "x", "6", "invalid", "r"), (4, "x", "6", "active", "r"), (5, "x", "8", "deprecated", "r")], "event_id long, artifact_type string, artifact_id string, new_state string, reason string")
    roots = spark.createDataFrame([(f"x/{i}",) for i in range(1, 10)], "root string")
    got = {r.root: r.reason for r in ln.upstream_gate(roots, edges(spark, pairs), events).collect()}
    assert got == {"x/1": "DEPRECATED", "x/2": "INVALID_ANCESTOR", "x/3": "INVALID_ANCESTOR", "x/4": "INVALID_ANCESTOR", "x/5": "INVALID", "x/6": None, "x/7": None, "x/8": "INVALID_ANCESTOR", "x/9": None}
    chain = {(r.root, r.node, r.depth) for r in ln.governance_chain(roots, edges(spark, pairs), events).where("depth > 0").collect()}
    assert chain == {("x/2", "x/1", 1), ("x/3", "x/1", 2), ("x/4", "x/1", 3), ("x/8", "x/1", 3), ("x/4", "x/5", 1), ("x/2", "x/5", 2), ("x/3", "x/5", 3), ("x/8", "x/5", 4)}


def test_levels_are_longest_ways(spark):
    pairs = [(0, 1), (1, 2), (2, 3), (0, 3), (3, 4), (0, 4), (9, 3), (4, 5), (1, 5)]
    got = ln.affected_closure(spark.createDataFrame([("x/0",), ("x/1",)], "root string"), edges(spark, pairs)).collect()
    assert {(r.root, r.node, r.level) for r in got} == {("x/0", f"x/{i}", i) for i in range(1, 6)} | {("x/1", f"x/{i}", i - 1) for i in range(2, 6)}
    assert {(r.node, r.parent) for r in got if r.root == "x/0" and not r.parent_replaced} == {("x/3", "x/9")}
