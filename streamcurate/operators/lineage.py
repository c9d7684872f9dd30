"""Lineage, governance and registry (G1 to G21) over plain tables.

artifacts: artifact_type, artifact_id, session_id, content_sha256, ...; edges: parent_type,
parent_id, child_type, child_id, relationship; events: event_id, artifact_type, artifact_id,
new_state, ...; versions: dataset_name, version, package_id, ....  A node's name is type/id.
Traversals are joins of a frontier with the edges, for many roots at once, until nothing new is reached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import fresh_path, materialize
from ..sources.files import hashed_files
from .graph import inherited, levels, strongly_connected

#: Artifact types in stage order.
STAGES = ("ingestion", "validation", "integrity", "normalization", "synchronization", "cleaning", "transformation", "qc", "package")
#: Relationship of each parent and child type.
RELATIONSHIPS = {
    ("ingestion", "validation"): "validated_from",
    ("validation", "integrity"): "checked_from",
    ("integrity", "normalization"): "normalized_from",
    ("normalization", "synchronization"): "synchronized_from",
    ("synchronization", "cleaning"): "cleaned_from",
    ("cleaning", "transformation"): "transformed_from",
    ("transformation", "qc"): "qc_of",
    ("transformation", "package"): "packaged_from",
    ("qc", "package"): "approved_by_qc",
}


def rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STAGES)), kind).cast("int")


def node(kind: str, ident: str) -> Column:
    return F.concat_ws("/", kind, ident)


# Where the manifest of each type holds its content hash, its time and its address.
CONTENT = {"ingestion": "sha256", "normalization": "normalized_sha256", "synchronization": "synchronized_sha256", "cleaning": "cleaned_sha256", "transformation": "transformed_sha256"}
CREATED = {"ingestion": "ingested_at", "validation": "validated_at"}
ADDRESS = {"ingestion": "storage_uri", "normalization": "artifact_uri", "synchronization": "artifact_uri", "cleaning": "artifact_uri", "transformation": "artifact_uri", "qc": "report_uri"}
WITH_STATUS = ("validation", "integrity", "cleaning", "qc", "package")
#: Unfinished files lie under such a name.
STAGING = r"(^|/)(\.tmp-[^/]*|\.staging|\.gitkeep)(/|$)"


def scan_artifacts(manifests: dict[str, DataFrame]) -> DataFrame:
    """G1: manifests of each type (columns path and value, the JSON text) to uniform rows with their parents."""
    rows = []
    for kind, df in manifests.items():
        get = lambda f: F.get_json_object("value", f"$.{f}")
        value = lambda table: get(table[kind]) if kind in table else F.lit(None).cast("string")
        listed = F.from_json(get("upstream.session_ids"), "array<string>")
        session = {"ingestion": get("session_id"), "synchronization": get("streams[0].session_id"), "cleaning": get("streams[0].session_id")}
        session |= dict.fromkeys(("transformation", "qc", "package"), F.when(F.size(listed) == 1, listed[0]))
        streams = F.from_json(get("streams"), "array<struct<normalization_id:string>>")
        parents = F.transform(streams, lambda s: F.struct(F.lit("normalization").alias("type"), s["normalization_id"].alias("id"))) if kind == "synchronization" else F.array(*(F.struct(F.lit(p).alias("type"), get(f"{p}_id").alias("id")) for p, c in RELATIONSHIPS if c == kind))
        rows.append(
            df.where(~F.col("path").rlike(STAGING)).select(
                F.lit(kind).alias("artifact_type"),
                get(f"{kind}_id").alias("artifact_id"),
                session.get(kind, F.lit(None).cast("string")).alias("session_id"),
                (get("status") if kind in WITH_STATUS else F.lit(None).cast("string")).alias("status"),
                value(ADDRESS).alias("storage_uri"),
                value(CONTENT).alias("content_sha256"),
                F.col("path").alias("manifest_uri"),
                F.sha2("value", 256).alias("manifest_sha256"),
                get(CREATED.get(kind, "created_at")).alias("created_at"),
                F.coalesce(parents.cast("array<struct<type:string,id:string>>"), F.expr("cast(array() as array<struct<type:string,id:string>>)")).alias("parents"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), rows).withColumn("pipeline_stage", rank(F.col("artifact_type")))


def derive_edges(artifacts: DataFrame) -> DataFrame:
    """One edge for each parent a manifest names."""
    each = artifacts.select("artifact_type", "artifact_id", F.explode("parents").alias("p"))
    name = F.lit(None).cast("string")
    for (a, b), value in RELATIONSHIPS.items():
        name = F.when((F.col("p.type") == a) & (F.col("artifact_type") == b), value).otherwise(name)
    return each.select(F.col("p.type").alias("parent_type"), F.col("p.id").alias("parent_id"), F.col("artifact_type").alias("child_type"), F.col("artifact_id").alias("child_id"), name.alias("relationship"))


def missing_parents(edges: DataFrame, artifacts: DataFrame, strict: bool = False) -> DataFrame:
    """Edges whose parent isn't known; if `strict`, any such edge is an error."""
    known = artifacts.select(F.col("artifact_type").alias("parent_type"), F.col("artifact_id").alias("parent_id"))
    found = edges.join(known, ["parent_type", "parent_id"], "left_anti")
    if strict and (some := found.take(1)):
        raise ValueError(f"unknown parent {some[0].parent_type}/{some[0].parent_id}")
    return found


def arrows(edges: DataFrame, direction: str) -> DataFrame:
    up = edges.select(node("child_type", "child_id").alias("from"), node("parent_type", "parent_id").alias("to"))
    down = up.select(F.col("to").alias("from"), F.col("from").alias("to"))
    return (up if direction == "up" else down).distinct()


def walk(roots: DataFrame, steps: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(root, node, depth) along arrows until nothing new is reached, or for max_depth steps if given.

    Each node is expanded once per root, so it's met as often as arrows lead to it from nodes found.  A
    node met by all its arrows can't come again; only those with arrows still to come (`left`) are held
    against what a level meets.  A level thus reads and writes its frontier and these, not all found so far.
    """
    base = fresh_path(roots.sparkSession, "walk")
    into = steps.groupBy(F.col("to").alias("_to")).agg(F.count("*").alias("arrows"))
    steps = materialize(steps.join(into, F.col("to") == F.col("_to")).select("from", "to", "arrows"), "arrows")
    first = roots.select("root", F.col("root").alias("node")).distinct()
    arrows_in = steps.select(F.col("to").alias("node"), "arrows").distinct()
    level = first.join(arrows_in, "node", "left").select("root", "node", F.coalesce("arrows", F.lit(0)).alias("left"), F.lit(True).alias("fresh"))
    schema, depth = level.schema, 0
    while True:
        path = f"{base}/depth={depth}"
        level.write.parquet(path)
        level = roots.sparkSession.read.schema(schema).parquet(path)
        if depth == max_depth or not level.where("fresh").take(1):
            break
        depth += 1
        met = level.where("fresh").join(steps, F.col("node") == F.col("from")).groupBy("root", F.col("to").alias("node")).agg(F.count("*").alias("met"), F.first("arrows").alias("arrows"))
        known = level.where("left > 0").select("root", "node", F.col("left").alias("due"))
        left = F.coalesce("due", "arrows") - F.coalesce("met", F.lit(0))
        level = met.join(known, ["root", "node"], "full").select("root", "node", left.alias("left"), F.col("due").isNull().alias("fresh")).where("fresh OR left > 0")
    return roots.sparkSession.read.schema(schema.add("depth", "integer")).parquet(base).where("fresh").select("root", "node", "depth")


def traverse(roots: DataFrame, edges: DataFrame, direction: str = "down", max_depth: int | None = None) -> DataFrame:
    """(root, node, depth) of all nodes reached from each root (column `root`), the root included at depth 0.

    "both" walks up and down apart: what lies above, and what lies below, but not what lies below an
    ancestor.
    """
    if direction not in ("up", "down", "both"):
        raise ValueError(f"unknown direction {direction!r}")
    if direction != "both":
        return walk(roots, arrows(edges, direction), max_depth)
    apart = [walk(roots, arrows(edges, d), max_depth) for d in ("up", "down")]
    return apart[0].unionByName(apart[1]).groupBy("root", "node").agg(F.min("depth").alias("depth"))


def traversed_edges(roots: DataFrame, edges: DataFrame, direction: str = "both", max_depth: int | None = None) -> DataFrame:
    """(root and the columns of the edge) of every edge that the walk from a root takes."""
    parts = []
    for d, near in (("up", node("child_type", "child_id")), ("down", node("parent_type", "parent_id"))):
        if direction in (d, "both"):
            reached = walk(roots, arrows(edges, d), max_depth)
            if max_depth is not None:
                reached = reached.where(F.col("depth") < max_depth)
            parts.append(edges.withColumn("node", near).join(reached.select("root", "node"), "node").select("root", *edges.columns))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def in_stage_order(reached: DataFrame) -> DataFrame:
    """Nodes of each root by stage, type and id; types without a stage come last."""
    kind = F.substring_index("node", "/", 1)
    stage = F.when(rank(kind) > 0, rank(kind)).otherwise(99)
    return reached.withColumn("pipeline_stage", stage).orderBy("root", "pipeline_stage", kind, F.substring(F.col("node"), F.length(kind) + 2, F.length("node")))


def not_rising(edges: DataFrame) -> DataFrame:
    """Edges that don't go up in rank; a cycle has one at least."""
    parent, child = rank(F.col("parent_type")), rank(F.col("child_type"))
    return edges.where((parent >= child) | parent.isNull() | child.isNull())


def cycle_components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that reach themselves; nodes of one component reach each other."""
    return strongly_connected(arrows(edges, "down"))


def detect_cycles(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Nodes that reach themselves, however long the way; by at most max_depth + 1 edges if that is given."""
    if not not_rising(edges).take(1):
        return edges.select(node("parent_type", "parent_id").alias("node")).where("false")
    on_cycles = cycle_components(edges)
    if max_depth is None:
        return on_cycles.select("node")
    # only ways inside a component return
    part = materialize(on_cycles, "components")
    steps = arrows(edges, "down").join(part.toDF("from", "_a"), "from").join(part.toDF("to", "_b"), "to").where("_a = _b").select("from", "to")
    starts = steps.select(F.col("to").alias("root"), F.col("from").alias("goal"))
    return starts.join(walk(starts, steps, max_depth), "root").where("goal = node").select("node").distinct()


def impact(roots: DataFrame, edges: DataFrame, versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(root, artifact_type, n) of what lies downstream, and (root, dataset_name, version) of packages there."""
    below = materialize(traverse(roots, edges, "down").where("depth > 0"), "impact")
    kinds = below.groupBy("root", F.substring_index("node", "/", 1).alias("artifact_type")).agg(F.count("*").alias("n"))
    named = below.join(versions.select(F.concat(F.lit("package/"), "package_id").alias("node"), "dataset_name", "version"), "node")
    return kinds, named.select("root", "dataset_name", "version").distinct()


def enriched_impact(roots: DataFrame, edges: DataFrame, versions: DataFrame, events: DataFrame, version_events: DataFrame) -> DataFrame:
    """One row per root: own state, downstream per state, packages, versions affected."""
    below = materialize(traverse(roots, edges, "down"), "impact")
    state = governance_state(events).select(node("artifact_type", "artifact_id").alias("node"), "state")
    marked = below.join(state, "node", "left").withColumn("state", F.coalesce("state", F.lit("active")))
    down = F.col("depth") > 0
    count = lambda c: F.sum((down & c).cast("long"))
    out = marked.groupBy("root").agg(
        F.max(F.when(~down, F.col("state"))).alias("own_state"),
        *(count(F.col("state") == s).alias(f"{s}_descendants") for s in ("active", "deprecated", "invalid")),
        F.sort_array(F.collect_set(F.when(down & F.col("node").startswith("package/"), F.substring_index("node", "/", -1)))).alias("packages"),
    )
    status = effective_version_status(versions, edges, events, version_events)
    affected = below.where("depth > 0").join(status.withColumn("node", F.concat(F.lit("package/"), "package_id")), "node")
    per = affected.groupBy("root").agg(F.count("*").alias("versions"), F.sum((F.col("effective_status") != "healthy").cast("long")).alias("unhealthy_versions"))
    return out.join(per, "root", "left").na.fill(0, ["versions", "unhealthy_versions"])


def governance_state(events: DataFrame) -> DataFrame:
    """The state of the latest event; events without a reason don't count."""
    good = events.where(F.trim("reason") != "")
    return good.groupBy("artifact_type", "artifact_id").agg(F.max_by("new_state", "event_id").alias("state"))


def states(events: DataFrame) -> DataFrame:
    return governance_state(events).select(node("artifact_type", "artifact_id").alias("node"), "state")


def governance_chain(roots: DataFrame, edges: DataFrame, events: DataFrame) -> DataFrame:
    """(root, node, depth, state) of the root and of each ancestor that is invalid or deprecated.

    Walks down from the few nodes in such a state, not up from every root.
    """
    state = materialize(states(events), "states")
    own = roots.select("root").distinct()
    first = own.join(state.toDF("root", "state"), "root", "left").select("root", F.col("root").alias("node"), F.lit(0).alias("depth"), F.coalesce("state", F.lit("active")).alias("state"))
    bad = state.where("state <> 'active'")
    below = walk(bad.select(F.col("node").alias("root")), arrows(edges, "down")).where("depth > 0").select(F.col("root").alias("bad"), F.col("node").alias("root"), "depth")
    above = below.join(own, "root", "left_semi").join(bad.toDF("bad", "state"), "bad").select("root", F.col("bad").alias("node"), "depth", "state")
    return first.unionByName(above)


#: Bits of the states that pass on to what lies below.
BITS = {"invalid": 1, "deprecated": 2}


def upstream_states(roots: DataFrame, edges: DataFrame, events: DataFrame) -> DataFrame:
    """(root, state, above): each root's own state, and the bits of the states above it, by propagation along the edges."""
    state = materialize(states(events), "states")
    bits = reduce(lambda c, s: c.when(F.col("state") == s, BITS[s]), list(BITS)[1:], F.when(F.col("state") == "invalid", BITS["invalid"])).otherwise(0)
    above = inherited(arrows(edges, "down"), state.select("node", bits.alias("bits")))
    own = roots.select("root").distinct().join(state.toDF("root", "state"), "root", "left")
    return own.join(above.toDF("root", "above"), "root", "left").select("root", F.coalesce("state", F.lit("active")).alias("state"), F.coalesce("above", F.lit(0)).alias("above"))


def upstream_gate(roots: DataFrame, edges: DataFrame, events: DataFrame, allow_deprecated: bool = False) -> DataFrame:
    """(root, open, reason); invalid blocks always, deprecated unless allowed."""
    has = lambda s: F.col("above").bitwiseAND(F.lit(BITS[s])) > 0
    deprecated = F.lit(not allow_deprecated)
    reason = F.when(F.col("state") == "invalid", "INVALID").when(has("invalid"), "INVALID_ANCESTOR").when((F.col("state") == "deprecated") & deprecated, "DEPRECATED").when(has("deprecated") & deprecated, "DEPRECATED_ANCESTOR")
    return upstream_states(roots, edges, events).select("root", reason.isNull().alias("open"), reason.alias("reason"))


def effective_version_status(versions: DataFrame, edges: DataFrame, events: DataFrame, version_events: DataFrame) -> DataFrame:
    """An explicit state wins; else `affected` below something invalid, else `healthy`."""
    explicit = version_events.groupBy("dataset_name", "version").agg(F.max_by("new_state", "event_id").alias("explicit"))
    named = versions.withColumn("root", F.concat(F.lit("package/"), "package_id"))
    invalid = (F.col("state") == "invalid") | (F.col("above").bitwiseAND(F.lit(BITS["invalid"])) > 0)
    bad = upstream_states(named, edges, events).where(invalid).select("root", F.lit(True).alias("bad"))
    out = versions.join(explicit, ["dataset_name", "version"], "left").withColumn("root", F.concat(F.lit("package/"), "package_id")).join(bad, "root", "left")
    status = F.coalesce("explicit", F.when(F.col("bad"), F.lit("affected")), F.lit("healthy"))
    return out.select("dataset_name", "version", "package_id", status.alias("effective_status"))


def register_versions(requests: DataFrame, existing: DataFrame, packages: DataFrame) -> DataFrame:
    """Outcome of each request (dataset_name, version, package_id).

    packages: package_id, accepted (completed, QC accepted and gate open).  The first request of a
    new (dataset, version) by package_id wins inside a batch.
    """
    w = Window.partitionBy("dataset_name", "version").orderBy("package_id")
    old = existing.select("dataset_name", "version", F.col("package_id").alias("old_package"))
    df = requests.join(old, ["dataset_name", "version"], "left").join(packages, "package_id", "left")
    valid = F.col("version").rlike(r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)$") & F.coalesce("accepted", F.lit(False))
    df = df.withColumn("_valid", valid).withColumn("_first", F.first(F.when(F.col("_valid"), F.col("package_id")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    outcome = (
        F.when(F.col("old_package") == F.col("package_id"), "unchanged")
        .when(F.col("old_package").isNotNull(), "conflict")
        .when(~F.col("_valid"), "rejected")
        .when(F.col("_first") == F.col("package_id"), "created")
        .otherwise("conflict")
    )
    return df.select("dataset_name", "version", "package_id", outcome.alias("outcome"))


def semver_latest(versions: DataFrame) -> DataFrame:
    """The highest MAJOR.MINOR.PATCH of each dataset."""
    good = versions.where(F.col("version").rlike(r"^\d+\.\d+\.\d+$"))
    key = F.transform(F.split("version", r"\."), lambda x: x.cast("long"))
    return good.groupBy("dataset_name").agg(F.max_by("version", F.struct(key[0].alias("a"), key[1].alias("b"), key[2].alias("c"))).alias("latest"))


def lineage_fingerprint(roots: DataFrame, edges: DataFrame, artifacts: DataFrame, columns: tuple[str, ...] = ("content_sha256",)) -> DataFrame:
    """A hash of the sorted contents and configurations upstream, without ids, times or paths.

    columns: what counts of an artifact, such as its schema version, configuration hash and split checksums.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    content = artifacts.select(node("artifact_type", "artifact_id").alias("node"), F.concat_ws(":", "artifact_type", *values).alias("part"))
    steps = arrows(edges, "up")
    # all that lies above a root with one arrow up lies at that arrow's end (`via`), which is walked once for all such roots
    first = steps.groupBy(F.col("from").alias("root")).agg(F.count("*").alias("_n"), F.min("to").alias("_to"))
    starts = materialize(roots.select("root").distinct().join(first, "root", "left").select("root", F.when(F.col("_n") == 1, F.col("_to")).otherwise(F.col("root")).alias("via")), "starts")
    tops = starts.select(F.col("via").alias("root")).distinct()
    met = tops.select(F.col("root").alias("from")).union(steps.select("to")).distinct()
    above = walk(tops, steps.join(met, "from", "left_semi").select("from", "to")).join(content, "node")
    sets = above.groupBy(F.col("root").alias("via")).agg(F.collect_set("part").alias("_above"))
    own = content.groupBy(F.col("node").alias("root")).agg(F.collect_set("part").alias("_own"))
    none = F.array().cast("array<string>")
    parts = starts.join(own, "root", "left").join(sets, "via", "left").select("root", F.array_union(F.coalesce("_own", none), F.coalesce("_above", none)).alias("parts"))
    return parts.where(F.size("parts") > 0).select("root", F.sha2(F.concat_ws("\n", F.array_sort("parts")), 256).alias("fingerprint"))


def verify_checksums(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, result); recorded: path, sha256, manifest_sha256, recorded_manifest_sha256; actual: path, found_sha256."""
    df = recorded.join(actual, "path", "left")
    result = F.when(F.col("found_sha256").isNull(), "missing").when(F.col("found_sha256") != F.col("sha256"), "checksum_mismatch").when(F.col("manifest_sha256") != F.col("recorded_manifest_sha256"), "manifest_mismatch").otherwise("verified")
    return df.select("path", result.alias("result"))


def verify_ancestors(roots: DataFrame, edges: DataFrame, results: DataFrame) -> DataFrame:
    """Per root the artifacts above it and itself, how many have each result (node, result), and whether all are verified."""
    above = traverse(roots, edges, "up").join(results, "node", "left").withColumn("result", F.coalesce("result", F.lit("missing")))
    count = lambda r: F.sum((F.col("result") == r).cast("long")).alias(r)
    out = above.groupBy("root").agg(F.count("*").alias("artifacts"), *map(count, ("verified", "missing", "checksum_mismatch", "manifest_mismatch")))
    return out.withColumn("passed", F.col("verified") == F.col("artifacts"))


def file_hashes(spark, path: str) -> DataFrame:
    return hashed_files(spark, path).select("path", F.col("sha256").alias("found_sha256"))


def catalog_health(artifacts: DataFrame, edges: DataFrame, events: DataFrame, versions: DataFrame) -> DataFrame:
    """(problem, name) of orphans, dangling references and missing parents."""
    named = lambda df, name, bit: df.select(name.alias("name"), F.lit(bit).alias("bits"))
    own = node("artifact_type", "artifact_id")
    # what a name is, as bits: known, known and no ingestion, a child, of a version, governed, a parent
    kinds = [
        artifacts.select(own.alias("name"), F.when(F.col("artifact_type") != "ingestion", 3).otherwise(1).alias("bits")),
        named(edges, node("child_type", "child_id"), 4),
        named(versions, F.concat(F.lit("package/"), "package_id"), 8),
        named(events, own, 16),
        named(edges, node("parent_type", "parent_id"), 32),
    ]
    names = reduce(lambda a, b: a.unionByName(b), kinds).groupBy("name").agg(F.bit_or("bits").alias("bits"))
    has = lambda bits: F.col("bits").bitwiseAND(F.lit(bits)) == bits
    problems = {"orphan": has(2) & ~has(4), "dangling_version": ~has(1) & has(8), "dangling_governance": ~has(1) & has(16), "missing_parent": ~has(1) & has(32)}
    found = F.filter(F.array(*(F.when(c, p) for p, c in problems.items())), lambda x: x.isNotNull())
    return names.select(F.explode(found).alias("problem"), "name")


def affected_closure(replaced: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(root, node, level, parent, parent_replaced): what has to be rebuilt, in topological order.

    level is the longest path from the replaced artifact; parents inside the closure are replaced.  Each node is
    expanded once, after all its parents.  A cycle below a replaced artifact leaves nodes without a level,
    which is an error; with max_depth, ways of so many edges at most count, and cycles don't matter.
    """
    steps = arrows(edges, "down")
    if max_depth is None:
        below = materialize(walk(replaced, steps).select("root", "node"), "closure")
        closure = levels(below.join(steps, F.col("node") == F.col("from")).select("root", "from", "to"), below)
        closure = materialize(closure, "closure")
        if some := below.join(closure, ["root", "node"], "left_anti").take(1):
            raise ValueError(f"a cycle lies below a replaced artifact, at or above {some[0].node}")
    else:
        frontier = replaced.select("root", F.col("root").alias("node")).distinct()
        found = frontier.withColumn("level", F.lit(0))
        for depth in range(1, max_depth + 1):
            frontier = materialize(frontier.join(steps, F.col("node") == F.col("from")).select("root", F.col("to").alias("node")).distinct(), "frontier")
            if not frontier.take(1):
                break
            found = found.unionByName(frontier.withColumn("level", F.lit(depth)))
        closure = found.groupBy("root", "node").agg(F.max("level").alias("level"))
    parents = closure.join(steps.select(F.col("to").alias("node"), F.col("from").alias("parent")), "node")
    inside = closure.select("root", F.col("node").alias("parent"), F.lit(True).alias("_in"))
    return parents.join(inside, ["root", "parent"], "left").where("level > 0").select("root", "node", "level", "parent", F.coalesce("_in", F.lit(False)).alias("parent_replaced"))


def replacement_conflicts(pairs: DataFrame, artifacts: DataFrame, columns: tuple[str, ...] = ("artifact_type", "session_id")) -> DataFrame:
    """(old, new, field) where a replacement (nodes old and new) doesn't agree in one of the columns; an unknown node disagrees in `node`.

    columns: what old and new must share, such as type, session, schema and ingestion.
    """
    known = artifacts.select(node("artifact_type", "artifact_id").alias("node"), F.struct(*columns).alias("own"))
    old, new = known.toDF("old", "old_own"), known.toDF("new", "new_own")
    both = pairs.select("old", "new").join(old, "old", "left").join(new, "new", "left")
    fields = [F.when(~F.col(f"old_own.{c}").eqNullSafe(F.col(f"new_own.{c}")), c) for c in columns]
    unknown = F.col("old_own").isNull() | F.col("new_own").isNull()
    found = F.when(unknown, F.array(F.lit("node"))).otherwise(F.filter(F.array(*fields), lambda x: x.isNotNull()))
    return both.select("old", "new", F.explode(found).alias("field"))


def artifact_detail(artifacts: DataFrame, edges: DataFrame, kind: str | None = None, session: str | None = None) -> DataFrame:
    """Artifacts with sorted names of parents and children, filtered."""
    up = edges.groupBy(node("child_type", "child_id").alias("name")).agg(F.sort_array(F.collect_list(node("parent_type", "parent_id"))).alias("parents"))
    down = edges.groupBy(node("parent_type", "parent_id").alias("name")).agg(F.sort_array(F.collect_list(node("child_type", "child_id"))).alias("children"))
    own = artifacts.withColumn("name", node("artifact_type", "artifact_id"))
    if kind is not None:
        own = own.where(F.col("artifact_type") == kind)
    if session is not None:
        own = own.where(F.col("session_id") == session)
    none = F.array().cast("array<string>")
    return own.join(up.withColumnRenamed("parents", "_up"), "name", "left").join(down.withColumnRenamed("children", "_down"), "name", "left").withColumns({"parents": F.coalesce("_up", none), "children": F.coalesce("_down", none)}).drop("_up", "_down")


def rescan_conflicts(known: DataFrame, scanned: DataFrame, columns: list[str]) -> DataFrame:
    """(artifact_type, artifact_id, outcome) of a new scan: new, unchanged or conflict."""
    keys = ["artifact_type", "artifact_id"]
    old = known.select(*keys, F.struct(*columns).alias("_old"))
    df = scanned.select(*keys, F.struct(*columns).alias("_new")).join(old, keys, "left")
    return df.select(*keys, F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("conflict").alias("outcome"))


def execution_key(stage: Column, upstream_id: Column, upstream_sha: Column, config_hash: Column, version: Column) -> Column:
    """G20."""
    return F.sha2(F.concat_ws(":", stage, upstream_id, upstream_sha, config_hash, version), 256)


def pending(inputs: DataFrame, finished: DataFrame) -> DataFrame:
    """Inputs (column execution_key) that aren't done."""
    return inputs.join(finished.select("execution_key"), "execution_key", "left_anti")


def package_results(packages: DataFrame, index: DataFrame, reports: DataFrame, versions: DataFrame) -> DataFrame:
    """Per package the samples of each split, QC status and registrations."""
    per = index.groupBy("package_id").agg(*(F.sum((F.col("split") == s).cast("long")).alias(f"{s}_samples") for s in ("train", "validation", "test")))
    names = versions.groupBy("package_id").agg(F.sort_array(F.collect_list(F.concat_ws("@", "dataset_name", "version"))).alias("registrations"))
    out = packages.join(per, "package_id", "left").join(reports.select("package_id", F.col("status").alias("qc_status"), "error_count", "warning_count"), "package_id", "left").join(names, "package_id", "left")
    return out.withColumn("registrations", F.coalesce("registrations", F.array().cast("array<string>"))).na.fill(0, [f"{s}_samples" for s in ("train", "validation", "test")])
