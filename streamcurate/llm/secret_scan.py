"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by regular expressions in every whole text.  Their hashes are then counted over
the corpus by distinct repositories and by distinct owners, in steps that combine before they
shuffle: a value that many owners or many repositories carry is a widely copied example, one that
stays with few of both looks live.  Each live value of an assignment adds a span of kind `live` (the
value alone) to the base spans, which all stay.

`documents` names an owner (`source`) and no repository, so a document is a repository of its owner
unless a column is given.

A candidate's place comes from splitting the text at the matches: the lengths of the pieces and of
the matches before it add up to its start (code points; `split` and `regexp_extract_all` walk the
same leftmost, non-overlapping matches).

Defined cases: a null or empty text has no spans; a null owner or repository counts as one of its
own; rows that repeat an owner and a repository are one repository; an empty table gives an empty
result; other columns of the input are ignored by the scan and kept by `redact`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table, whole_row

#: The patterns of the base kinds, each with the least length of the part checked.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
#: Runs shorter than the least length can't pass, and maximal runs can't overlap.
ACCESS_LONG = r"AKIA[A-Z0-9]{16,}"
HEX_LONG = r"(?<![0-9a-f])[0-9a-f]{24,}"

#: More owners or repositories than this make a value a widely copied example.
COPIED_OWNERS, COPIED_REPOSITORIES = 2, 20
#: Matches whose places are added up in one step; steps are added up in turn.
STRIDE = 128


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, body>>: matches of the pattern, in code points."""
    empty = F.expr("cast(array() as array<struct<start:int,end:int,body:string>>)")

    def shift(acc, x):
        start = acc["at"] + x["g"]
        end = start + F.length(x["b"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"), x["b"].alias("body")))).alias("found"))

    def walk(steps, at):
        return F.aggregate(steps, F.struct(at.alias("at"), empty.alias("found")), shift)["found"]

    def advance(acc, part):
        size = F.aggregate(part, F.lit(0), lambda n, x: n + x["g"] + F.length(x["b"]))
        return F.struct((acc["at"] + size).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

    body = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    # the piece behind the last match has no match
    steps = F.slice(F.transform(F.arrays_zip(gaps.alias("g"), body.alias("b")), lambda x: F.struct(x["g"].alias("g"), x["b"].alias("b"))), F.lit(1), F.size(body))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(body) - 1) / STRIDE).cast("int")), lambda k: F.slice(steps, k * STRIDE + 1, F.lit(STRIDE)))
    starts = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts")), advance)["starts"]
    many = F.flatten(F.zip_with(parts, starts, walk))
    return F.when(text.rlike(pattern), F.when(F.size(body) > STRIDE, many).otherwise(walk(steps, F.lit(0)))).otherwise(empty)


SPANS = "array<struct<kind:string,rank:int,start:int,end:int,value:string,value_start:int>>"


def spans_in(text: Column) -> Column:
    """Base spans of a text, kind by kind: array<struct<kind, rank, start, end, value, value_start>>."""
    text = F.coalesce(text, F.lit(""))

    def named(found: Column, kind: str, rank: int, value) -> Column:
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), m["start"].alias("start"), m["end"].alias("end"), value(m["body"]).alias("value"), (m["end"] - F.length(value(m["body"]))).alias("value_start"))).cast(SPANS)

    assign = F.filter(named(matches(text, ASSIGN), "assign", 0, lambda b: F.regexp_extract(b, ASSIGN, 2)), lambda m: F.length(m["value"]) >= ASSIGN_VALUE_MIN)
    access = named(matches(text, ACCESS_LONG), "access", 1, lambda b: b)
    digits = named(matches(text, HEX_LONG), "hex", 2, lambda b: b)
    return F.concat(assign, access, digits)


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, owner, repository and spans of every document."""
    return docs.select(F.col("doc_id"), F.col(owner).alias("owner"), F.col(repository).alias("repository"), spans_in(F.col("text")).alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories: how many distinct ones carry each value, over the corpus."""
    values = found.select("owner", "repository", F.explode("spans").alias("s")).select(F.sha2("s.value", 256).alias("hash"), "owner", "repository").distinct()
    by_owner = values.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def looks_live(copied_owners: int, copied_repositories: int) -> Column:
    return (F.col("owners") <= copied_owners) & (F.col("repositories") <= copied_repositories)


def judged(found: DataFrame, live: Column) -> DataFrame:
    """row, s, live: the distinct spans of each row, and whether their value looks live."""
    # written first, so that a value with very many rows can be split in the join
    values = materialize(ownership(found).select("hash", live.alias("live")), "values")
    listed = found.select("row", F.explode("spans").alias("s")).select("row", F.sha2("s.value", 256).alias("hash"), "s").distinct()
    return materialize(listed, "spans").join(values, "hash").select("row", "s", "live")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """One row per document: counts and places of secrets, and how widely each value is copied.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.
    """
    found = materialize(candidates(docs, owner, repository).withColumn("row", F.struct("doc_id", F.xxhash64("owner", "spans").alias("hash"))), "secrets")
    shape = "array<struct<start:int,rank:int,kind:string,end:int>>"
    live = judged(found.where(F.size("spans") > 0), looks_live(copied_owners, copied_repositories))
    extra = live.groupBy("row").agg(
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum((~F.col("live")).cast("long")).alias("n_copied"),
        F.collect_list(F.when(F.col("live") & (F.col("s.kind") == "assign"), F.struct(F.col("s.value_start").alias("start"), F.lit(3).alias("rank"), F.lit("live").alias("kind"), F.col("s.end").alias("end")))).alias("added"),
    )
    base = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(shape))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.join(extra.withColumnRenamed("row", "of"), F.col("row").eqNullSafe(F.col("of")), "left").select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat(base, F.coalesce(F.col("added"), F.array()).cast(shape)))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def query(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents"))


def redact(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES, mark: str = "[SECRET]") -> DataFrame:
    """The columns of `docs`, with `mark` in place of each base span whose value looks live.

    Widely copied examples stay.  n_chars, where there is such a column, follows the text.  Texts are
    searched once; only documents with a candidate are joined.
    """
    own = F.col("doc.doc_id"), F.xxhash64(F.col(f"doc.{owner}"), "spans")
    scanned = docs.select(whole_row(docs).alias("doc"), spans_in(F.col("text")).alias("spans"))
    found = materialize(scanned.select("doc", F.col(f"doc.{owner}").alias("owner"), F.col(f"doc.{repository}").alias("repository"), "spans", F.struct(own[0].alias("doc_id"), own[1].alias("hash")).alias("row")), "secrets")
    some = F.size("spans") > 0
    live = judged(found.where(some).select("row", "owner", "repository", "spans"), looks_live(copied_owners, copied_repositories)).where("live")
    # spans that begin inside another, of another kind, share its mark
    order = Window.partitionBy("of").orderBy("start", "end")
    each = live.select(F.col("row").alias("of"), "s.start", "s.end").distinct().withColumn("before", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    each = each.withColumn("place", F.sum(F.when(F.col("before") > F.col("start"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = each.groupBy("of", "place").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    marked = whole.groupBy("of").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone"))
    pieces = F.expr(
        f"""concat(array_join(transform(gone, (g, i) -> concat(substring(doc.text, if(i = 0, 0, gone[i - 1].end) + 1, g.start - if(i = 0, 0, gone[i - 1].end)), '{mark}')), ''),
            substring(doc.text, element_at(gone, -1).end + 1))"""
    )
    dirty = found.where(some).join(marked, F.col("row").eqNullSafe(F.col("of")), "left")
    out = dirty.select(F.col("doc").withField("text", F.when(F.col("gone").isNotNull(), pieces).otherwise(F.col("doc.text"))).alias("doc"))
    if "n_chars" in docs.columns:
        out = out.select(F.col("doc").withField("n_chars", F.length("doc.text").cast(docs.schema["n_chars"].dataType)).alias("doc"))
    return found.where(~some).select("doc.*").unionByName(out.select("doc.*"))


#: DuckDB: each regex's matches and the pieces between them, positions by running sums.
_KIND = """
  {kind}_m AS (SELECT rid, list_filter(list_transform(generate_series(1, len(b)), lambda i: {{'kind': '{kind}', 'rank': {rank},
      'start': (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(b[1:i-1], lambda x: length(x))), 0))::BIGINT, 'body': b[i], 'value': {value}}}), lambda s: length(s.value) >= {least}) AS spans
    FROM (SELECT rid, regexp_extract_all(t, '{pattern}', 0{options}) AS b, {groups} AS v, regexp_split_to_array(t, '{pattern}'{options}) AS g FROM docs WHERE regexp_matches(t, '{pattern}'{options})))"""


def oracle_sql() -> str:
    assign = r"""(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = ",".join(
        _KIND.format(kind=kind, rank=rank, pattern=pattern, options=options, value=value, least=least, groups=groups)
        for kind, rank, pattern, options, value, least, groups in (
            ("assign", 0, assign, ", 'i'", "v[i]", ASSIGN_VALUE_MIN, f"regexp_extract_all(t, '{assign}', 2, 'i')"),
            ("access", 1, ACCESS, "", "b[i]", ACCESS_MIN, "NULL"),
            ("hex", 2, HEX, "", "b[i]", HEX_MIN, "NULL"),
        )
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),{kinds},
  flat AS (SELECT rid, unnest(spans) AS s FROM (SELECT * FROM assign_m UNION ALL SELECT * FROM access_m UNION ALL SELECT * FROM hex_m)),
  found AS (SELECT rid, s.kind AS kind, s.rank AS rank, s.start AS st, s.start + length(s.body) AS en, s.value AS value FROM flat),
  carried AS (SELECT DISTINCT value, coalesce(source, chr(0)) AS owner, coalesce(doc_id::VARCHAR, chr(0)) AS repository FROM found JOIN docs USING (rid)),
  owners AS (SELECT value, count(DISTINCT owner) <= {COPIED_OWNERS} AND count(*) <= {COPIED_REPOSITORIES} AS live FROM carried GROUP BY value),
  judged AS (SELECT found.*, live FROM found JOIN owners USING (value)),
  shown AS (SELECT rid, kind, rank, st, en FROM judged UNION ALL SELECT rid, 'live', 3, en - length(value), en FROM judged WHERE kind = 'assign' AND live),
  a AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
      string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, rank) AS base, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied FROM judged GROUP BY rid),
  b AS (SELECT rid, string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, rank) AS spans FROM shown GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM docs LEFT JOIN a USING (rid) LEFT JOIN b USING (rid)"""
