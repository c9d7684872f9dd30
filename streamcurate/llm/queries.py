"""The registered queries of this subpackage and, where SQL can express them, their DuckDB form."""

from __future__ import annotations

from . import decontamination, embedding_dedup, fill_in_middle, language_id, merkle, ngram_join, packing, secret_scan, sharding, substring_dedup, suffix_dedup, token_counts, warc


def queries():
    return {
        "op1_superkmer_dedup": substring_dedup.query,
        "op2_arc_to_warc": warc.query,
        "op3_ngram_jaccard_join": ngram_join.query,
        "op4_secret_ownership": secret_scan.query,
        "op5_suffix_array_dedup": suffix_dedup.query,
        "op6_cross_polytope_dedup": embedding_dedup.query,
        "op7_benchmark_decontamination": decontamination.query,
        "op8_best_fit_packing": packing.query,
        "op9_separator_token_counts": token_counts.query,
        "op10_kneser_ney_language_id": language_id.query,
        "op11_weighted_hash_tree": sharding.query,
        "op12_merkle_manifest": merkle.query,
        "op13_fill_in_middle": fill_in_middle.query,
    }


SUBSTRING_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  win AS (SELECT rid, i, array_to_string(w[i:i + {substring_dedup.WINDOW - 1}], ' ') AS s FROM (SELECT rid, w, unnest(generate_series(1, len(w) - {substring_dedup.WINDOW - 1})) AS i FROM d)),
  dup AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
  hit AS (SELECT DISTINCT rid, unnest(generate_series(i, i + {substring_dedup.WINDOW - 1})) AS p FROM win JOIN dup USING (s)),
  word AS (SELECT rid, unnest(generate_series(1, len(w))) AS p, unnest(w) AS x FROM d),
  kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN hit USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""

#: Bytes as pairs of hex digits; strings of 400 bytes meet by MD5.
SUFFIX_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
  win AS (SELECT rid, i, md5(substr(h, 2 * i - 1, {2 * suffix_dedup.WINDOW})) AS s FROM (SELECT rid, h, unnest(generate_series(1, n - {suffix_dedup.WINDOW - 1})) AS i FROM d)),
  dup AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
  hit AS (SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS step FROM win SEMI JOIN dup USING (s)),
  isle AS (SELECT rid, i, count(*) FILTER (step IS NULL OR step > {suffix_dedup.WINDOW}) OVER (PARTITION BY rid ORDER BY i) AS k FROM hit),
  gone AS (SELECT rid, min(i) AS lo, max(i) + {suffix_dedup.WINDOW} AS hi FROM isle GROUP BY rid, k),
  cut AS (SELECT rid, lag(hi, 1, 1) OVER (PARTITION BY rid ORDER BY lo) AS a, lo AS b, hi, lead(lo) OVER (PARTITION BY rid ORDER BY lo) IS NULL AS last FROM gone),
  kept AS (SELECT rid, string_agg(substr(h, 2 * a - 1, 2 * (b - a)) || CASE WHEN last THEN substr(h, 2 * hi - 1) ELSE '' END, '' ORDER BY a) AS k, sum(hi - b)::BIGINT AS n_removed, count(*) AS n_spans FROM cut JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""

_COMPONENTS = """
  edge AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
  reach(x, y) AS (SELECT id, id FROM node UNION SELECT reach.x, edge.b FROM reach JOIN edge ON reach.y = edge.a),
  low AS (SELECT x AS id, min(y) AS class FROM reach GROUP BY x),
  links AS (SELECT a AS id, count(*) AS n FROM edge GROUP BY a)"""

NGRAM_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  node AS (SELECT id FROM d),
  gram AS (SELECT DISTINCT id, array_to_string(w[i:i + least({ngram_join.N}, len(w)) - 1], ' ') AS s
    FROM (SELECT id, w, unnest(generate_series(1, len(w) - least({ngram_join.N}, len(w)) + 1)) AS i FROM d WHERE len(w) > 0)),
  size AS (SELECT id, count(*) AS n FROM gram GROUP BY id),
  both_ AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM gram x JOIN gram y ON x.s = y.s AND x.id < y.id GROUP BY ALL),
  pair AS (SELECT a, b FROM both_ JOIN size p ON p.id = a JOIN size q ON q.id = b WHERE c >= {ngram_join.THRESHOLD} * (p.n + q.n - c)),
  set_ AS (SELECT id, string_agg(s, chr(10) ORDER BY s) AS t FROM gram GROUP BY id),
  copy AS (SELECT id, count(*) OVER (PARTITION BY t) AS n FROM set_),{_COMPONENTS}
SELECT node.id AS doc_id, coalesce(links.n, 0)::BIGINT AS n_links, coalesce(copy.n, 1)::BIGINT AS n_copies, class AS class_id, class = node.id AS kept
FROM node JOIN low USING (id) LEFT JOIN links USING (id) LEFT JOIN copy USING (id)"""

EMBEDDING_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings),
  node AS (SELECT id FROM v),
  pair AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id < y.id WHERE list_cosine_similarity(x.e, y.e) >= {embedding_dedup.THRESHOLD}),{_COMPONENTS}
SELECT node.id AS vec_id, coalesce(links.n, 0)::BIGINT AS n_links, class AS component_id, class = node.id AS kept FROM node JOIN low USING (id) LEFT JOIN links USING (id)"""


def oracle_sql():
    return {
        "op1_superkmer_dedup": SUBSTRING_SQL,
        "op2_arc_to_warc": warc.oracle_sql(),
        "op3_ngram_jaccard_join": NGRAM_SQL,
        "op4_secret_ownership": secret_scan.oracle_sql(),
        "op5_suffix_array_dedup": SUFFIX_SQL,
        "op6_cross_polytope_dedup": EMBEDDING_SQL,
        "op7_benchmark_decontamination": decontamination.oracle_sql(),
        "op11_weighted_hash_tree": sharding.oracle_sql(),
        "op12_merkle_manifest": merkle.oracle_sql(),
        "op13_fill_in_middle": fill_in_middle.oracle_sql(),
    }
