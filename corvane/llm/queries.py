"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.llm import (
    decontaminate,
    forest,
    licenses,
    linedup,
    merkle,
    mixing,
    packing,
    ppm,
    render,
    secret_scan,
    toxicity,
    vectors,
    winnow,
)
from corvane.llm.common import held_out, learnt


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = ppm.learn(docs.where(learnt()).select("lang", "text"))
    found = ppm.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_report(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source`` owns a document and every document is a repository of its own."""
    docs = _table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs.select("doc_id", "text", "source"), owner="source", repository="doc_id")
    return secret_scan.digest(found)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(learnt()).select("doc_id", "toxic")
    scored = toxicity.classify(docs, toxicity.learn(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linedup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"))


def op13_vector_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.report(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_language_id, op2_document_fingerprints, op3_secret_scan, op4_toxicity,
        op5_license_scan, op6_line_dedup, op7_source_mixing, op8_html_extraction,
        op9_minhash_near_dedup, op10_benchmark_decontamination, op11_packing,
        op12_merkle_manifest, op13_vector_compression,
    )
}



def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _license_sql() -> str:
    """Every unit of every text against every template."""
    templates = ", ".join(f"({i}, {_text(name)}, {_text(body)})"
                          for i, (name, body) in enumerate(licenses.TEMPLATES))

    def grams(w: str) -> str:
        return f"list_distinct([{w}[i] || ' ' || {w}[i + 1] FOR i IN range(1, len({w}))])"

    return rf"""
WITH words AS (
  SELECT name, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') AS w
  FROM (VALUES {templates}) AS t(i, name, body)),
templates AS (SELECT name, {grams('w')} AS g FROM words),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT r, unnest(list_distinct(list_concat(string_split(text, chr(10)),
    string_split_regex(text, '\n[ \t\r]*\n')))) AS unit FROM docs),
pieces AS (SELECT r, unit, regexp_extract_all(lower(unit), '[\p{{L}}\p{{N}}]+') AS w FROM units),
grams AS (SELECT r, unit, {grams('w')} AS g FROM pieces WHERE len(w) > 1),
scored AS (
  SELECT r, unit, name, 2.0 * len(list_intersect(grams.g, templates.g))
    / (len(grams.g) + len(templates.g)) AS dice
  FROM grams JOIN templates ON list_has_any(grams.g, templates.g)),
best AS (
  SELECT r, name, dice FROM (
    SELECT *, row_number() OVER (PARTITION BY r, unit ORDER BY dice DESC, name) AS place FROM scored)
  WHERE place = 1 AND dice >= {licenses.LEAST_DICE}),
found AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM best GROUP BY r),
top AS (
  SELECT r, name, dice FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, name) AS place FROM best)
  WHERE place = 1)
SELECT doc_id, top.name AS license, round(coalesce(top.dice, 0.0)::DOUBLE, 6) AS dice,
  coalesce(names, '') AS licenses, coalesce(n, 0)::BIGINT AS n_matches
FROM docs LEFT JOIN found USING (r) LEFT JOIN top USING (r)"""


def _secret_sql() -> str:
    """Matches and the pieces between them, side by side, per kind."""
    kinds = [(secret_scan.ASSIGN, 1), (secret_scan.ACCESS, 0), (secret_scan.HEX, 0), (secret_scan.OTHER, 0)]
    matches = " UNION ALL ".join(f"""
  SELECT r, {kind} AS kind, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(vs) AS v,
    unnest(ps[:len(ms)]) AS p FROM (
    SELECT r, regexp_extract_all(text, {_text(pattern)}, 0) AS ms,
      regexp_extract_all(text, {_text(pattern)}, {group}) AS vs,
      string_split_regex(text, {_text(pattern)}) AS ps FROM docs) WHERE len(ms) > 0"""
                                for kind, (pattern, group) in enumerate(kinds))
    names = "[" + ", ".join(map(_text, secret_scan.KINDS)) + "]"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
matches AS ({matches}),
placed AS (
  SELECT r, kind, m, v, sum(length(p) + length(m)) OVER (PARTITION BY r, kind ORDER BY i)::BIGINT AS stop
  FROM matches),
every AS (
  SELECT r, kind, stop - length(m) AS start, stop, v FROM placed
  WHERE (kind = 0 AND length(v) >= {secret_scan.ASSIGN_LEAST}) OR kind IN (1, 2)
    OR (kind = 3 AND regexp_matches(v, '{secret_scan.LETTER}')
        AND regexp_matches(v, '{secret_scan.TWO_DIGITS}'))),
spans AS (
  SELECT * FROM every e WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM every b WHERE b.r = e.r AND b.kind < 3 AND b.start < e.stop AND e.start < b.stop)),
owners AS (
  SELECT v, count(DISTINCT source) BETWEEN 1 AND {secret_scan.MAX_OWNERS}
    AND count(DISTINCT doc_id) <= {secret_scan.MAX_REPOSITORIES} AS live
  FROM spans JOIN docs USING (r) GROUP BY v),
kept AS (
  SELECT r, kind, start, stop, live,
    {names}[kind + 1] || ':' || start || ':' || stop AS listed
  FROM spans JOIN owners USING (v) WHERE kind < 3 OR live),
sums AS (
  SELECT r, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1,
    count(*) FILTER (kind = 2) AS n2, count(*) FILTER (kind = 3) AS n3, count(*) FILTER (live) AS nl,
    string_agg(listed, ',' ORDER BY start, kind) AS spans,
    string_agg(listed, ',' ORDER BY start, kind) FILTER (kind < 3) AS base
  FROM kept GROUP BY r)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n3, 0) AS n_owned, coalesce(nl, 0) AS n_live
FROM docs LEFT JOIN sums USING (r)"""


def _near_sql() -> str:
    """Full sets joined on their shingles; components by reachability."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN string_split_regex(
    translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[\x20\x09-\x0D]+')
    IF x <> ''] AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
    END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {forest.PERCENT} * (a.n + b.n - count(*))),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least.c AS component_id, doc_id = least.c AS kept
FROM sets JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) AS least ON least.x = doc_id"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit; DuckDB has no function for it."""
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END"
    byte = f"list_reduce(list_concat([xor(a, b)], [0::BIGINT FOR k IN range(8)]), lambda c, k: {bit})"
    return (f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], "
            f"[ascii(x)::BIGINT FOR x IN string_split({text}, '')]), lambda a, b: {byte}))")


def _merkle_sql() -> str:
    """Levels of every tree as lists, then every leaf walked up to the root."""
    def fields(n_chars: str) -> str:
        return " || ".join(
            f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"
            for c in ("doc_id", "source", "documents.lang", n_chars, "text"))

    pairs = "[sha256(nodes[2 * i - 1] || coalesce(nodes[2 * i], '')) FOR i IN range(1, (len(nodes) + 1) // 2 + 1)]"
    return f"""
WITH RECURSIVE langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT lang FROM documents)),
leaves AS (
  SELECT doc_id, t, sha256({fields('n_chars')}) AS leaf,
    CASE WHEN coalesce({_crc32_sql('doc_id::VARCHAR')} % {merkle.TAMPER_EVERY} = 0, false)
      THEN sha256({fields('n_chars::HUGEINT + 1')}) ELSE sha256({fields('n_chars')}) END AS seen
  FROM documents JOIN langs ON documents.lang IS NOT DISTINCT FROM langs.lang),
placed AS (
  SELECT *, row_number() OVER () AS r,
    row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
level(t, h, nodes) AS (
  SELECT t, 0, list(leaf ORDER BY place) FROM placed GROUP BY t
  UNION ALL SELECT t, h + 1, {pairs} FROM level WHERE len(nodes) > 1),
subroots AS (SELECT t, nodes[1] AS subroot FROM level WHERE len(nodes) = 1),
top(h, nodes) AS (
  SELECT 1000, list(subroot ORDER BY t) FROM subroots
  UNION ALL SELECT h + 1, {pairs} FROM top WHERE len(nodes) > 1),
steps AS (
  SELECT t, row_number() OVER (PARTITION BY t ORDER BY h) - 1 AS s, h, nodes FROM (
    SELECT t, h, nodes FROM level WHERE len(nodes) > 1
    UNION ALL SELECT t, top.h, top.nodes FROM top CROSS JOIN langs WHERE len(top.nodes) > 1)),
walk(r, t, s, i, node, proof) AS (
  SELECT r, t, 0::BIGINT, place, seen, '' FROM placed
  UNION ALL
  SELECT r, t, s + 1, j // 2, sha256(CASE WHEN j % 2 = 1 THEN sibling || node ELSE node || sibling END), proof || sibling
  FROM (
    SELECT r, w.t, w.s, node, proof, j, coalesce(nodes[xor(j, 1) + 1], '') AS sibling
    FROM (SELECT walk.*, h, nodes, CASE WHEN h = 1000 THEN walk.t ELSE i END AS j
          FROM walk JOIN steps ON steps.t = walk.t AND steps.s = walk.s) AS w)),
ends AS (SELECT r, arg_max(node, s) AS folded, arg_max(proof, s) AS proof FROM walk GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed JOIN subroots USING (t) JOIN ends USING (r)
  CROSS JOIN (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1)"""


def _vector_sql() -> str:
    """Every part against every entry, component by component, in each round."""
    parts, entries = vectors.PARTS, vectors.ENTRIES
    steps = []
    for round_ in range(vectors.ROUNDS + 1):
        steps.append(f"""
assigned{round_} AS (
  SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS near FROM (
    SELECT vec_id, cells.p, e, sum((x - y) * (x - y))::BIGINT AS d
    FROM cells JOIN book{round_} AS b ON b.p = cells.p AND b.i = cells.i GROUP BY vec_id, cells.p, e)
  GROUP BY vec_id, p)""")
        if round_ < vectors.ROUNDS:
            steps.append(f"""
moved{round_} AS (
  SELECT cells.p, near.e AS e, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM cells JOIN assigned{round_} AS a ON a.vec_id = cells.vec_id AND a.p = cells.p GROUP BY cells.p, near.e, i),
book{round_ + 1} AS (
  SELECT b.p, b.e, b.i, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y
  FROM book{round_} AS b LEFT JOIN moved{round_} AS m ON m.p = b.p AND m.e = b.e AND m.i = b.i)""")
    last = vectors.ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, label, [floor({vectors.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
cells AS (
  SELECT vec_id, (k - 1) // (len(v) // {parts}) AS p, (k - 1) % (len(v) // {parts}) AS i, v[k] AS x
  FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS k FROM kept)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}),
book0 AS (SELECT p, e, i, x AS y FROM cells JOIN seeds USING (vec_id)),{','.join(steps)},
codes AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(near.e)), 2, '0'), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error
  FROM assigned{last} GROUP BY vec_id),
sums AS (SELECT label, sum(error)::BIGINT AS label_error FROM codes JOIN kept USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error,
  (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, i)) FROM book{last}) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id) JOIN sums ON sums.label IS NOT DISTINCT FROM kept.label"""


# The others have no SQL form: learned models, hashes DuckDB lacks, tree building,
# iterated scheduling. They are tested against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op3_secret_scan": _secret_sql(),
    "op5_license_scan": _license_sql(),
    "op9_minhash_near_dedup": _near_sql(),
    "op12_merkle_manifest": _merkle_sql(),
    "op13_vector_compression": _vector_sql(),
}
