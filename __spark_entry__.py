
from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.operators import (
    bitmaps,
    components,
    cooccur,
    graphstats,
    groupstats,
    inverted,
    links,
    logs,
    pagerank,
    ranking,
    retrieval,
    words,
)
from corvane.functions.measures import log_sum_exp
from corvane.plans.scratch import scratch_path
from corvane.sources import ranges, sinks, tables, text
from corvane.sources.tables import (
    key_graph,
    line_fetcher,
    log,
    observations,
    part_links,
    purchase_flow,
    text_log,
)

try:
    import corpus_pipeline
    from corvane.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "corvane.llm"):
        raise
    llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared by the queries and their SQL.
SUPPORT = 10
WORDS = ["de", "the", "der"]
LOOKUP = ["Nicht", "quality", "thanedble"]
ASKED = ["the", "bronze", "gold", "de", "der"]
HISTOGRAM = ["the", "de"]
POSTFIX = {
    0: "the of AND",
    1: "de la AND un AND",
    2: "the der OR in AND und AND",
    3: "bronze the OR with AND from AND",
    4: "los las OR el un AND OR que AND",
}
# Docnos per shard of the index of document lines: 64 documents.
SHARD = 64 * tables.DOC_LINES
FROM_DAY, TO_DAY = date(2024, 1, 10), date(2024, 1, 20)
EVENT_KEYWORDS = "(?i)error|signup"
SOURCES = [6, 15]
ITERATIONS = 5
CONVERGED = 40
LOG_SCALE = 30.0
TOP = 10


# Session setting: tasks the documents are dealt over before they are split into lines,
# for a table of a single file. Unset, the splits of the files are left as they are.
LINE_PARTITIONS = "corvane.line.partitions"
# Two-hop neighbours are asked for every node whose id is divisible by this.
ASKED_EVERY = 50


def lines(spark: SparkSession, d: str) -> DataFrame:
    partitions = spark.conf.get(LINE_PARTITIONS, None)
    return tables.lines(spark, d, int(partitions) if partitions else None)


def entry(spark: SparkSession) -> DataFrame:
    """PMI of the term pairs of the document lines."""
    return _pmi(spark, "/root/testdata/sf0.001")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Floating-point results to six decimals, as in the SQL."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def _joined(df: DataFrame, name: str) -> DataFrame:
    """A list column as comma-separated text."""
    return df.withColumn(name, F.array_join(F.col(name).cast("array<string>"), ","))


def _pmi(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(cooccur.pmi(lines(spark, d), SUPPORT), "pmi")


def _index(spark: SparkSession, d: str) -> DataFrame:
    return inverted.build_inverted_index(lines(spark, d), SHARD)


def _gap_index(spark: SparkSession, d: str) -> DataFrame:
    index = inverted.store_index(_index(spark, d))
    return inverted.store_index(inverted.compress_postings(index), "gaps", replaces=[index])


def _index_rows(spark: SparkSession, d: str) -> DataFrame:
    return inverted.posting_rows(_index(spark, d))


_STORED: dict[tuple[str, str], str] = {}


def _index_path(spark: SparkSession, d: str) -> str:
    """The stored index of the lines: built by the first query of an application that asks
    for it, looked up in by all while its folder stands."""
    key = spark.sparkContext.applicationId, d
    if key not in _STORED or not sinks.index_stands(spark, _STORED[key]):
        path = scratch_path(spark, "index")
        sinks.write_index(_index(spark, d), path)
        _STORED[key] = path
    return _STORED[key]


def _collection(spark: SparkSession, d: str) -> str:
    """The lines in order as a text collection of several files."""
    ordered = lines(spark, d).repartitionByRange(8, "docno").sortWithinPartitions("docno")
    return _text_file(ordered.select("text"))


def _lookup_by_offset(spark: SparkSession, d: str) -> DataFrame:
    """Postings of a written collection, lines fetched by their byte offsets."""
    path = _collection(spark, d)
    index = inverted.build_inverted_index(text.read_lines(spark, path), 1 << 22)
    return retrieval.lookup_postings(index, ranges.line_reader(spark, path), LOOKUP).drop("docno")


def _prices(spark: SparkSession, d: str) -> DataFrame:
    """(k, v): prices of the lines of each supplier, as doubles."""
    return tables.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("k"), F.col("l_extendedprice").cast("double").alias("v"))


def _log_prices(spark: SparkSession, d: str) -> DataFrame:
    """Per part the log of a sum whose terms are too small for doubles."""
    items = tables.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("k"), (-F.col("l_extendedprice").cast("double") / LOG_SCALE).alias("log"))
    return _rounded(log_sum_exp(items, ["k"], "log", "log_sum"), "log_sum")


def _log_messages(spark: SparkSession, d: str) -> DataFrame:
    logs_of = pagerank.log_scores(_personalized(spark, d, SOURCES))
    return _rounded(pagerank.log_messages(*purchase_flow(spark, d), logs_of), "log_score")


def _repeated_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Parts and suppliers of the order lines as a node list that names ids several times."""
    listed = tables.table(spark, d, "lineitem").select(F.explode(F.array(
        F.col("l_partkey") * 3, F.col("l_suppkey") * 3 + 2)).alias("id"))
    return graphstats.repeated_nodes(listed)


def _text_file(df: DataFrame, compression: str = "none") -> str:
    """Path of the rows written as tab-separated text."""
    path = scratch_path(df.sparkSession, "text")
    sinks.write_text(df, path, compression=compression)
    return path


def _log_file(spark: SparkSession, d: str) -> str:
    records = text_log(spark, d).select(F.lit("id"), "date", F.lit("user"), "content")
    return _text_file(records)


def _batch(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.boolean_retrieval_batch(_index(spark, d), line_fetcher(spark, d), POSTFIX)


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose id is divisible by ASKED_EVERY."""
    parts = tables.table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    return parts.where(F.col("id") % ASKED_EVERY == 0)


def _adjacency_file(nodes: DataFrame, edges: DataFrame, sep: str) -> str:
    """Path of text lines: a node and the nodes its list names."""
    lists = edges.groupBy(F.col("src").alias("id")).agg(F.collect_list("dst").alias("nbrs"))
    named = F.coalesce("nbrs", F.array().cast("array<bigint>"))
    line = F.array_join(F.concat(F.array("id"), named).cast("array<string>"), sep)
    return _text_file(nodes.join(lists, "id", "left").select(line.alias("line")))


def _flow_from_adjacency(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return text.read_adjacency(spark, _adjacency_file(*purchase_flow(spark, d), " "))


def _links_from_adjacency(spark: SparkSession, d: str) -> DataFrame:
    edges = part_links(spark, d)
    nodes = edges.select(F.col("src").alias("id")).distinct()
    return text.read_adjacency(spark, _adjacency_file(nodes, edges, "\t"), tabs=True)[1]


def _flow_from_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    nodes, edges = purchase_flow(spark, d)
    path = scratch_path(spark, "records")
    sinks.write_records(edges, path, partitions=8)
    return nodes, sinks.read_records(spark, path)


def _resumed(spark: SparkSession, d: str) -> DataFrame:
    """Ranks of a run that was stopped after two iterations and resumed."""
    nodes, edges = purchase_flow(spark, d)
    base = scratch_path(spark, "states")
    pagerank.personalized_pagerank(nodes, edges, SOURCES, 2, base=base)
    return pagerank.personalized_pagerank(nodes, edges, SOURCES, ITERATIONS, base=base, start=2)


def _personalized(spark: SparkSession, d: str, sources: list[int]) -> DataFrame:
    nodes, edges = purchase_flow(spark, d)
    return pagerank.personalized_pagerank(nodes, edges, sources, ITERATIONS)


def _pagerank(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges = purchase_flow(spark, d)
    return pagerank.pagerank(nodes, edges, ITERATIONS)


def queries() -> dict[str, Query]:
    found = _library_queries()
    if llm is not None:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = _library_sql()
    if llm is not None:
        found |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _library_queries() -> dict[str, Query]:
    return {
        # Words.
        "word_count": lambda s, d: words.word_count(lines(s, d)),
        "word_count_from_text": lambda s, d: words.word_count(
            text.read_lines(s, _text_file(lines(s, d).select("text")))),
        "word_count_from_gzip": lambda s, d: words.word_count(
            text.read_text(s, _text_file(lines(s, d).select("text"), "gzip"), 16)),
        "word_count_alpha": lambda s, d: words.word_count_alpha(lines(s, d)),
        "document_frequency": lambda s, d: words.document_frequency(lines(s, d)),
        "term_frequency": lambda s, d: words.term_frequency(lines(s, d)),
        "vocabulary_size": lambda s, d: words.vocabulary_size(words.word_count(lines(s, d))),
        "vocabulary_size_alpha": lambda s, d: words.vocabulary_size(
            words.word_count_alpha(lines(s, d))),
        "vocabulary_edges": lambda s, d: words.vocabulary_edges(words.word_count(lines(s, d))),
        "vocabulary_edges_alpha": lambda s, d: words.vocabulary_edges(
            words.word_count_alpha(lines(s, d))),
        "term_recount": lambda s, d: words.term_recount(words.word_count(lines(s, d))),
        "term_ids_by_frequency": lambda s, d: words.term_ids_by_frequency(lines(s, d)),
        "term_ids_alphabetical": lambda s, d: words.term_ids_alphabetical(lines(s, d)),
        # Co-occurrence.
        "cooccurrence_pairs": lambda s, d: cooccur.cooccurrence_pairs(lines(s, d), SUPPORT),
        "cooccurrence_stripes": lambda s, d: cooccur.stripe_rows(
            cooccur.cooccurrence_stripes(lines(s, d), SUPPORT)),
        "pmi": _pmi,
        "max_pmi_pair": lambda s, d: _rounded(
            cooccur.max_pmi_pair(cooccur.pmi(lines(s, d), SUPPORT)), "pmi"),
        "top_pmi_for_word": lambda s, d: _rounded(
            cooccur.top_pmi_for_word(cooccur.pmi(lines(s, d), SUPPORT), WORDS), "pmi"),
        # Grouped statistics.
        "value_multiplicity": lambda s, d: groupstats.value_multiplicity(
            observations(s, d, "l_suppkey")),
        "group_mode": lambda s, d: groupstats.group_mode(observations(s, d, "l_suppkey")),
        "group_median": lambda s, d: groupstats.group_median(observations(s, d, "l_orderkey")),
        "group_median_compat": lambda s, d: groupstats.group_median_compat(
            observations(s, d, "l_orderkey")),
        "group_median_real": lambda s, d: _rounded(
            groupstats.group_median_real(_prices(s, d)), "median"),
        "group_median_real_compat": lambda s, d: _rounded(
            groupstats.group_median_real_compat(_prices(s, d)), "median"),
        "log_sum_exp": _log_prices,
        "group_max": lambda s, d: groupstats.group_max(observations(s, d, "l_partkey")),
        "group_max_from_text": lambda s, d: groupstats.group_max(
            text.read_observations(s, _text_file(observations(s, d, "l_partkey")))),
        "group_max_from_tsv": lambda s, d: groupstats.group_max(
            text.read_tsv(s, _text_file(observations(s, d, "l_partkey")), "k STRING, v INT")),
        # Index and retrieval.
        "build_inverted_index": lambda s, d: _index(s, d).select(
            "term", "df", "shard",
            F.array_join(F.transform("postings", lambda p: F.concat_ws(
                ":", p["docno"].cast("string"), p["tf"].cast("string"))), ",").alias("postings")),
        "posting_gaps": lambda s, d: inverted.posting_gaps(
            inverted.store_index(_index(s, d))),
        "restore_docnos": lambda s, d: inverted.restore_docnos(_gap_index(s, d)),
        "tf_histogram": lambda s, d: inverted.tf_histogram(_index(s, d)),
        "tf_histogram_of_terms": lambda s, d: inverted.tf_histogram(_index(s, d), HISTOGRAM),
        "lookup_postings": lambda s, d: retrieval.lookup_postings(
            sinks.find_terms(s, _index_path(s, d), LOOKUP), line_fetcher(s, d), LOOKUP),
        "lookup_postings_by_offset": _lookup_by_offset,
        "sorted_postings": lambda s, d: inverted.sorted_runs(lines(s, d), SHARD).select(
            "term", F.inline("postings")),
        "document_set": lambda s, d: retrieval.document_set(_index(s, d), WORDS[1]),
        "absent_terms": lambda s, d: retrieval.absent_terms(_index(s, d), ASKED),
        "boolean_retrieval": lambda s, d: retrieval.boolean_retrieval(
            _index(s, d), line_fetcher(s, d), POSTFIX[2]),
        "boolean_retrieval_batch": _batch,
        "boolean_retrieval_stored": lambda s, d: retrieval.boolean_retrieval_batch(
            sinks.find_terms(s, _index_path(s, d), [t for q in POSTFIX.values() for t in retrieval.query_terms(q)]),
            line_fetcher(s, d), POSTFIX),
        "stored_index_terms": lambda s, d: sinks.read_index(s, _index_path(s, d)).groupBy("term", "df").agg(
            F.count(F.lit(1)).alias("shards")),
        "boolean_retrieval_bitmaps": lambda s, d: bitmaps.boolean_retrieval_bitmaps(
            bitmaps.build_bitmap_index(lines(s, d)), line_fetcher(s, d), POSTFIX),
        # Logs.
        "hourly_counts": lambda s, d: logs.hourly_counts_between(log(s, d), FROM_DAY, TO_DAY),
        "hourly_counts_matching": lambda s, d: logs.hourly_counts_between(
            logs.matching(log(s, d), EVENT_KEYWORDS), FROM_DAY, TO_DAY),
        "hourly_counts_text": lambda s, d: logs.hourly_counts(
            text_log(s, d), (1, 10), (1, 20)),
        "hourly_counts_text_matching": lambda s, d: logs.hourly_counts_matching(
            text_log(s, d), EVENT_KEYWORDS, (1, 10), (1, 20)),
        "hourly_counts_from_text": lambda s, d: logs.hourly_counts(
            text.read_log(s, _log_file(s, d)), (1, 10), (1, 20)),
        "hourly_counts_padded": lambda s, d: logs.padded_keys(
            logs.hourly_counts(text_log(s, d), (1, 10), (1, 20))),
        # Graph counts and neighbourhoods.
        "graph_stats": lambda s, d: graphstats.graph_stats(*purchase_flow(s, d)),
        "graph_stats_from_adjacency": lambda s, d: graphstats.graph_stats(
            *_flow_from_adjacency(s, d)),
        "graph_stats_from_records": lambda s, d: graphstats.graph_stats(*_flow_from_records(s, d)),
        "message_stats": lambda s, d: graphstats.message_stats(*purchase_flow(s, d)),
        "repeated_nodes": _repeated_nodes,
        "edge_touched_nodes": lambda s, d: graphstats.edge_touched_nodes(purchase_flow(s, d)[1]),
        "two_hop_neighbors": lambda s, d: _joined(
            links.two_hop_neighbors(part_links(s, d), _asked(s, d)), "nbrs"),
        "two_hop_neighbors_strict": lambda s, d: _joined(
            links.two_hop_neighbors(part_links(s, d), _asked(s, d), exclude_direct=True), "nbrs"),
        "two_hop_neighbors_nonempty": lambda s, d: _joined(
            links.two_hop_neighbors_nonempty(part_links(s, d), _asked(s, d)), "nbrs"),
        "clustering_compat": lambda s, d: links.clustering_compat(part_links(s, d)),
        "clustering_coefficient": lambda s, d: _rounded(
            links.clustering_coefficient(part_links(s, d)), "lcc"),
        "clustering_from_adjacency": lambda s, d: _rounded(
            links.clustering_coefficient(_links_from_adjacency(s, d)), "lcc"),
        # Ranks and components.
        "build_rank_records": lambda s, d: pagerank.build_rank_records(
            purchase_flow(s, d)[0], SOURCES),
        "personalized_pagerank": lambda s, d: _rounded(_personalized(s, d, SOURCES[:1]), "score"),
        "personalized_pagerank_multi": lambda s, d: _rounded(
            _personalized(s, d, SOURCES), "score"),
        "personalized_pagerank_resumed": lambda s, d: _rounded(_resumed(s, d), "score"),
        "missing_mass": lambda s, d: _rounded(pagerank.missing_mass(
            *purchase_flow(s, d), _personalized(s, d, SOURCES)), "missing"),
        "log_scores": lambda s, d: _rounded(
            pagerank.log_scores(_personalized(s, d, SOURCES)), "log_score"),
        "top_n_per_source": lambda s, d: _rounded(
            ranking.top_n_per_source(_personalized(s, d, SOURCES), TOP), "score"),
        "top_report": lambda s, d: ranking.top_report(
            ranking.top_n_per_source(_personalized(s, d, SOURCES), TOP)),
        "pagerank": lambda s, d: _rounded(_pagerank(s, d), "score"),
        "pagerank_converged": lambda s, d: _rounded(
            pagerank.converged_pagerank(*purchase_flow(s, d), tol=1e-11), "score"),
        "log_messages": _log_messages,
        "rank_all": lambda s, d: _rounded(ranking.rank_all(_pagerank(s, d)), "score"),
        "dump_ranks": lambda s, d: pagerank.dump_ranks(
            _personalized(s, d, SOURCES), purchase_flow(s, d)[1]),
        "weakly_connected_components": lambda s, d: components.weakly_connected_components(
            *key_graph(s, d)),
        "component_count": lambda s, d: components.component_count(
            components.weakly_connected_components(*key_graph(s, d))),
    }


# --- SQL -------------------------------------------------------------------------

_LINES = f"""lines AS (
  SELECT doc_id * {tables.DOC_LINES} + line - 1 AS docno, parts[line] AS text
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)))"""

# The two tokenizers differ only in the vertical tab, which the second cuts at as well.
_TOKENS = _LINES + r""",
tok AS (
  SELECT docno, term FROM (
    SELECT docno, unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS term FROM lines)
  WHERE term <> '')"""
_INDEX_TOKENS = _LINES + r""",
tok AS (
  SELECT docno, term FROM (
    SELECT docno, unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS term FROM lines)
  WHERE term <> '')"""

_COUNTS = _TOKENS + ", counts AS (SELECT term, count(*) AS cnt FROM tok GROUP BY term)"
_ALPHA = _TOKENS + """, counts AS (
  SELECT term, count(*) AS cnt FROM tok WHERE regexp_full_match(term, '[A-Za-z]+') GROUP BY term)"""
_SIZE = "SELECT count(*) AS n FROM counts"
_EDGES_OF_COUNTS = """
SELECT 'first' AS place, term, cnt FROM (SELECT * FROM counts ORDER BY term LIMIT 1)
UNION ALL
SELECT 'last_3', term, cnt FROM (SELECT * FROM counts ORDER BY term DESC LIMIT 1 OFFSET 2)"""

_PMI = _TOKENS + f""",
dist AS (SELECT DISTINCT docno, term FROM tok),
df AS (SELECT term, count(*) AS df FROM dist GROUP BY term),
kept AS (SELECT docno, term, df FROM dist JOIN df USING (term) WHERE df >= {SUPPORT}),
half AS (
  SELECT x.term AS a, y.term AS b, any_value(x.df) AS da, any_value(y.df) AS db, count(*) AS n
  FROM kept x JOIN kept y ON x.docno = y.docno AND x.term < y.term
  GROUP BY x.term, y.term HAVING count(*) >= {SUPPORT}),
total AS (SELECT count(*) AS docs FROM lines),
scored AS (
  SELECT a, b, n, ln((docs::DOUBLE * n) / (da::DOUBLE * db)) AS pmi FROM half, total
  UNION ALL
  SELECT b, a, n, ln((docs::DOUBLE * n) / (da::DOUBLE * db)) FROM half, total)"""

_POSTINGS = _INDEX_TOKENS + f""",
tf AS (SELECT term, docno, count(*) AS tf FROM tok GROUP BY term, docno),
idx AS (SELECT term, count(*) OVER (PARTITION BY term) AS df, docno, tf,
               docno // {SHARD} AS shard FROM tf)"""


def _obs(key: str) -> str:
    return f"""obs AS (SELECT {key}::VARCHAR AS k, l_quantity::INT AS v FROM lineitem),
mult AS (SELECT k, v, count(*) AS n FROM obs GROUP BY k, v)"""


_PRICES = "obs AS (SELECT l_suppkey::VARCHAR AS k, l_extendedprice::DOUBLE AS v FROM lineitem)"

_RUNS = """,
runs AS (
  SELECT k, v, n, lag(v) OVER (PARTITION BY k ORDER BY v) AS prev,
         sum(n) OVER (PARTITION BY k ORDER BY v) AS upto,
         sum(n) OVER (PARTITION BY k) AS total
  FROM mult),
mids AS (SELECT *, total // 2 + 1 AS mid FROM runs
         WHERE upto >= total // 2 + 1 AND upto - n < total // 2 + 1)"""



def _in_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _postfix_sql(postfix: str) -> str:
    """The postfix query as set algebra over per-term document sets."""
    stack: list[str] = []
    for token in postfix.split():
        if token in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            op = "INTERSECT" if token == "AND" else "UNION"
            stack.append(f"(SELECT * FROM {left} {op} SELECT * FROM {right})")
        else:
            stack.append(f"(SELECT docno FROM tf WHERE term = '{token}')")
    return stack[0]


def _hours(where: str, day: str = "strftime(ts, '%-m/%-d')") -> str:
    return f"""SELECT {day} AS day, strftime(ts, '%H') AS hour, count(*) AS cnt
FROM events WHERE ts >= DATE '{FROM_DAY}' AND ts < DATE '{TO_DAY}' + INTERVAL 1 DAY {where}
GROUP BY ALL"""


_MATCH = "AND regexp_matches(concat_ws(' ', event_type, props), '(?i)error|signup')"

_NEXT = """nexts AS (
  SELECT DISTINCT x.l_partkey AS a, y.l_partkey AS b FROM lineitem x JOIN lineitem y
  ON x.l_orderkey = y.l_orderkey AND y.l_linenumber = x.l_linenumber + 1
  WHERE x.l_partkey <> y.l_partkey)"""

_FLOW = _NEXT + """,
nodes AS MATERIALIZED (
  SELECT p_partkey * 3 AS id FROM part UNION ALL SELECT c_custkey * 3 + 1 FROM customer),
edges AS MATERIALIZED (
  SELECT a * 3 AS src, b * 3 AS dst FROM nexts
  UNION ALL SELECT l_partkey * 3, o_custkey * 3 + 1
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT DISTINCT l_partkey * 3, l_suppkey * 3 + 2 FROM lineitem)"""

_PART_LINKS = _NEXT + """,
edges AS MATERIALIZED (SELECT a AS src, b AS dst FROM nexts UNION SELECT b, a FROM nexts),
pairs AS MATERIALIZED (
  SELECT DISTINCT x.dst AS node, y.dst AS nbr FROM edges x JOIN edges y
  ON x.src = y.src AND x.dst <> y.dst)"""


def _two_hop_sql(pairs: str, keep_empty: bool) -> str:
    rows = f"SELECT node, nbr FROM {pairs} WHERE node % {ASKED_EVERY} = 0"
    if keep_empty:
        rows += f" UNION ALL SELECT DISTINCT src, NULL::BIGINT FROM edges WHERE src % {ASKED_EVERY} = 0"
    return f"""SELECT node, coalesce(nbr // {links.SPAN}, 0) AS block,
  coalesce(string_agg(nbr::VARCHAR, ',' ORDER BY nbr), '') AS nbrs
FROM ({rows}) GROUP BY node, coalesce(nbr // {links.SPAN}, 0)"""


def _ranks_sql(sources: list[int], iterations: int) -> str:
    """Personalized PageRank, one block of common tables per iteration."""
    alpha = pagerank.ALPHA
    values = ", ".join(f"({s}::BIGINT)" for s in sources)
    ctes = [_FLOW, f"sources(source) AS (VALUES {values})",
            "outs AS MATERIALIZED (SELECT src, count(*) AS k FROM edges GROUP BY src)",
            """r0 AS MATERIALIZED (SELECT id, source,
  CASE WHEN id = source THEN 1.0::DOUBLE ELSE 0.0 END AS score FROM nodes CROSS JOIN sources)"""]
    for i in range(iterations):
        ctes.append(f"""s{i} AS (
  SELECT e.dst AS id, r.source, sum(r.score / o.k) AS m
  FROM r{i} r JOIN outs o ON o.src = r.id JOIN edges e ON e.src = r.id GROUP BY e.dst, r.source)""")
        ctes.append(f"""m{i} AS MATERIALIZED (
  SELECT n.id, q.source, coalesce(s.m, 0) AS m FROM nodes n CROSS JOIN sources q
  LEFT JOIN s{i} s ON s.id = n.id AND s.source = q.source)""")
        ctes.append(f"x{i} AS (SELECT source, 1 - sum(m) AS missing FROM m{i} GROUP BY source)")
        ctes.append(f"""r{i + 1} AS MATERIALIZED (
  SELECT id, source, (1 - {alpha}) * m + CASE WHEN id = source
    THEN {alpha} + (1 - {alpha}) * greatest(missing, 0) ELSE 0 END AS score
  FROM m{i} JOIN x{i} USING (source))""")
    ctes.append(f"ranks AS (SELECT source, id, score FROM r{iterations})")
    return "WITH " + ",\n".join(ctes)


def _pagerank_sql(iterations: int) -> str:
    """Global PageRank, one block of common tables per iteration."""
    alpha = pagerank.ALPHA
    ctes = [_FLOW, "v AS (SELECT count(*)::DOUBLE AS v FROM nodes)",
            "outs AS MATERIALIZED (SELECT src, count(*) AS k FROM edges GROUP BY src)",
            "r0 AS MATERIALIZED (SELECT id, 1 / v AS score FROM nodes, v)"]
    for i in range(iterations):
        ctes.append(f"""s{i} AS (
  SELECT e.dst AS id, sum(r.score / o.k) AS m
  FROM r{i} r JOIN outs o ON o.src = r.id JOIN edges e ON e.src = r.id GROUP BY e.dst)""")
        ctes.append(f"""m{i} AS MATERIALIZED (
  SELECT n.id, coalesce(s.m, 0) AS m FROM nodes n LEFT JOIN s{i} s ON s.id = n.id)""")
        ctes.append(f"x{i} AS (SELECT 1 - sum(m) AS missing FROM m{i})")
        ctes.append(f"""r{i + 1} AS MATERIALIZED (
  SELECT id, {alpha} / v + (1 - {alpha}) * (m + missing / v) AS score FROM m{i}, x{i}, v)""")
    ctes.append(f"ranks AS (SELECT id, score FROM r{iterations})")
    return "WITH " + ",\n".join(ctes)


def _components_sql(rounds: int) -> str:
    """Least id within ``rounds`` links; any two ids of a tree of depth 3 are nearer."""
    ctes = ["""nodes AS MATERIALIZED (
  SELECT r_regionkey::BIGINT * 6 AS id FROM region UNION ALL SELECT n_nationkey::BIGINT * 6 + 1 FROM nation
  UNION ALL SELECT c_custkey * 6 + 2 FROM customer UNION ALL SELECT s_suppkey * 6 + 3 FROM supplier
  UNION ALL SELECT o_orderkey * 6 + 4 FROM orders UNION ALL SELECT p_partkey * 6 + 5 FROM part)""",
            """fk AS (
  SELECT n_nationkey::BIGINT * 6 + 1 AS a, n_regionkey::BIGINT * 6 AS b FROM nation
  UNION ALL SELECT c_custkey * 6 + 2, c_nationkey::BIGINT * 6 + 1 FROM customer
  UNION ALL SELECT s_suppkey * 6 + 3, s_nationkey::BIGINT * 6 + 1 FROM supplier
  UNION ALL SELECT o_orderkey * 6 + 4, o_custkey * 6 + 2 FROM orders)""",
            """sym AS MATERIALIZED (
  SELECT a, b FROM fk UNION ALL SELECT b, a FROM fk UNION ALL SELECT id, id FROM nodes)""",
            "c0 AS (SELECT id, id AS comp FROM nodes)"]
    for i in range(rounds):
        ctes.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT a AS id, min(comp) AS comp FROM sym JOIN c{i} ON c{i}.id = b GROUP BY a)""")
    ctes.append(f"""comps AS (SELECT nodes.id, comp AS component
  FROM nodes JOIN c{rounds} ON c{rounds}.id = nodes.id)""")
    return "WITH " + ",\n".join(ctes)


def _library_sql() -> dict[str, str]:
    ranks1 = _ranks_sql(SOURCES[:1], ITERATIONS)
    ranks = _ranks_sql(SOURCES, ITERATIONS)
    further = _ranks_sql(SOURCES, ITERATIONS + 1)
    total = _pagerank_sql(ITERATIONS)
    comps = _components_sql(8)
    top = f"""SELECT source, rank, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, id) AS rank FROM ranks)
WHERE rank <= {TOP}"""
    strict = ("strict AS (SELECT node, nbr FROM pairs ANTI JOIN edges "
              "ON edges.src = node AND edges.dst = nbr)")
    counted = f"WITH {_COUNTS} SELECT term, cnt FROM counts"
    part_max = f"WITH {_obs('l_partkey')} SELECT k, max(v) AS max FROM obs GROUP BY k"
    found = f"WITH {_POSTINGS} " + " UNION ALL ".join(
        f"""SELECT {q}::INT AS qid, docno, text FROM lines
WHERE docno IN (SELECT * FROM {_postfix_sql(p)})""" for q, p in POSTFIX.items())
    stats = f"""WITH {_FLOW}
SELECT (SELECT count(*) FROM nodes) AS num_nodes, (SELECT count(*) FROM edges) AS num_edges,
  (SELECT count(*) FROM nodes WHERE id IN (SELECT src FROM edges)) AS num_active_nodes,
  (SELECT count(*) FROM nodes WHERE id NOT IN (SELECT src FROM edges)) AS num_dangling,
  (SELECT count(DISTINCT dst) FROM edges WHERE dst NOT IN (SELECT id FROM nodes))
    AS num_missing_targets"""
    clustering = f"""WITH {_PART_LINKS},
ks AS (SELECT src AS node, count(*) AS k FROM edges GROUP BY src),
found AS (
  SELECT e.src AS node, count(*) AS links FROM edges e JOIN edges f ON e.src = f.src AND e.dst < f.dst
  JOIN edges g ON g.src = e.dst AND g.dst = f.dst GROUP BY e.src)
SELECT node, coalesce(links, 0) AS links, k * (k - 1) // 2 AS possible,
  round(CASE WHEN k > 1 THEN coalesce(links, 0)::DOUBLE / (k * (k - 1) // 2) END, 6) AS lcc
FROM ks LEFT JOIN found USING (node)"""
    return {
        "word_count": counted,
        "word_count_from_text": counted,
        "word_count_from_gzip": counted,
        "word_count_alpha": f"WITH {_ALPHA} SELECT term, cnt FROM counts",
        "document_frequency": f"""WITH {_TOKENS}
SELECT term, count(DISTINCT docno) AS df FROM tok GROUP BY term""",
        "term_frequency": f"""WITH {_INDEX_TOKENS}
SELECT term, docno, count(*) AS tf FROM tok GROUP BY term, docno""",
        "vocabulary_size": f"WITH {_COUNTS} {_SIZE}",
        "vocabulary_size_alpha": f"WITH {_ALPHA} {_SIZE}",
        "vocabulary_edges": f"WITH {_COUNTS} {_EDGES_OF_COUNTS}",
        "vocabulary_edges_alpha": f"WITH {_ALPHA} {_EDGES_OF_COUNTS}",
        "term_recount": f"WITH {_TOKENS} SELECT DISTINCT term, 1::BIGINT AS n FROM tok",
        "term_ids_by_frequency": f"""WITH {_COUNTS}
SELECT term, row_number() OVER (ORDER BY cnt DESC, term) AS id FROM counts""",
        "term_ids_alphabetical": f"""WITH {_COUNTS}
SELECT term, row_number() OVER (ORDER BY term) AS id FROM counts""",
        "cooccurrence_pairs": f"WITH {_PMI} SELECT a, b, n FROM scored",
        "cooccurrence_stripes": f"WITH {_PMI} SELECT a, b, n FROM scored",
        "pmi": f"WITH {_PMI} SELECT a, b, n, round(pmi, 6) AS pmi FROM scored",
        "max_pmi_pair": f"""WITH {_PMI}, best AS (SELECT * FROM scored ORDER BY pmi DESC, a, b LIMIT 1)
SELECT a, b, round(pmi, 6) AS pmi FROM best""",
        "top_pmi_for_word": f"""WITH {_PMI}, best AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY pmi DESC, b) AS rank
  FROM scored WHERE a IN ({_in_list(WORDS)}))
SELECT a, rank::INT AS rank, b, round(pmi, 6) AS pmi FROM best WHERE rank <= 3""",
        "value_multiplicity": f"WITH {_obs('l_suppkey')} SELECT k, v, n FROM mult",
        "group_mode": f"""WITH {_obs('l_suppkey')}, best AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS place FROM mult)
SELECT k, v::BIGINT AS mode FROM best WHERE place = 1""",
        "group_median": f"""WITH {_obs('l_orderkey')}
SELECT k, trunc(median(v))::BIGINT AS median FROM obs GROUP BY k""",
        "group_median_compat": f"""WITH {_obs('l_orderkey')}{_RUNS}
SELECT k, (CASE WHEN total % 2 = 1 OR prev IS NULL OR 2 * upto < 2 * mid + n THEN v
                ELSE trunc((prev + v) / 2.0) END)::BIGINT AS median FROM mids""",
        "group_median_real": f"""WITH {_PRICES}
SELECT k, round(median(v), 6) AS median FROM obs GROUP BY k""",
        "group_median_real_compat": f"""WITH {_PRICES},
mult AS (SELECT k, v, count(*) AS n FROM obs GROUP BY k, v){_RUNS}
SELECT k, round(CASE WHEN total % 2 = 1 OR prev IS NULL OR 2 * upto < 2 * mid + n THEN v
                     ELSE (prev + v) / 2 END, 6) AS median FROM mids""",
        "log_sum_exp": f"""WITH logs AS (
  SELECT l_partkey AS k, -l_extendedprice::DOUBLE / {LOG_SCALE} AS v FROM lineitem),
tops AS (SELECT k, max(v) AS top FROM logs GROUP BY k)
SELECT k, round(top + ln(sum(exp(v - top))), 6) AS log_sum FROM logs JOIN tops USING (k) GROUP BY k, top""",
        "group_max": part_max,
        "group_max_from_text": part_max,
        "group_max_from_tsv": part_max,
        "build_inverted_index": f"""WITH {_POSTINGS}
SELECT term, df, shard, string_agg(docno || ':' || tf, ',' ORDER BY docno) AS postings
FROM idx GROUP BY term, df, shard""",
        "posting_gaps": f"""WITH {_POSTINGS}
SELECT term, docno, docno - lag(docno, 1, 0) OVER (PARTITION BY term ORDER BY docno) AS gap, tf
FROM idx""",
        "restore_docnos": f"WITH {_POSTINGS} SELECT term, docno, tf FROM idx",
        "tf_histogram": f"WITH {_POSTINGS} SELECT term, tf, count(*) AS n FROM tf GROUP BY term, tf",
        "tf_histogram_of_terms": f"""WITH {_POSTINGS}
SELECT term, tf, count(*) AS n FROM tf WHERE term IN ({_in_list(HISTOGRAM)}) GROUP BY term, tf""",
        "lookup_postings": f"""WITH {_POSTINGS}
SELECT term, df, docno, tf, text FROM idx JOIN lines USING (docno)
WHERE term IN ({_in_list(LOOKUP)})""",
        "lookup_postings_by_offset": f"""WITH {_POSTINGS}
SELECT term, df, tf, text FROM idx JOIN lines USING (docno) WHERE term IN ({_in_list(LOOKUP)})""",
        "sorted_postings": f"WITH {_POSTINGS} SELECT term, docno, tf FROM idx",
        "stored_index_terms": f"""WITH {_POSTINGS}
SELECT term, df, count(DISTINCT shard) AS shards FROM idx GROUP BY term, df""",
        "document_set": f"""WITH {_POSTINGS} SELECT docno FROM tf WHERE term = '{WORDS[1]}'""",
        "absent_terms": f"""WITH {_INDEX_TOKENS}
SELECT term FROM unnest([{_in_list(ASKED)}]) AS asked(term)
WHERE term NOT IN (SELECT term FROM tok)""",
        "boolean_retrieval": f"""WITH {_POSTINGS}
SELECT docno, text FROM lines WHERE docno IN (SELECT * FROM {_postfix_sql(POSTFIX[2])})""",
        "boolean_retrieval_batch": found,
        "boolean_retrieval_bitmaps": found,
        "boolean_retrieval_stored": found,
        "hourly_counts": _hours(""),
        "hourly_counts_matching": _hours(_MATCH),
        "hourly_counts_text": _hours(""),
        "hourly_counts_text_matching": _hours(_MATCH),
        "hourly_counts_from_text": _hours(""),
        "hourly_counts_padded": f"""SELECT day || ' ' || hour AS key, cnt
FROM ({_hours("", "strftime(ts, '%-m/%d')")})""",
        "graph_stats": stats,
        "graph_stats_from_adjacency": stats,
        "graph_stats_from_records": stats,
        "message_stats": f"""WITH {_FLOW}
SELECT count(*) AS messages_sent, count(DISTINCT dst) AS distinct_targets FROM edges
WHERE src IN (SELECT id FROM nodes)""",
        "repeated_nodes": """SELECT id, count(*) AS listed FROM (
  SELECT l_partkey * 3 AS id FROM lineitem UNION ALL SELECT l_suppkey * 3 + 2 FROM lineitem)
GROUP BY id HAVING count(*) > 1""",
        "edge_touched_nodes": f"""WITH {_FLOW}
SELECT src AS id FROM edges UNION SELECT dst FROM edges""",
        "two_hop_neighbors": f"WITH {_PART_LINKS} {_two_hop_sql('pairs', True)}",
        "two_hop_neighbors_strict": f"WITH {_PART_LINKS}, {strict} {_two_hop_sql('strict', True)}",
        "two_hop_neighbors_nonempty": f"WITH {_PART_LINKS} {_two_hop_sql('pairs', False)}",
        "clustering_compat": f"""WITH {_PART_LINKS},
ks AS (SELECT src AS node, count(*) AS k FROM edges GROUP BY src),
both_hops AS (SELECT node, count(*) AS n FROM pairs JOIN edges ON src = node AND dst = nbr GROUP BY node)
SELECT node, coalesce(n, 0) // 2 AS closed, k * (k + 1) // 2 AS possible
FROM ks LEFT JOIN both_hops USING (node)""",
        "clustering_coefficient": clustering,
        "clustering_from_adjacency": clustering,
        "build_rank_records": f"{ranks} SELECT id, source, score FROM r0",
        "personalized_pagerank": f"""{ranks1}
SELECT source, id, round(score, 6) AS score FROM ranks""",
        "personalized_pagerank_multi": f"""{ranks}
SELECT source, id, round(score, 6) AS score FROM ranks""",
        "personalized_pagerank_resumed": f"""{ranks}
SELECT source, id, round(score, 6) AS score FROM ranks""",
        "missing_mass": f"""{further}
SELECT source, round(missing, 6) AS missing FROM x{ITERATIONS}""",
        "log_scores": f"""{ranks}
SELECT source, id, round(ln(score), 6) AS log_score FROM ranks WHERE score > 0""",
        "top_n_per_source": f"""{ranks}
SELECT source, rank::INT AS rank, id, round(score, 6) AS score FROM ({top})""",
        "top_report": f"""{ranks}
SELECT source, rank::INT AS rank, printf('%.5f %d', score, id) AS line FROM ({top})
UNION ALL SELECT source, 0, 'Source: ' || source FROM sources""",
        "pagerank": f"{total} SELECT id, round(score, 6) AS score FROM ranks",
        "pagerank_converged": f"{_pagerank_sql(CONVERGED)} SELECT id, round(score, 6) AS score FROM ranks",
        "log_messages": f"""{further}
SELECT source, id, round(ln((1 - {pagerank.ALPHA}) * m), 6) AS log_score FROM m{ITERATIONS} WHERE m > 0""",
        "rank_all": f"{total} SELECT id, round(score, 6) AS score FROM ranks ORDER BY score DESC, id",
        "dump_ranks": f"""{ranks}, lists AS (
  SELECT src, dst // 1000000 AS block, string_agg(dst::VARCHAR, ' ' ORDER BY dst) AS nbrs
  FROM edges GROUP BY src, dst // 1000000)
SELECT concat_ws(chr(9), id::VARCHAR, source::VARCHAR, printf('%.6f', score),
  coalesce(block, 0)::VARCHAR, coalesce(nbrs, ''))
  AS value FROM ranks LEFT JOIN lists ON src = id""",
        "weakly_connected_components": f"{comps} SELECT id, component FROM comps",
        "component_count": f"{comps} SELECT count(DISTINCT component) AS n FROM comps",
    }
