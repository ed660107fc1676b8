import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
import __spark_entry__ as entry  # noqa: E402
from check_oracle import KINDS, TABLES, normal  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
CHECKED = ["word_count_alpha", "term_ids_by_frequency", "pmi", "group_median_compat",
           "build_inverted_index", "restore_docnos", "boolean_retrieval_batch",
           "hourly_counts_text_matching", "two_hop_neighbors", "clustering_compat",
           "lookup_postings", "lookup_postings_by_offset", "boolean_retrieval_bitmaps", "sorted_postings",
           "stored_index_terms", "group_median_real", "group_median_real_compat", "log_sum_exp", "log_messages",
           "pagerank_converged", "repeated_nodes", "graph_stats_from_adjacency", "clustering_from_adjacency",
           "group_max_from_tsv", "message_stats", "personalized_pagerank_resumed", "dump_ranks",
           "personalized_pagerank_multi", "pagerank", "weakly_connected_components"]

needs_data = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


def test_every_query_has_sql():
    assert set(entry._library_queries()) == set(entry._library_sql())


@needs_data
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["a", "b", "n", "pmi"] and not df.isEmpty()


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    sql = entry.oracle_sql()[name]
    df = entry.queries()[name](spark, SF_DIR)
    types = {r[0]: KINDS.get(r[1], r[1]) for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert dict(df.dtypes) == types
    cols = sorted(df.columns)
    got = sorted(repr([normal(v) for v in r]) for r in df.select(cols).collect())
    want = sorted(repr([normal(v) for v in r])
                  for r in duck.execute(sql).df()[cols].itertuples(index=False, name=None))
    assert got == want
