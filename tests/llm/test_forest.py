import random
import re

import numpy as np
import pytest

from corvane.llm import forest


def shingles(text, words):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not tokens:
        return frozenset()
    if len(tokens) < words:
        return frozenset([tuple(tokens)])
    return frozenset(tuple(tokens[i:i + words]) for i in range(len(tokens) - words + 1))


def plain(rows, words, percent):
    """Components by comparing all pairs."""
    sets = [shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)}


def result(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(seed, groups, copies, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(length)]
        for _ in range(copies):
            text = base[:]
            for _ in range(rng.randint(0, max(1, length // 30))):
                text[rng.randrange(length)] = word()
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_all_pairs_agree(spark, words, percent):
    rows = near_copies(1, 8, 14, 120) + [(1000 + i, t) for i, t in near_copies(2, 12, 2, 9)]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words, percent)
    assert result(got) == plain(rows, words, percent)


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(forest.near_duplicates(docs)) == plain(rows, 3, 85)


def test_rows_of_any_kind(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É é"),
            (8, "é É"), (9, "w " * 400_000), (10, "w " * 300_000), (11, "a b c d e"), (12, "a b c d e"),
            (13, "same text here now"), (13, "same text here now")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows],
                                 "doc_id long, text string, node int, sig string")
    got = forest.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 1, 6, True), (7, 1, 7, True), (8, 1, 8, True), (9, 1, 9, True), (10, 1, 9, False),
        (11, 2, 11, True), (12, 3, 12, True), (13, 2, 13, True), (13, 2, 13, True)]
    assert forest.near_duplicates(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "x y z w"), (5, "a b c d")],
                                  "doc_id long, text string")
    assert sorted(map(str, result(forest.near_duplicates(nulls)))) == [
        "(5, 2, 5)", "(None, 2, 5)", "(None, 2, None)"]


def test_region_neighbours_left_open_are_settled(spark, monkeypatch):
    """With a single tree and no neighbours at all, the regions alone give the links."""
    monkeypatch.setattr(forest, "_neighbours", lambda nodes: spark.createDataFrame([], "a long, b long"))
    rows = near_copies(3, 4, 12, 100)
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == plain(rows, 3, 85)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    other = base.copy()
    other[:160] = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
    agree = (forest.signature(np.unique(base)) == forest.signature(np.unique(other))).mean()
    assert abs(agree - 1840 / 2160) < 0.2
    floor = forest.VALUES * 0.85 - 4 * (forest.VALUES * 0.85 * 0.15) ** 0.5
    assert floor - 1 < forest.agree_floor(85) <= floor


def test_settled_components_are_not_searched_again(spark, monkeypatch):
    """Rounds without a new link leave the components alone, others see only new links."""
    seen, search = [], forest.weakly_connected_components
    monkeypatch.setattr(forest, "weakly_connected_components",
                        lambda nodes, edges: seen.append(edges.count()) or search(nodes, edges))
    rows = near_copies(5, 5, 2, 60)
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == plain(rows, 3, 85) and len(seen) == 1
    seen.clear()
    rows = near_copies(1, 8, 14, 120)
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == plain(rows, 3, 85) and len(seen) > 1 and max(seen[1:]) < seen[0]
