import hashlib
import random

import numpy as np
import pytest

from corvane.llm import winnow


def gram_hashes(text, k):
    """The operator's gram hashes, one gram at a time: a gram alone has one hash."""
    if len(text) < k:
        return [int(winnow.winnow(text, k, 1)[0][0])]
    return [int(winnow.winnow(text[i:i + k], k, 1)[0][0]) for i in range(len(text) - k + 1)]


def plain(text, k, window):
    """Winnowing by its definition."""
    if not text:
        return []
    hashes = gram_hashes(text, k)
    width = min(window, len(hashes))
    chosen = set()
    for i in range(len(hashes) - width + 1):
        least = min(hashes[i:i + width])
        chosen.add(max(j for j in range(i, i + width) if hashes[j] == least))
    return [(hashes[j], j) for j in sorted(chosen)]


@pytest.mark.parametrize("window", [1, 2, 3, 7, 8, 32])
def test_by_definition(window):
    rng = random.Random(window)
    for n in (0, 1, 3, 4, 5, 9, 40, 150):
        for letters in ("ab", "abcdefghé😀 "):
            text = "".join(rng.choice(letters) for _ in range(n))
            hashes, places = winnow.winnow(text, 4, window)
            assert list(zip(hashes.tolist(), places.tolist())) == plain(text, 4, window)


def test_shared_passage_is_found():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(40))[:winnow.K + winnow.WINDOW - 1]
    one = " ".join(word() for _ in range(50)) + passage
    two = passage + " ".join(word() for _ in range(50))
    assert set(winnow.winnow(one)[0]) & set(winnow.winnow(two)[0])


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")


@pytest.mark.parametrize("parts", [1, 5])
def test_edit_report(spark, parts, monkeypatch):
    rng = random.Random(2)
    rows = [(i * 3, "".join(rng.choice("abc dé") for _ in range(rng.choice([0, 1, 3, 50, 400]))), "x")
            for i in range(40)]
    rows[7] = (rows[7][0], None, "x")
    rows[9] = (rows[9][0], rows[8][1], "x")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        shuffled = rows[:]
        rng.shuffle(shuffled)
        got = {r.doc_id: r for r in winnow.edit_report(table(spark, shuffled)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    for i, (doc_id, text, _) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited = text[:len(text) - m] + following[:m]
        r = got[doc_id]
        own, changed, other = (set(winnow.winnow(t)[0].tolist()) for t in (text, edited, following))
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == winnow.digest(*winnow.winnow(text))
        assert r.edited_fingerprint == winnow.digest(*winnow.winnow(edited))
        assert np.isclose(r.near_edited, like(own, changed)) and np.isclose(r.near_next, like(own, other))


def test_small_tables(spark):
    assert winnow.edit_report(table(spark, [])).count() == 0
    one = winnow.edit_report(table(spark, [(1, "abcdefgh", None)])).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert one[0].near_next == 1.0
    twice = winnow.edit_report(table(spark, [(1, "same", None), (1, "same", None), (None, "x", None)])).collect()
    assert len(twice) == 3


def test_positions_are_kept(spark):
    row = winnow.fingerprints(table(spark, [(1, "ab" * 100, "x")]).drop("fingerprint")).first()
    hashes, places = winnow.winnow("ab" * 100)
    assert row.hashes == hashes.tolist() and row.positions == places.tolist()
