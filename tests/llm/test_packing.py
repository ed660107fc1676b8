import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corvane.llm import packing, queries

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


def reference_ids(texts):
    coding = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coding.encode_special_tokens = True
    return [[*e.ids, 1] for e in coding.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def pieces_of(found):
    out = {}
    for r in found:
        out.setdefault(r.sequence_id, []).append(r)
    return {s: sorted(p, key=lambda r: r.offset) for s, p in out.items()}


def check_layout(found, capacity):
    """Sequences are gapless from 0 and no longer than they may be."""
    for parts in pieces_of(found).values():
        at = 0
        for r in parts:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity


def plain_first_fit(lengths, capacity):
    bins = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for held in bins:
            if sum(lengths[i] for i in held) + lengths[item] <= capacity:
                held.append(item)
                break
        else:
            bins.append([item])
    return bins


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_first_bin(seed):
    rnd = random.Random(seed)
    lengths = [rnd.choice([rnd.randint(1, 20), rnd.randint(1, 100)]) for _ in range(300)]
    assert packing.first_fit_decreasing(lengths, 100) == plain_first_fit(lengths, 100)


def test_tree_of_few_items():
    assert packing.first_fit_decreasing([], 10) == []
    assert packing.first_fit_decreasing([10], 10) == [[0]]
    assert packing.first_fit_decreasing([3, 3, 3, 3], 6) == [[0, 1], [2, 3]]


@pytest.mark.parametrize("seed", range(20))
def test_settling_keeps_every_id(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, 100) for _ in range(rnd.randint(1, 60))]
    bins = [[(i, 0, lengths[i]) for i in b] for b in packing.first_fit_decreasing(lengths, 100)]
    settled = packing.settle(bins, 100, 5)
    assert len(settled) <= len(bins)
    seen = {}
    for held in settled:
        assert 0 < sum(p[2] for p in held) <= 100
        for item, start, length in held:
            seen.setdefault(item, []).append((start, length))
    for item, length in enumerate(lengths):
        at = 0
        for start, part in sorted(seen[item]):
            assert start == at and part >= min(5, length)
            at += part
        assert at == length


def test_ids_are_those_of_the_tokenizers_file():
    encode = packing.encoder(RANKS, PATTERN)
    rnd = random.Random(3)
    letters = "ab 'sTl\n\t\r 12.,!-<|endoftext|>éß　 日本😀\x00\x1c\x85"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>", "x" * 5000, "don't  we'll\n\n\n "]
    assert [[*encode(t).tolist(), 1] for t in texts] == reference_ids(texts)


def test_query_over_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip((d.doc_id for d in docs), reference_ids([d.text for d in docs])))
    frame = queries.op11_packing(spark, SF)
    found = frame.collect()
    check_layout(found, 2048)
    covered = {}
    for r in found:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
    assert covered.keys() == ids.keys()
    for doc_id, parts in covered.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc_id])
    total = sum(map(len, ids.values()))
    used = [sum(r.length for r in parts) for parts in pieces_of(found).values()]
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in used)
    assert padded - total < 2048 + total * 0.005
    assert sorted(map(tuple, found)) == sorted(map(tuple, frame.collect()))


def test_edge_cases(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "abc", "y"), (None, "abc", "y"), (2, "word " * 30_000, "z"),
            (3, "é" * 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `sequence_id` string").repartition(3)
    found = packing.pack(docs, RANKS, PATTERN, capacity=64, least_cut=4, group_bytes=1000).collect()
    check_layout(found, 64)
    sizes = sorted(len(i) for i in reference_ids([r[1] for r in rows]))
    # Rows with one id are told apart by what they have in common with none.
    assert sum(r.length for r in found) == sum(sizes)
    assert sorted({r.doc_tokens for r in found}) == sorted(set(sizes))
    assert sum(r.length for r in found if r.doc_id == 1) == 2
    assert sum(r.length for r in found if r.doc_id is None) == 2 * len(reference_ids(["abc"])[0])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, RANKS, PATTERN).collect() == []


def test_small_groups_give_more_padding_but_whole_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = packing.pack(docs, RANKS, PATTERN).agg(F.sum("length")).first()[0]
    many = packing.pack(docs, RANKS, PATTERN, group_bytes=20_000).agg(F.sum("length")).first()[0]
    assert one == many


def test_sequences_are_padded(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string")
    pieces = packing.pack(docs, RANKS, PATTERN, capacity=16).cache()
    row = packing.sequences(pieces, 16, pad_id=7).collect()
    assert len(row) == 1 and row[0].used == 6
    ids = np.frombuffer(row[0].ids, "<u4").tolist()
    a, b = reference_ids(["a b c", "d"])
    assert ids[:6] in ([*a, *b], [*b, *a]) and ids[6:] == [7] * 10
    exact = packing.sequences(pieces.where("doc_id = 1"), 16).collect()[0]
    assert exact.used == 4 and len(exact.ids) == 16
    pieces.unpersist()
